"""Copy the tables n times with shifted keys, to see how queries scale.

    python -m proofs.replicate /root/testdata/sf0.1 /tmp/run-x/sf0.1x10 10

With --hot a third of all copied orders goes to one customer.
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from daygrain.session import build_session

KEYS = {"orders": "o_orderkey", "lineitem": "l_orderkey", "events": "event_id"}


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("source")
    parser.add_argument("target")
    parser.add_argument("copies", type=int)
    parser.add_argument("--hot", action="store_true")
    args = parser.parse_args()
    spark = build_session("replicate", "local[8]", 8)
    copies = spark.range(args.copies).select(F.col("id").alias("copy"))
    for table in ("region", "nation", "customer", "supplier", "part"):
        spark.read.parquet(f"{args.source}/{table}.parquet").write.parquet(f"{args.target}/{table}.parquet")
    for table, key in KEYS.items():
        df = spark.read.parquet(f"{args.source}/{table}.parquet")
        shift = df.agg(F.max(key)).first()[0] + 1
        grown = df.crossJoin(F.broadcast(copies)).withColumn(key, F.col(key) + F.col("copy") * shift).drop("copy")
        if args.hot and table == "orders":
            grown = grown.withColumn("o_custkey", F.when(F.pmod(F.xxhash64(key), F.lit(3)) == 0, F.lit(7)).otherwise(F.col("o_custkey")))
        grown.repartition(32).write.parquet(f"{args.target}/{table}.parquet")
    spark.stop()


if __name__ == "__main__":
    main()
