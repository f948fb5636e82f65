"""Run queries beside their SQL and compare schemas, row counts and values.

    python -m proofs.check [--sf 0.01] [name …]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from daygrain.session import build_session, temporary  # noqa: E402
from proofs.queries import REGISTRY  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
KINDS = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp_ntz"}


def plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def compare(spark, con, folder: str, name: str) -> tuple[bool, str]:
    build, sql = REGISTRY[name]
    began = time.time()
    with temporary(spark):
        df = build(spark, folder)
        rows = df.collect()
    took = time.time() - began
    if sql is None:
        return False, f"{len(rows)} rows, no SQL to compare with, {took:.1f}s"
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    expected = found.fetchall()
    kinds = {r[0]: KINDS.get(r[1], r[1]) for r in con.execute("DESCRIBE " + sql).fetchall()}
    ours = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    notes = []
    if kinds != ours:
        notes.append(f"types differ: {sorted(set(kinds.items()) ^ set(ours.items()))}")
    if len(rows) != len(expected):
        notes.append(f"rows {len(rows)} vs {len(expected)}")
    columns = sorted(ours)
    if sorted(names) == columns:
        places = [names.index(c) for c in columns]
        left = sorted(tuple(plain(r[c]) for c in columns) for r in rows)
        right = sorted(tuple(plain(r[p]) for p in places) for r in expected)
        if left != right:
            pairs = [(a, b) for a, b in zip(left, right) if a != b]
            example = [(c, x, y) for c, x, y in zip(columns, *pairs[0]) if x != y] if pairs else ""
            notes.append(f"values differ in {len(pairs)} rows, e.g. {example}")
    return not notes, f"{len(rows)} rows, {took:.1f}s " + "; ".join(notes)


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("--folder", help="tables elsewhere, such as replicated ones")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    folder = args.folder or f"/root/testdata/sf{args.sf}"
    spark = build_session("check", "local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        path = f"{folder}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    bad = 0
    for name in args.names or REGISTRY:
        try:
            good, note = compare(spark, con, folder, name)
        except Exception as problem:  # noqa: BLE001 - report and go on
            good, note = False, f"{type(problem).__name__}: {str(problem)[:700]}"
        bad += not good
        print("ok  " if good else "FAIL", name, note, flush=True)
    print(f"{bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
