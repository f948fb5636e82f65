"""Daily landing folder -> observation table, each file once."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daygrain.functions.columns import point
from daygrain.operators.consolidate import consolidate, recompile
from daygrain.session import cut, temporary
from daygrain.sinks.tables import finish_pending, read_day, write_time_range
from daygrain.sources import schemas
from daygrain.sources.snapshots import DATE_IN_PATH


def landing_stream(spark: SparkSession, landing: str, pattern: str = DATE_IN_PATH, schema: T.StructType = schemas.OBSERVATION) -> DataFrame:
    """New JSON arrays below ``landing`` with the date from their path; what does not parse fails the batch."""
    rows = (
        spark.readStream.schema(schema)
        .option("multiLine", "true")
        .option("mode", "FAILFAST")
        .option("recursiveFileLookup", "true")
        .option("timestampNTZFormat", schemas.ISO_INSTANT)
        .json(landing)
    )
    stamp = F.regexp_extract(F.col("_metadata.file_path"), pattern, 1)
    return rows.select("*", F.to_date(stamp, "yyyy-MM-dd").alias("file_date"))


def absorb(batch: DataFrame, table: str, time: str = "reportTime") -> None:
    """Fold one micro-batch into a day-partitioned table, its files in date order.

    Only the tail is written: the day the batch begins in and the days after it.
    """
    spark = batch.sparkSession
    with temporary(spark):
        parsed = cut(batch)
        first = parsed.agg(F.min(time).alias("t")).first().t
        if first is None:
            return
        finish_pending(spark, table)
        inside = recompile(parsed, "file_date", time, keys=())
        begun = read_day(spark, table, first.date())
        # The batch's first instant is never superseded: a later file that covers it begins with it.
        write_time_range(consolidate(begun, inside, time, begins=point(first)), table, time, first.date(), dt.date.max)


def run_available(stream: DataFrame, table: str, checkpoint: str, time: str = "reportTime"):
    """Process every file that has arrived, then stop. Call it again for the next day.

    A batch repeated after a failure first completes the write that was interrupted, then replaces
    its own tail and so changes nothing.
    """
    query = (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(lambda batch, _: absorb(batch, table, time))
        .start()
    )
    query.awaitTermination()
    return query
