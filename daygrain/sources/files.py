"""Readers for landed CSV, JSON, Parquet and zip files.

Paths may be lists, globs or folders: many files are one read, never a loop.
"""

from __future__ import annotations

import csv
import io
import re
import zipfile
from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daygrain.functions.columns import in_range
from daygrain.session import ship
from daygrain.sources import schemas

Paths = str | list[str]


# --- parquet ----------------------------------------------------------------


def read_observations(spark: SparkSession, base: str, city: str, start=None, end=None) -> DataFrame:
    """Observations of one city from yearly sets; only the years of [start, end) are opened."""
    partitioned = T.StructType([*schemas.OBSERVATION.fields, T.StructField("city", T.StringType()), T.StructField("year", T.IntegerType())])
    rows = spark.read.schema(partitioned).parquet(base).where(F.col("city") == city)
    if start is not None and end is not None:
        rows = rows.where(F.col("year").between(start.year, end.year)).where(in_range(F.col("reportTime"), start, end))
    return rows.select(*schemas.OBSERVATION.names)


# --- csv --------------------------------------------------------------------


def strict_csv(spark: SparkSession, schema: T.StructType) -> DataFrameReader:
    """A CSV reader that pads and cuts no line: without pruning, each line's width is checked whatever is selected."""
    return spark.read.schema(schema).options(mode="FAILFAST", columnPruning="false")


def read_csv_text(spark: SparkSession, paths: Paths, names: list[str]) -> DataFrame:
    """CSV with a header line, every column as text; a line of another width raises."""
    return strict_csv(spark, schemas.strings(names)).csv(paths, header=True, enforceSchema=True)


def read_csv_typed(spark: SparkSession, paths: Paths, schema: T.StructType) -> DataFrame:
    """CSV with a header line and declared types; a value that does not fit raises."""
    return strict_csv(spark, schema).csv(paths, header=True)


def first_lines(spark: SparkSession, path: str, count: int) -> list[str]:
    """The first few lines of a file, from its first split only."""
    lines = spark.read.text(path).where(F.col("_metadata.file_block_start") == 0)
    return [row.value for row in lines.select("value").take(count)]


def unique_names(header: Sequence[str]) -> list[str]:
    """Header names with repeats told apart: x, x_duplicated_0, x_duplicated_1 …"""
    seen: dict[str, int] = {}
    names = []
    for name in header:
        again = seen.get(name)
        names.append(name if again is None else f"{name}_duplicated_{again}")
        seen[name] = 0 if again is None else again + 1
    return names


def read_csv_after_preamble(spark: SparkSession, path: str, skip: int) -> DataFrame:
    """CSV whose header follows ``skip`` title lines; every column as text.

    The header fixes the schema by position. Title and header lines are recognised by
    content, so the data itself stays splittable and is read once. A data line of another
    width raises; a line of a single cell is a note, and stays with the other columns NULL.
    """
    opening = [next(csv.reader([line]), []) for line in first_lines(spark, path, skip + 1)]
    names = unique_names(opening[-1])
    width = len(names)
    places = [f"_{i}" for i in range(width)]
    ragged = T.StructType([*schemas.strings(places).fields, T.StructField("__ragged", T.StringType())])
    rows = spark.read.schema(ragged).options(columnNameOfCorruptRecord="__ragged", columnPruning="false").csv(path, header=False)
    known = F.lit(False)
    for cells in opening:
        padded = [c if c != "" else None for c in (cells + [""] * width)[:width]]
        same = F.lit(True)
        for place, cell in zip(places, padded):
            same = same & F.col(place).eqNullSafe(F.lit(cell).cast("string"))
        known = known | same
    note = reduce(Column.__and__, [F.col(p).isNull() for p in places[1:]], F.lit(True))
    odd = F.raise_error(F.concat(F.lit(f"a line of {path} has not {width} fields: "), F.col("__ragged"))).cast("boolean")
    kept = rows.where(F.when(known, False).when(F.col("__ragged").isNotNull() & ~note, odd).otherwise(True))
    return kept.select(*places).toDF(*names)


def read_csv_named_apart(spark: SparkSession, paths: Paths, names_path: str) -> DataFrame:
    """Headerless CSV whose column names are the single row of another CSV."""
    names = list(spark.read.csv(names_path, header=False).first())
    return strict_csv(spark, schemas.strings(names)).csv(paths, header=False)


# --- json -------------------------------------------------------------------


def read_envelope(spark: SparkSession, paths: Paths, row: T.StructType, field: str = "rows") -> DataFrame:
    """JSON documents holding their rows in one array field; a broken document or a value of another type raises."""
    envelope = T.StructType([T.StructField(field, T.ArrayType(row))])
    return spark.read.schema(envelope).json(paths, multiLine=True, mode="FAILFAST").select(F.inline(field))


def read_schedule(spark: SparkSession, paths: Paths, start=None, end=None) -> DataFrame:
    """Nested schedule documents as one flat row per game; missing fields are NULL."""
    days = spark.read.schema(schemas.SCHEDULE).json(paths, multiLine=True, mode="FAILFAST").select(F.inline("dates"))
    days = days.withColumn("date", F.to_date("date", "yyyy-MM-dd"))
    if start is not None and end is not None:
        days = days.where(in_range(F.col("date"), start, end))
    games = days.select("date", F.explode("games").alias("g"))
    return games.select("date", *[F.col(f"g.{path}").alias(name) for name, path in schemas.SCHEDULE_COLUMNS.items()])


def read_observation_arrays(spark: SparkSession, paths: Paths) -> DataFrame:
    """JSON arrays of observations; the schema drops unknown keys and fills missing ones. What does not parse raises."""
    reader = spark.read.schema(schemas.OBSERVATION).option("timestampNTZFormat", schemas.ISO_INSTANT)
    return reader.json(paths, multiLine=True, mode="FAILFAST")


# --- zip --------------------------------------------------------------------


def _member_rows(width: int, encoding: str, pattern: str):
    wanted = re.compile(pattern)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for member in filter(wanted.search, archive.namelist()):
                        with archive.open(member) as raw:
                            reader = csv.reader(io.TextIOWrapper(raw, encoding=encoding, newline=""))
                            cells: list[list[str]] = []
                            for record in reader:
                                if record and len(record) != width:
                                    raise ValueError(f"line {reader.line_num} of {member} in {path} has {len(record)} fields, not {width}")
                                if record:
                                    cells.append(record)
                                if len(cells) == 4096:
                                    yield pd.DataFrame({"path": path, "member": member, "cells": cells})
                                    cells = []
                            if cells:
                                yield pd.DataFrame({"path": path, "member": member, "cells": cells})

    return run


def unzip_csv(archives: DataFrame, names: Sequence[str], encoding: str = "utf-8", members: str = r"(?i)\.(csv|txt)$") -> DataFrame:
    """Rows of the CSV members of zip files, given as (path, content).

    Archives are opened in parallel, one at a time per task, and leave in small batches. Only
    members whose name matches ``members`` are data; a record of another width raises.
    """
    ship(archives.sparkSession)
    cells = archives.select("path", "content").mapInPandas(_member_rows(len(names), encoding, members), "path string, member string, cells array<string>")
    columns = [F.nullif(F.get("cells", F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(names)]
    return cells.select("path", "member", *columns)


def read_zipped_csv(spark: SparkSession, paths: Paths, names: Sequence[str], encoding: str = "utf-8", members: str = r"(?i)\.(csv|txt)$") -> DataFrame:
    return unzip_csv(spark.read.format("binaryFile").load(paths), names, encoding, members)
