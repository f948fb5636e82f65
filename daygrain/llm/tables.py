"""Where the queries and the pipeline take their inputs from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """The place of a public tokenizer's file on this machine; the package that has it is on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def unused(columns: list[str], *names: str) -> list[str]:
    """The names, each with as many underscores after it as tell it from all ``columns``, in any letter case."""
    taken, found = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found
