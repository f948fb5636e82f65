"""Landing copies: the tables written as the file kinds the readers expect.

Python only frames documents per Arrow batch; rows are serialised in the JVM.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def land_documents(rows: DataFrame, path: str, opening: str, closing: str, stamp: str | None = None) -> None:
    """Column ``doc`` (JSON text) joined into documents, one file per batch and stamp."""

    def frame(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            groups = batch.groupby(stamp) if stamp else [(None, batch)]
            for value, group in groups:
                text = opening + ",".join(group["doc"]) + closing
                yield pd.DataFrame({"value": [text], **({stamp: [value]} if stamp else {})})

    schema = "value string" + (f", {stamp} string" if stamp else "")
    writer = rows.select("doc", *([stamp] if stamp else [])).mapInPandas(frame, schema).write.option("maxRecordsPerFile", 1)
    (writer.partitionBy(stamp) if stamp else writer).text(path)


def land_lines(rows: DataFrame, path: str, preamble: list[str]) -> None:
    """Column ``line`` as text files that each begin with the preamble."""

    def frame(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"value": preamble})
        for batch in batches:
            yield pd.DataFrame({"value": batch["line"]})

    rows.select("line").mapInPandas(frame, "value string").write.text(path)


def zipped(rows: DataFrame, name: str) -> DataFrame:
    """Column ``line`` packed into zip archives, one per batch, as (path, content)."""

    def frame(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            buffer = io.BytesIO()
            with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
                archive.writestr(f"{name}.csv", "\r\n".join(batch["line"]) + "\r\n")
            yield pd.DataFrame({"path": [f"{name}.zip"], "content": [buffer.getvalue()]})

    return rows.select("line").mapInPandas(frame, "path string, content binary")


def json_rows(df: DataFrame) -> DataFrame:
    """Each row as JSON text in ``doc``, absent fields left out."""
    return df.select("*", F.to_json(F.struct(*df.columns)).alias("doc"))
