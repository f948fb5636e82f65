"""Vectors of integers in blocks: what the exact searches share.

A vector travels as the bytes of its integers, and many vectors of one length as one row, so that a
query block and an index block meet as two matrices.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE = 256
#: Below these, sums of products are exact in float32, in float64 and in 64-bit integers.
EXACT_32, EXACT_64, EXACT_INT = 2**24, 2**53, 2**63
ROW = "vec_id bigint, label bigint, dims int, wide boolean, norm2 double, body binary"


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        table = pa.Table.from_batches([batch]).filter(pc.is_valid(batch.column("embedding")))
        if not len(table):
            continue
        lists = table.column("embedding").combine_chunks()
        length = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        x = pc.cast(pc.list_flatten(lists), pa.float64()).to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(length)), length)
        good = np.bincount(row[~np.isfinite(x)], minlength=len(length)) == 0
        x = np.floor(SCALE * x)
        top = np.zeros(len(length))
        kept = good[row]
        np.maximum.at(top, row[kept], np.abs(x[kept]))
        if top.max(initial=0) >= 2**62:
            raise OverflowError("a component times 256 does not fit into 62 bits")
        norm2 = np.bincount(row[kept], x[kept] ** 2, len(length))
        for wide, kind in ((False, np.int32), (True, np.int64)):
            picked = good & ((top >= 2**31) == wide)
            if not picked.any():
                continue
            data = x[picked[row]].astype(kind)
            ends = np.concatenate(([0], np.cumsum(length[picked] * data.itemsize))).astype(np.int32)
            body = pa.Array.from_buffers(pa.binary(), int(picked.sum()), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data.tobytes())])
            rows = table.filter(pa.array(picked))
            columns = [rows.column("vec_id"), rows.column("label"), pa.array(length[picked].astype(np.int32)), pa.array(np.full(len(rows), wide)), pa.array(norm2[picked]), body]
            yield pa.table(columns, ["vec_id", "label", "dims", "wide", "norm2", "body"]).combine_chunks().to_batches()[0]


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, dims, wide, norm2, body): each component x as floor(256 * x) with x in double.

    Rows with a null id, a null vector or a null or non-finite component are left out. ``body`` has 32-bit
    integers, or 64-bit ones in a ``wide`` row. An empty vector is one of no components.
    """
    label = F.col("label").cast("bigint") if "label" in vectors.columns else F.lit(None).cast("bigint")
    rows = vectors.where("vec_id IS NOT NULL").select(F.col("vec_id").cast("bigint").alias("vec_id"), label.alias("label"), "embedding")
    return rows.mapInArrow(_whole, ROW)


def matrix(bodies: list[bytes] | bytes, rows: int, dims: int, wide: bool) -> np.ndarray:
    data = bodies if isinstance(bodies, bytes) else b"".join(bodies)
    return np.frombuffer(data, np.int64 if wide else np.int32).reshape(rows, dims)


def most(values: np.ndarray) -> int:
    return max(int(values.max(initial=0)), -int(values.min(initial=0)))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products of the rows of two integer matrices, exact, in the fastest arithmetic that holds them."""
    bound = most(a) * most(b) * a.shape[1]
    if bound < EXACT_32:
        return (a.astype(np.float32) @ b.astype(np.float32).T).astype(np.int64)
    if bound < EXACT_64:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if bound < EXACT_INT:
        return a.astype(np.int64) @ b.astype(np.int64).T
    exact = a.astype(object) @ b.astype(object).T
    if any(abs(v) >= EXACT_INT for v in exact.ravel()):
        raise OverflowError("an inner product does not fit into 64 bits")
    return exact.astype(np.int64)


def cut_blocks(values: int, keys: list[str], build: Callable[[pd.DataFrame, np.ndarray], dict]) -> Callable:
    """For mapInPandas: a row for each run of equal ``keys``, of at most ``values`` components; ``build`` adds columns.

    Runs end with their batch. ``block`` is unique, and the same when a task is run again.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            if not len(batch):
                continue
            out = []
            new = np.zeros(len(batch), bool)
            new[0] = True
            for key in keys:
                column = batch[key].to_numpy()
                new[1:] |= column[1:] != column[:-1]
            edges = np.append(np.flatnonzero(new), len(batch))
            for a, b in zip(edges[:-1], edges[1:]):
                step = max(1, values // max(1, int(batch["dims"].iloc[a])))
                for at in range(a, b, step):
                    part = batch.iloc[at : min(b, at + step)]
                    dims, wide = int(part["dims"].iloc[0]), bool(part["wide"].iloc[0])
                    body = b"".join(part["body"])
                    row = {"block": number, "n": len(part), "ids": part["vec_id"].to_numpy(np.int64).tobytes(), "body": body, **{k: part[k].iloc[0] for k in keys}}
                    out.append(row | build(part, matrix(body, len(part), dims, wide)))
                    number += 1
            yield pd.DataFrame(out)

    return run


class Best:
    """The ``k`` best (score, id) of each of many rows: higher scores first, then smaller ids."""

    def __init__(self, rows: int, k: int, floor: np.ndarray | None = None):
        self.k, self.rows = k, rows
        #: No partner with a lower score can be among the best of the row.
        self.least = np.full(rows, np.iinfo(np.int64).min) if floor is None else floor.copy()
        self.found = [np.zeros(0, np.int64)] * 3

    def add(self, row: np.ndarray, score: np.ndarray, partner: np.ndarray) -> None:
        if not len(row):
            return
        row, score, partner = (np.concatenate(x) for x in zip(self.found, (row, score, partner)))
        order = np.lexsort((partner, -score, row))
        row, score, partner = row[order], score[order], partner[order]
        first = np.searchsorted(row, np.arange(self.rows))
        place = np.arange(len(row)) - first[row]
        kept = place < self.k
        last = place == self.k - 1
        self.least[row[last]] = np.maximum(self.least[row[last]], score[last])
        self.found = [row[kept], score[kept], partner[kept]]
