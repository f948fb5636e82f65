"""Averaged hashed subword embeddings under a linear softmax: training, calibration and scoring."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrain.llm.spans import IS_SPACE, Chunk, chunks
from daygrain.session import cut, ship

BITS = 16
#: Folds of the sample, and how many of them calibrate.
FOLDS, CALIBRATING = 3, 2
SIZES = (2, 3, 4)
#: Odd multipliers of the hash of each subword size.
MULTIPLIERS = {2: 2654435761, 3: 2246822519, 4: 3266489917}


def subwords(chunk: Chunk) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each size: where subwords start and their buckets.

    A subword is a run of bytes without white space inside; a space before or after a word counts
    as its edge. None reaches over the end of a text.
    """
    data = chunk.bytes
    space = IS_SPACE[data]
    plain = np.where(space, np.uint8(32), data).astype(np.uint32)
    ends = np.repeat(chunk.offsets[1:], np.diff(chunk.offsets))
    n = len(data)
    for size in SIZES:
        if n < size:
            continue
        count = n - size + 1
        good = ends[:count] - np.arange(count) >= size
        value = plain[:count].copy()
        for k in range(1, size):
            value |= plain[k : k + count] << np.uint32(8 * k)
            if k < size - 1:
                good &= ~space[k : k + count]
        at = np.flatnonzero(good)
        yield at, ((value[at] * np.uint32(MULTIPLIERS[size])) >> np.uint32(32 - BITS)).astype(np.int64)


def _scrambled(text: str) -> str:
    """The letters and marks of a text in random order, its white space where it was: junk with the same characters."""
    found = np.array(list(text))
    places = np.flatnonzero(~np.char.isspace(found)) if len(found) else np.zeros(0, int)
    found[places] = found[np.random.default_rng(zlib.crc32(text.encode(errors="replace"))).permutation(places)]
    return "".join(found)


def _bags(column: pa.Array) -> tuple[list[bytes], list[bytes]]:
    """For each text its buckets and their shares."""
    buckets, shares = [], []
    for chunk in chunks(column):
        found = list(subwords(chunk))
        for a, b in zip(chunk.offsets[:-1], chunk.offsets[1:]):
            own = [x[np.searchsorted(at, a) : np.searchsorted(at, b)] for at, x in found]
            bucket, count = np.unique(np.concatenate(own) if own else np.zeros(0, np.int64), return_counts=True)
            buckets.append(bucket.astype(np.int32).tobytes())
            shares.append((count / max(1, count.sum())).astype(np.float32).tobytes())
    return buckets, shares


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bags = [pa.array(x, pa.binary()) for x in _bags(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("label"), *bags], ["label", "buckets", "shares"])


def _measured(table: np.ndarray, bias: np.ndarray, seen: np.ndarray):
    """Raw scores and the share of familiar subwords of calibrating texts, as they are and scrambled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for junk, column in ((False, texts), (True, pa.array([_scrambled(t) for t in texts.to_pylist()], pa.string()))):
                bags = [(np.frombuffer(b, np.int32), np.frombuffer(s, np.float32)) for b, s in zip(*_bags(column))]
                raw = pa.array([(s @ table[b] + bias).tolist() for b, s in bags], pa.list_(pa.float64()))
                familiar = pa.array([float(s @ seen[b]) for b, s in bags], pa.float64())
                yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array([junk] * len(bags), pa.bool_()), raw, familiar], ["label", "junk", "raw", "familiar"])

    return run


@dataclass
class Model:
    """``table`` holds, for each bucket, what its embedding adds to the score of each label; ``seen`` the buckets of the training texts.

    A text is rejected if its score is below ``reject_below``, or the share of its subwords that were
    seen below ``least_familiar``. ``false_acceptance`` is the share of the scrambled calibration
    texts that pass both.
    """

    labels: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    reject_below: float
    seen: np.ndarray
    least_familiar: float = 0.0
    false_acceptance: float = 0.0


def sample(labelled: DataFrame, per_label: float) -> DataFrame:
    """About ``per_label`` rows of each label of (doc_id, text, label), chosen by a hash of doc_id.

    The labels are the outputs of the model, so their counts are few.
    """
    counts = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = F.lit(0.0)
    for label, n in counts.items():
        share = F.when(F.col("label") == label, min(1.0, per_label / n)).otherwise(share)
    place = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 30)) / float(1 << 30)
    return labelled.where(place < share).withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(FOLDS)).cast("int"))


def train(labelled: DataFrame, per_label: int, dims: int = 16, epochs: int = 10, rate: float = 0.5, reject: float = 0.001, accept: float = 0.01) -> Model:
    """Fit on a bounded sample of (doc_id, text, label): ``per_label`` whole texts of each label to learn from, twice as many to calibrate.

    The calibrating texts settle the temperature of the softmax and what is rejected. They are
    scrambled too, which gives junk of the same characters. A text is rejected for its score if
    ``reject`` of the calibrating texts lie lower; and for its subwords if fewer of them were seen in
    training than in all but ``accept`` of the junk, but no more than ``reject`` of the calibrating texts either.
    Only the bags of the learning texts and the scores of the others are collected.
    Without labelled rows the model has no label and rejects everything.
    """
    ship(labelled.sparkSession)
    some = cut(sample(labelled.where("label IS NOT NULL AND text IS NOT NULL"), per_label * FOLDS / (FOLDS - CALIBRATING)).select("text", "label", "fold"))
    # Too few texts to hold any back: all of them learn, and calibrate as well.
    few = some.count() < 60
    own = some if few else some.where(F.col("fold") >= CALIBRATING)
    rows = own.mapInArrow(_features, "label string, buckets binary, shares binary").toPandas()
    # A fixed order, whatever the partitions came back in.
    rows = rows.sort_values(["label", "buckets", "shares"], ignore_index=True)
    labels = sorted(set(rows["label"]))
    if not labels:
        return Model([], np.zeros((1 << BITS, 0)), np.zeros(0), 1.0, 1.0, np.zeros(1 << BITS))
    index = {x: k for k, x in enumerate(labels)}
    data = [(np.frombuffer(b, np.int32), np.frombuffer(s, np.float32), index[y]) for b, s, y in zip(rows["buckets"], rows["shares"], rows["label"])]
    random = np.random.default_rng(5)
    embeddings = random.normal(0, 1, (1 << BITS, dims)).astype(np.float32)
    weights, bias = np.zeros((dims, len(labels)), np.float32), np.zeros(len(labels), np.float32)
    steps, step = epochs * len(data), 0
    for _ in range(epochs):
        for k in random.permutation(len(data)):
            buckets, shares, y = data[k]
            now = rate * (1 - step / steps)
            step += 1
            mean = shares @ embeddings[buckets] if len(buckets) else np.zeros(dims, np.float32)
            wrong = _softmax(mean @ weights + bias)
            wrong[y] -= 1
            back = weights @ wrong
            weights -= now * np.outer(mean, wrong)
            bias -= 0.1 * now * wrong
            if len(buckets):
                # Shares are about 1 / length: times the length, a bucket moves at the pace of the weights, less a margin for stability.
                embeddings[buckets] -= (0.2 * now * shares * len(buckets))[:, None] * back
    table = (embeddings @ weights).astype(np.float64)
    seen = np.zeros(1 << BITS)
    for buckets, _, _ in data:
        seen[buckets] = 1.0
    held = some if few else some.where(F.col("fold") < CALIBRATING)
    held = held.where(F.col("label").isin(labels)).mapInArrow(_measured(table, bias.astype(np.float64), seen), "label string, junk boolean, raw array<double>, familiar double")
    held = held.toPandas().sort_values(["label", "junk", "familiar"], ignore_index=True, kind="stable")
    junk, familiar = held["junk"].to_numpy(bool), held["familiar"].to_numpy(float)
    raw = np.stack(held["raw"].to_numpy()) if len(held) else np.zeros((0, len(labels)))
    truth = np.array([index[y] for y in held["label"]], int)
    grid = np.geomspace(0.5, 20, 40)
    if junk.all():
        return Model(labels, table, bias.astype(np.float64), 1.0, 0.0, seen)
    losses = [-np.log(np.maximum(_shares(raw / t)[~junk, truth[~junk]], 1e-9)).mean() for t in grid]
    temperature = float(grid[int(np.argmin(losses))])
    sure = _shares(raw / temperature).max(axis=1)
    reject_below = float(np.quantile(sure[~junk], reject, method="lower"))
    least = min(float(np.quantile(familiar[~junk], reject, method="lower")), float(np.quantile(familiar[junk], 1 - accept)))
    passed = float(((sure >= reject_below) & (familiar >= least))[junk].mean())
    return Model(labels, table, bias.astype(np.float64), temperature, reject_below, seen, least, passed)


def _shares(raw: np.ndarray) -> np.ndarray:
    e = np.exp(raw - raw.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


def _scored(model: Model):
    # Beside the labels' columns, the share of the subwords that were seen.
    table = [*(np.ascontiguousarray(model.table[:, k]) for k in range(len(model.labels))), model.seen]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, score, shares, familiar = [], [], [], []
            for chunk in chunks(batch.column("text")):
                total, count = np.zeros((chunk.rows, len(table))), np.zeros(chunk.rows)
                for at, buckets in subwords(chunk):
                    first = np.searchsorted(at, chunk.offsets)
                    some = np.flatnonzero(first[1:] > first[:-1])
                    count += np.diff(first)
                    for k, own in enumerate(table):
                        if len(some):
                            total[some, k] += np.add.reduceat(own[buckets], first[:-1][some])
                total /= np.maximum(count, 1)[:, None]
                familiar += total[:, -1].tolist()
                raw = (total[:, :-1] + model.bias) / model.temperature
                share = _shares(raw)
                label += [model.labels[k] for k in share.argmax(axis=1)]
                score += share.max(axis=1).tolist()
                shares += share.tolist()
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(label, pa.string()), pa.array(score, pa.float64()), pa.array(shares, pa.list_(pa.float64())), pa.array(familiar, pa.float64())], ["key", "label", "score", "shares", "familiar"])

    return run


def score(texts: DataFrame, model: Model, key: Column, key_type: str) -> DataFrame:
    """(key, label, score, shares, familiar) of each whole text: the best label, its probability, those of all labels, and the share of its subwords that training saw."""
    ship(texts.sparkSession)
    rows = texts.select(key.alias("key"), "text")
    if not model.labels:
        return rows.select("key", F.lit(None).cast("string").alias("label"), F.lit(0.0).alias("score"), F.lit(None).cast("array<double>").alias("shares"), F.lit(0.0).alias("familiar"))
    return rows.mapInArrow(_scored(model), f"key {key_type}, label string, score double, shares array<double>, familiar double")
