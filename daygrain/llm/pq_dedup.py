"""Embedding near-duplicates: inverted lists with product-quantised residuals, table-lookup distances, exact rerank."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.llm.components import components
from daygrain.session import cut, ship

COSINE = 0.9
#: The index is fitted on no more vectors than these, taken by a hash of their id; every vector is indexed.
SAMPLE = 32768
#: A list holds about so many vectors. Beyond COARSE lists each is divided by the same FINE residual centres at most, so
#: that 4 million lists are fitted on the one sample; a list that is larger all the same is split into blocks.
LIST_SIZE, COARSE, FINE = 256, 2048, 2048
#: A vector probes the square root of the number of lists, and no less than these.
PROBES = 12
SUBSPACES, CODES = 8, 256
#: Vectors of a list, and queries, that meet in one task at a time.
BLOCK, QUERIES = 2048, 4096


@dataclass
class Index:
    """List a * len(``fine``) + b has the centre ``coarse[a] + fine[b]``; for each subspace of the residuals there is a book of code vectors."""

    coarse: np.ndarray
    fine: np.ndarray
    parts: list[np.ndarray]
    books: list[np.ndarray]

    @property
    def lists(self) -> int:
        return len(self.coarse) * len(self.fine)

    @property
    def probes(self) -> int:
        return min(self.lists, max(PROBES, math.isqrt(self.lists - 1) + 1))

    def centre(self, cell):
        return self.coarse[cell // len(self.fine)] + self.fine[cell % len(self.fine)]

    def nearest(self, points: np.ndarray) -> np.ndarray:
        """The ``probes`` nearest lists of each point among those of its nearest coarse centres, the nearest first."""
        count, width = self.probes, len(self.fine)
        wide = min(len(self.coarse), count if width == 1 else max(-(-count // width), 4 * (math.isqrt(count) + 1)))
        own, fine, inner = (self.coarse**2).sum(axis=1), (self.fine**2).sum(axis=1), 2 * self.coarse @ self.fine.T
        step = max(1, 2_000_000 // max(len(self.coarse), wide * width))
        return np.concatenate([self._nearest(points[a : a + step], own, fine, inner, count, wide) for a in range(0, len(points), step)])

    def _nearest(self, points: np.ndarray, own: np.ndarray, fine: np.ndarray, inner: np.ndarray, count: int, wide: int) -> np.ndarray:
        # |x - a - b|^2 = |x - a|^2 + |b|^2 - 2 x.b + 2 a.b, less |x|^2
        far = own - 2 * points @ self.coarse.T
        near = np.argpartition(far, wide - 1, axis=1)[:, :wide]
        total = np.take_along_axis(far, near, 1)[:, :, None] + (fine - 2 * points @ self.fine.T)[:, None, :] + inner[near]
        cells = (near[:, :, None] * len(fine) + np.arange(len(fine))).reshape(len(points), -1)
        total = total.reshape(len(points), -1)
        best = np.argpartition(total, count - 1, axis=1)[:, :count]
        order = np.argsort(np.take_along_axis(total, best, 1), axis=1, kind="stable")
        return np.take_along_axis(cells, np.take_along_axis(best, order, 1), 1)


def _means(points: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    """k-means by Lloyd's rounds, from points chosen at random; an empty centre stays where it was."""
    k = min(k, len(points))
    centres = points[np.random.default_rng(seed).choice(len(points), k, replace=False)].copy()
    for _ in range(rounds):
        nearest = _nearest(points, centres)
        order = np.argsort(nearest, kind="stable")
        found, first = np.unique(nearest[order], return_index=True)
        sums = np.add.reduceat(points[order], first, axis=0)
        centres[found] = sums / np.diff(np.append(first, len(points)))[:, None]
    return centres


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half = (centres**2).sum(axis=1) / 2
    step = max(1, 4_000_000 // len(centres))
    return np.concatenate([(half - points[a : a + step] @ centres.T).argmin(axis=1) for a in range(0, len(points), step)])


def fit(points: np.ndarray, lists: int) -> Index:
    """An index of unit vectors with ``lists`` lists, or some more."""
    coarse = _means(points, min(lists, COARSE), 8, 1)
    fine = np.zeros((1, points.shape[1]))
    if lists > len(coarse):
        rest = points - coarse[_nearest(points, coarse)]
        fine = _means(rest, min(FINE, -(-lists // len(coarse))), 6, 20)
    index = Index(coarse, fine, [p for p in np.array_split(np.arange(points.shape[1]), SUBSPACES) if len(p)], [])
    rest = points - index.centre(index.nearest(points)[:, 0])
    index.books += [_means(rest[:, p], CODES, 6, 2 + k) for k, p in enumerate(index.parts)]
    return index


def _units(column: pd.Series) -> np.ndarray:
    points = np.stack(column.to_numpy()).astype(np.float64)
    return points / np.sqrt((points**2).sum(axis=1))[:, None]


ENTRY = "rep bigint, copies bigint, embedding array<{}>, cell int, probes array<int>, codes binary, error double"


def _encoded(index: Index):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for at in range(0, len(whole), 512):
                batch = whole.iloc[at : at + 512]
                points = _units(batch["embedding"])
                probes = index.nearest(points).astype(np.int32)
                rest = points - index.centre(probes[:, 0])
                codes = np.stack([_nearest(rest[:, p], book) for p, book in zip(index.parts, index.books)], 1).astype(np.uint8)
                guess = np.concatenate([book[codes[:, k]] for k, book in enumerate(index.books)], axis=1)
                error = np.sqrt(((rest - guess) ** 2).sum(axis=1))
                yield batch.assign(cell=probes[:, 0], probes=list(probes), codes=[c.tobytes() for c in codes], error=error)

    return run


FOUND = "kind int, a bigint, b bigint"


def _compared(index: Index):
    """Links of a block of queries with a block of a list: how many each vector has, and a forest of them."""
    reach = np.sqrt(2 - 2 * COSINE)

    def run(key: tuple, listed: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        if not len(listed) or not len(asking):
            return pd.DataFrame({"kind": [], "a": [], "b": []}).astype({"kind": "int32", "a": "int64", "b": "int64"})
        cell = int(key[0])
        stored, queries = _units(listed["embedding"]), _units(asking["embedding"])
        codes = np.frombuffer(b"".join(listed["codes"]), np.uint8).reshape(len(listed), -1)
        within = (reach + listed["error"].to_numpy()) ** 2
        ids, asks = listed["rep"].to_numpy(), asking["rep"].to_numpy()
        probes, own = np.stack(listed["probes"].to_numpy()), asking["cell"].to_numpy()
        pairs = [np.zeros((2, 0), np.int64)]
        for at in range(0, len(queries), 256):
            part = queries[at : at + 256]
            rest = part - index.centre(cell)
            total = np.zeros((len(part), len(stored)), np.float32)
            for k, (p, book) in enumerate(zip(index.parts, index.books)):
                tables = (rest[:, p] ** 2).sum(axis=1)[:, None] + (book**2).sum(axis=1) - 2 * rest[:, p] @ book.T
                total += tables.astype(np.float32)[:, codes[:, k]]
            q, x = np.nonzero(total <= (within + 1e-4).astype(np.float32))
            # A pair that meets in both cells counts where the smaller id asks.
            q += at
            once = (asks[q] < ids[x]) | ((asks[q] != ids[x]) & ~(probes[x] == own[q][:, None]).any(axis=1))
            q, x = q[once], x[once]
            for b in range(0, len(q), 1 << 16):
                i, j = q[b : b + (1 << 16)], x[b : b + (1 << 16)]
                near = (queries[i] * stored[j]).sum(axis=1) >= COSINE
                pairs.append(np.stack((i[near], j[near])))
        i, j = np.concatenate(pairs, axis=1)
        counts = pd.concat([pd.Series(listed["copies"].to_numpy()[j]).groupby(asks[i]).sum(), pd.Series(asking["copies"].to_numpy()[i]).groupby(ids[j]).sum()])
        forest = _forest(asks[i], ids[j])
        return pd.DataFrame(
            {
                "kind": np.concatenate((np.zeros(len(counts), np.int32), np.ones(len(forest), np.int32))),
                "a": np.concatenate((counts.index.to_numpy(np.int64), forest[:, 0])),
                "b": np.concatenate((counts.to_numpy(np.int64), forest[:, 1])),
            }
        )

    return run


def _forest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Links that connect what the links (a, b) connect, one less than members for each component."""
    names, number = np.unique(np.concatenate((a, b)), return_inverse=True)
    u, v = number[: len(a)], number[len(a) :]
    label = np.arange(len(names))
    while len(u):
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, u, low)
        np.minimum.at(new, v, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(names)))
    return np.stack((names[moved], names[label[moved]]), 1).astype(np.int64).reshape(-1, 2)


def near_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors`` (vec_id, embedding; more columns are ignored).

    Two vectors link when their cosine in double precision is at least 0.9. Null, empty and zero
    vectors and those with null or non-finite components link with nothing, nor do vectors of
    different lengths. Equal vectors are one entry of the index, with their number. A pair is found
    if one of the two has the other's list among those it probes; within a list none is missed,
    as a vector's distance from its code bounds how far the table-lookup distance can be off. Lists grow in number
    with the vectors, and probes with the lists.
    Rows that share a vec_id count as different vectors, and share the links of both.
    """
    spark = vectors.sparkSession
    ship(spark)
    # Doubles stay doubles.
    kind = "float" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "double"
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast(f"array<{kind}>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = rows.where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & finite & F.exists("embedding", lambda x: x != 0))
    classes = usable.groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    classes = cut(classes.withColumn("dims", F.size("embedding")))
    sizes = {r["dims"]: r["n"] for r in classes.groupBy("dims").agg(F.count("*").alias("n")).collect()}
    found = spark.createDataFrame([], FOUND)
    for dims, n in sorted(sizes.items()):
        found = found.union(_links(classes.where(F.col("dims") == dims).drop("dims"), n))
    found = cut(found)
    member = cut(usable.join(classes.select("embedding", "rep", "copies"), "embedding").select("vec_id", "rep", "copies"))
    counted = found.where("kind = 0").groupBy(F.col("a").alias("rep")).agg(F.sum("b").alias("linked"))
    links = found.where("kind = 1").select("a", "b")
    copies = member.where("vec_id <> rep").select(F.col("rep").alias("a"), F.col("vec_id").alias("b"))
    group = components(links.union(copies)).withColumnRenamed("id", "vec_id")
    known = member.join(counted, "rep", "left").groupBy("vec_id").agg(F.sum(F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n"))
    done = rows.select("vec_id").join(known, "vec_id", "left").join(group, "vec_id", "left")
    component = F.coalesce("component_id", "vec_id")
    return done.select("vec_id", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))


def _links(classes: DataFrame, n: int) -> DataFrame:
    """Counts and links (kind, a, b) among distinct vectors (embedding, rep, copies) of one length."""
    sample = classes.orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).select("embedding").toPandas()
    index = fit(_units(sample["embedding"]), max(1, n // LIST_SIZE))
    kind = classes.schema["embedding"].dataType.elementType.simpleString()
    entries = cut(classes.select("rep", "copies", "embedding").mapInPandas(_encoded(index), ENTRY.format(kind)))
    held = entries.groupBy("cell").agg(F.count("*").alias("held"))
    asked = entries.select(F.explode("probes").alias("cell")).groupBy("cell").agg(F.count("*").alias("asked"))
    blocks = cut(
        held.join(asked, "cell").select(
            "cell", F.ceil(F.col("held") / BLOCK).cast("int").alias("blocks"), F.ceil(F.col("asked") / QUERIES).cast("int").alias("query_blocks")
        )
    )
    spot = F.xxhash64("rep")
    listed = (
        entries.join(blocks, "cell")
        .withColumn("block", F.pmod(spot, "blocks").cast("int"))
        .withColumn("query_block", F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)))
        .select("cell", "block", "query_block", "rep", "copies", "embedding", "probes", "codes", "error")
    )
    asking = (
        entries.select(F.col("rep").alias("asks"), F.col("copies").alias("n"), F.col("embedding").alias("e"), F.col("cell").alias("own"), F.explode("probes").alias("cell"))
        .join(blocks, "cell")
        .select(
            F.col("cell").alias("at"),
            F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("part"),
            F.pmod(F.xxhash64("asks"), "query_blocks").cast("int").alias("query_part"),
            F.col("asks").alias("rep"),
            F.col("n").alias("copies"),
            F.col("e").alias("embedding"),
            F.col("own").alias("cell"),
        )
    )
    tiles = listed.groupBy("cell", "block", "query_block").cogroup(asking.groupBy("at", "part", "query_part"))
    return tiles.applyInPandas(_compared(index), FOUND)
