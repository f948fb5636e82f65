"""Exact top-k search by inner product: pivots, sorted annuli around them, bounds by the triangle inequality."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daygrain.llm.blocks import Best, cut_blocks, matrix, products, whole_vectors
from daygrain.session import cut, ship

#: Pivots are chosen among no more vectors than these, taken by a hash of their id; every vector is indexed.
SAMPLE, PIVOTS = 2048, 64
#: Components of an annulus, of a block of queries, and annuli that one task expands.
ANNULUS, QUERIES, SHARD = 1 << 16, 1 << 17, 16
#: Distances are doubles: bounds give way by so much of the largest length.
SLACK = 1e-6


@dataclass
class Pivots:
    """For each vector length: pivots with one coordinate more, and sample vectors with their ids.

    The coordinate more is sqrt(top - |x|^2) for a stored vector x and 0 for a query q. With it all
    stored vectors have the length sqrt(top), and |q - x|^2 = |q|^2 + top - 2 q.x: the highest inner
    products are the smallest distances.
    """

    top: float
    places: dict[int, np.ndarray]
    sample: dict[int, tuple[np.ndarray, np.ndarray]]

    def of(self, dims: int) -> np.ndarray:
        return self.places.get(dims, np.zeros((1, dims + 1)))

    def lifted(self, x: np.ndarray, stored: bool) -> np.ndarray:
        x = x.astype(np.float64)
        more = np.sqrt(np.maximum(0, self.top - (x**2).sum(axis=1))) if stored else np.zeros(len(x))
        return np.column_stack((x, more))

    def distances(self, x: np.ndarray, stored: bool) -> np.ndarray:
        """From each row to each pivot."""
        x, p = self.lifted(x, stored), self.of(x.shape[1])
        return np.sqrt(np.maximum(0, (x**2).sum(axis=1)[:, None] + (p**2).sum(axis=1) - 2 * x @ p.T))

    def radius(self, x: np.ndarray, least: np.ndarray) -> np.ndarray:
        """How far from query x a vector of score ``least`` lies at most, with the slack."""
        own = (x.astype(np.float64) ** 2).sum(axis=1)
        return np.sqrt(np.maximum(0, own + self.top - 2 * least.astype(np.float64))) + SLACK * np.sqrt(own + self.top) + SLACK


def choose(rows: pd.DataFrame, top: float) -> Pivots:
    """Pivots far from each other: each is the sample vector farthest from those chosen before."""
    found = Pivots(top, {}, {})
    for (dims, wide), part in rows.groupby(["dims", "wide"]):
        x = matrix(list(part["body"]), len(part), int(dims), bool(wide)).astype(np.int64)
        if dims in found.sample:
            x = np.concatenate((found.sample[dims][1], x))
            part = pd.DataFrame({"vec_id": np.concatenate((found.sample[dims][0], part["vec_id"]))})
        found.sample[int(dims)] = (part["vec_id"].to_numpy(np.int64), x)
    for dims, (_, x) in found.sample.items():
        y = found.lifted(x, True)
        picked, far = [0], ((y - y[0]) ** 2).sum(axis=1)
        while len(picked) < PIVOTS and far.max() > 0:
            picked.append(int(far.argmax()))
            far = np.minimum(far, ((y - y[picked[-1]]) ** 2).sum(axis=1))
        found.places[dims] = y[picked]
    return found


KEYED = "vec_id bigint, dims int, wide boolean, cell int, r double, body binary"
ANNULI = "block bigint, n int, dims int, wide boolean, cell int, lo double, hi double, ids binary, radii binary, body binary"
ASKED = "block bigint, n int, dims int, wide boolean, near array<double>, far array<double>, reach double, ids binary, least binary, body binary"
FOUND = "block bigint, at int, query_id bigint, vec_id bigint, score bigint"


def _keyed(pivots: Pivots):
    """The nearest pivot of each vector and the distance to it, by which the annuli are sorted."""

    def run(batches):
        for batch in batches:
            for (dims, wide), part in batch.groupby(["dims", "wide"]):
                away = pivots.distances(matrix(list(part["body"]), len(part), int(dims), bool(wide)), True)
                cell = away.argmin(axis=1)
                yield part.assign(cell=cell.astype(np.int32), r=away[np.arange(len(part)), cell])[["vec_id", "dims", "wide", "cell", "r", "body"]]

    return run


def _annulus(part: pd.DataFrame, x: np.ndarray) -> dict:
    r = part["r"].to_numpy(np.float64)
    return {"lo": r[0], "hi": r[-1], "radii": r.tobytes()}


def _asking(pivots: Pivots, k: int):
    """What a block of queries knows before it starts: distances to the pivots, and the kth best score among the sample."""

    def build(part: pd.DataFrame, x: np.ndarray) -> dict:
        away = pivots.distances(x, False)
        best = Best(len(x), k)
        if x.shape[1] in pivots.sample:
            ids, y = pivots.sample[x.shape[1]]
            score = products(x, y)
            i, j = np.nonzero(part["vec_id"].to_numpy()[:, None] != ids)
            best.add(i, score[i, j], ids[j])
        # A query that has less than k partners in the sample knows nothing, and reaches everywhere.
        known = best.least > np.iinfo(np.int64).min
        reach = pivots.radius(x, np.where(known, best.least, 0))
        return {"near": away.min(axis=0), "far": away.max(axis=0), "reach": float(np.where(known, reach, np.inf).max()), "least": best.least.tobytes()}

    return build


def _expanded(pivots: Pivots, k: int):
    """A block of queries expands annuli in the order of their distance, until the next one is out of everyone's reach."""

    def run(key: tuple, annuli: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(annuli) or not len(asked):
            return pd.DataFrame({c.split()[0]: [] for c in FOUND.split(", ")}).astype({"at": np.int32} | dict.fromkeys(("block", "query_id", "vec_id", "score"), np.int64))
        own = asked.iloc[0]
        dims, n = int(own["dims"]), int(own["n"])
        x = matrix(own["body"], n, dims, bool(own["wide"]))
        ids = np.frombuffer(own["ids"], np.int64)
        best = Best(n, k, np.frombuffer(own["least"], np.int64))
        away = pivots.distances(x, False)
        reach = np.where(best.least > np.iinfo(np.int64).min, pivots.radius(x, np.maximum(best.least, -(2**62))), np.inf)
        gaps = [np.maximum(0, np.maximum(a.lo - away[:, a.cell], away[:, a.cell] - a.hi)) for a in annuli[["cell", "lo", "hi"]].itertuples()]
        for number in np.argsort([g.min() for g in gaps], kind="stable"):
            gap, ring = gaps[number], annuli.iloc[number]
            if gap.min() > reach.max():
                break
            active = np.flatnonzero(gap <= reach)
            if not len(active):
                continue
            d, radii = away[active, ring["cell"]], np.frombuffer(ring["radii"], np.float64)
            a, b = np.searchsorted(radii, (d - reach[active]).min(), "left"), np.searchsorted(radii, (d + reach[active]).max(), "right")
            if a >= b:
                continue
            stored = matrix(ring["body"], int(ring["n"]), dims, bool(ring["wide"]))[a:b]
            partners = np.frombuffer(ring["ids"], np.int64)[a:b]
            for start in range(0, len(active), 512):
                rows = active[start : start + 512]
                score = products(x[rows], stored)
                i, j = np.nonzero((score >= best.least[rows][:, None]) & (ids[rows][:, None] != partners))
                best.add(rows[i], score[i, j], partners[j])
            full = best.least > np.iinfo(np.int64).min
            reach = np.where(full, pivots.radius(x, np.maximum(best.least, -(2**62))), np.inf)
        row, score, partner = best.found
        return pd.DataFrame({"block": np.full(len(row), own["asking"]), "at": row.astype(np.int32), "query_id": ids[row], "vec_id": partner, "score": score})

    return run


def _gap(at: Column, lo: Column, hi: Column) -> Column:
    """How far the annulus lo..hi lies from the distances that a block of queries has to its pivot."""
    near, far = F.element_at("near", at), F.element_at("far", at)
    return F.greatest(lo - far, near - hi, F.lit(0.0))


def top_k(vectors: DataFrame, queries: Column, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row where ``queries`` holds, the k rows of highest inner product.

    ``vectors`` has vec_id and embedding; ``queries`` is a condition on vec_id. Components x count as
    floor(256 * x), x in double, and scores are exact 64-bit integers (one that does not fit raises an
    error). Equal scores go by smaller vec_id; a query with fewer partners gets them all.
    Null vectors, those with null or non-finite components and rows without an id take no part, neither
    asking nor found. Vectors of different lengths never meet. Rows that share a vec_id are separate
    rows, and none of them is a partner of the other; a repeated query is answered once for each row.

    Every vector is stored under its nearest pivot in the order of its distance to it, in annuli of
    bounded size, so that a hot pivot is many annuli. A block of queries meets an annulus only if the
    triangle inequality lets one of its queries reach it with the kth best score found among the pivots'
    sample; a task then expands its annuli from the nearest outwards, with the reach shrinking, and
    stops at the first one out of reach. A distance that equals the bound is still read, so ties are whole.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = cut(whole_vectors(vectors))
    facts = rows.agg(F.max("norm2").alias("top")).first()
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "body").limit(SAMPLE).select("vec_id", "dims", "wide", "body").toPandas()
    pivots = choose(sample, facts["top"] or 0.0)
    order = ["dims", "wide", "cell", "r", "vec_id"]
    keyed = rows.mapInPandas(_keyed(pivots), KEYED).repartitionByRange(*order).sortWithinPartitions(*order)
    index = cut(keyed.mapInPandas(cut_blocks(ANNULUS, ["dims", "wide", "cell"], _annulus), ANNULI))
    # Neighbours ask together, so that a block reaches few annuli: the same order by pivot and distance.
    asking = rows.where(queries).mapInPandas(_keyed(pivots), KEYED).repartitionByRange(*order).sortWithinPartitions(*order)
    asked = cut(asking.mapInPandas(cut_blocks(QUERIES, ["dims", "wide"], _asking(pivots, k)), ASKED))
    shards = max(1, -(-index.count() // SHARD))
    shard = F.pmod(F.xxhash64("ring"), F.lit(shards))
    rings = index.select(F.col("block").alias("ring"), "dims", "cell", "lo", "hi").withColumn("shard", shard)
    spread = asked.select("block", "dims", "near", "far", "reach", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shards - 1).cast("bigint"))).alias("shard"))
    tiles = spread.join(rings, ["dims", "shard"]).where(_gap(F.col("cell") + 1, F.col("lo"), F.col("hi")) <= F.col("reach")).select("block", "shard", "ring")
    tiles = cut(tiles)
    sent = tiles.join(index.withColumnRenamed("block", "ring").drop("dims"), "ring")
    waiting = tiles.select("block", "shard").distinct().join(asked.select("block", "n", "dims", "wide", "ids", "least", "body"), "block")
    waiting = waiting.withColumnsRenamed({"block": "asking", "shard": "part"})
    found = sent.groupBy("block", "shard").cogroup(waiting.groupBy("asking", "part")).applyInPandas(_expanded(pivots, k), FOUND)
    best = Window.partitionBy("block", "at").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
