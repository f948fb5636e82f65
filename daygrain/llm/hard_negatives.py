"""Hard negatives by a packed R-tree: boxes give intervals of inner products, the best box is read first."""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daygrain.llm.blocks import EXACT_32, EXACT_64, Best, cut_blocks, matrix, most, products, whole_vectors
from daygrain.session import cut, ship

#: The slabs of the packing are laid out on no more vectors than these, taken by a hash of their id; every vector is packed.
SAMPLE, SLABS = 8192, 8
#: Components of a leaf, of a subtree and of a block of anchors; subtrees that one task searches.
LEAF, SUBTREE, ANCHORS, SHARD = 1 << 14, 1 << 18, 1 << 15, 8
NEVER = np.iinfo(np.int64).min


@dataclass
class Slabs:
    """For one vector length: the three axes of most variance, edges along the first, and for each slab edges along the second."""

    axes: np.ndarray
    first: np.ndarray
    second: list[np.ndarray]

    def of(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Slab along the first axis, slab along the second one in it, and the value along the third."""
        one = np.searchsorted(self.first, x[:, self.axes[0]], "right")
        two = np.zeros(len(x), np.int64)
        for slab in np.unique(one):
            inside = one == slab
            two[inside] = np.searchsorted(self.second[slab], x[inside, self.axes[1]], "right")
        return one, two, x[:, self.axes[2]]


def lay_out(sample: pd.DataFrame) -> dict[int, Slabs]:
    """Sort, tile, recurse: cut the sample into SLABS even slabs along one axis, and each of them along the next."""
    found = {}
    for dims, part in sample.groupby("dims"):
        if not dims:
            continue
        x = np.concatenate([matrix(list(p["body"]), len(p), int(dims), bool(w)).astype(np.int64) for w, p in part.groupby("wide")])
        axes = np.argsort(-x.astype(np.float64).var(axis=0), kind="stable")[:3]
        axes = np.concatenate((axes, np.repeat(axes[-1:], 3 - len(axes))))
        cuts = np.arange(1, SLABS) / SLABS
        edges = np.unique(np.quantile(x[:, axes[0]], cuts, method="lower"))
        slab = np.searchsorted(edges, x[:, axes[0]], "right")
        inner = [x[slab == s, axes[1]] for s in range(len(edges) + 1)]
        found[int(dims)] = Slabs(axes, edges, [np.unique(np.quantile(v, cuts, method="lower")) if len(v) else np.zeros(0, np.int64) for v in inner])
    return found


PLACED = "vec_id bigint, label bigint, dims int, wide boolean, one int, two int, along bigint, body binary"
ORDER = ["dims", "wide", "label", "one", "two", "along", "vec_id"]
TREES = "block bigint, n int, dims int, wide boolean, label bigint, ids binary, body binary, boxes binary"
BLOCKS = "block bigint, n int, dims int, wide boolean, label bigint, ids binary, body binary"
FOUND = "block bigint, at int, anchor_id bigint, other_id bigint, score bigint"


def _placed(slabs: dict[int, Slabs]):
    def run(batches):
        for batch in batches:
            for (dims, wide), part in batch.groupby(["dims", "wide"]):
                x = matrix(list(part["body"]), len(part), int(dims), bool(wide))
                flat = np.zeros(len(part), np.int64)
                one, two, along = slabs[dims].of(x) if dims in slabs else (flat, flat, flat)
                yield part.assign(one=one.astype(np.int32), two=two.astype(np.int32), along=along.astype(np.int64))[[c.split()[0] for c in PLACED.split(", ")]]

    return run


def _per_leaf(dims: int) -> int:
    return max(1, LEAF // max(1, dims))


def _boxes(part: pd.DataFrame, x: np.ndarray) -> dict:
    """Least and greatest value of each coordinate: of the subtree, then of its leaves in their order."""
    if not x.shape[1]:
        return {"boxes": b""}
    starts = np.arange(0, len(x), _per_leaf(x.shape[1]))
    low, high = np.minimum.reduceat(x, starts, axis=0), np.maximum.reduceat(x, starts, axis=0)
    low, high = np.concatenate((low.min(axis=0)[None], low)), np.concatenate((high.max(axis=0)[None], high))
    return {"boxes": np.stack((low, high)).astype(np.int64).tobytes()}


def _intervals(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Between which values the inner products of each row of x with the vectors of each box lie.

    A coordinate's product is least at one end of its interval and greatest at the other, by the sign of x.
    Sums that doubles do not hold exactly are given some room.
    """
    bound = most(x) * max(most(low), most(high)) * x.shape[1]
    kind = np.float32 if bound < EXACT_32 else np.float64
    plus, minus, low, high = (v.astype(kind) for v in (np.maximum(x, 0), np.minimum(x, 0), low, high))
    room = 1e-9 * bound if bound >= EXACT_64 else 0.0
    return plus @ low.T + minus @ high.T - room, plus @ high.T + minus @ low.T + room


def _search(k: int):
    """The best k partners in each row's score window, from the subtrees of a shard.

    A row is an anchor with a window of scores; several rows may ask for one anchor. One queue serves
    all rows of a block, by the greatest upper end among the rows that a box still concerns.
    """

    def run(key: tuple, trees: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(trees) or not len(asked):
            return pd.DataFrame({c.split()[0]: [] for c in FOUND.split(", ")}).astype({"at": np.int32} | dict.fromkeys(("block", "anchor_id", "other_id", "score"), np.int64))
        own = asked.iloc[0]
        dims = int(own["dims"])
        x, ids = matrix(own["body"], int(own["n"]), dims, bool(own["wide"])), np.frombuffer(own["ids"], np.int64)
        if "owner" in own.index and own["owner"] is not None:
            owner, least, greatest = (np.asarray(own[c], np.int64) for c in ("owner", "least", "greatest"))
        else:
            owner = np.arange(len(x))
            least, greatest = np.full(len(x), NEVER), np.full(len(x), np.iinfo(np.int64).max)
        best = Best(len(owner), k, least)
        bodies = [matrix(t.body, t.n, dims, bool(t.wide)) for t in trees.itertuples()]
        others = [np.frombuffer(t.ids, np.int64) for t in trees.itertuples()]
        boxes = [np.frombuffer(t.boxes, np.int64).reshape(2, -1, dims) if dims else np.zeros((2, 2, 0), np.int64) for t in trees.itertuples()]
        step = _per_leaf(dims)
        queue: list[tuple] = []

        def concerned(low: np.ndarray, high: np.ndarray) -> np.ndarray:
            """Rows whose window the interval meets, unless it ends strictly below their kth score."""
            return np.flatnonzero((high[owner] >= best.least) & (low[owner] <= greatest))

        def offer(tree: int, leaf: int, low: np.ndarray, high: np.ndarray) -> None:
            rows = concerned(low, high)
            if len(rows):
                heapq.heappush(queue, (-float(high[owner[rows]].max()), tree, leaf, low, high))

        low, high = _intervals(x, np.stack([b[0, 0] for b in boxes]), np.stack([b[1, 0] for b in boxes]))
        for tree in range(len(boxes)):
            offer(tree, -1, low[:, tree], high[:, tree])
        while queue:
            _, tree, leaf, low, high = heapq.heappop(queue)
            rows = concerned(low, high)
            if not len(rows):
                continue
            if leaf < 0:
                low, high = _intervals(x, boxes[tree][0, 1:], boxes[tree][1, 1:])
                for number in range(low.shape[1]):
                    offer(tree, number, low[:, number], high[:, number])
                continue
            part, partners = bodies[tree][leaf * step : (leaf + 1) * step], others[tree][leaf * step : (leaf + 1) * step]
            asking, inverse = np.unique(owner[rows], return_inverse=True)
            score = products(x[asking], part)
            for start in range(0, len(rows), 1024):
                r, s = rows[start : start + 1024], score[inverse[start : start + 1024]]
                i, j = np.nonzero((s >= best.least[r][:, None]) & (s <= greatest[r][:, None]) & (ids[owner[r]][:, None] != partners))
                best.add(r[i], s[i, j], partners[j])
        row, score, partner = best.found
        return pd.DataFrame({"block": np.full(len(row), own["asking"]), "at": row.astype(np.int32), "anchor_id": ids[owner[row]], "other_id": partner, "score": score})

    return run


def _found(asked: DataFrame, trees: DataFrame, shards: int, same_label: bool, k: int) -> DataFrame:
    """The k best partners of every row of the blocks, with their ``place`` from 1: each block meets the subtrees of one label or of the others, shard by shard."""
    everywhere = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shards - 1).cast("bigint")))
    spread = asked.select("block", "dims", "label", everywhere.alias("shard"))
    heads = trees.select(F.col("block").alias("tree"), "dims", F.col("label").alias("of"), F.pmod(F.xxhash64("block"), F.lit(shards)).alias("shard"))
    alike = F.col("label") == F.col("of")
    tiles = cut(spread.join(heads, ["dims", "shard"]).where(alike if same_label else ~alike).select("block", "shard", "tree"))
    sent = tiles.join(trees.withColumnRenamed("block", "tree").drop("label", "dims"), "tree")
    waiting = tiles.select(F.col("block").alias("asking"), F.col("shard").alias("part")).distinct()
    waiting = waiting.join(asked.withColumnRenamed("block", "asking").drop("label"), "asking")
    found = sent.groupBy("block", "shard").cogroup(waiting.groupBy("asking", "part")).applyInPandas(_search(k), FOUND)
    best = Window.partitionBy("block", "at").orderBy(F.desc("score"), "other_id")
    return found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k)


def hard_negatives(
    vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5, low_per_cent: int = 80, high_per_cent: int = 100
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every anchor and each of its positives.

    ``vectors`` has vec_id, embedding and label; ``anchors`` is a condition on vec_id. Components x count
    as floor(256 * x), x in double; a score is the exact inner product (one that does not fit into 64 bits
    raises an error). An anchor's positives are its first rows of the same label, its negatives for a
    positive the first rows of other labels whose score lies between ``low_per_cent`` and ``high_per_cent``
    per cent of the positive's; higher scores come first, then smaller vec_id, and where there are fewer
    all are returned. The window of a negative positive score is empty.

    Rows with a null id, label or vector, or a null or non-finite component take no part; vectors of
    different lengths never meet. Rows that share a vec_id are separate rows, none of them a partner of the other.

    Vectors are packed by sort, tile, recurse along the three axes of most variance, for each label
    apart, into leaves and subtrees of bounded size, so that a hot label is many subtrees. A block of
    anchors searches a shard of subtrees by a queue; boxes whose interval of inner products lies outside
    of a row's window, or strictly below its kth score, are not read.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = cut(whole_vectors(vectors.where("label IS NOT NULL")))
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "body").limit(SAMPLE).select("dims", "wide", "body").toPandas()
    placed = cut(rows.drop("norm2").mapInPandas(_placed(lay_out(sample)), PLACED))
    keys = ["dims", "wide", "label"]
    packed = placed.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    trees = cut(packed.mapInPandas(cut_blocks(SUBTREE, keys, _boxes), TREES))
    asking = placed.where(anchors).repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    asked = cut(asking.mapInPandas(cut_blocks(ANCHORS, keys, lambda part, x: {}), BLOCKS))
    shards = max(1, -(-trees.count() // SHARD))
    near = cut(_found(asked, trees, shards, True, positives))
    scaled = "cast(score as decimal(38, 0)) * {}"
    window = near.where("score >= 0").select(
        "block",
        F.col("at").alias("owner"),
        F.expr(f"({scaled.format(low_per_cent)} + 99) div 100").alias("least"),
        F.expr(f"({scaled.format(high_per_cent)}) div 100").alias("greatest"),
        F.col("other_id").alias("positive_id"),
        "place",
        F.col("score").alias("positive_score"),
    )
    # At most a block of anchors times the positives of each: the rows of a block are bounded.
    lists = window.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("owner", "place", "least", "greatest", "positive_id", "positive_score"))).alias("w"))
    lists = cut(lists)
    again = asked.join(lists.select("block", *[F.col(f"w.{c}").alias(c) for c in ("owner", "least", "greatest")]), "block")
    far = _found(again, trees, shards, False, negatives)
    named = lists.select("block", F.posexplode("w").alias("at", "w")).select("block", "at", "w.positive_id", "w.positive_score")
    done = far.join(named, ["block", "at"])
    return done.select("anchor_id", "positive_id", F.col("place").alias("rank"), F.col("other_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
