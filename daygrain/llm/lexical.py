"""Ranked lexical search: impact lists read from the top, with direct accesses and best positions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daygrain.llm.blocks import Best
from daygrain.session import cut, ship

#: Fixed value: what parts terms. All other ASCII characters (digits, letters) and everything beyond ASCII belong to a term.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Bytes of text handled at a time (a longer text alone), postings of a shard, items of a block.
PIECE, SHARD, ITEMS = 1 << 22, 1 << 20, 256
#: Positions read from each list at first; then twice as many as before.
FIRST_READ = 32
COUNTED = "row bigint, id bigint, n bigint, terms array<string>, counts array<bigint>"
#: Stands for all terms of a document: its count is the document's length.
ANY = ""


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 40
    for batch in batches:
        texts = pc.fill_null(pc.cast(batch.column("text"), pa.large_string()), "")
        size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        at = 0
        while at < len(batch):
            to = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + PIECE, "right")))
            parts = pc.split_pattern_regex(pc.ascii_lower(texts.slice(at, to - at)), pattern=BETWEEN)
            row = np.repeat(np.arange(to - at), pc.list_value_length(parts).to_numpy(zero_copy_only=False))
            coded = pc.dictionary_encode(pc.list_flatten(parts))
            code, names = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
            real = pc.not_equal(names, ANY).to_numpy(zero_copy_only=False)[code] if len(code) else np.zeros(0, bool)
            n = np.bincount(row[real], minlength=to - at)
            pair, count = np.unique(row[real] * max(1, len(names)) + code[real], return_counts=True)
            own, code = np.divmod(pair, max(1, len(names)))
            ends = np.searchsorted(own, np.arange(to - at + 1)).astype(np.int32)
            terms = pa.ListArray.from_arrays(pa.array(ends), pc.cast(names.take(pa.array(code)), pa.string()))
            counts = pa.ListArray.from_arrays(pa.array(ends), pa.array(count.astype(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(number, number + to - at)), batch.column("id").slice(at, to - at), pa.array(n.astype(np.int64)), terms, counts], ["row", "id", "n", "terms", "counts"])
            number, at = number + to - at, to


def term_counts(texts: DataFrame, key: Column) -> DataFrame:
    """(row, id, n, terms, counts) of every row with an id: its distinct terms and how often each occurs, n in all.

    ``row`` is unique. Texts are handled whole; a task holds a small multiple of PIECE or of its longest text.
    """
    return texts.select(key.cast("bigint").alias("id"), "text").where("id IS NOT NULL").mapInArrow(_counted, COUNTED)


FOUND = "item bigint, item_id bigint, doc_id bigint, score bigint"


def _first_unseen(seen: np.ndarray, at: int) -> int:
    """The first position from ``at`` on that is not seen; the length if there is none."""
    step = 64
    while at < len(seen):
        part = seen[at : at + step]
        first = int(part.argmin())
        if not part[first]:
            return at + first
        at, step = at + len(part), step * 2
    return len(seen)


class Lists:
    """The impact lists of a shard: by falling impact for reading, by document for direct access."""

    def __init__(self, code: np.ndarray, doc: np.ndarray, impact: np.ndarray):
        top = np.lexsort((doc, -impact, code))
        direct = np.lexsort((doc, code))
        self.codes, self.starts = np.unique(code[top], return_index=True)
        self.ends = np.append(self.starts[1:], len(code))
        self.read_doc, self.read_impact = doc[top], impact[top]
        self.doc, self.impact = doc[direct], impact[direct]
        rank = np.empty(len(code), np.int64)
        rank[top] = np.arange(len(code))
        #: Where each document stands in the list of falling impact.
        self.place = rank[direct] - np.repeat(self.starts, self.ends - self.starts)

    def best(self, terms: np.ndarray, weights: np.ndarray, names: np.ndarray, known: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Scores and names of the k best documents for weighted terms, and how many documents were scored.

        All lists are read downwards together. A document met for the first time is looked up in every
        list, which also marks the place where it stands there. All documents not met yet stand below
        the first unmarked place of each list, so the weighted impacts at these places bound their scores.
        """
        at = np.searchsorted(self.codes, terms)
        there = (at < len(self.codes)) & (weights > 0)
        there[there] = self.codes[at[there]] == terms[there]
        lists = [(int(self.starts[a]), int(self.ends[a]), int(w)) for a, w in zip(at[there], weights[there])]
        seen = [np.zeros(e - s, bool) for s, e, _ in lists]
        first = [0] * len(lists)
        found = Best(1, k)
        depth, step, scored = 0, FIRST_READ, []
        while lists:
            met = np.unique(np.concatenate([self.read_doc[s + depth : min(e, s + depth + step)] for s, e, _ in lists]))
            met = met[~known[met]]
            known[met] = True
            scored.append(met)
            score = np.zeros(len(met), np.int64)
            for (s, e, w), marked in zip(lists, seen):
                here = np.searchsorted(self.doc[s:e], met)
                hit = np.flatnonzero(here < e - s)
                hit = hit[self.doc[s + here[hit]] == met[hit]]
                score[hit] += w * self.impact[s + here[hit]]
                marked[self.place[s + here[hit]]] = True
            good = score >= max(1, found.least[0])
            found.add(np.zeros(int(good.sum()), np.int64), score[good], names[met[good]])
            depth, step = depth + step, step * 2
            first = [_first_unseen(marked, f) for marked, f in zip(seen, first)]
            bound = sum(w * int(self.read_impact[s + f]) for (s, e, w), f in zip(lists, first) if f < e - s)
            if bound == 0 or bound < found.least[0]:
                break
        for met in scored:
            known[met] = False
        return found.found[1], found.found[2], sum(map(len, scored))


def _ranked(k: int):
    def run(key: tuple, postings: pd.DataFrame, items: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({c.split()[0]: np.zeros(0, np.int64) for c in FOUND.split(", ")})]
        if len(postings) and len(items):
            rows, first, doc = np.unique(postings["row"].to_numpy(), return_index=True, return_inverse=True)
            names = postings["doc_id"].to_numpy()[first]
            lists = Lists(postings["code"].to_numpy(), doc, postings["impact"].to_numpy())
            known = np.zeros(len(rows), bool)
            for item in items.itertuples():
                score, name, _ = lists.best(np.asarray(item.codes, np.int64), np.asarray(item.weights, np.int64), names, known, k)
                out.append(pd.DataFrame({"item": np.full(len(score), item.item), "item_id": np.full(len(score), item.item_id), "doc_id": name, "score": score}))
        return pd.concat(out)

    return run


def ranked(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """(item_id, rank, doc_id, score): for each item the k documents of highest score above 0, equal scores by smaller doc_id.

    ``docs`` has doc_id and text, ``items`` item_id and text. A term is a maximal run of digits, ASCII
    letters (A-Z lower-cased) and characters beyond ASCII. With N documents that hold a term, L terms in
    all of them, n in a document, df documents that hold a term and tf occurrences in one, a term's
    weight w is floor(1000 ln((2N + 2) / (2df + 1))), a document's m is 75 + 25nN div L, and its score
    the sum of w * (10^9 tf div (1000tf + 12m)) over the item's terms, repeats included.

    Null and empty texts have no term: such a document is never returned, such an item gets no rows.
    Rows without an id take no part, neither in the counts. Each row is a document, or an item, of its
    own: repeated ids and texts are not merged. Other columns are ignored.

    Documents are dealt over shards of a bounded number of postings, each with its impact lists; the
    frequencies are those of all documents. In a shard the items of a block are answered by best
    positions, until no document that was not met can reach the kth score; one that could equal it is
    still read. The k best of the shards are merged. Terms that no item has never leave their task
    where the items' terms are few enough for the planner to broadcast them.
    """
    spark = docs.sparkSession
    ship(spark)
    asked = cut(term_counts(items, F.col("item_id")).withColumnsRenamed({"row": "item", "id": "item_id"}))
    words = asked.select("item", "item_id", F.explode(F.arrays_zip("terms", "counts")).alias("t")).select("item", "item_id", "t.terms", "t.counts")
    names = words.select(F.col("terms").alias("term")).union(spark.createDataFrame([(ANY,)], "term string")).distinct()
    names = cut(names.withColumn("code", F.monotonically_increasing_id()))
    every = term_counts(docs, F.col("doc_id")).where("n > 0")
    with_length = F.arrays_zip(F.concat("terms", F.array(F.lit(ANY))).alias("term"), F.concat("counts", F.array("n")).alias("tf"))
    postings = every.select("row", F.col("id").alias("doc_id"), "n", F.explode(with_length).alias("p")).select("row", "doc_id", "n", "p.term", "p.tf")
    postings = cut(postings.join(names, "term").drop("term"))
    total = names.where(F.col("term") == ANY).select("code").first()[0]
    facts = postings.where(F.col("code") == total).agg(F.count("*").alias("docs"), F.sum("tf").alias("terms")).first()
    n_docs, n_terms = facts["docs"], max(1, facts["terms"] or 0)
    held = postings.where(F.col("code") != total).groupBy("code").agg(F.count("*").alias("df"))
    held = cut(held.withColumn("w", F.floor(1000 * F.log((2 * F.lit(n_docs) + 2).cast("double") / (2 * F.col("df") + 1).cast("double")))))
    n_postings = held.agg(F.sum("df")).first()[0] or 0
    blocks = max(1, -(-asked.count() // ITEMS))
    coded = words.join(names, words["terms"] == names["term"]).join(held, "code")
    coded = cut(coded.select("item", "item_id", F.pmod(F.xxhash64("item"), F.lit(blocks)).alias("block"), "code", (F.col("w") * F.col("counts")).alias("weight")))
    # A list for each item, as long as the item's own text.
    pairs = F.collect_list(F.struct("code", "weight"))
    lists = coded.groupBy("item", "item_id", "block").agg(pairs.alias("p")).select("item", "item_id", "block", F.col("p.code").alias("codes"), F.col("p.weight").alias("weights"))
    shards = max(1, -(-n_postings // SHARD))
    length = F.expr(f"75 + cast((cast(25 as decimal(38, 0)) * n * {n_docs}) div {n_terms} as bigint)")
    impact = F.expr("(1000000000 * tf) div (1000 * tf + 12 * m)").alias("impact")
    wanted = coded.select("code", "block").distinct()
    sent = postings.withColumn("m", length).join(wanted, "code").select("block", F.pmod(F.xxhash64("row"), F.lit(shards)).alias("shard"), "row", "doc_id", "code", impact)
    everywhere = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shards - 1).cast("bigint")))
    asking = lists.select(F.col("block").alias("own"), everywhere.alias("part"), "item", "item_id", "codes", "weights")
    found = sent.groupBy("block", "shard").cogroup(asking.groupBy("own", "part")).applyInPandas(_ranked(k), FOUND)
    best = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
