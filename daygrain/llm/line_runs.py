"""Line deduplication against levelled sorted runs of line hashes.

A run is a stored table of line keys, sorted by key, with the number of documents that hold the
line and the largest of their ids. Documents arrive in batches of falling doc_id. Each batch
merge-anti-joins the runs: lines that no run knows have their largest holder in this batch. The
batch then becomes a run of level 0; as soon as a level has ``fanout`` runs, they are merged
into one run of the next level, so n batches leave about log n runs to look through.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrain.llm.tables import unused
from daygrain.session import cut

# The white space stripped from a line, and the letters that are lower-cased.
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

MIN_CHARS = 40
MIN_DOCS = 5
BATCHES = 4
FANOUT = 2
KEY = ["k1", "k2"]


def split_lines(text: Column) -> Column:
    """The lines of a text; null and empty text are one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """Stripped, and with A-Z lower-cased; ``lower`` does that alone, and faster, on lines of single-byte characters."""
    bare = F.btrim(line, F.lit(SPACES))
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def long_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, row_hash, pos, k1, k2): each line long enough, its place, and its key as two 64-bit hashes."""
    keys = F.transform(split_lines(F.col("text")), lambda x, i: F.struct(i.alias("pos"), line_key(x).alias("key")))
    lines = docs.where("doc_id IS NOT NULL").select("doc_id", F.xxhash64("text").alias("row_hash"), F.explode(keys).alias("line"))
    return lines.where(F.length("line.key") >= min_chars).select(
        "doc_id", "row_hash", "line.pos", F.xxhash64("line.key").alias("k1"), F.xxhash64(F.lit(1), F.col("line.key")).alias("k2")
    )


class LineRuns:
    """The levelled runs: level k holds less than ``fanout`` runs, each merged from fanout ** k batches."""

    def __init__(self, fanout: int = FANOUT):
        self.fanout = fanout
        self.levels: list[list[DataFrame]] = []

    def _all(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def _store(self, run: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(cut(run.sortWithinPartitions(*KEY)))
        if len(self.levels[level]) >= self.fanout:
            merged, self.levels[level] = self.levels[level], []
            self._store(_merge(merged), level + 1)

    def absorb(self, lines: DataFrame) -> None:
        """Take in the lines (doc_id, k1, k2) of a batch whose ids are below those of all earlier ones."""
        batch = lines.groupBy(*KEY).agg(F.count_distinct("doc_id").alias("n_docs"), F.max("doc_id").alias("holder"))
        known = self._all()
        if known:
            keys = reduce(DataFrame.union, [run.select(*KEY) for run in known])
            fresh = batch.join(keys, KEY, "left_anti")
            again = batch.join(keys, KEY, "left_semi").withColumn("holder", F.lit(None).cast("bigint"))
            batch = fresh.union(again)
        self._store(batch, 0)

    def repeated(self, min_docs: int = MIN_DOCS) -> DataFrame:
        """(k1, k2, holder) of the lines that at least ``min_docs`` documents hold."""
        return _merge(self._all()).where(F.col("n_docs") >= min_docs).select(*KEY, "holder")


def _merge(runs: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, runs).groupBy(*KEY).agg(F.sum("n_docs").alias("n_docs"), F.max("holder").alias("holder"))


def line_dedup(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """Each row of ``docs`` (doc_id, text, …) with ``kept`` text, ``n_lines`` before dropping and ``n_dropped``.

    A line whose key has ``min_chars`` code points or more, and which ``min_docs`` documents or more
    hold, is dropped everywhere but in the document of the largest id that holds it (where all its
    occurrences stay). Null and empty text are one empty line, kept. A row without doc_id keeps its
    lines and does not count as a holder; rows of one doc_id count as one document. Other columns
    are passed through, but for those named kept, n_lines or n_dropped.
    """
    lines = cut(long_lines(docs, min_chars))
    # Boundaries only spread the work: any would give the same result.
    steps = [k / batches for k in range(batches - 1, 0, -1)]
    bounds = lines.agg(F.percentile_approx("doc_id", F.array(*map(F.lit, steps)), F.lit(1000))).first()[0] or []
    runs = LineRuns(fanout)
    edges = [None, *bounds, None]
    for above, upto in zip(edges[1:], edges[:-1]):
        batch = lines
        if above is not None:
            batch = batch.where(F.col("doc_id") > above)
        if upto is not None:
            batch = batch.where(F.col("doc_id") <= upto)
        runs.absorb(batch.select("doc_id", *KEY))
    repeated = cut(runs.repeated(min_docs))
    places = lines.join(repeated, KEY).where("doc_id < holder").groupBy("doc_id", "row_hash").agg(F.sort_array(F.collect_set("pos")).alias("gone"))
    doc, row, places_of, all_lines = unused(docs.columns, "_doc", "_row", "_gone", "_lines")
    gone = cut(places).toDF(doc, row, places_of)
    joined = docs.join(gone, (docs["doc_id"] == F.col(doc)) & (F.xxhash64(docs["text"]) == F.col(row)), "left")
    # Between one dropped line and the next, whole slices stay: linear in the number of lines.
    split = joined.withColumn(all_lines, split_lines(docs["text"]))
    kept = F.when(F.size(places_of) > 0, F.array_join(_slices(all_lines, places_of), "\n")).otherwise(F.coalesce(docs["text"], F.lit("")))
    return split.select(
        *[docs[c] for c in docs.columns if c not in ("kept", "n_lines", "n_dropped")],
        kept.alias("kept"),
        F.size(all_lines).cast("bigint").alias("n_lines"),
        F.coalesce(F.size(places_of), F.lit(0)).cast("bigint").alias("n_dropped"),
    )


def _slices(lines: str, gone: str) -> Column:
    """The array ``lines`` without the places in the sorted array ``gone``."""
    return F.expr(
        f"""flatten(transform(sequence(0, size({gone})), j ->
            slice({lines}, if(j = 0, 1, {gone}[greatest(j, 1) - 1] + 2),
                  if(j = size({gone}), size({lines}), {gone}[least(j, size({gone}) - 1)]) - if(j = 0, 0, {gone}[greatest(j, 1) - 1] + 1))))"""
    )
