"""Near-duplicate classes by Jaccard similarity of word shingles: exact, by universe partition and pigeonhole.

Two sets r, s with similarity of at least 0.8 differ in at most (|r| + |s|) / 9 elements. For each
size band the universe of shingle hashes is cut into more segments than that, so at least one
segment of the two sets must be equal. A set's plan for its band and for the band below (where it
is the larger partner) indexes the content of each of its non-empty segments.

* A set whose non-empty segments outnumber its possible differences has a guarantee of its own:
  it needs to look up only ``differences + 1`` of them. Which ones is decided by cost: the
  segments whose content is shared by most sets are left out, those that nobody shares cost nothing.
* A set with too few non-empty segments also indexes the one-deletion neighbourhoods of its
  segments (a segment then detects up to one difference, so it counts twice), and where even that
  is too little, single elements. A pair needs the guarantee of one of its two sets, so only pairs
  of two such sets depend on the finer index, and both are in it.
* Candidates are verified by exact intersection, after a bound that a join can test: every element
  flips one of 512 parities, so sets differ in no fewer elements than their parities do. Links inside a class that is already connected
  cannot change it, so first every set is compared with the smallest one it shares a segment with,
  and then only sets of different classes are compared: large groups of near copies cost a star.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daygrain.llm.components import components
from daygrain.llm.spans import mixed, shingle_sets
from daygrain.session import cut, ship

WORDS = 5
PER_CENT = 80
#: Share of segments beyond those that the pigeonhole needs, so that widely shared ones can be left out.
SPARE = 0.2
#: So many sets a task knows again before it starts afresh.
REMEMBERED = 10_000


def band_limits(largest: int) -> list[tuple[int, int]]:
    """(smallest, largest) set size of each band; a partner at 0.8 is in the same or an adjacent band."""
    bands, low = [], 1
    while low <= largest:
        high = low * 100 // PER_CENT
        bands.append((low, high))
        low = high + 1
    return bands


def most_differences(a: int, b: int) -> int:
    """The largest symmetric difference of sets of these sizes that are similar enough."""
    return (a + b) * (100 - PER_CENT) // (100 + PER_CENT)


def segments_of(high: int) -> int:
    """How many segments the plan of a band has, ``high`` being its largest set size."""
    most = most_differences(high, high * 100 // PER_CENT)
    return 1 if most == 0 else most + 1 + max(2, int(SPARE * (most + 1)))


def signatures(elements: np.ndarray, bands: list[tuple[int, int]], band: int, smaller: bool) -> Iterator[tuple[int, int, np.ndarray]]:
    """(plan, how many may be left out, signatures) of a set in the plan of ``band``.

    ``smaller``: the set lies in that band itself; otherwise in the one above.
    """
    n, (_, high) = len(elements), bands[band]
    needed = most_differences(n, n * 100 // PER_CENT if smaller else min(n, high)) + 1
    segments = segments_of(high)
    mass = mixed(elements + np.uint64(0x5851F42D4C957F2D))
    cell = ((elements >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)
    starts = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
    own = np.add.reduceat(mass, starts)
    salt = mixed(cell * np.uint64(4096) + np.uint64(band))
    spare = len(starts) - needed
    yield band * 3, max(spare, 0) if spare >= 0 else len(starts), mixed(own ^ salt[starts])
    if spare >= 0:
        return
    sizes = np.diff(np.append(starts, n))
    salt = mixed(salt + np.uint64(1))
    several = np.repeat(sizes, sizes) > 1
    shrunk = np.repeat(own, sizes)[several] - mass[several]
    yield band * 3 + 1, 0, np.unique(mixed(np.concatenate((own ^ salt[starts], shrunk ^ salt[several]))))
    if int(np.minimum(sizes, 2).sum()) < needed:
        yield band * 3 + 2, n - needed, mixed(mass ^ np.uint64(3 * band + 2))


PARITIES = [f"p{k}" for k in range(8)]
MARKS = ", ".join(f"{p} bigint" for p in PARITIES)


def parities(elements: np.ndarray) -> np.ndarray:
    """512 bits in eight words: the parity of how many elements hash to each bit."""
    bits = np.bincount((elements & np.uint64(511)).astype(np.int64), minlength=512) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def set_keys(elements: np.ndarray) -> tuple[int, int]:
    """Two 64-bit hashes of a set, together its identity."""
    if not len(elements):
        return 0, 0
    return int(mixed(elements).sum()), int(mixed(elements ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum())


def _profiles(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, first, second, bits = [], [], [], []
            for found in shingle_sets(batch.column("text"), words):
                sizes.append(len(found))
                bits.append(parities(found))
                for keys, key in zip((first, second), set_keys(found)):
                    keys.append(key)
            hashes = [pa.array(np.array(k, np.uint64).view(np.int64)) for k in (first, second)]
            marks = [pa.array(b) for b in np.array(bits, np.int64).reshape(-1, len(PARITIES)).T]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), *hashes, *marks], ["doc_id", "n_shingles", "k1", "k2", *PARITIES])

    return run


def _index(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Of equal sets near each other one speaks for all: a group of copies is small before it is shuffled.
        known: set[tuple[int, int]] = set()
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            rows: list[tuple[int, int, int, np.ndarray]] = []
            held = 0
            if len(known) > REMEMBERED:
                known.clear()
            bands = band_limits(1)
            for doc, found in zip(ids.tolist(), shingle_sets(batch.column("text"), words)):
                n = len(found)
                if not n or (key := set_keys(found)) in known:
                    continue
                known.add(key)
                if n > bands[-1][1]:
                    bands = band_limits(n)
                band = next(k for k in range(len(bands) - 1, -1, -1) if bands[k][0] <= n)
                for at in (band, band - 1) if band else (band,):
                    for plan, spare, found_here in signatures(found, bands, at, at == band):
                        rows.append((doc, plan, spare, found_here))
                        held += len(found_here)
                if held > 200_000:
                    yield _rows(rows)
                    rows, held = [], 0
            if rows:
                yield _rows(rows)

    return run


def _rows(rows: list[tuple[int, int, int, np.ndarray]]) -> pa.RecordBatch:
    counts = [len(r[3]) for r in rows]
    doc, plan, spare = (np.repeat(np.array([r[k] for r in rows], np.int64), counts) for k in range(3))
    sig = np.concatenate([r[3] for r in rows]).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(sig), pa.array(doc), pa.array(plan.astype(np.int32)), pa.array(spare.astype(np.int32))], ["sig", "doc_id", "plan", "spare"])


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [x.tobytes() for x in shingle_sets(batch.column("text"), words)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.binary())], ["doc_id", "elements"])

    return run


def may_link(one: str, two: str) -> Column:
    """Whether the sizes and parities of two sets leave room for a link."""
    a, b = F.col(f"{one}.size"), F.col(f"{two}.size")
    differ = reduce(Column.__add__, [F.bit_count(F.col(f"{one}.{p}").bitwiseXOR(F.col(f"{two}.{p}"))) for p in PARITIES])
    return (100 * F.least(a, b) >= PER_CENT * F.greatest(a, b)) & (differ * (100 + PER_CENT) <= (a + b) * (100 - PER_CENT))


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        good = []
        for left, right in zip(batch.column("left"), batch.column("right")):
            r, s = np.frombuffer(left.as_buffer(), np.uint64), np.frombuffer(right.as_buffer(), np.uint64)
            both = np.sort(np.concatenate((r, s)))
            common = int((both[1:] == both[:-1]).sum())
            good.append(100 * common >= PER_CENT * (len(r) + len(s) - common))
        yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))


def linked(pairs: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """The pairs (a, b) of a stored table whose sets are similar enough; sets are made of their documents only."""
    wanted = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    sets = cut(texts.join(cut(wanted), "doc_id", "left_semi").mapInArrow(_sets(words), "doc_id bigint, elements binary"))
    left = sets.select(F.col("doc_id").alias("a"), F.col("elements").alias("left"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("elements").alias("right"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    return both.mapInArrow(_verified, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text; more columns are ignored).

    Null, empty and white-space texts have an empty set and link with nothing; their component is
    their doc_id. Equal sets are one class from the start. A null doc_id gets a null component_id;
    rows that share a doc_id are one document with several sets, each of which may link it.
    """
    ship(docs.sparkSession)
    texts = docs.select("doc_id", "text")
    profile = cut(texts.mapInArrow(_profiles(words), f"doc_id bigint, n_shingles bigint, k1 bigint, k2 bigint, {MARKS}"))
    filled = profile.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = filled.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"))
    marks = filled.select(F.col("doc_id").alias("rep"), F.col("n_shingles").alias("size"), *PARITIES)
    member = cut(filled.join(classes, ["k1", "k2"]).select("doc_id", "rep", "n_shingles").distinct())

    # Signatures that two documents at least have; a window that looks one row back and ahead holds no group.
    index = texts.where("doc_id IS NOT NULL").mapInArrow(_index(words), "sig bigint, doc_id bigint, plan int, spare int")
    order = Window.partitionBy("sig").orderBy("doc_id")
    shared = (
        index.withColumn("back", F.lag("doc_id").over(order))
        .withColumn("ahead", F.lead("doc_id").over(order))
        .where("back IS NOT NULL OR ahead IS NOT NULL")
        .select("sig", "doc_id", "plan", "spare")
    )
    rows = cut(shared.join(member.select("doc_id", "rep"), "doc_id").select("sig", "rep", "plan", "spare").distinct())
    buckets = rows.groupBy("sig").agg(F.count("*").alias("n"), F.min("rep").alias("leader"), F.max("rep").alias("last")).where("leader <> last")
    counted = rows.join(buckets.select("sig", "n", "leader"), "sig")
    # Each set leaves out its most shared signatures, as many as its guarantee allows.
    dearest = Window.partitionBy("rep", "plan").orderBy(F.desc("n"), "sig")
    index_rows = cut(counted.withColumn("place", F.row_number().over(dearest)).select("sig", "rep", "leader", (F.col("place") > F.col("spare")).alias("probes")))

    stars = index_rows.where("probes AND rep <> leader").select("rep", "leader").distinct()
    stars = stars.join(marks, "rep").alias("one").join(marks.withColumnRenamed("rep", "leader").alias("two"), "leader").where(may_link("one", "two"))
    links = cut(linked(cut(stars.groupBy(F.col("rep").alias("b")).agg(F.min("leader").alias("a"))), texts, words))
    group = cut(components(links))

    # All that is left: sets of different classes that share a signature at least one of them looks up.
    placed = index_rows.join(group.withColumnRenamed("id", "rep"), "rep", "left").withColumn("group", F.coalesce("component_id", "rep")).drop("component_id")
    placed = cut(placed)
    mixed_buckets = placed.groupBy("sig").agg(F.min("group").alias("low"), F.max("group").alias("high"), F.max("probes").alias("probed")).where("low <> high AND probed")
    # The class of most members is compared with the others only, never with itself.
    sizes = placed.join(mixed_buckets.select("sig"), "sig").groupBy("sig", "group").agg(F.count("*").alias("n"))
    main = sizes.groupBy("sig").agg(F.max(F.struct("n", "group")).alias("top")).select("sig", F.col("top.group").alias("main"))
    there = cut(placed.join(main, "sig").join(marks, "rep").select("sig", "rep", "group", "probes", "size", *PARITIES, (F.col("group") == F.col("main")).alias("is_main")))
    one, two = there.where("NOT is_main").alias("one"), there.alias("two")
    apart = (F.col("one.group") != F.col("two.group")) & (F.col("one.probes") | F.col("two.probes"))
    near = (
        one.join(two, (F.col("one.sig") == F.col("two.sig")) & apart & may_link("one", "two"))
        .select(F.least("one.rep", "two.rep").alias("a"), F.greatest("one.rep", "two.rep").alias("b"))
        .distinct()
    )
    more = linked(cut(near), texts, words)
    copies = member.where("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    everything = components(links.union(more).union(copies)).withColumnRenamed("id", "doc_id")
    return profile.select("doc_id", "n_shingles").join(everything, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
