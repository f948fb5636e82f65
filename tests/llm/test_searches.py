"""The exact searches against brute force."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_rows import ODD
from pyspark.sql import functions as F

from daygrain.llm import blocks, hard_negatives, lexical, pivot_search


def whole(rows):
    """[(vec_id, label, integers)] of the rows that take part."""
    found = []
    for vec_id, vector, *label in rows:
        if vec_id is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            found.append((vec_id, label[0] if label else None, [math.floor(256 * x) for x in vector]))
    return found


def score(a, b):
    return sum(x * y for x, y in zip(a, b))


def brute_top(rows, every, k=5):
    out = []
    for q, _, x in whole(rows):
        if q % every == 0:
            best = sorted((-score(x, y), c) for c, _, y in whole(rows) if c != q and len(x) == len(y))[:k]
            out += [(q, rank, c, -s) for rank, (s, c) in enumerate(best, 1)]
    return sorted(out)


def brute_negatives(rows, every, low=80, high=100, k=5):
    out = []
    held = [r for r in whole(rows) if r[1] is not None]
    for q, label, x in held:
        if q % every:
            continue
        near = sorted((-score(x, y), c) for c, own, y in held if c != q and own == label and len(x) == len(y))[:k]
        far = sorted((-score(x, y), c) for c, own, y in held if c != q and own != label and len(x) == len(y))
        for s, p in near:
            fit = [(n, c) for n, c in far if low * -s <= 100 * -n <= high * -s][:k]
            out += [(q, p, rank, c, -s, -n) for rank, (n, c) in enumerate(fit, 1)]
    return sorted(out)


def odd_vectors():
    random = np.random.default_rng(8)
    plain = lambda v: [float(x) for x in v]
    rows = [(k, plain(random.normal(size=8) * 0.3), k % 3) for k in range(300)]
    centres = random.normal(size=(6, 8))
    rows += [(300 + k, plain(centres[k % 6] + 0.02 * random.normal(size=8)), k % 4) for k in range(300)]
    rows += [(700 + k, rows[300][1], k % 3) for k in range(40)]  # copies: ties
    rows += [(800, None, 1), (801, [], 1), (810, [], 2), (802, [float("nan")] * 8, 1), (803, [float("inf")] + [0.0] * 7, 1), (804, [None] + [0.0] * 7, 1)]
    rows += [(805, [0.0] * 8, 1), (806, [1.0, 2.0], 1), (807, [1.5, -2.0], 2), (820, [2.0, 2.0], 1), (None, [0.5] * 8, 1), (808, [0.5] * 8, None)]
    rows += [(850, [9e6] + [0.1] * 7, 1), (851, [9e6] + [-0.1] * 7, 1), (852, [-8.9e6] + [0.3] * 7, 2), (853, [8.8e6] + [0.3] * 7, 2), (870, rows[5][1], 0), (870, rows[6][1], 0), (871, rows[5][1], 1), (871, rows[5][1], 1)]
    return rows


VECTORS = "vec_id bigint, embedding array<double>, label int"
SMALL = {pivot_search: {"ANNULUS": 64, "QUERIES": 80, "SHARD": 3, "SAMPLE": 40, "PIVOTS": 7}, hard_negatives: {"LEAF": 40, "SUBTREE": 160, "ANCHORS": 80, "SHARD": 2, "SAMPLE": 50, "SLABS": 3}}


@pytest.fixture(params=[False, True], ids=["usual", "small blocks"])
def block_sizes(request, monkeypatch):
    for module, values in SMALL.items() if request.param else ():
        for name, value in values.items():
            monkeypatch.setattr(module, name, value)


def clashing(df):
    return df.selectExpr("*", "1 AS block", "2 AS cell", "3 AS shard", "'x' AS body", "4 AS dims", "5 AS query_id", "6 AS rank", "7 AS score", "8 AS norm2", "9 AS anchor_id", "10 AS wide")


def test_top_k(spark, rows, block_sizes):
    given = odd_vectors()
    found = pivot_search.top_k(clashing(spark.createDataFrame(given, VECTORS)), F.col("vec_id") % 10 == 0)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(rows(found)) == brute_top(given, 10)


def test_top_k_of_few_and_no_rows(spark, rows):
    given = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (50, [-1.0, 0.25]), (51, [0.1])]
    df = spark.createDataFrame(given, "vec_id bigint, embedding array<float>")
    assert sorted(rows(pivot_search.top_k(df, F.col("vec_id") % 50 == 0))) == brute_top(given[:3], 50)
    assert pivot_search.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert pivot_search.top_k(df, F.col("vec_id") < 0).count() == 0


def test_annuli_out_of_reach_are_not_read(spark, monkeypatch):
    """On clustered vectors most tiles of query block and annulus are ruled out before anything is sent."""
    for name, value in {"ANNULUS": 16 * 50, "QUERIES": 16 * 10, "SHARD": 1, "SAMPLE": 400}.items():
        monkeypatch.setattr(pivot_search, name, value)
    random = np.random.default_rng(2)
    centres = random.normal(size=(20, 16))
    given = [(k, [float(x) for x in centres[k % 20] + 0.01 * random.normal(size=16)]) for k in range(4000)]
    stored = []
    real = pivot_search.cut
    monkeypatch.setattr(pivot_search, "cut", lambda df: stored.append(real(df)) or stored[-1])
    found = pivot_search.top_k(spark.createDataFrame(given, "vec_id bigint, embedding array<double>"), F.col("vec_id") % 50 == 0)
    assert sorted(tuple(r) for r in found.collect()) == brute_top(given, 50)
    tiles = next(t for t in stored if "ring" in t.columns).count()
    annuli, asking = next(t for t in stored if "radii" in t.columns).count(), next(t for t in stored if "reach" in t.columns).count()
    assert tiles < 0.6 * annuli * asking


def test_a_score_beyond_64_bits_is_an_error(spark):
    df = spark.createDataFrame([(0, [1e9, 1e9], 1), (1, [1.1e9, 1e9], 1), (2, [1.0, 1.0], 2)], VECTORS).where("vec_id >= 0")
    assert pivot_search.top_k(df.withColumn("embedding", F.transform("embedding", lambda x: x / 1000)), F.col("vec_id") == 0).count() == 2
    with pytest.raises(Exception, match="64 bits"):
        pivot_search.top_k(df, F.col("vec_id") == 0).collect()
    with pytest.raises(Exception, match="62 bits"):
        pivot_search.top_k(spark.createDataFrame([(0, [1e30], 1)], VECTORS), F.col("vec_id") == 0).collect()


def test_hard_negatives(spark, rows, block_sizes):
    given = odd_vectors()
    found = hard_negatives.hard_negatives(clashing(spark.createDataFrame(given, VECTORS)), F.col("vec_id") % 10 == 0)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(rows(found)) == brute_negatives(given, 10)
    other = hard_negatives.hard_negatives(spark.createDataFrame(given, VECTORS), F.col("vec_id") % 20 == 0, 3, 2, 33, 95)
    near = {(a, p) for a, p, *_ in brute_negatives(given, 20, 33, 95, 3)}
    got = rows(other)
    assert {(r[0], r[1]) for r in got} == near and all(33 * r[4] <= 100 * r[5] <= 95 * r[4] and r[2] <= 2 for r in got)
    nothing = spark.createDataFrame(given, VECTORS)
    assert hard_negatives.hard_negatives(nothing.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert hard_negatives.hard_negatives(nothing.withColumn("label", F.lit(1)), F.col("vec_id") % 10 == 0).count() == 0


def test_intervals_hold_every_product():
    random = np.random.default_rng(1)
    x, y = random.integers(-300, 300, (20, 12)), random.integers(-300, 300, (30, 12))
    low, high = hard_negatives._intervals(x, y.min(axis=0)[None], y.max(axis=0)[None])
    exact = x @ y.T
    assert (low[:, 0] <= exact.min(axis=1)).all() and (high[:, 0] >= exact.max(axis=1)).all()
    low, high = hard_negatives._intervals(x, y[:1], y[:1])
    assert (low[:, 0] == exact[:, 0]).all() and (high[:, 0] == exact[:, 0]).all()


def test_boxes_that_cannot_matter_are_not_read(monkeypatch):
    """The queue reads the leaves around the anchor's own cluster, not the others."""
    import pandas as pd

    random = np.random.default_rng(5)
    centres = 2000 * random.normal(size=(16, 3))
    x = np.concatenate([c + random.normal(size=(64, 3)) for c in centres]).astype(np.int64)
    monkeypatch.setattr(hard_negatives, "LEAF", 64 * 3)
    tree = {"block": 1, "shard": 0, "n": len(x), "wide": False, "ids": np.arange(len(x)).tobytes(), "body": x.astype(np.int32).tobytes(), **hard_negatives._boxes(None, x)}
    asked = {"asking": 9, "part": 0, "n": 1, "dims": 3, "wide": False, "ids": np.array([5000]).tobytes(), "body": x[:1].astype(np.int32).tobytes()}
    read = []
    real = hard_negatives.products
    monkeypatch.setattr(hard_negatives, "products", lambda a, b: read.append(len(b)) or real(a, b))
    found = hard_negatives._search(5)((1, 0), pd.DataFrame([tree]), pd.DataFrame([asked]))
    exact = sorted(((-int(v), k) for k, v in enumerate(x @ x[0])))[:5]
    assert [(-s, i) for s, i in zip(found["score"], found["other_id"])] == [(s, i) for s, i in exact]
    assert read.count(64) <= 4


def test_products_are_exact_in_each_arithmetic():
    random = np.random.default_rng(3)
    for top in (100, 10**6, 2**30, 2**31):
        a, b = random.integers(-top, top, (3, 2)), random.integers(-top, top, (4, 2))
        assert blocks.products(a, b).tolist() == [[score(map(int, p), map(int, q)) for q in b] for p in a]


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_ranked(docs, items, k=20):
    held = [(d, Counter(t), len(t)) for d, t in ((d[0], terms(d[1])) for d in docs if d[0] is not None) if t]
    n_docs, n_terms = len(held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    lists = defaultdict(list)
    for at, (_, counts, n) in enumerate(held):
        m = 75 + (25 * n * n_docs) // n_terms
        for t, tf in counts.items():
            w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
            lists[t].append((at, w * ((10**9 * tf) // (1000 * tf + 12 * m))))
    out = []
    for item, text in items:
        total = Counter()
        for t in terms(text) if item is not None else ():
            for at, part in lists[t]:
                total[at] += part
        best = sorted((-s, held[at][0]) for at, s in total.items() if s > 0)[:k]
        out += [(item, rank, d, -s) for rank, (s, d) in enumerate(best, 1)]
    return sorted(out)


def odd_texts():
    random = np.random.default_rng(6)
    words = [f"w{k}" for k in range(60)] + ["Ünï", "日本語", "ABC", "x1y2", "naïve"]
    weights = 1 / np.arange(1, len(words) + 1)
    text = lambda n: " ".join(random.choice(words, n, p=weights / weights.sum()))
    docs = [(100 + k, text(int(random.integers(1, 60)))) for k in range(300)]
    docs += ODD + [(600 + k, "same words in each of these copies w50") for k in range(30)]
    items = [(k, text(int(random.integers(1, 12)))) for k in range(20)]
    items += [(50, None), (51, ""), (52, "?!"), (53, "nowhere"), (54, "copies, COPIES copies"), (55, "日本語 ties"), (None, "copies"), (56, "very long text w1 w2"), (57, "a\x00b-c_d")]
    return docs, items


ITEMS = "item_id bigint, text string"


@pytest.mark.parametrize("small", [False, True])
def test_ranked(spark, rows, docs_of, monkeypatch, small):
    for name, value in {"SHARD": 300, "ITEMS": 7, "FIRST_READ": 2, "PIECE": 500}.items() if small else ():
        monkeypatch.setattr(lexical, name, value)
    docs, items = odd_texts()
    asked = spark.createDataFrame(items, ITEMS).selectExpr("*", "1 AS doc_id", "2 AS rank", "3 AS code", "4 AS row", "5 AS id", "6 AS terms")
    given = docs_of(docs).selectExpr("*", "1 AS code", "2 AS m", "3 AS tf", "4 AS term", "5 AS id", "6 AS row")
    found = lexical.ranked(given, asked)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(rows(found)) == brute_ranked(docs, items)


def test_ranked_of_nothing(spark, docs_of):
    docs, items = odd_texts()
    asked = spark.createDataFrame(items, ITEMS)
    assert lexical.ranked(docs_of([]), asked).count() == 0
    assert lexical.ranked(docs_of(docs), asked.limit(0)).count() == 0
    assert lexical.ranked(docs_of([(1, None), (2, "...")]), asked).count() == 0


def test_best_positions_stop_before_the_end():
    """One document far above the others is found after few accesses, though both lists are long."""
    n = 20_000
    impact = np.concatenate((900_000 - np.arange(n), 900_000 - np.arange(n)[::-1]))
    impact[[7, n + 7]] = 990_000
    lists = lexical.Lists(np.repeat([3, 8], n), np.concatenate((np.arange(n), np.arange(n))), impact)
    known = np.zeros(n, bool)
    found, names, scored = lists.best(np.array([3, 5, 8]), np.array([10, 10, 10]), np.arange(n) + 500, known, 1)
    assert found.tolist() == [2 * 10 * 990_000] and names.tolist() == [507]
    assert scored < n / 100 and not known.any()
