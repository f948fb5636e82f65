"""Vectors and shingle sets against brute force."""

import random
import re

import numpy as np
import pytest
from llm_rows import ODD

from daygrain.llm import components, ngram_join, pq_dedup


def roots(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_components_of_chains_stars_and_nothing(spark):
    links = [(k, k + 1) for k in range(20, 60)] + [(100, k) for k in range(101, 160)] + [(160, 130), (7, 7), (None, 3), (5, 4), (4, 5)]
    found = components.components(spark.createDataFrame(links, "a bigint, b bigint"))
    got = {r["id"]: r["component_id"] for r in found.collect()}
    real = [(a, b) for a, b in links if a is not None and a != b]
    assert got == roots({x for p in real for x in p}, real)
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def shingles(text, n=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[k : k + n]) for k in range(len(words) - n + 1)) if len(words) >= n else frozenset([tuple(words)] if words else [])


def brute_classes(rows):
    sets = {}
    for doc, text, *_ in rows:
        if doc is not None:
            sets[doc] = shingles(text)
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    top = roots(ids, links)
    return {i: (len(sets[i]), top[i]) for i in ids}


def classes(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.near_duplicates(df).collect() if r["doc_id"] is not None}


def test_near_duplicates_of_random_families(spark, docs_of):
    random.seed(3)
    rows = []
    for size in (1, 4, 5, 6, 7, 8, 9, 10, 11, 12, 14, 17, 23, 40, 90, 300):
        base = [random.choice("abcdefghij") + str(random.randrange(40)) for _ in range(size)]
        for k in range(9):
            words = list(base)
            for _ in range(random.choice((0, 0, 1, 1, 2, size // 30, size // 12))):
                at = random.randrange(len(words))
                action = random.random()
                if action < 0.4:
                    words[at] = f"new{random.randrange(10**6)}"
                elif action < 0.7 and len(words) > 1:
                    del words[at]
                else:
                    words.insert(at, random.choice(base))
            rows.append((len(rows), " ".join(words).upper() if k % 2 else "  ".join(words)))
    shared = "one passage of a few words that every one of these documents holds somewhere in it as a notice of some kind"
    rows += [(1000 + k, " ".join(f"w{k}x{j}" for j in range(30)) + " " + shared) for k in range(30)]
    assert classes(docs_of(rows)) == brute_classes(rows)


def test_near_duplicates_of_odd_rows_and_none(spark, docs_of):
    found = ngram_join.near_duplicates(docs_of(ODD))
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    got = sorted((tuple(r) for r in found.collect()), key=repr)
    expected = brute_classes(ODD)
    alone = [(None, len(shingles(ODD[4][1])), None)]
    assert got == sorted([(d, *expected[d]) for d, _ in ODD if d is not None] + alone, key=repr)
    assert ngram_join.near_duplicates(docs_of([])).count() == 0


def test_every_pair_shares_a_probed_signature():
    """The guarantee itself: of two similar sets one at least must look up a segment the other has."""
    random.seed(9)
    bands = ngram_join.band_limits(2000)
    for _ in range(400):
        n = random.choice((1, 2, 3, 4, 5, 6, 8, 10, 13, 20, 33, 60, 150, 400))
        base = np.unique(np.array([random.getrandbits(64) for _ in range(n)], np.uint64))
        n = len(base)
        gone = random.randrange(0, max(1, n // 9) + 1)
        added = np.array([random.getrandbits(64) for _ in range(random.randrange(0, max(1, n // 9) + 1))], np.uint64)
        other = np.unique(np.concatenate((np.delete(base, random.sample(range(n), min(gone, n - 1))), added)))
        common = len(np.intersect1d(base, other))
        if 100 * common < 80 * (len(base) + len(other) - common):
            continue
        index = []
        for x in (base, other):
            band = next(k for k in range(len(bands) - 1, -1, -1) if bands[k][0] <= len(x))
            index.append({(plan, s): spare for at in ((band, band - 1) if band else (band,)) for plan, spare, found in ngram_join.signatures(x, bands, at, at == band) for s in found.tolist()})
        both = set(index[0]) & set(index[1])
        # Each may leave out `spare` signatures of a plan, so more than that must be shared.
        assert any(sum(q[0] == plan for q in both) > own[key] for own in index for plan, key in [(k[0], k) for k in both])


def brute_vectors(rows):
    good = {i: np.array(v, np.float64) for i, v in rows if v is not None and len(v) and None not in v and np.isfinite(np.array(v, float)).all() and np.any(v)}
    ids = sorted(i for i, _ in rows)
    links = []
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if a in good and b in good and len(good[a]) == len(good[b]):
                x, y = good[a], good[b]
                if (x @ y) / np.sqrt((x @ x) * (y @ y)) >= 0.9:
                    links.append((a, b))
    top = roots(ids, links)
    return {i: (sum(i in p for p in links), top[i], top[i] == i) for i in ids}


def test_near_vectors(spark, monkeypatch):
    random = np.random.default_rng(4)
    rows = []
    for _ in range(60):
        base = random.normal(size=16)
        for _ in range(random.integers(1, 7)):
            rows.append((len(rows), [float(np.float32(x)) for x in base + random.normal(size=16) * random.choice([0.05, 0.2, 0.3])]))
    rows += [(1000 + k, rows[3][1]) for k in range(12)]  # copies
    rows += [(1100, [2 * float(x) for x in rows[3][1]]), (1101, None), (1102, []), (1103, [0.0] * 16), (1104, [float("nan")] * 16), (1105, [float("inf")] + [1.0] * 15)]
    rows += [(1106, [None] + [1.0] * 15), (1107, [1.0, 2.0]), (1108, [1.0, 2.1])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").selectExpr("*", "1 AS rep", "2 AS cell", "3 AS label", "4 AS copies")
    expected = brute_vectors(rows)
    for lists, block, queries in ((1 << 20, 2048, 4096), (16, 5, 7)):
        monkeypatch.setattr(pq_dedup, "LIST_SIZE", lists)
        monkeypatch.setattr(pq_dedup, "BLOCK", block)
        monkeypatch.setattr(pq_dedup, "QUERIES", queries)
        got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in pq_dedup.near_vectors(df).collect()}
        assert set(got) == set(expected)
        if lists > 16:
            assert got == expected
        else:  # several lists: recall counts
            assert sum(v[0] for v in got.values()) >= 0.9 * sum(v[0] for v in expected.values())
            assert all(got[i][0] <= expected[i][0] for i in got)
    assert pq_dedup.near_vectors(df.limit(0)).count() == 0


def test_recall_on_the_given_vectors(spark):
    """The given vectors have no pair, and none is found."""
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    x = np.array([r["embedding"] for r in rows.orderBy("vec_id").collect()], np.float64)
    x /= np.sqrt((x**2).sum(axis=1))[:, None]
    assert sum(r["n_links"] for r in pq_dedup.near_vectors(rows).collect()) == int(((x @ x.T) >= 0.9).sum()) - len(x) == 0


@pytest.mark.parametrize("lists", [64, 512, 2048, 16384, 4_000_000])
def test_recall_of_planted_pairs_by_the_number_of_lists(lists):
    """Pairs at a cosine of 0.9 to 0.92 in 64 dimensions: how many meet in a probed list. The figures are in the README."""
    random = np.random.default_rng(lists)
    unit = lambda v: v / np.sqrt((v**2).sum(axis=1))[:, None]
    index = pq_dedup.fit(unit(random.normal(size=(4096, 64))), lists)
    assert index.lists >= lists
    one = unit(random.normal(size=(200, 64)))
    other = random.normal(size=one.shape)
    other = unit(other - (other * one).sum(axis=1)[:, None] * one)
    cosine = random.uniform(0.9, 0.92, len(one))[:, None]
    other = cosine * one + np.sqrt(1 - cosine**2) * other
    a, b = index.nearest(one), index.nearest(other)
    recall = float(((a == b[:, :1]).any(axis=1) | (b == a[:, :1]).any(axis=1)).mean())
    print(f"{index.lists} lists, {index.probes} probes: recall {recall:.3f}")
    assert recall >= 0.95


def test_lists_divided_twice_lose_no_link_when_all_are_probed(spark, monkeypatch):
    random = np.random.default_rng(9)
    rows = []
    for _ in range(80):
        base = random.normal(size=12)
        rows += [(len(rows) + k, [float(x) for x in base + random.normal(size=12) * 0.15]) for k in range(4)]
    for name, value in {"LIST_SIZE": 8, "COARSE": 6, "PROBES": 1000}.items():
        monkeypatch.setattr(pq_dedup, name, value)
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in pq_dedup.near_vectors(df).collect()}
    assert got == brute_vectors(rows)


@pytest.mark.parametrize("n", [1, 2, 3, 7, 50, 1000])
def test_bands_hold_every_partner(n):
    bands = ngram_join.band_limits(2 * n)
    at = next(k for k, (low, high) in enumerate(bands) if low <= n <= high)
    assert bands[at][0] <= n * 5 // 4 <= bands[min(at + 1, len(bands) - 1)][1]
