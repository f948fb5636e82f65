"""Operators on texts and pages against plain versions, exact round trips and held-out rows."""

import hashlib
import random
import re
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_rows import ODD
from pyspark.sql import functions as F

from daygrain.llm import decontaminate, html_text, language, licenses, line_runs, packing, quality, spans, subword, token_counts
from daygrain.llm.tables import tokenizer_path

BPE = tokenizer_path("byte_bpe_50k.json")
UNIGRAM = tokenizer_path("piece_bpe_32k.model")
ALPHABET = list("abcXYZ019 .,!?'\n\t-_éßñ²½日🙂 ​") + ["'s", "'re", " the", "  ", "<|endoftext|>", " don't", "\n\n"]


# -- packing --


def test_ids_equal_the_tokenizers_own():
    from tokenizers import Tokenizer

    random.seed(1)
    texts = ["", " ", "'", "a'", "''s", " 's", "x's", "don't we'll", "\n's", "<|endoftext|>", "a<|endoftext|>b"]
    texts += ["".join(random.choices(ALPHABET, k=random.randrange(60))) for _ in range(400)]
    plain = Tokenizer.from_file(BPE)
    words = packing.Words(BPE)
    words.SLOTS = 64  # so that pre-tokens meet in one place all the time
    words.clear()
    for _ in range(2):
        assert [x.tolist() for x in words.ids(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_best_fit_is_a_packing_close_to_the_bound():
    random.seed(2)
    sizes = np.array([random.randint(1, 100) for _ in range(3000)])
    bins = packing.best_fit(sizes, 100)
    assert sorted(k for b in bins for k in b) == list(range(3000))
    assert max(int(sizes[b].sum()) for b in bins) <= 100
    assert len(bins) <= 1.02 * sizes.sum() / 100 + 1
    assert packing.best_fit(np.zeros(0, np.int64), 100) == []


def test_packing_round_trip(spark, docs_of, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "GROUP", 40)
    random.seed(3)
    rows = ODD + [(100 + k, "".join(random.choices(ALPHABET, k=random.choice((3, 30, 300, 6000))))) for k in range(150)]
    found = packing.pack_documents(docs_of(rows), BPE, 256).toPandas()
    assert list(found.columns) == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    plain = Tokenizer.from_file(BPE)
    expected = []
    for doc, text in rows:
        ids = np.array(plain.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        count = -(-len(ids) // 256)
        edges = [0] + [len(ids) - 256 * (count - 1 - k) for k in range(count)]
        expected += [(doc, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(edges, edges[1:]))]
    got = [(None if d != d else int(d), *map(int, r)) for d, *r in found[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False)]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    for _, one in found.sort_values("offset").groupby("sequence_id"):
        assert one["length"].sum() <= 256
        assert (one["offset"] == one["length"].cumsum() - one["length"]).all()
    assert found["sequence_id"].nunique() <= 1.05 * found["length"].sum() / 256 + 2
    assert packing.pack_documents(docs_of([]), BPE).count() == 0


def test_items_that_cannot_pair_stay_apart(spark):
    pieces = spark.createDataFrame([(k, 0, 0, 700, k) for k in range(300)], "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")
    assert packing.pack(pieces, 1024, group=50).select("sequence_id").distinct().count() == 300


def test_equal_rows_are_dealt_apart_and_small_bins_meet(spark):
    """Rows that are equal in everything are many groups, and one bin at most stays that is not more than half full."""
    same = spark.range(200_000, numPartitions=8).selectExpr("cast(null AS bigint) AS doc_id", "0 AS piece", "0L AS start", "1L AS length", "7L AS ids_crc32")
    packed = packing.pack(same, 1024, group=4096)
    sizes = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert sizes.agg(F.sum("n"), F.max("n"), F.count_if(F.expr("n <> end"))).first()[:] == (200_000, 1024, 0)
    assert sizes.count() <= -(-200_000 // 1024) + 1


def test_rounds_go_on_while_bins_can_join(spark):
    source = random.Random(4)
    pieces = [(k, 0, 0, source.choice([300, 500, 505, 700, 705, 319, 10]), k) for k in range(3000)]
    df = spark.createDataFrame(pieces, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")
    packed = packing.pack(df, 1024, group=32)
    filled = sorted(r["n"] for r in packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect())
    assert packed.count() == 3000 and sum(2 * n <= 1024 for n in filled) <= 1


# -- line dedup --


def brute_lines(rows, chars, docs):
    def key(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))

    split = [(d, (t or "").split("\n")) for d, t in rows]
    holders = {}
    for d, lines in split:
        for line in lines:
            if d is not None and len(key(line)) >= chars:
                holders.setdefault(key(line), set()).add(d)
    last = {k: max(v) for k, v in holders.items() if len(v) >= docs}
    out = []
    for d, lines in split:
        kept = [x for x in lines if d is None or last.get(key(x), d) == d]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


@pytest.mark.parametrize("batches, fanout", [(1, 2), (4, 2), (7, 3)])
def test_line_dedup(spark, docs_of, batches, fanout):
    random.seed(batches)
    pool = [f"Line {k} ÉÀ with words" for k in range(12)] + ["", " ", "short"]
    rows = ODD + [(50 + k, "\n".join(random.choice((str.upper, str, lambda x: f" \t{x}\r"))(random.choice(pool)) for _ in range(random.randrange(9)))) for k in range(60)]
    rows += rows[-3:]
    done = line_runs.line_dedup(docs_of(rows), 9, 5, batches, fanout)
    got = [tuple(r) for r in done.select("doc_id", "n_lines", "n_dropped", "kept").collect()]
    assert sorted(got, key=repr) == sorted(brute_lines(rows, 9, 5), key=repr)
    assert {"sig", "label"} <= set(done.columns)


def test_line_dedup_of_nothing(docs_of):
    assert line_runs.line_dedup(docs_of([])).count() == 0


def test_runs_are_compacted(spark):
    runs = line_runs.LineRuns(2)
    for k in range(7, 0, -1):
        runs.absorb(spark.createDataFrame([(k, 1, 1), (k, k, 0)], "doc_id bigint, k1 bigint, k2 bigint"))
    assert [len(level) for level in runs.levels] == [1, 1, 1]
    assert {tuple(r) for r in runs.repeated(7).collect()} == {(1, 1, 7)}


# -- decontamination --

ITEM = "A train leaves Boston at 60 miles per hour and Alice waits for 3 hours before she meets Bob near the old station today"
OTHER = "Nothing in this sentence looks like anything that was asked before in any test of this kind at all"


def test_templates_catch_copies_and_new_values(spark, docs_of):
    # A new value for each old one is a re-parameterised question; one name with two values is not.
    alike = ITEM.replace("Boston", "Paris").replace("60", "75.5").replace("miles", "km").replace("Alice", "Carol").replace("3 hours", "4 hours")
    twice = "If Tom has 5 apples and Tom eats 2 of his apples then how many apples does poor Tom have left over"
    docs = [(1, f"Before. {ITEM}. After it."), (2, f"intro\n{alike}\nmore"), (3, OTHER), (4, ITEM[:60]), (5, twice.replace("Tom", "Ann").replace("5", "9")), (6, twice.replace("Tom", "Ann", 2))]
    items = spark.createDataFrame([(1, ITEM), (2, OTHER[:20]), (3, None), (None, ITEM), (4, twice), (4, twice)], "item_id bigint, text string").selectExpr("*", "1 AS doc_id", "2 AS pos")
    got = {(r["doc_id"], r["item_id"]): (r["n_slots"], r["n_changed"]) for r in decontaminate.leaks(docs_of(docs + ODD), items).collect()}
    assert set(got) == {(1, 1), (2, 1), (5, 4)}
    assert got[1, 1][1] == 0 and got[1, 1][0] >= 6
    assert got[2, 1][1] == 5
    assert got[5, 4][1] == 4


def test_copies_in_other_letter_case_or_after_other_words(spark, docs_of):
    short = "What is 12 times 7?"
    wrapped = ITEM.replace("Boston", "\nBoston").replace("Alice", "\nAlice").replace("Bob", "\nBob")
    docs = [(1, ITEM.upper()), (2, ITEM.lower()), (3, wrapped), (4, f"Question: {short}"), (5, f"he asked {short.lower()} again"), (6, OTHER.upper()), (7, "Question: " + short.replace("12", "15"))]
    items = spark.createDataFrame([(1, ITEM), (2, short)], "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]): (r["n_windows"], r["n_found"], r["n_changed"]) for r in decontaminate.leaks(docs_of(docs), items).collect()}
    assert set(got) == {(1, 1), (2, 1), (3, 1), (4, 2), (5, 2), (7, 2)}
    assert all(found == n for n, found, _ in got.values())
    assert {k: v[2] for k, v in got.items()} == {(1, 1): 0, (2, 1): 0, (3, 1): 0, (4, 2): 0, (5, 2): 0, (7, 2): 1}


def test_one_clash_costs_only_its_windows(spark, docs_of):
    tail = "and then the farmer walks along the river until the sun goes down behind the hills while his dog follows slowly and the birds sing in the tall trees near the old mill"
    names = f"If Tom has many apples and Tom gives some away {tail}"
    numbers = f"there are 3 apples and 3 pears in a basket {tail} of the village"
    docs = [(1, names.replace("Tom", "Ann", 1)), (2, numbers.replace("3", "7", 1)), (3, numbers.replace("3 apples", "4 apples").replace("3 pears", "5 pears")), (4, numbers)]
    items = spark.createDataFrame([(1, names), (2, numbers)], "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]): r["n_found"] < r["n_windows"] for r in decontaminate.leaks(docs_of(docs), items).collect()}
    assert got == {(1, 1): True, (2, 2): True, (3, 2): True, (4, 2): False}


def leaked(spark, docs_of, docs, items):
    found = decontaminate.leaks(docs_of(docs), spark.createDataFrame(items, "item_id bigint, text string"))
    return {(r["doc_id"], r["item_id"]): (r["n_windows"], r["n_found"], r["n_changed"], r["form"]) for r in found.collect()}


def test_items_of_fewer_tokens_than_a_window_are_found_word_for_word(spark, docs_of):
    items = [(1, "What is 2+2?"), (2, "Who wrote Hamlet?"), (3, "Pi?"), (4, "...")]
    docs = [(1, "Tell me: what is 2 + 2? I wonder."), (2, "Question: who wrote Hamlet? Nobody knows."), (3, "What is 2+3? Who wrote the play?"), (4, "Take Pi."), (5, "WHO WROTE HAMLET"), (6, "What is 2")]
    assert leaked(spark, docs_of, docs, items) == {(1, 1): (1, 1, 0, "aligned"), (2, 2): (1, 1, 0, "aligned"), (4, 3): (1, 1, 0, "aligned"), (5, 2): (1, 1, 0, "aligned")}


def test_scripts_without_spaces_are_found_character_by_character(spark, docs_of):
    item, thai = "\u65e5\u672c\u306e\u9996\u90fd\u306f\u3069\u3053\u3067\u3059\u304b", "\u0e40\u0e21\u0e37\u0e2d\u0e07\u0e2b\u0e25\u0e27\u0e07"
    docs = [(1, f"\u8cea\u554f{item}\u3002Tokyo"), (2, item[:5] + "\u5927" + item[6:]), (3, f"x {thai} y"), (4, "\u65e5\u672c")]
    got = leaked(spark, docs_of, docs, [(1, item), (2, thai), (3, "\u65e5\u672c\u4eba")])
    assert set(got) == {(1, 1), (3, 2)} and all(found == n for n, found, *_ in got.values())


def test_tables_of_numbers_meet_by_their_values_only(spark, docs_of):
    numbers = " ".join(str(k) for k in range(100, 160))
    plain = "Please add up the following numbers and tell me what you get"
    items = [(1, f"{plain} {numbers}"), (2, numbers)]
    docs = [(1, " ".join(str(k) for k in range(3000, 6000))), (2, f"{plain} {numbers}"), (3, f"{plain} " + " ".join(str(k) for k in range(700, 760))), (4, numbers)]
    got = leaked(spark, docs_of, docs, items)
    assert set(got) == {(2, 1), (2, 2), (3, 1), (4, 2)}
    # Windows without a word count for the item that has no others.
    assert got[2, 1][0] == 12 and got[4, 2][0] == 56 and got[3, 1][2] > 0


def test_forms_say_what_was_enough(spark, docs_of):
    tail = "and then the farmer walks along the river until the sun goes down behind the hills while his dog follows slowly"
    names = f"If Tom has many apples and Tom gives some away {tail}"
    docs = [(1, names), (2, names.upper()), (3, names.replace("Tom", "Ann", 1))]
    got = leaked(spark, docs_of, docs, [(1, names)])
    assert {k: v[3] for k, v in got.items()} == {(1, 1): "aligned", (2, 1): "caseless", (3, 1): "caseless"}


def test_a_word_repeated_on_and_on(spark, docs_of):
    got = leaked(spark, docs_of, [(1, "ha " * 3000), (2, "ha " * 4)], [(1, "ha " * 20), (2, "the ha " * 10)])
    assert set(got) == {(1, 1)}


def test_the_registered_sql_says_what_the_query_does(spark, tmp_path):
    import duckdb

    from daygrain.llm.queries import LLM_REGISTRY

    build, sql = LLM_REGISTRY["op7_benchmark_decontamination"]
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    twice = ITEM.replace("Boston", "Paris").replace("60", "75.5").replace("3 hours", "4 hours")
    texts = [ITEM, ITEM.upper(), twice, f"Q: what is 2 + 2? \u65e5\u672c\u306e\u9996\u90fd\u306f?", "1 2 3 4 5 6 7 8 9", ITEM.replace("Alice", "Eve", 1) + ITEM, None, "", "5 Miles. Then 7 miles, 8 Bob"]
    extra = spark.createDataFrame([(900_000 + k, t) for k, t in enumerate(texts)], "doc_id bigint, text string")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet").select("doc_id", "text").union(extra)
    items = spark.createDataFrame([(1000 + k, t) for k, t in enumerate([ITEM, "What is 2+2?", "\u65e5\u672c\u306e\u9996\u90fd\u306f?", "1 2 3 4 5 6 7", None, ""])], "item_id bigint, text string")
    bench = spark.read.parquet(f"{tmp_path}/benchmark.parquet").union(items)
    docs.write.parquet(f"{tmp_path}/more/documents.parquet")
    bench.write.parquet(f"{tmp_path}/more/benchmark.parquet")
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/more/{name}.parquet/*.parquet'")
    rel = con.execute(sql)
    names = [c[0] for c in rel.description]
    expected = sorted(rel.fetchall())
    assert sorted(tuple(r[c] for c in names) for r in build(spark, f"{tmp_path}/more").collect()) == expected
    assert len(expected) >= 9 and {r[names.index("form")] for r in expected} >= {"aligned", "caseless"}


def test_no_documents_or_no_benchmark(spark, docs_of):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.leaks(docs_of(ODD), none).count() == 0
    assert decontaminate.leaks(docs_of([]), none).count() == 0


# -- language and quality --


def test_language(spark, docs_of):
    random.seed(5)
    syllables = {"aa": ["ka", "lo", "mi"], "bb": ["sch", "ung", "ei"]}
    rows = [(k, " ".join("".join(random.choices(syllables[lang], k=3)) for _ in range(20)), lang) for k in range(400) for lang in [random.choice(["aa", "bb"])]]
    docs = docs_of(rows + [(1000 + k, t) for k, (_, t) in enumerate(ODD)])
    model = language.learn(docs.where("doc_id < 1000"))
    found = language.languages(docs, model).toPandas()
    assert len(found) == 400 + len(ODD)
    truth = {d: x for d, _, x in rows}
    held = found[found["held_out"] & found["doc_id"].isin(truth)]
    assert (held["lang_pred"] == held["doc_id"].map(truth)).mean() > 0.98
    assert found["held_out"].tolist() == [zlib.crc32(str(int(d)).encode()) % 4 == 2 for d in found["doc_id"]]
    assert found["score"].between(0, 1).all()
    texts = {1000 + k: t for k, (_, t) in enumerate(ODD)}
    for row in found[found["doc_id"] >= 1000].itertuples():
        letters = any(unicodedata.category(c)[0] == "L" for c in texts[row.doc_id] or "")
        assert (row.lang_pred == "und") == (not letters)
        assert letters or (row.rejected and row.score == 0)
    again = language.languages(docs, language.learn(docs.where("doc_id < 1000"))).toPandas()
    assert sorted(again["score"]) == sorted(found["score"])


SYLLABLES = {"aa": "ka lo mi te ru pa".split(), "bb": "sch ung ei berg ich zu".split(), "cc": "qux vyv fjo wq xy kjw".split()}


def prose(lang, n, seed):
    source = random.Random(seed)
    return " ".join("".join(source.choices(SYLLABLES[lang], k=3)) for _ in range(n))


def test_junk_and_a_language_that_was_left_out_are_rejected(spark, docs_of):
    known = [(k, prose(lang, 40, k), lang) for k in range(3000) for lang in ["aa" if k % 2 else "bb"]]
    model = language.learn(docs_of(known))
    assert model.false_acceptance <= 0.02 and model.reject_below != 0.5
    source = random.Random(1)
    salad = [(10_000 + k, "".join(source.choice("abcdefghijklmnopqrstuvwxyz    ") for _ in range(150)), None) for k in range(300)]
    foreign = [(20_000 + k, prose("cc", 40, k), None) for k in range(300)]
    fresh = [(30_000 + k, prose(lang, 40, 50_000 + k), lang) for k in range(1000) for lang in ["aa" if k % 2 else "bb"]]
    found = language.languages(docs_of(salad + foreign + fresh), model).toPandas()
    rejected = lambda low: found[found["doc_id"].between(low, low + 9999)]["rejected"].mean()
    assert rejected(10_000) >= 0.98 and rejected(20_000) >= 0.98 and rejected(30_000) <= 0.005


def test_scores_equal_a_plain_loop(spark, docs_of):
    rows = [(k, prose("aa" if k % 2 else "bb", 12, k), "aa" if k % 2 else "bb") for k in range(400)]
    model = language.learn(docs_of(rows))
    texts = rows[:20] + [(1000, "ka  lo\tmi x", None), (1001, "é ung\n", None), (1002, "z", None)]
    found = {r["doc_id"]: r for r in language.languages(docs_of(texts), model).collect()}
    for doc, text, _ in texts:
        data = bytes(32 if c in b" \t\n\x0b\x0c\r" else c for c in text.encode())
        total, seen, n = np.zeros(len(model.labels)), 0.0, 0
        for size in (2, 3, 4):
            for at in range(len(data) - size + 1):
                part = data[at : at + size]
                if 32 not in part[1:-1]:
                    bucket = (int.from_bytes(part, "little") * subword.MULTIPLIERS[size] % 2**32) >> (32 - subword.BITS)
                    total, seen, n = total + model.table[bucket], seen + model.seen[bucket], n + 1
        raw = np.exp((total / max(1, n) + model.bias) / model.temperature)
        share = raw / raw.sum()
        assert found[doc]["score"] == pytest.approx(share.max()) and found[doc]["lang_pred"] == model.labels[int(share.argmax())]
        assert found[doc]["rejected"] == (share.max() < model.reject_below or seen / max(1, n) < model.least_familiar)


def test_memory_of_a_batch_is_small_beside_its_texts():
    import tracemalloc

    random.seed(31)
    texts = ["".join(random.choices("abcdefgh  ", k=4000)) for _ in range(1000)]
    column = pa.array(texts, pa.string())
    batch = pa.RecordBatch.from_arrays([column, column], ["key", "text"])
    model = subword.Model(["a", "b"], np.zeros((1 << subword.BITS, 2)), np.zeros(2), 1.0, 0.0, np.zeros(1 << subword.BITS))
    peaks = []
    for work in (lambda: list(subword._scored(model)(iter([batch]))), lambda: sum(len(s) for s in spans.shingle_sets(column))):
        tracemalloc.start()
        work()
        peaks.append(tracemalloc.get_traced_memory()[1] / 1e6)
        tracemalloc.stop()
    assert max(peaks) < 20, peaks


def test_language_without_labels(spark, docs_of):
    docs = docs_of([(d, t, None) for d, t in ODD])
    found = language.languages(docs, language.learn(docs)).collect()
    assert len(found) == len(ODD) and {r["lang_pred"] for r in found} == {"und"}
    assert language.languages(docs_of([]), language.learn(docs_of([]))).count() == 0


def test_quality_on_held_out_rows(spark):
    from pyspark.sql import functions as F

    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    found = quality.quality(docs.where("doc_id < 4000"), labels, F.col("source"), F.concat_ws("/", "source", "lang")).join(labels.withColumnRenamed("quality", "truth"), "doc_id").where("held_out").toPandas()
    assert (found["kept"] == (found["truth"] == 1)).mean() > 0.95
    assert found[found["truth"] == 1]["kept"].mean() > 0.99


def test_sparse_sites_shrink(spark):
    rows = [("big", "big/a", 1)] * 90 + [("big", "big/a", 0)] * 10 + [("big", "big/b", 0)] + [("bad", "bad/a", 0)] * 50 + [("new", "new/a", 1)]
    hosts, paths, overall = quality.posteriors(spark.createDataFrame(rows, "host string, path string, good int"))
    host = {r["host"]: r["host_quality"] for r in hosts.collect()}
    path = {r["path"]: r["path_quality"] for r in paths.collect()}
    assert host["bad"] < 0.1 < overall < host["big"] < 0.91
    assert overall < host["new"] < 1
    assert path["big/b"] < path["big/a"] < 1
    assert path["bad/a"] < 0.1


def test_quality_of_odd_rows_and_without_labels(spark, docs_of):
    from pyspark.sql import functions as F

    labels = spark.createDataFrame([(4, 1), (5, 0), (5, 1), (None, 1), (6, None), (7, 3), (1, 1), (8, 0)], "doc_id bigint, quality int").selectExpr("*", "0 AS toxic", "'z' AS host", "'t' AS text")
    for known in (labels, labels.limit(0)):
        found = quality.quality(docs_of(ODD), known, F.col("source"), F.lit(None)).collect()
        assert len(found) == len(ODD)
        assert all(0 < r["quality"] < 1 for r in found)
    assert quality.quality(docs_of([]), labels, F.col("source"), F.col("lang")).count() == 0


# -- pages --

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var x = "</p>";</script></head><body>
<header class="site-header"><h1>Site</h1><p>slogan, slogan, slogan</p></header><nav><ul><li><a href=1>Menu</a></ul></nav>
<div id="cookie-notice"><p>We use cookies, many, many cookies</p></div>
<div class="layout"><div class="post-body"><article><header><h1>The &amp; title</h1><p>by somebody</p></header>
<p>First   paragraph,\n with <b>bold</b> and <a href="x?a>b">a link</a>.<p>Second&nbsp;one &lt;b&gt; &#233; &eacute;<br>after
<div class="ad">Buy, buy, buy</div><ul><li>one<li>two</ul><table><tr><td>cell 1<td>cell 2</table><pre>a
  b</pre><form><p>Your name, please</p><input></form><!-- hidden <p>x</p> --></article></div>
<aside><p>Side, side, side</p></aside><section id="comments"><p>Nice, really nice, post, thanks</p></section></div>
<footer><p>&copy; me, myself, I</p></footer></body></html>"""


def test_article_without_its_surroundings():
    assert html_text.main_text(PAGE).split("\n") == [
        "The & title", "First paragraph, with bold and a link.", "Second one <b> é é after", "one", "two", "cell 1", "cell 2", "a b",
    ]


def test_best_container_and_siblings():
    links = "".join(f"<p><a href={k}>some link, with words, number {k}</a></p>" for k in range(30))
    body = "".join(f"<p>Sentence {k}, with a comma, and some more words to it.</p>" for k in range(6))
    got = html_text.main_text(f"<body><div>{links}</div><div><h2>Head</h2><div>{body}</div><div>{body}</div></div></body>")
    assert "link" not in got and got.count("Sentence") == 12


@pytest.mark.parametrize(
    "html, text",
    [(None, ""), ("", ""), (" ", ""), ("plain & <simple", "plain & <simple"), ("<p>a<p>b", "a\nb"), ("<!-- never ends", ""), ("<script>never ends", ""), ("<p title='>'>x</p>", "x"), ("</p></div>x", "x"), ("<div hidden>a</div>", ""), ("<p>" * 3000 + "x", "x"), ("<div>" * 3000 + "y, z", "y, z"), ("<p>&am</p>", "&am")],
)
def test_odd_pages(html, text):
    assert html_text.main_text(html) == text


@pytest.mark.parametrize("way", ["<div class='content has-sidebar'>{}</div>", "<div class=no-sidebar>{}</div>", "<div class='search-result'>{}</div>", "<div class=share-enabled>{}</div>", "<form action=x>{}</form>", "<form><div class='sidebar'>{}</div></form>"])
@pytest.mark.parametrize("what", ["{}", "<article>{}</article>"])
def test_names_and_forms_do_not_lose_the_article(way, what):
    body = "".join(f"<p>Sentence {k}, with a comma, and some more words to it.</p>" for k in range(6))
    got = html_text.main_text("<body><div class=sidebar><p>Side, side, side</p></div>" + way.format(what.format(body)) + "<form><p>Your name, please</p></form></body>")
    assert got.count("Sentence") == 6 and "Side" not in got and "name" not in got


def test_named_parts_go_from_inside_a_paragraph_and_answers_below_an_article():
    page = "<body><div class=post><h1>Head</h1><p>One, two<span class=share>Share it</span> three.</p></div><div class=comments>" + "<p>Nice, nice, nice words.</p>" * 3 + "</div></body>"
    assert html_text.main_text(page) == "Head\nOne, two three."


def test_a_long_named_part_goes_beside_an_article_and_stays_inside_one():
    long = "<p>Many, many, many words of some kind.</p>" * 5
    assert html_text.main_text(f"<div class=ad>{long}</div><article><h1>Head</h1><p>One, two.</p></article>") == "Head\nOne, two."
    assert html_text.main_text(f"<article><h1>Head</h1><div class=search-result>{long}</div></article>").count("Many") == 5


def test_headline_far_below_its_article():
    assert html_text.main_text("<article>" + "<div>" * 12 + "<header><h1>Head</h1></header><p>One, two, three.</p>" + "</div>" * 12 + "</article>") == "Head\nOne, two, three."


def test_pages_table(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "v", ""), (3, "w", "<p>" + "long, " * 200_000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 AS text", "2 AS n_chars")
    found = html_text.extract(pages).collect()
    assert sorted((r["page_id"] or 0, r["n_chars"]) for r in found) == sorted((i or 0, len(html_text.main_text(h))) for i, _, h in rows)
    assert html_text.extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize("page", [
    "<div>" * 100_000 + "text, of some length" + "</section>" * 100_000,
    "<b><div>" + "<i>" * 100_000 + "</b>" * 100_000 + "text, of some length",
    "<header>" + "<div>" * 100_000 + "<h1>t</h1>" * 1000 + "</header><p>text, of some length</p>",
], ids=["stray blocks", "stray inline tags", "deep header"])
def test_broken_pages_take_linear_time(page):
    import time

    began = time.process_time()
    assert "text, of some length" in html_text.main_text(page)
    assert time.process_time() - began < 6


# -- token counts and licences --


def brute_tokens(model, word):
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        size = len(word[end - 1].encode())
        options = [(best[end - 1][0] + size * model.byte, -(-best[end - 1][1] + size))]
        options += [(best[s][0] + model.pieces[word[s:end]], best[s][1] - 1) for s in range(end) if word[s:end] in model.pieces]
        best.append(max(options))
    return -best[-1][1]


def test_token_counts(spark, docs_of):
    model = token_counts.Unigram.from_ranks(UNIGRAM)
    random.seed(6)
    rows = [r for r in ODD if r[0] != 8] + [(100 + k, "".join(random.choices(ALPHABET + ["tion", "ing", " er"], k=80))) for k in range(40)]
    found = {(r["doc_id"], r["n_pretokens"], r["n_tokens"]) for r in token_counts.token_counts(docs_of(rows + [(8, "a very long text " * 40000)]), UNIGRAM).collect()}
    words = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    expected = {(d, len(w), sum(brute_tokens(model, "▁" + x) for x in w)) for d, w in words}
    expected.add((8, 160000, 40000 * sum(brute_tokens(model, "▁" + x) for x in ("a", "very", "long", "text"))))
    assert found == expected
    assert token_counts.token_counts(docs_of([]), UNIGRAM).count() == 0


def test_shared_prefixes_do_not_change_counts():
    model = token_counts.Unigram({"a": -1.0, "ab": -1.5, "b": -1.0, "abc": -4.0, "c": -1.0, "bc": -1.0})
    words = ["abc", "ab", "", "abcabc", "abd", "b", "éa", "ab"]
    assert model.counts(words) == [brute_tokens(model, w) for w in words]


def test_licences(spark, docs_of):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    long = " ".join(f"word{k}" for k in range(300))
    rows = ODD + [(20, f"text\n{mit}\n"), (21, gpl.replace("3", "2")), (22, f"{long} {gpl} {long}"), (23, "A license to fish was granted, with copyright nowhere."), (24, f"{mit}\n{gpl}"), (25, gpl.upper())]
    got = sorted((r["doc_id"], r["block"], r["license"], r["n_missing"]) for r in licenses.licenses(docs_of(rows)).collect())
    assert got == [(20, 1, "MIT", 0), (21, 0, "GPL-2.0", 0), (22, 0, "GPL-3.0", 0), (24, 0, "MIT", 0), (24, 1, "GPL-3.0", 0), (25, 0, "GPL-3.0", 0)]
    assert licenses.licenses(docs_of([])).count() == 0


def test_licence_scan_agrees_with_plain_search(spark):
    """On the given documents every line that holds a template word for word is found, and no other line wins exactly."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    plain = set()
    for d, t in docs.select("doc_id", "text").collect():
        for k, line in enumerate((t or "").split("\n")):
            words = " ".join(licenses.words_of(line))
            plain |= {(d, k, n) for n, x in licenses.TEMPLATES.items() if f" {' '.join(licenses.words_of(x))} " in f" {words} "}
    exact = {(r["doc_id"], r["block"], r["license"]) for r in licenses.licenses(docs).where("n_missing = 0 AND n_added = 0").collect()}
    assert exact == plain


def notices(spark, docs_of, *texts):
    found = licenses.licenses(docs_of(list(enumerate(texts)))).collect()
    return sorted((r["doc_id"], r["block"], r["last_block"], r["license"], r["kind"], r["n_missing"], r["n_added"]) for r in found)


def test_licences_over_line_ends_several_a_line_and_tags(spark, docs_of):
    got = notices(
        spark,
        docs_of,
        "intro\nLicensed under the Apache License,\nVersion 2.0.\nend",
        "Code: released under the MIT License. Text and pictures: Licensed under CC BY-NC 4.0. Enjoy.",
        "// SPDX-License-Identifier: Apache-2.0\nint main() {}",
        "# SPDX-License-Identifier: GPL-2.0-or-later",
        "Licensed under CC BY 4.0.",
        "Driver licence holders read the copyright page, in the public domain of ideas.",
    )
    assert got == [
        (0, 1, 2, "Apache-2.0", "notice", 0, 0),
        (1, 0, 0, "CC-BY-NC-4.0", "notice", 0, 0),
        (1, 0, 0, "MIT", "notice", 0, 0),
        (2, 0, 0, "Apache-2.0", "tag", 0, 0),
        (3, 0, 0, "GPL-2.0-or-later", "tag", 0, 0),
        (4, 0, 0, "CC-BY-4.0", "notice", 0, 0),
    ]


def test_every_header_and_body_is_found_whole_wrapped_and_with_changes(spark, docs_of):
    texts = [t for t in licenses.standard_templates() if t.kind in ("header", "body")]
    assert len(texts) >= 15
    wrapped = []
    for t in texts:
        words = t.text.split()
        lines = [" * " + " ".join(words[k : k + 9]) for k in range(0, len(words), 9)]
        wrapped.append("Copyright (c) 2020 Some Body\n\n" + "\n".join(lines) + "\n\nint x;")
    got = notices(spark, docs_of, *wrapped)
    assert [(d, name, kind, missing + added) for d, _, _, name, kind, missing, added in got] == [(k, t.license, t.kind, 0) for k, t in enumerate(texts)]
    changed = []
    for t in texts:
        words = t.text.split()
        for at in range(12, len(words), 25):
            words[at] = "other"
        changed.append(" ".join(words).upper())
    found = {(r[0], r[3]) for r in notices(spark, docs_of, *changed)}
    assert {(k, t.license) for k, t in enumerate(texts) if len(t.text.split()) > 12} <= found


def test_licence_scan_equals_all_windows_by_brute_force(spark, docs_of):
    """All windows of all templates' lengths, word by word; of overlapping ones the longest. Random filler between notices."""
    source = random.Random(12)
    given = licenses.standard_templates()
    texts = []
    for _ in range(40):
        parts = []
        for _ in range(source.randrange(1, 5)):
            parts += ["".join(source.choices("bcdfgklmnprst", k=5)) for _ in range(source.randrange(3, 30))] + [source.choice(given).text]
        words = " ".join(parts).split(" ")
        texts.append("".join(w + source.choice((" ", " ", " ", "\n")) for w in words))
    expected = set()
    for d, text in enumerate(texts):
        words = licenses.words_of(text)
        exact = [(len(x), k, t.license, t.kind) for t in given for x in [licenses.words_of(t.text)] for k in range(len(words) - len(x) + 1) if words[k : k + len(x)] == x]
        taken = []
        for n, k, name, kind in sorted(exact, key=lambda e: (-e[0], e[1:])):
            if all(k + n <= a or b <= k for a, b in taken):
                taken.append((k, k + n))
                expected.add((d, name, kind, " ".join(words[k : k + n])))
    found = licenses.licenses(docs_of(list(enumerate(texts)))).where("n_missing = 0 AND n_added = 0").collect()
    assert {(r["doc_id"], r["license"], r["kind"], r["wording"]) for r in found} == expected


def test_kept_text_hash_is_of_utf8(docs_of):
    from pyspark.sql import functions as F

    done = line_runs.line_dedup(docs_of([(1, "é\nü")])).select(F.sha2("kept", 256)).first()[0]
    assert done == hashlib.sha256("é\nü".encode()).hexdigest()
