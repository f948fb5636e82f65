"""As-of and interval joins, value frames, ranks, sessions, snapshots and states, against brute force and by their plans."""

import datetime as dt
import random
from collections import Counter
from types import SimpleNamespace

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from daygrain.operators import asof, changes, frames, intervals, ranks, sessions, states
from daygrain.plans import city_days
from proofs import relations


@pytest.fixture
def few_ranges(spark):
    """Ranges of a few rows, so that groups and runs of equal values reach over many of them."""
    names = {"spark.sql.shuffle.partitions": "13", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in names}
    for k, value in names.items():
        spark.conf.set(k, value)
    yield
    for k, value in before.items():
        spark.conf.set(k, value)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- as-of -------------------------------------------------------------------


def brute_asof(left, right, strict=False, within=None):
    out = []
    for number, key, at in left:
        best = None
        for k, t, tie in right:
            if None not in (key, at, k, t) and k == key and (t < at if strict else t <= at) and (within is None or t >= at - within):
                best = max(best, (t, tie)) if best else (t, tie)
        out.append((number, key, at, *(best or (None, None))))
    return sorted(out, key=repr)


def asof_of(spark, left, right, **how):
    a = spark.createDataFrame(left, "number bigint, key string, at bigint")
    b = spark.createDataFrame(right, "key string, at bigint, tie bigint")
    return asof.asof_join(a, b, {"key": "key"}, "at", "at", {"found_at": "at", "found": "tie"}, ties=["tie"], **how)


def asof_rows():
    draw = random.Random(5)
    keys = ["hot"] * 6 + ["a", "b", "c", None]
    left = [(k, draw.choice(keys), draw.choice([None, *range(60)])) for k in range(400)]
    right = [(draw.choice(keys), draw.choice([None, *range(10, 60, 3)]), draw.randrange(50)) for _ in range(150)]
    left += [(1000 + k, "hot", 30) for k in range(300)] + [(2000, "alone", 5), (2000, "alone", 5)]
    return left, right + [right[0], right[0]]


@pytest.mark.parametrize("strict", [False, True])
def test_asof_with_ties_nulls_and_no_predecessor(spark, rows, few_ranges, strict):
    left, right = asof_rows()
    assert rows(asof_of(spark, left, right, strict=strict)) == brute_asof(left, right, strict)


def test_asof_within_a_time(spark, rows, few_ranges):
    left, right = asof_rows()
    assert rows(asof_of(spark, left, right, within=F.lit(4))) == brute_asof(left, right, within=4)


def test_asof_of_empty_sides_and_clashes(spark):
    left, right = asof_rows()
    assert asof_of(spark, [], right).count() == 0
    assert asof_of(spark, left, []).where("found IS NULL").count() == len(left)
    a = spark.createDataFrame(left, "number bigint, key string, at bigint")
    with pytest.raises(ValueError, match="already"):
        asof.asof_join(a, a, {"key": "key"}, "at", "at", {"number": "number"})


def test_asof_without_keys(spark, rows, few_ranges):
    left, right = asof_rows()
    a = spark.createDataFrame([(n, "x", t) for n, _, t in left], "number bigint, key string, at bigint")
    b = spark.createDataFrame(right, "key string, at bigint, tie bigint")
    found = asof.asof_join(a, b, {}, "at", "at", {"found_at": "at", "found": "tie"}, ties=["tie"])
    assert rows(found) == brute_asof([(n, "x", t) for n, _, t in left], [("x", t, tie) for _, t, tie in right])


def test_a_hot_key_of_the_asof_join_fills_many_ranges(spark, monkeypatch, few_ranges):
    stored = []
    real = asof.cut
    monkeypatch.setattr(asof, "cut", lambda df: stored.append(real(df)) or stored[-1])
    left = [(k, "hot", 7) for k in range(2000)]
    asof_of(spark, left, [("hot", 3, 1)]).collect()
    most = stored[0].groupBy("__k0", "__chunk").count().agg(F.max("count")).first()[0]
    assert most < 400


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.tuples(st.integers(0, 99), st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(-5, 5))), max_size=12),
    st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(-5, 5)), st.integers(0, 3)), max_size=8),
    st.booleans(),
)
def test_asof_of_anything(spark, left, right, strict):
    assert sorted((tuple(r) for r in asof_of(spark, left, right, strict=strict).collect()), key=repr) == brute_asof(left, right, strict)


# --- intervals ---------------------------------------------------------------

MOMENT = dt.datetime(2024, 1, 1)


def brute_intervals(points, spans, how="inner"):
    out = []
    for p, at, key in points:
        met = [s for s in spans if None not in (at, key, *s[1:4]) and s[1] <= at < s[2] and s[3] == key]
        out += [(p, at, key, *s) for s in met] or ([(p, at, key, None, None, None, None)] if how == "left" else [])
    return sorted(out, key=repr)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("kind", ["bigint", "timestamp_ntz", "timestamp", "date"])
def test_points_in_intervals(spark, rows, how, kind):
    draw = random.Random(3)
    place = {"bigint": lambda n: n, "date": lambda n: MOMENT.date() + dt.timedelta(days=n)}.get(kind, lambda n: MOMENT + dt.timedelta(seconds=n * 0.37))
    points = [(k, draw.choice([None, *map(place, range(-50, 90))]), draw.choice(["a", "a", "b", None])) for k in range(200)]
    spans = []
    for k in range(80):
        start, length = draw.randrange(-60, 80), draw.choice([0, 1, 1, 2, 3, 5, 17, 64, 300, -4])
        spans.append((k, place(start), draw.choice([place(start + length)] * 9 + [None]), draw.choice(["a", "b", "c", None])))
    spans += [(100, None, place(3), "a"), spans[0]]
    p = spark.createDataFrame(points + points[:2], f"point bigint, at {kind}, key string")
    s = spark.createDataFrame(spans, f"span bigint, opened {kind}, closed {kind}, own string")
    found = intervals.interval_join(p, s, "at", "opened", "closed", {"key": "own"}, how=how)
    assert rows(found) == brute_intervals(points + points[:2], spans, how)


def test_interval_join_has_no_nested_loop_and_checks_its_input(spark):
    p = spark.range(1000).withColumnRenamed("id", "at")
    s = spark.range(1000).selectExpr("id AS opened", "id + 1 + id % 50 * id AS closed")
    found = intervals.interval_join(p, s, "at", "opened", "closed")
    found.count()
    assert "NestedLoop" not in plan(found) and "Cartesian" not in plan(found)
    assert intervals.interval_join(p, s.limit(0), "at", "opened", "closed", how="left").count() == 1000
    assert intervals.interval_join(p.limit(0), s, "at", "opened", "closed").count() == 0
    with pytest.raises(TypeError, match="different types"):
        intervals.interval_join(p.withColumn("at", F.col("at").cast("int")), s, "at", "opened", "closed")
    with pytest.raises(TypeError, match="double"):
        intervals.interval_join(p.select(F.col("at").cast("double")), s.selectExpr("double(opened) AS opened", "double(closed) AS closed"), "at", "opened", "closed")
    with pytest.raises(ValueError, match="both sides"):
        intervals.interval_join(p, s.withColumnRenamed("closed", "at"), "at", "opened", "at")


def test_an_interval_lies_in_two_cells_at_most(spark):
    """However long: cells grow with the interval."""
    lengths = [1, 2, 3, 4, 5, 1000, 10**6 + 1, 10**12, 2**50]
    s = spark.createDataFrame([(7 * n + 13, 7 * n + 13 + n) for n in lengths], "low bigint, high bigint")
    level = s.withColumn("level", intervals._level(F.col("high") - F.col("low")))
    for r in level.collect():
        size, length = 2 ** r["level"], r["high"] - r["low"]
        assert length <= size < 4 * max(2, length) and (r["high"] - 1) // size - r["low"] // size <= 1


def brute_open(points, spans):
    out = []
    for number, at in points:
        met = [low for low, high in spans if None not in (at, low, high) and low <= at < high]
        out.append((number, at, len(met), min(met, default=None)))
    return sorted(out, key=repr)


def placed_spans(place):
    """Points and intervals with ties, a hot place of either, NULLs, empty and backward intervals and rows that come twice."""
    draw = random.Random(8)
    points = [(k, draw.choice([None, *map(place, range(-50, 90))])) for k in range(200)] + [(1000 + k, place(30)) for k in range(300)]
    spans = [(place(low), place(low + draw.choice([0, 1, 1, 2, 5, 17, 64, 300, -4]))) for low in (draw.randrange(-60, 80) for _ in range(120))]
    spans += [(place(30), place(30 + k % 7)) for k in range(200)] + [(place(k % 9), place(30)) for k in range(200)]
    spans += [(None, place(3)), (place(3), None), (None, None), spans[0]]
    return points + points[:2], spans


@pytest.mark.parametrize("kind", ["bigint", "int", "timestamp_ntz", "timestamp", "date"])
def test_intervals_open_at_points(spark, rows, few_ranges, kind):
    place = {"date": lambda n: MOMENT.date() + dt.timedelta(days=n - 19_700), "bigint": lambda n: n, "int": lambda n: n}.get(kind, lambda n: MOMENT + dt.timedelta(seconds=n * 0.370001))
    points, spans = placed_spans(place)
    p = spark.createDataFrame(points, f"place bigint, at {kind}")
    s = spark.createDataFrame(spans, f"opened {kind}, closed {kind}")
    found = intervals.open_at(p, s, "at", "opened", "closed", "n", "first")
    assert dict(found.dtypes) == {"place": "bigint", "at": kind, "n": "bigint", "first": kind}
    assert rows(found) == brute_open(points, spans)


def test_open_intervals_of_merged_ranges_empty_sides_and_the_ends_of_the_line(spark, rows):
    points, spans = placed_spans(lambda n: n)
    points += [(3000, 2**63 - 1), (3001, -(2**63)), (3002, 2**63 - 2)]
    spans += [(-(2**63), 2**63 - 1), (2**63 - 2, 2**63 - 1)]
    p = spark.createDataFrame(points, "point bigint, at bigint")
    s = spark.createDataFrame(spans, "opened bigint, closed bigint")
    assert rows(intervals.open_at(p, s, "at", "opened", "closed", "n", "first")) == brute_open(points, spans)
    assert rows(intervals.open_at(p, s.limit(0), "at", "opened", "closed", "n", "first")) == brute_open(points, [])
    assert intervals.open_at(p.limit(0), s, "at", "opened", "closed", "n", "first").count() == 0
    with pytest.raises(TypeError, match="different types"):
        intervals.open_at(p.withColumn("at", F.col("at").cast("int")), s, "at", "opened", "closed", "n", "first")
    with pytest.raises(ValueError, match="already"):
        intervals.open_at(p, s, "at", "opened", "closed", "point", "first")


def test_a_hot_place_of_open_intervals_fills_many_ranges(spark, monkeypatch, few_ranges):
    p = spark.range(2000).selectExpr("id", "7L AS at")
    sizes = []
    frame, real = type(p), type(p).mapInArrow

    def counted(df, f, schema):
        sizes.append([r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()])
        return real(df, f, schema)

    monkeypatch.setattr(frame, "mapInArrow", counted)
    s = spark.range(3000).selectExpr("7L AS opened", "8L AS closed")
    found = intervals.open_at(p, s, "at", "opened", "closed", "n", "first")
    assert found.where("n = 3000 AND first = 7").count() == 2000
    assert sum(sizes[0]) == 8000 and max(sizes[0]) < 1600


def test_open_orders_of_events_make_no_pairs(spark, rows, monkeypatch):
    """400 orders begin in as many seconds, 400 events follow: more than 70,000 pairs, of which none is stored."""
    stored = []
    real = intervals.cut
    monkeypatch.setattr(intervals, "cut", lambda df: stored.append(real(df)) or stored[-1])
    second = lambda key: dt.timedelta(seconds=key * 7919 % 2592000, microseconds=key % 1000000)
    keys = [k * pow(7919, -1, 2592000) % 2592000 for k in range(400)]
    orders = [(k, 1, 1.0) for k in [*keys, None, keys[1]]]
    events = [(k % 390 if k else None, 1, MOMENT + dt.timedelta(seconds=400 + k, microseconds=k) if k % 50 else None, "view", 1.0) for k in range(400)]
    tables = {
        "orders": spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint, o_totalprice double"),
        "events": spark.createDataFrame(events, "event_id bigint, user_id bigint, ts timestamp_ntz, event_type string, value double"),
    }
    found = relations.RELATIONS["interval_join_orders_open_at_each_event"][0](SimpleNamespace(table=tables.get))
    spans = [(MOMENT + second(k), MOMENT + second(k) + dt.timedelta(seconds=k % 5400 + 1)) for k, *_ in orders if k is not None and k % 7]
    expected = {}
    for key, _, n, first in brute_open([(e[0], e[2]) for e in events], spans):
        before = expected.get(key, (0, None))
        expected[key] = (before[0] + n, min([t for t in (before[1], first) if t], default=None))
    assert sum(n for n, _ in expected.values()) > 70_000
    assert rows(found) == sorted([(k, *v) for k, v in expected.items()], key=repr)
    assert sum(df.count() for df in stored) < 5000


# --- frames by value ---------------------------------------------------------


def brute_frames(data, width):
    out = []
    for number, key, at, value in data:
        frame = [v for _, k, t, v in data if k == key and ((t is None and at is None) or (None not in (t, at) and at - width <= t <= at))]
        full = [v for v in frame if v is not None]
        out.append((number, key, at, value, sum(full) if full else None, len(full), min(full, default=None), max(full, default=None)))
    return sorted(out, key=repr)


MADE = {"total": ("sum", "value"), "n": ("count", "value"), "least": ("min", "value"), "most": ("max", "value")}


@pytest.mark.parametrize("width", [1, 7, 40])
def test_frames_of_hot_keys_ties_and_nulls(spark, rows, few_ranges, width):
    draw = random.Random(width)
    data = [(k, draw.choice(["hot", "hot", "hot", "b", None]), draw.choice([None, *range(-40, 60)]), draw.choice([None, *range(-9, 90)])) for k in range(600)]
    data += [(1000 + k, "hot", 12, k) for k in range(200)] + [(2000, "alone", 3, None), (2000, "alone", 3, None)]
    df = spark.createDataFrame(data, "number bigint, key string, at bigint, value bigint")
    assert rows(frames.over_last(df, ["key"], "at", width, MADE)) == brute_frames(data, width)


def test_frames_without_keys_by_day_and_of_decimals(spark, rows):
    data = [(k, "x", k * k % 50, k) for k in range(60)]
    df = spark.createDataFrame(data, "number bigint, key string, at int, value bigint")
    days = df.withColumn("at", F.date_add(F.lit(dt.date(1969, 12, 1)), F.col("at"))).withColumn("value", F.col("value").cast("decimal(9, 2)"))
    found = frames.over_last(days, [], "at", 7, MADE)
    assert dict(found.dtypes)["total"] == "decimal(19,2)"
    got = sorted((r["number"], int(r["total"]), r["n"], int(r["least"]), int(r["most"])) for r in found.collect())
    assert got == sorted((r[0], *r[4:]) for r in brute_frames(data, 7))
    assert frames.over_last(df.limit(0), ["key"], "at", 7, MADE).count() == 0
    with pytest.raises(ValueError, match="unknown aggregates"):
        frames.over_last(df, [], "at", 7, {"m": ("median", "value")})


def test_a_hot_block_of_frames_fills_many_ranges(spark, monkeypatch, few_ranges):
    stored = []
    real = asof.cut
    monkeypatch.setattr(asof, "cut", lambda df: stored.append(real(df)) or stored[-1])
    df = spark.range(3000).selectExpr("'hot' AS key", "id AS at", "id AS value")
    frames.over_last(df, ["key"], "at", 10**6, {"total": ("sum", "value")}).collect()
    assert stored[0].groupBy("__k0", "__block", "__chunk").count().agg(F.max("count")).first()[0] < 1200


def test_frames_add_each_row_once(spark, monkeypatch, few_ranges):
    """Spark adds a frame that ends at UNBOUNDED FOLLOWING anew for each row: n * n / 2 steps for the n rows of a range."""
    plans = []
    real = frames.cut
    monkeypatch.setattr(frames, "cut", lambda df: plans.append(plan(df)) or real(df))
    df = spark.range(3000).selectExpr("'hot' AS key", "id AS at", "id AS value")
    found = frames.over_last(df, ["key"], "at", 10**6, MADE)
    assert [r["least"] for r in found.orderBy("at").collect()] == [0] * 3000
    # The frame of all rows of a group is added once.
    frame = [p.replace("unboundedpreceding$(), unboundedfollowing$()", "all") for p in (*plans, plan(found))]
    assert len(frame) == 2 and all("Window" in p and "unboundedfollowing" not in p for p in frame)


# --- ranks -------------------------------------------------------------------


def brute_ranks(values, tiles, descending):
    low, high = [v for v in values if v is None], sorted(v for v in values if v is not None)
    order = high[::-1] + low if descending else low + high
    n = len(order)
    small, larger = divmod(n, tiles)
    tile = [k // (small + 1) if k < larger * (small + 1) else larger + (k - larger * (small + 1)) // max(1, small) for k in range(n)]
    distinct = list(dict.fromkeys(order))
    rank = {v: order.index(v) + 1 for v in distinct}
    rows = [(v, k + 1, rank[v], distinct.index(v) + 1, (rank[v] - 1) / (n - 1) if n > 1 else 0.0, tile[k] + 1) for k, v in enumerate(order)]
    return sorted(rows, key=repr)


NAMES = ["row_number", "rank", "dense_rank", "percent_rank", "ntile"]


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("tiles", [1, 7, 5000])
def test_ranks_with_runs_over_many_ranges(spark, rows, few_ranges, descending, tiles):
    draw = random.Random(tiles)
    values = [draw.choice([None, 1, 5, 5, 5, 5, 5, *range(10, 20)]) for _ in range(900)]
    df = spark.createDataFrame([(v,) for v in values], "v bigint").repartition(8)
    found = ranks.global_ranks(df, ["v"], NAMES, tiles=tiles, descending=["v"] if descending else [])
    assert rows(found) == brute_ranks(values, tiles, descending)


def test_ranks_of_few_rows_and_wrong_names(spark, rows, few_ranges):
    one = spark.createDataFrame([(3, "x")], "v bigint, __other string")
    assert rows(ranks.global_ranks(one, ["v"], NAMES, tiles=4)) == [(3, "x", 1, 1, 1, 0.0, 1)]
    assert ranks.global_ranks(one.limit(0), ["v"], NAMES, tiles=4).count() == 0
    same = spark.createDataFrame([(3,)] * 50, "v bigint").repartition(5)
    assert {tuple(r)[1:] for r in ranks.global_ranks(same, ["v"], ["rank", "dense_rank"]).collect()} == {(1, 1)}
    for names, tiles in ((["median"], None), (["ntile"], None), (["rank"], 3), (["ntile"], 0)):
        with pytest.raises(ValueError):
            ranks.global_ranks(one, ["v"], names, tiles=tiles)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.integers(0, 4)), min_size=1, max_size=30), st.integers(1, 9))
def test_ranks_of_anything(spark, values, tiles):
    df = spark.createDataFrame([(v,) for v in values], "v bigint").repartition(3)
    found = ranks.global_ranks(df, ["v"], NAMES, tiles=tiles)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute_ranks(values, tiles, False)


# --- sessions ----------------------------------------------------------------


def brute_sessions(data, gap):
    out = []
    for key in {k for _, k, _ in data}:
        number, before = 0, None
        for n, _, at in sorted((r for r in data if r[1] == key and r[2] is not None), key=lambda r: r[2]):
            number += before is None or at - before >= gap
            before = at
            out.append((n, key, at, number))
    return sorted(out + [(n, k, None, None) for n, k, at in data if at is None], key=repr)


@pytest.mark.parametrize("gap", [1, 4, 500])
def test_sessions_over_many_ranges(spark, rows, few_ranges, gap):
    draw = random.Random(gap)
    data = [(k, draw.choice(["hot", "hot", "hot", "b", None]), draw.choice([None, *range(900)])) for k in range(500)]
    data += [(1000 + k, "hot", 300) for k in range(150)]
    df = spark.createDataFrame(data, "number bigint, key string, at bigint")
    assert rows(sessions.with_sessions(df, ["key"], "at", gap)) == brute_sessions(data, gap)
    table = sessions.session_table(df, ["key"], "at", gap, {"total": F.sum("number")})
    known = [r for r in brute_sessions(data, gap) if r[3]]
    assert table.agg(F.sum("n"), F.sum("total")).first()[:] == (len(known), sum(r[0] for r in known))
    assert table.count() == len({(r[1], r[3]) for r in known})


def test_sessions_without_keys_and_rows(spark, rows):
    data = [(k, "x", k * k) for k in range(40)]
    df = spark.createDataFrame(data, "number bigint, key string, at bigint")
    assert rows(sessions.with_sessions(df, [], "at", 30)) == brute_sessions(data, 30)
    assert sessions.with_sessions(df.limit(0), ["key"], "at", 30).count() == 0
    with pytest.raises(ValueError):
        sessions.with_sessions(df, [], "at", 0)


# --- snapshots ---------------------------------------------------------------

SNAPSHOT = "key bigint, name string, score double"
OLD = [(1, "a", 1.0), (2, "b", 2.0), (2, "b", 2.0), (3, None, None), (4, "d", 4.0), (None, "n", 0.0), (6, "f", 6.0), (6, "g", 6.0)]
NEW = [(1, "a", 1.5), (2, "b", 2.0), (3, None, None), (5, "e", 5.0), (5, "e", 5.0), (None, "m", 0.0), (6, "h", 6.0), (6, "i", 6.0)]


def test_row_difference_counts_repeated_rows(spark, rows):
    old, new = spark.createDataFrame(OLD, SNAPSHOT), spark.createDataFrame(NEW, SNAPSHOT)
    expected = Counter(NEW)
    expected.subtract(Counter(OLD))
    assert rows(changes.row_difference(old, new)) == sorted(((*r, n) for r, n in expected.items() if n), key=repr)
    assert changes.row_difference(old, old).count() == 0
    with pytest.raises(ValueError, match="different columns"):
        changes.row_difference(old, new.drop("score"))


def test_changes_name_the_columns_that_differ(spark):
    found = changes.changes(spark.createDataFrame(OLD, SNAPSHOT), spark.createDataFrame(NEW, SNAPSHOT), ["key"]).collect()
    plain = lambda s: tuple(s) if s else None
    got = sorted(((r["key"], r["kind"], r["n"], plain(r["before"]), plain(r["after"]), r["changed"]) for r in found), key=repr)
    assert got == sorted(
        [
            (1, "changed", 1, ("a", 1.0), ("a", 1.5), ["score"]),
            (None, "changed", 1, ("n", 0.0), ("m", 0.0), ["name"]),
            (2, "removed", 1, ("b", 2.0), None, None),
            (4, "removed", 1, ("d", 4.0), None, None),
            (5, "added", 2, None, ("e", 5.0), None),
            *[(6, "removed", 1, (x, 6.0), None, None) for x in "fg"],
            *[(6, "added", 1, None, (x, 6.0), None) for x in "hi"],
        ],
        key=repr,
    )


def test_a_history_gives_back_each_snapshot(spark, rows):
    snapshots = [OLD, NEW, [], OLD + OLD, NEW]
    frames_ = [spark.createDataFrame(s, SNAPSHOT) for s in snapshots]
    day = lambda n: F.lit(dt.date(2024, 1, 1 + n))
    history = changes.open_history(frames_[0], day(0))
    for n in range(1, len(frames_)):
        found = changes.row_difference(frames_[n - 1], frames_[n])
        history = asof.cut(changes.with_difference(history, found, day(n)))
    for n, rows_ in enumerate(snapshots):
        assert rows(changes.as_of(history, day(n))) == sorted(((*r, k) for r, k in Counter(rows_).items()), key=repr)
    assert changes.as_of(history, F.lit(dt.date(2023, 1, 1))).count() == 0


# --- states ------------------------------------------------------------------


def test_merged_states_keep_their_bounds(spark):
    df = spark.range(40000).select(F.expr("date_add(date'2024-01-01', cast(id % 9 AS int))").alias("day"), F.expr("if(id % 4 = 0, 'hot', 'b')").alias("key"),
        F.expr("if(id % 50 = 0, null, sqrt(id))").alias("value"), F.expr("id % 7000").alias("who"))
    stored = asof.cut(states.day_states(df, ["key"], F.col("day"), {"q": "value"}, {"d": "who"}))
    assert stored.count() == 18
    first, last = (F.lit(dt.date(2024, 1, d)) for d in (3, 7))
    found = {r["key"]: r for r in states.over_days(stored, ["key"], first, last, {"q": [0.1, 0.5, 0.99]}, ["d"]).collect()}
    exact = df.where(F.col("day").between(first, last)).toPandas()
    for key, part in exact.groupby("key"):
        values = part["value"].dropna()
        assert found[key]["n"] == len(part)
        for q, share in zip(found[key]["q"], (0.1, 0.5, 0.99)):
            assert abs((values <= q).mean() - share) <= 2 * states.RANK_ERROR
        assert abs(found[key]["d"] - part["who"].nunique()) <= 0.05 * part["who"].nunique()


def test_states_of_nothing_but_nulls(spark):
    df = spark.createDataFrame([("a", None, None), ("a", float("nan"), None)], "key string, value double, who bigint")
    stored = states.day_states(df, ["key"], F.lit(dt.date(2024, 1, 1)), {"q": "value"}, {"d": "who"})
    every = F.lit(dt.date(2024, 1, 1))
    assert [tuple(r) for r in states.over_days(stored, ["key"], every, every, {"q": [0.5]}, ["d"]).collect()] == [("a", 2, None, 0)]


def test_rolled_up_distinct_counts(spark, rows):
    draw = random.Random(1)
    data = [(draw.choice(["a", "b", None]), draw.choice([1, 2, None]), draw.choice([None, -40000, -1, 0, 1, *range(32760, 32780), 10**9])) for _ in range(500)]
    df = spark.createDataFrame(data, "x string, y int, v bigint")
    found = states.rolled_up(states.bitmap_states(df, ["x", "y"], "v"), ["x", "y"], "n")
    expected = []
    for depth in (2, 1, 0):
        for group in {r[:depth] for r in data}:
            values = {r[2] for r in data if r[:depth] == group and r[2] is not None}
            if values:
                expected.append((*group, *[None] * (2 - depth), depth, len(values)))
    assert rows(found) == sorted(expected, key=repr)
    assert rows(states.rolled_up(states.bitmap_states(df.limit(0), ["x", "y"], "v"), ["x", "y"], "n")) == [(None, None, 0, 0)]


# --- cities ------------------------------------------------------------------


def test_two_cities_never_mix(spark, rows, few_ranges):
    draw = random.Random(2)
    data = [(draw.choice(["p", "p", "p", "d", None]), dt.date(2024, 1, 1) + dt.timedelta(days=draw.randrange(30)), k, draw.choice([None, None, k]), draw.randrange(1000)) for k in range(400)]
    df = spark.createDataFrame(data, "city string, entry_date date, game_id bigint, team_game_number bigint, wins bigint")
    expected = []
    for key in ("p", "d", None):
        own = sorted((r for r in data if r[0] == key), key=lambda r: (r[1], r[2]))
        expected += [(*r, r[4] if r[3] is not None else max(x[4] for x in own[max(0, i - 9) : i + 1])) for i, r in enumerate(own)]
    assert rows(city_days.carried(df, ["wins"], block_rows=16, keys=["city"])) == sorted(expected, key=repr)
