"""Queries over relations of order and value: as-of and interval joins, value frames, ranks of a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.operators.asof import asof_join
from daygrain.operators.changes import as_of, changes, open_history, row_difference, with_difference
from daygrain.operators.frames import over_last
from daygrain.operators.intervals import interval_join, open_at
from daygrain.operators.ranks import global_ranks
from daygrain.operators.sessions import session_table
from daygrain.operators.states import RANK_ERROR, bitmap_states, day_states, over_days, rolled_up
from daygrain.session import cut
from proofs.views import Views

RELATIONS: dict[str, tuple[Callable[[Views], DataFrame], str | None]] = {}


def relation(name: str, sql: str | None):
    def register(build: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
        RELATIONS[name] = (build, sql)
        return build

    return register


# A third of the events is given to one user, whose range any operator must split.
USERS = "CASE WHEN event_id % 3 = 0 THEN 7 ELSE user_id END"
EVENTS = f"e AS (SELECT event_id, {USERS} AS who, ts, event_type, CAST(round(value * 100) AS BIGINT) AS cents FROM events)"
# Orders spread over the days of the events, each at a moment of its own.
ORDERS = """o AS (SELECT o_orderkey, o_custkey, o_totalprice,
    TIMESTAMP '2024-01-01' + to_microseconds((o_orderkey * 7919 % 2592000) * 1000000 + o_orderkey % 1000000) AS moment FROM orders)"""


def events(v: Views) -> DataFrame:
    cents = F.round(F.col("value") * 100).cast("bigint").alias("cents")
    return v.table("events").select("event_id", F.expr(USERS).alias("who"), "ts", "event_type", cents)


def orders(v: Views) -> DataFrame:
    micros = "o_orderkey * 7919 % 2592000 * 1000000 + o_orderkey % 1000000"
    moment = F.expr(f"timestampadd(MICROSECOND, {micros}, timestamp_ntz'2024-01-01')").alias("moment")
    return v.table("orders").select("o_orderkey", "o_custkey", "o_totalprice", moment)


@relation(
    "asof_last_order_of_each_user",
    f"""WITH {EVENTS}, {ORDERS} SELECT event_id, who, ts, o_orderkey AS last_order, moment AS last_moment, o_totalprice AS last_price
    FROM e ASOF LEFT JOIN o ON who = o_custkey AND ts >= moment""",
)
def _(v):
    columns = {"last_order": "o_orderkey", "last_moment": "moment", "last_price": "o_totalprice"}
    found = asof_join(events(v), orders(v), {"who": "o_custkey"}, "ts", "moment", columns)
    return found.select("event_id", "who", "ts", *columns)


@relation(
    "asof_reading_before_each_incident",
    f"""WITH {EVENTS}, {ORDERS}, r AS (SELECT event_id AS reading, ts AS seen, cents AS level FROM e WHERE event_type = 'view'),
    j AS (SELECT *, seen >= moment - INTERVAL 5 MINUTES AS fresh FROM o ASOF LEFT JOIN r ON moment > seen)
    SELECT o_orderkey, moment, CASE WHEN fresh THEN reading END AS reading, CASE WHEN fresh THEN level END AS level FROM j""",
)
def _(v):
    readings = events(v).where("event_type = 'view'")
    within = F.expr("INTERVAL 5 MINUTES")
    found = asof_join(orders(v), readings, {}, "moment", "ts", {"reading": "event_id", "level": "cents"}, strict=True, within=within)
    return found.select("o_orderkey", "moment", "reading", "level")


# Intervals of a second to an hour and a half, every seventh of three days.
SPANS = f"""{ORDERS}, s AS (SELECT o_orderkey, o_custkey, moment AS opened,
    moment + to_seconds(CASE WHEN o_orderkey % 7 = 0 THEN 259200 ELSE o_orderkey % 5400 + 1 END) AS closed FROM o)"""


def spans(v: Views) -> DataFrame:
    seconds = "cast(if(o_orderkey % 7 = 0, 259200, o_orderkey % 5400 + 1) AS bigint)"
    closed = F.expr(f"timestampadd(SECOND, {seconds}, moment)").alias("closed")
    return orders(v).select("o_orderkey", "o_custkey", F.col("moment").alias("opened"), closed)


@relation(
    "interval_join_events_in_open_orders",
    f"""WITH {EVENTS}, {SPANS} SELECT event_id, who, ts, o_orderkey, opened, closed
    FROM e JOIN s ON who = o_custkey AND ts >= opened AND ts < closed""",
)
def _(v):
    return interval_join(events(v), spans(v), "ts", "opened", "closed", {"who": "o_custkey"}).select("event_id", "who", "ts", "o_orderkey", "opened", "closed")


@relation(
    "interval_join_orders_open_at_each_event",
    f"""WITH {EVENTS}, {SPANS} SELECT event_id, count(o_orderkey) AS open_orders, min(opened) AS first_opened
    FROM e LEFT JOIN s ON ts >= opened AND ts < closed AND o_orderkey % 7 <> 0 GROUP BY event_id""",
)
def _(v):
    # Counted at each moment: the pairs of events and open orders grow with the product of the tables.
    found = open_at(events(v).select("event_id", "ts"), spans(v).where("o_orderkey % 7 <> 0"), "ts", "opened", "closed", "open_orders", "first_opened")
    return found.groupBy("event_id").agg(F.sum("open_orders").alias("open_orders"), F.min("first_opened").alias("first_opened"))


@relation(
    "value_frames_last_seven_days",
    f"""WITH {EVENTS} SELECT event_id, who, ts, CAST(sum(cents) OVER w AS BIGINT) AS week_cents, count(*) OVER w AS week_events,
    max(cents) OVER w AS most, min(cents) OVER w AS least FROM e
    WINDOW w AS (PARTITION BY who ORDER BY ts RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND CURRENT ROW)""",
)
def _(v):
    made = {"week_cents": ("sum", "cents"), "week_events": ("count", "event_id"), "most": ("max", "cents"), "least": ("min", "cents")}
    return over_last(events(v), ["who"], "ts", 7 * 86_400_000_000, made).select("event_id", "who", "ts", *made)


@relation(
    "value_frames_month_of_all_orders",
    """WITH d AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders)
    SELECT o_orderkey, day, CAST(sum(cents) OVER w AS BIGINT) AS month_cents, max(cents) OVER w AS dearest FROM d
    WINDOW w AS (ORDER BY day RANGE BETWEEN INTERVAL 30 DAYS PRECEDING AND CURRENT ROW)""",
)
def _(v):
    day = F.col("o_orderdate").cast("date").alias("day")
    rows = v.table("orders").select("o_orderkey", day, F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"))
    made = {"month_cents": ("sum", "cents"), "dearest": ("max", "cents")}
    return over_last(rows, [], "day", 30, made).select("o_orderkey", "day", *made)


@relation(
    "global_ranks_of_quantities",
    """SELECT l_orderkey, l_partkey, l_quantity, rank() OVER w AS place, dense_rank() OVER w AS level, percent_rank() OVER w AS share
    FROM lineitem WINDOW w AS (ORDER BY l_quantity DESC)""",
)
def _(v):
    found = global_ranks(v.table("lineitem"), ["l_quantity"], ["rank", "dense_rank", "percent_rank"], descending=["l_quantity"])
    return found.select("l_orderkey", "l_partkey", "l_quantity", F.col("rank").alias("place"), F.col("dense_rank").alias("level"), F.col("percent_rank").alias("share"))


@relation(
    "global_ntile_of_prices",
    """SELECT tile, count(*) AS n, min(place) AS first_place, max(place) AS last_place, min(l_extendedprice) AS least, max(l_extendedprice) AS most FROM (
    SELECT l_extendedprice, ntile(97) OVER w AS tile, row_number() OVER w AS place FROM lineitem WINDOW w AS (ORDER BY l_extendedprice)) GROUP BY tile""",
)
def _(v):
    found = global_ranks(v.table("lineitem"), ["l_extendedprice"], ["ntile", "row_number"], tiles=97)
    price = F.col("l_extendedprice")
    return found.groupBy(F.col("ntile").alias("tile")).agg(
        F.count("*").alias("n"), F.min("row_number").alias("first_place"), F.max("row_number").alias("last_place"), F.min(price).alias("least"), F.max(price).alias("most")
    )


@relation(
    "sessions_of_each_user",
    f"""WITH {EVENTS}, f AS (SELECT *, CASE WHEN ts - lag(ts) OVER w < INTERVAL 40 MINUTES THEN 0 ELSE 1 END AS begins FROM e WINDOW w AS (PARTITION BY who ORDER BY ts)),
    s AS (SELECT *, CAST(sum(begins) OVER (PARTITION BY who ORDER BY ts) AS BIGINT) AS session FROM f)
    SELECT who, session, min(ts) AS started, max(ts) AS ended, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents FROM s GROUP BY who, session""",
)
def _(v):
    return session_table(events(v), ["who"], "ts", 40 * 60_000_000, {"cents": F.sum("cents")})


# The newer snapshot: some orders gone, some repriced, some entered again under new numbers, some twice.
NEWER = """SELECT o_orderkey, o_custkey, o_orderstatus, CAST(round(o_totalprice * 100) AS BIGINT) + CASE WHEN o_orderkey % 11 = 0 THEN 100 ELSE 0 END AS cents
    FROM orders WHERE o_orderkey % 13 <> 0
    UNION ALL SELECT o_orderkey + 10000000, o_custkey, o_orderstatus, CAST(round(o_totalprice * 100) AS BIGINT) FROM orders WHERE o_orderkey % 17 = 0
    UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, CAST(round(o_totalprice * 100) AS BIGINT) FROM orders WHERE o_orderkey % 19 = 0"""
OLDER = "SELECT o_orderkey, o_custkey, o_orderstatus, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders"


def snapshots_of_orders(v: Views) -> tuple[DataFrame, DataFrame]:
    rows = v.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"))
    key = F.col("o_orderkey")
    raised = F.when(key % 11 == 0, F.col("cents") + 100).otherwise(F.col("cents"))
    new = rows.withColumn("cents", raised).where(key % 13 != 0)
    new = new.union(rows.where(key % 17 == 0).withColumn("o_orderkey", key + 10_000_000)).union(rows.where(key % 19 == 0))
    return rows, new


@relation(
    "snapshot_rows_added_and_removed",
    f"""WITH a AS ({OLDER}), b AS ({NEWER}), moved AS (
    SELECT *, 1 AS n FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a) UNION ALL SELECT *, -1 FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b))
    SELECT o_orderkey, o_custkey, o_orderstatus, cents, CAST(sum(n) AS BIGINT) AS n FROM moved GROUP BY ALL""",
)
def _(v):
    return row_difference(*snapshots_of_orders(v))


@relation(
    "snapshot_changes_by_key",
    f"""WITH a AS ({OLDER}), b AS ({NEWER}), moved AS (
    SELECT *, 1 AS n FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a) UNION ALL SELECT *, -1 FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)),
    k AS (SELECT o_orderkey, sum(n) FILTER (n > 0) AS come, -sum(n) FILTER (n < 0) AS gone FROM moved GROUP BY o_orderkey),
    one AS (SELECT o_orderkey FROM k WHERE come = 1 AND gone = 1)
    SELECT o_orderkey, 'changed' AS kind, CAST(1 AS BIGINT) AS n, max(cents) FILTER (n < 0) AS cents_before, max(cents) FILTER (n > 0) AS cents_after, 'cents' AS columns
    FROM moved JOIN one USING (o_orderkey) GROUP BY o_orderkey
    UNION ALL SELECT o_orderkey, CASE WHEN n > 0 THEN 'added' ELSE 'removed' END, count(*), CASE WHEN n < 0 THEN cents END, CASE WHEN n > 0 THEN cents END, NULL
    FROM moved ANTI JOIN one USING (o_orderkey) GROUP BY o_orderkey, o_custkey, o_orderstatus, cents, n""",
)
def _(v):
    found = changes(*snapshots_of_orders(v), ["o_orderkey"])
    names = F.array_join("changed", ",").alias("columns")
    return found.select("o_orderkey", "kind", "n", F.col("before.cents").alias("cents_before"), F.col("after.cents").alias("cents_after"), names)


@relation(
    "snapshot_history_as_of",
    f"WITH b AS ({NEWER}) SELECT o_orderkey, o_custkey, o_orderstatus, cents, count(*) AS n FROM b GROUP BY ALL",
)
def _(v):
    old, new = snapshots_of_orders(v)
    first, second = (F.lit(d).cast("date") for d in ("2024-01-01", "2024-02-01"))
    history = with_difference(open_history(old, first), row_difference(old, new), second)
    return as_of(cut(history), second)


@relation(
    "states_quantiles_and_counts_of_a_range",
    """SELECT event_type, count(*) AS n, true AS median_is_near, true AS ninth_is_near, true AS users_are_near FROM events
    WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' GROUP BY event_type""",
)
def _(v):
    """From stored daily states only; the exact figures beside them say whether the bounds hold."""
    rows = v.table("events").withColumn("day", F.to_date("ts"))
    stored = cut(day_states(rows, ["event_type"], F.col("day"), {"value_state": "value"}, {"user_state": "user_id"}))
    first, last = (F.lit(d).cast("date") for d in ("2024-01-05", "2024-01-20"))
    found = over_days(stored, ["event_type"], first, last, {"value_state": [0.5, 0.9]}, ["user_state"])
    # Where the merged quantiles stand among the values, and how many users there are, exactly.
    inside = rows.where(F.col("day").between(first, last)).join(found.withColumnRenamed("event_type", "type"), F.col("event_type") == F.col("type"))
    place = [F.avg((F.col("value") <= F.col("value_state")[i]).cast("double")) for i in (0, 1)]
    users = F.abs(F.max("user_state") - F.count_distinct("user_id")) <= 0.05 * F.count_distinct("user_id")
    near = [F.abs(p - share) <= 2 * RANK_ERROR for p, share in zip(place, (0.5, 0.9))]
    return inside.groupBy("event_type").agg(
        F.max("n").alias("n"), near[0].alias("median_is_near"), near[1].alias("ninth_is_near"), users.alias("users_are_near")
    )


@relation(
    "states_distinct_users_rolled_up",
    """SELECT event_type, day, CAST(2 - grouping(event_type) - grouping(day) AS INT) AS level, count(DISTINCT user_id) AS users
    FROM (SELECT event_type, CAST(ts AS DATE) AS day, user_id FROM events) GROUP BY ROLLUP (event_type, day)""",
)
def _(v):
    rows = v.table("events").withColumn("day", F.to_date("ts"))
    return rolled_up(bitmap_states(rows, ["event_type", "day"], "user_id"), ["event_type", "day"], "users")
