"""The registered queries: name -> (Spark callable, SQL or None)."""

from __future__ import annotations

import datetime as dt
import operator
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrain.functions import columns as C
from daygrain.operators import consolidate as merge
from daygrain.operators import joins, ordered, quality, stats
from daygrain.plans import city_days as city
from daygrain.plans import games, incidents, raw, refresh, staging, weather
from daygrain.session import cut, fresh_folder
from daygrain.sinks import tables
from daygrain.sources import files, schemas, snapshots
from daygrain.streaming import landing as stream
from proofs import landing
from proofs.relations import RELATIONS
from proofs.views import AREA, CATEGORIES, SQL, TEAM, Views, no_day, with_views, workday

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Query, str | None]] = {}


def query(name: str, sql: str | None):
    def register(build: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
        REGISTRY[name] = (lambda spark, folder: build(Views(spark, folder)), sql)
        return build

    return register


def aliased(**columns) -> list:
    return [c.alias(n) for n, c in columns.items()]


# --- sources -----------------------------------------------------------------


def observation_rows(v: Views) -> DataFrame:
    """Events under the full observation schema, city by event type."""
    given = {
        "icaoId": F.col("station"),
        "reportTime": F.col("reportTime"),
        "temp": F.col("temp"),
        "pcp6hr": F.col("pcp6hr"),
        "obsTime": F.col("event_id"),
    }
    columns = [given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.OBSERVATION.fields]
    return v.raw_observations().select(*columns, F.col("station").alias("city"))


@query(
    "s1_observations_parquet",
    """SELECT event_id AS "obsTime", ts AS "reportTime", CAST(floor(value / 10) * 5 AS DOUBLE) AS temp FROM events
    WHERE event_type = 'view' AND ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20'""",
)
def _(v):
    base = fresh_folder(v.spark, "yearly")
    tables.write_yearly(observation_rows(v), base)
    rows = files.read_observations(v.spark, base, "view", dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 20))
    return rows.select("obsTime", "reportTime", "temp")


@query(
    "s17_yearly_sets",
    """SELECT event_type AS city, CAST(year(ts) AS INT) AS "year", count(*) AS n, min(ts) AS first_time, max(ts) AS last_time
    FROM events GROUP BY ALL""",
)
def _(v):
    base = fresh_folder(v.spark, "yearly")
    tables.write_yearly(observation_rows(v), base)
    return v.spark.read.parquet(base).groupBy("city", "year").agg(
        F.count(F.lit(1)).alias("n"), F.min("reportTime").alias("first_time"), F.max("reportTime").alias("last_time")
    )


ORDER_TEXT = """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
    strftime(o_orderdate, '%Y%m%d') AS o_orderdate, o_orderpriority FROM orders"""
ORDER_NAMES = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"]


def order_text(v: Views) -> DataFrame:
    return v.table("orders").select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.col("o_custkey").cast("string").alias("o_custkey"),
        "o_orderstatus",
        F.date_format("o_orderdate", "yyyyMMdd").alias("o_orderdate"),
        "o_orderpriority",
    )


@query("s2_csv_all_text", ORDER_TEXT)
def _(v):
    path = fresh_folder(v.spark, "csv")
    order_text(v).write.csv(path, header=True)
    return files.read_csv_text(v.spark, path, ORDER_NAMES)


@query(
    "s3_csv_preamble",
    """SELECT CAST(o_orderdate AS DATE) AS "date", CAST(o_orderkey AS VARCHAR) AS "tavg", o_orderpriority AS "tmax" FROM orders
    WHERE o_orderdate >= DATE '1996-01-01' AND o_orderdate < DATE '1999-01-01'""",
)
def _(v):
    path = fresh_folder(v.spark, "preamble")
    line = F.concat_ws(",", F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderkey").cast("string"), "o_orderpriority")
    landing.land_lines(v.table("orders").select(line.alias("line")), path, ["A STATION, SOMEWHERE (S1)", "Date,TAVG,TMAX"])
    rows = files.read_csv_after_preamble(v.spark, path, skip=1).toDF("date", "tavg", "tmax")
    rows = rows.withColumn("date", F.to_date("date", "yyyy-MM-dd"))
    return rows.where(C.in_range(F.col("date"), dt.date(1996, 1, 1), dt.date(1999, 1, 1)))


CENSUS_YEARS = range(1992, 1999)


def wide_counts(v: Views) -> DataFrame:
    """Orders per customer and year, one column per year, as a census file line: rank, area, years."""
    year = F.year("o_orderdate")
    counts = v.table("orders").groupBy("o_custkey").agg(
        *[(F.count_if(year == y) * 1000).alias(str(y)) for y in CENSUS_YEARS]
    )
    grouped = [F.format_number(str(y), 0) for y in CENSUS_YEARS]
    return counts.select(F.concat_ws(",", F.lit("x"), F.concat(F.lit("area "), "o_custkey"), *[F.concat(F.lit('"'), g, F.lit('"')) for g in grouped]).alias("line"))


LONG_COUNTS = """SELECT 'area ' || o_custkey AS geographic_area, y AS "year",
    1000 * count(*) FILTER (WHERE year(o_orderdate) = y) AS population
    FROM orders, (SELECT unnest(range(1992, 1999)) AS y) GROUP BY o_custkey, y"""


@query("s4_blank_headers_u2_concat_u3_unpivot_x3_replace", f"SELECT geographic_area, CAST(\"year\" AS BIGINT) AS \"year\", population FROM ({LONG_COUNTS})")
def _(v):
    path = fresh_folder(v.spark, "census")
    landing.land_lines(wide_counts(v), path, ["table with titles", "Estimates,of,something", ",," + ",".join(map(str, CENSUS_YEARS))])
    rows = files.read_csv_after_preamble(v.spark, path, skip=2)
    years = lambda *found: raw.years_to_rows(rows, "_duplicated_0", {str(y): str(y) for y in found})
    return raw.population([years(*CENSUS_YEARS[:4]), years(*CENSUS_YEARS[4:])])


@query(
    "s5_names_apart_x9_parse_date",
    """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders
    WHERE o_orderdate >= DATE '1997-01-01' AND o_orderdate < DATE '1998-01-01'""",
)
def _(v):
    base = fresh_folder(v.spark, "named")
    order_text(v).write.csv(f"{base}/logs")
    v.spark.createDataFrame([(",".join(ORDER_NAMES),)], "line string").write.text(f"{base}/names")
    rows = files.read_csv_named_apart(v.spark, f"{base}/logs", f"{base}/names")
    rows = rows.withColumn("o_orderdate", F.to_date("o_orderdate", "yyyyMMdd"))
    rows = rows.where(C.in_range(F.col("o_orderdate"), dt.date(1997, 1, 1), dt.date(1998, 1, 1)))
    return rows.select("o_orderkey", "o_orderpriority", "o_orderdate")


@query("s6_csv_typed", "SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer")
def _(v):
    path = fresh_folder(v.spark, "domain")
    source = v.table("customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    source.write.csv(path, header=True)
    return files.read_csv_typed(v.spark, path, source.schema)


@query(
    "s7_json_envelope",
    """SELECT o_orderkey AS objectid, CAST(o_orderdate AS DATE) AS dispatch_date, o_orderpriority AS text_general_code,
    o_totalprice AS point_x, CAST(o_orderkey AS DOUBLE) AS dc_key, CAST(NULL AS INT) AS "hour" FROM orders""",
)
def _(v):
    path = fresh_folder(v.spark, "envelope")
    rows = v.table("orders").select(
        F.col("o_orderkey").alias("objectid"),
        F.col("o_orderkey").alias("dc_key"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("dispatch_date"),
        F.col("o_orderpriority").alias("text_general_code"),
        F.col("o_totalprice").alias("point_x"),
        F.lit("unknown to the schema").alias("extra"),
    )
    landing.land_documents(landing.json_rows(rows), path, '{"rows":[', '],"total_rows":1}')
    found = files.read_envelope(v.spark, path, schemas.INCIDENT)
    return found.select(
        "objectid", F.to_date("dispatch_date", "yyyy-MM-dd").alias("dispatch_date"), "text_general_code", "point_x",
        F.col("dc_key").cast("double").alias("dc_key"), "hour",
    )


def schedule_documents(v: Views, path: str) -> None:
    """Games as a nested schedule, one day entry per game."""
    g = v.games()

    def side(name: str):
        record = F.struct((F.col("n_lines") * 3).alias("wins"), F.col("n_lines").alias("losses"), F.lit(".750").alias("pct"))
        return F.struct(
            F.struct(F.col(f"{name}_key").alias("id"), F.col(f"{name}_name").alias("name")).alias("team"),
            F.col(f"{name}_score").alias("score"),
            record.alias("leagueRecord"),
        )

    game = F.struct(
        F.col("game_id").alias("gamePk"),
        F.col("season").cast("string").alias("season"),
        F.struct(F.col("state").alias("codedGameState"), F.lit(False).alias("startTimeTBD")).alias("status"),
        F.struct(side("away").alias("away"), side("home").alias("home")).alias("teams"),
        F.when(F.col("night"), F.lit("night")).otherwise(F.lit("day")).alias("dayNight"),
        F.col("n_lines").alias("seriesGameNumber"),
    )
    days = g.select(F.date_format("game_date", "yyyy-MM-dd").alias("date"), F.array(game).alias("games"))
    landing.land_documents(landing.json_rows(days), path, '{"dates":[', "]}")


@query(
    "s8_nested_schedule",
    with_views("games", select="""SELECT game_date AS "date", game_id AS game_pk, CAST(season AS VARCHAR) AS season, state AS coded_game_state,
    false AS start_time_tbd, away_name AS away_team_name, away_score AS away_team_score, CAST(n_lines * 3 AS INT) AS away_team_record_wins,
    home_key AS home_team_id, home_score AS home_team_score, CASE WHEN night THEN 'night' ELSE 'day' END AS day_night,
    CAST(NULL AS VARCHAR) AS venue_name, CAST(NULL AS BOOLEAN) AS is_tie, CAST(n_lines AS INT) AS series_game_number
    FROM games WHERE game_date >= DATE '1996-01-01' AND game_date < DATE '2001-01-01'"""),
)
def _(v):
    path = fresh_folder(v.spark, "schedule")
    schedule_documents(v, path)
    rows = files.read_schedule(v.spark, path, dt.date(1996, 1, 1), dt.date(2001, 1, 1))
    return rows.select(
        "date", "game_pk", "season", "coded_game_state", "start_time_tbd", "away_team_name", "away_team_score", "away_team_record_wins",
        "home_team_id", "home_team_score", "day_night", "venue_name", "is_tie", "series_game_number",
    )


FILE_DATE = "CAST(ts AS DATE) + CASE WHEN value > 450 THEN 2 ELSE 0 END"


def landed_observations(v: Views) -> DataFrame:
    """Events as observation JSON with the date of their daily file; high values arrive two days late."""
    day = F.to_date("ts")
    late = F.when(F.col("value") > 450, F.date_add(day, 2)).otherwise(day)
    rows = v.table("events").select(
        F.col("event_type").alias("icaoId"),
        F.col("event_id").alias("obsTime"),
        F.date_format("ts", schemas.ISO_INSTANT).alias("reportTime"),
        F.col("value").alias("temp"),
        F.array(F.lit("dropped")).alias("clouds"),
    )
    stamped = v.table("events").select("event_id", F.date_format(late, "yyyy-MM-dd").alias("file_date"))
    return landing.json_rows(rows).join(stamped, F.col("obsTime") == F.col("event_id")).select("doc", "file_date")


@query(
    "s9_observation_arrays",
    """SELECT event_type AS "icaoId", event_id AS "obsTime", date_trunc('milliseconds', ts) AS "reportTime", value AS temp,
    CAST(NULL AS DOUBLE) AS dewp, CAST(NULL AS BIGINT) AS wspd FROM events""",
)
def _(v):
    path = fresh_folder(v.spark, "arrays")
    landing.land_documents(landed_observations(v), path, "[", "]", "file_date")
    return files.read_observation_arrays(v.spark, path).select("icaoId", "obsTime", "reportTime", "temp", "dewp", "wspd")


@query("s10_prefix_union", ORDER_TEXT)
def _(v):
    base = fresh_folder(v.spark, "prefix")
    text = order_text(v)
    text.where("o_orderstatus = 'F'").write.csv(f"{base}/past/finished")
    text.where("o_orderstatus <> 'F'").write.csv(f"{base}/past/others")
    return v.spark.read.schema(schemas.strings(ORDER_NAMES)).csv([f"{base}/past/finished", f"{base}/past/others"])


@query(
    "s11_latest_snapshot",
    """SELECT event_id, ts, value FROM events WHERE CAST(ts AS DATE) = (
    SELECT max(CAST(ts AS DATE)) FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2023-12-22' AND DATE '2024-01-21')""",
)
def _(v):
    base = fresh_folder(v.spark, "snapshots")
    events = v.table("events").select("event_id", "ts", "value")
    events.withColumn("taken", F.to_date("ts")).write.partitionBy("taken").parquet(base)
    paths = snapshots.list_paths(v.spark, base, "*.parquet")
    newest = snapshots.require_snapshot(paths, *snapshots.station_window(dt.date(2024, 1, 20)))
    return v.spark.read.schema(events.schema).parquet(*newest)


STAMPED = """SELECT CASE WHEN o_orderstatus = 'P' THEN 'orders-' || o_orderkey || '.csv'
    ELSE o_orderpriority || '_' || strftime(o_orderdate, '%Y-%m-%d') || '.csv' END AS path, o_orderdate, o_orderstatus FROM orders"""


@query(
    "s12_greatest_stamp",
    f"""SELECT path FROM ({STAMPED}) WHERE o_orderstatus <> 'P' AND o_orderdate = (
    SELECT max(o_orderdate) FROM orders WHERE o_orderstatus <> 'P')""",
)
def _(v):
    stamped = F.concat(F.col("o_orderpriority"), F.lit("_"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(".csv"))
    plain = F.concat(F.lit("orders-"), F.col("o_orderkey").cast("string"), F.lit(".csv"))
    names = v.table("orders").select(F.when(F.col("o_orderstatus") == "P", plain).otherwise(stamped).alias("path"))
    return snapshots.greatest_stamp(names)


@query("s16_zip_members", ORDER_TEXT)
def _(v):
    line = F.concat_ws(",", *[F.concat(F.lit('"'), c, F.lit('"')) for c in ORDER_NAMES])
    archives = landing.zipped(order_text(v).select(line.alias("line")), "orders")
    return files.unzip_csv(archives, ORDER_NAMES).select(*ORDER_NAMES)


# --- sinks -------------------------------------------------------------------


@query("s13_full_refresh", "SELECT o_orderkey, o_totalprice * 2 AS price FROM orders")
def _(v):
    table = fresh_folder(v.spark, "full")
    orders = v.table("orders")
    tables.write_full(orders.select("o_orderkey", F.col("o_totalprice").alias("price")), table)
    tables.write_full(tables.read_table(v.spark, table).withColumn("price", F.col("price") * 2), table)
    return tables.read_table(v.spark, table)


@query(
    "s14_time_range",
    """SELECT event_id, ts, value FROM events
    WHERE ts < DATE '2024-01-10' OR ts >= DATE '2024-01-20' OR (value > 100 AND isodow(ts) < 6)""",
)
def _(v):
    table = fresh_folder(v.spark, "ranges")
    events = v.table("events").select("event_id", "ts", "value")
    tables.write_time_range(events, table, "ts", dt.date(2024, 1, 1), dt.date(2024, 2, 1))
    weekdays = events.where((F.col("value") > 100) & (F.weekday("ts") < 5))
    tables.write_time_range(weekdays, table, "ts", dt.date(2024, 1, 10), dt.date(2024, 1, 20))
    return tables.read_time_range(v.spark, table, "event_id bigint, ts timestamp_ntz, value double")


@query(
    "s15_upsert",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN -o_totalprice ELSE o_totalprice END AS price
    FROM orders""",
)
def _(v):
    table = fresh_folder(v.spark, "keyed")
    orders = v.table("orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").alias("price"))
    tables.upsert(orders.drop("o_orderstatus"), table, "o_orderkey")
    tables.upsert(orders.where("o_orderstatus = 'F'").select("o_orderkey", (-F.col("price")).alias("price")), table, "o_orderkey")
    return tables.read_table(v.spark, table)


@query("k1_refresh_by_definition", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 2 * o_totalprice ELSE o_totalprice END AS price FROM orders")
def _(v):
    base = fresh_folder(v.spark, "defined")
    definition = refresh.Table("prices", refresh.BY_KEY, key="o_orderkey", unique=("o_orderkey",), numeric=("price",))
    orders = v.table("orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").alias("price"))
    refresh.refresh(orders.drop("o_orderstatus"), definition, base)
    path = refresh.refresh(orders.where("o_orderstatus = 'F'").select("o_orderkey", (2 * F.col("price")).alias("price")), definition, base)
    return tables.read_table(v.spark, path)


@query(
    "s18_tail_replace",
    """WITH fresh AS (SELECT event_id, ts, value FROM events WHERE event_type = 'view' AND ts >= TIMESTAMP '2024-01-15 12:00:00')
    SELECT * FROM fresh UNION ALL
    SELECT event_id, ts, value FROM events WHERE NOT (event_type = 'view' AND ts >= TIMESTAMP '2024-01-15 12:00:00') AND ts < (SELECT min(ts) FROM fresh)""",
)
def _(v):
    rows = v.table("events").select("event_id", "ts", "value", "event_type")
    late = (F.col("event_type") == "view") & (F.col("ts") >= C.point(dt.datetime(2024, 1, 15, 12)))
    new, old = rows.where(late), rows.where(~late)
    return merge.consolidate(old.drop("event_type"), new.drop("event_type"), "ts")


def _recompiled(city_expr: str, time: str, columns: str) -> str:
    return f"""WITH f AS (SELECT *, {city_expr} AS city, {FILE_DATE} AS file_date, {time} AS t FROM events),
    firsts AS (SELECT city, file_date, min(t) AS first_t FROM f GROUP BY ALL)
    SELECT {columns} FROM f WHERE NOT EXISTS (
      SELECT 1 FROM firsts l WHERE l.city = f.city AND l.file_date > f.file_date AND l.first_t <= f.t)"""


@query("s19_recompile_year", _recompiled("event_type", "ts", "event_id, city, ts, value, CAST(file_date AS DATE) AS file_date"))
def _(v):
    day = F.to_date("ts")
    late = F.when(F.col("value") > 450, F.date_add(day, 2)).otherwise(day)
    rows = v.table("events").select("event_id", F.col("event_type").alias("city"), "ts", "value", late.alias("file_date"))
    return merge.recompile(rows, "file_date", "ts", ["city"])


@query(
    "t1_landing_stream",
    _recompiled("1", "date_trunc('milliseconds', ts)", 'event_type AS "icaoId", event_id AS "obsTime", t AS "reportTime", value AS temp'),
)
def _(v):
    base = fresh_folder(v.spark, "stream")
    landing.land_documents(landed_observations(v), f"{base}/landing", "[", "]", "file_date")
    arriving = stream.landing_stream(v.spark, f"{base}/landing").select("icaoId", "obsTime", "reportTime", "temp", "file_date")
    stream.run_available(arriving, f"{base}/table", f"{base}/progress")
    stored = tables.read_time_range(v.spark, f"{base}/table", "icaoId string, obsTime bigint, reportTime timestamp_ntz, temp double")
    return stored


# --- projection and filters ----------------------------------------------------


@query("p1_staging_projection", """SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS dispatch_date, year(o_orderdate) AS dispatch_year,
    month(o_orderdate) AS dispatch_month, day(o_orderdate) AS dispatch_day, o_orderpriority AS incident_type FROM orders""")
def _(v):
    raw_rows = v.table("orders").select(
        F.col("o_orderkey").alias("dc_key"), F.to_date("o_orderdate").alias("dispatch_date"), F.col("o_orderpriority").alias("text_general_code")
    )
    return staging.incidents(raw_rows)


_STAT = "stat_days"


@query("p2_display_names_p3_drop", with_views(_STAT, select="""SELECT entry_date, max_temp_deg_f AS "Daily Max Temp (F)",
    total_incidents_per_100k AS "Incidents per 100k", team_outcome AS "Win/Loss (Text)", team_score AS "Runs Scored" FROM stat_days"""))
def _(v):
    few = v.days().select("entry_date", "max_temp_deg_f", "total_incidents_per_100k", "team_outcome", "team_score", "report_date")
    return city.display(few.drop("report_date"))


@query("p4_flags_f3_status_x5_try_cast", with_views("stg_current", select="SELECT * FROM stg_current"))
def _(v):
    return staging.current_games(v.raw_current(v.games()))


@query("p5_outcomes_u1_distinct_sides", with_views("schedule_games", select="SELECT * EXCLUDE (game_number) FROM schedule_games"))
def _(v):
    return games.current_sides(staging.current_games(v.raw_current(v.games())))


@query("p6_pick_by_side_j3_either_team", with_views("log_games", select="SELECT * FROM log_games"))
def _(v):
    return games.historical_team_games(staging.historical_games(v.raw_historical(v.stored_games())), v.raw_teams())


@query(
    "p7_team_perspective",
    with_views("games", select=f"""SELECT game_id, CASE WHEN home_name = '{TEAM}' THEN home_name ELSE away_name END AS team,
    home_name = '{TEAM}' AS home_game, CASE WHEN home_name = '{TEAM}' THEN home_score ELSE away_score END AS team_score
    FROM games WHERE home_name = '{TEAM}' OR away_name = '{TEAM}'"""),
)
def _(v):
    rows = v.games().withColumnsRenamed({"home_name": "home_team", "away_name": "away_team"})
    figures = {f"{s}_team_{c}": F.lit(None).cast("int") for s in ("home", "away") for c in city.PERSPECTIVE if c != "score"}
    rows = rows.withColumns(
        {**figures, "home_team_score": F.col("home_score"), "away_team_score": F.col("away_score"), "night_game": F.col("night"), "time_of_game_minutes": F.lit(0)}
    )
    return city.team_view(rows, TEAM).select("game_id", "team", "home_game", "team_score")


@query("f6_games_of_team", with_views("gold_games", select=f"SELECT * FROM gold_games WHERE home_team = '{TEAM}' OR away_team = '{TEAM}'"))
def _(v):
    return city.games_of(gold_games(v), TEAM)


@query("p8_outcome_value_p9_deviation", with_views(_STAT, select="""SELECT entry_date,
    CASE team_outcome WHEN 'win' THEN 1 WHEN 'loss' THEN 0 END AS v, max_temp_deg_f - avg_max_temp_deg_f AS above_norm FROM stat_days"""))
def _(v):
    return v.days().select(
        "entry_date", C.outcome_value(F.col("team_outcome")).alias("v"), city.deviation("max_temp_deg_f", "avg_max_temp_deg_f").alias("above_norm")
    )


@query("p10_first_present", with_views(_STAT, select="""SELECT entry_date, coalesce(max_temp_deg_f, total_incidents, -1) AS figure FROM stat_days"""))
def _(v):
    return v.days().select("entry_date", F.coalesce("max_temp_deg_f", "total_incidents", F.lit(-1)).cast("double").alias("figure"))


@query("p11_source_choice_j1_full_outer", with_views("gold_weather", select="SELECT * FROM gold_weather"))
def _(v):
    return gold_weather(v)


@query("f1_half_open_range", "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-05 06:00:00' AND ts < TIMESTAMP '2024-01-09 18:00:00'")
def _(v):
    return v.table("events").select("event_id", "ts").where(C.in_range(F.col("ts"), dt.datetime(2024, 1, 5, 6), dt.datetime(2024, 1, 9, 18)))


@query("f2_inclusive_days", with_views(_STAT, select="""SELECT entry_date, total_incidents FROM stat_days
    WHERE entry_date BETWEEN DATE '1996-02-01' AND DATE '1996-12-31'"""))
def _(v):
    return city.between_days(v.days().select("entry_date", "total_incidents"), dt.date(1996, 2, 1), dt.date(1996, 12, 31))


@query("f4_not_null", with_views(_STAT, select="""SELECT entry_date, team_current_record_wins_lag FROM stat_days WHERE team_current_record_wins_lag IS NOT NULL"""))
def _(v):
    return city.in_season(v.days()).select("entry_date", "team_current_record_wins_lag")


@query("f5_flag_and_negation", with_views("stg_current", select="""SELECT home_team_is_winner AS flag, count(*) AS n FROM stg_current
    WHERE home_team_is_winner OR NOT home_team_is_winner GROUP BY 1"""))
def _(v):
    rows = staging.current_games(v.raw_current(v.games())).select(F.col("home_team_is_winner").alias("flag"))
    both = rows.where(F.col("flag")).unionByName(rows.where(~F.col("flag")))
    return both.groupBy("flag").agg(F.count(F.lit(1)).alias("n"))


@query("f7_ilike", """SELECT o_orderkey, o_orderpriority ILIKE '5-low' AS whole, o_orderpriority ILIKE '%UrGent%' OR o_orderpriority ILIKE '%high%' AS part
    FROM orders""")
def _(v):
    text = F.col("o_orderpriority")
    return v.table("orders").select("o_orderkey", text.ilike("5-low").alias("whole"), C.matches_any(text, ["%UrGent%", "%high%"]).alias("part"))


@query("f8_column_thresholds", with_views(_STAT, select="""SELECT entry_date FROM stat_days
    WHERE max_temp_deg_f > avg_max_temp_deg_f AND team_current_streak >= 4 AND total_precip_inches >= 1"""))
def _(v):
    tests = stats.weather_conditions()
    return v.days().where(tests["hot"] & tests["rainy"] & stats.team_conditions()["winning_streak"]).select("entry_date")


# --- joins -------------------------------------------------------------------


@query("j2_full_outer_three_keys", with_views("team_games", select="SELECT * FROM team_games"))
def _(v):
    return combined_games(v)


@query("j4_pair_sides", with_views("schedule_games", select="""SELECT h.game_date, h.game_id, h.team AS home_team, a.team AS away_team,
    h.game_number AS home_number, a.game_number AS away_number FROM schedule_games h JOIN schedule_games a
    ON h.game_date = a.game_date AND h.game_id = a.game_id WHERE h.home_team AND NOT a.home_team"""))
def _(v):
    rows = games.current_team_games(staging.current_games(v.raw_current(v.games())))
    blank = {c: F.lit(None).cast("int") for c in ("current_streak", "current_win_pct", "last_10_win_pct", "last_40_win_pct", "time_of_game_minutes")}
    paired = games.pair_sides(rows.withColumns(blank))
    return paired.select(
        "game_date", "game_id", "home_team", "away_team",
        F.col("home_team_game_number").alias("home_number"), F.col("away_team_game_number").alias("away_number"),
    )


@query("j5_population_of_year_j6_default", with_views("incidents", "best_estimates", select=f"""SELECT i.id, i.dispatch_year, p.population AS of_year, d.population AS latest
    FROM incidents i LEFT JOIN (SELECT * FROM best_estimates WHERE geographic_area ILIKE '{AREA}') p ON i.dispatch_year = p."year"
    LEFT JOIN (SELECT population FROM best_estimates WHERE geographic_area ILIKE '{AREA}' ORDER BY "year" DESC LIMIT 1) d ON TRUE"""))
def _(v):
    estimates = staging.population(v.area_years()).where(F.col("geographic_area").ilike(AREA)).select("year", "population")
    of_year = estimates.withColumnsRenamed({"population": "of_year"})
    latest = estimates.select(F.col("year").alias("__y"), F.col("population").alias("latest"))
    rows = v.incidents().join(of_year, F.col("dispatch_year") == F.col("year"), "left")
    rows = joins.with_default_row(rows, latest, [F.col("__y").desc_nulls_last()])
    return rows.select("id", "dispatch_year", "of_year", "latest")


@query("j6_default_row_absent", "SELECT o_orderkey, CAST(NULL AS VARCHAR) AS fallback FROM orders")
def _(v):
    none = v.table("nation").where(F.col("n_name") == "NO SUCH NATION").select(F.col("n_name").alias("fallback"))
    return joins.with_default_row(v.table("orders").select("o_orderkey"), none, [F.col("fallback")])


@query("j7_three_way_days", """WITH a AS (SELECT CAST(CAST(ts AS DATE) + CASE isodow(ts) WHEN 6 THEN 2 WHEN 7 THEN 1 ELSE 0 END AS DATE) AS a_day, count(*) AS a_n FROM events WHERE event_type IN ('view', 'error') GROUP BY 1),
    b AS (SELECT CAST(CAST(ts AS DATE) + CAST(isodow(ts) IN (1, 6) AS INT) AS DATE) AS b_day, count(*) AS b_n FROM events WHERE event_type IN ('click', 'signup') GROUP BY 1),
    c AS (SELECT CAST(CAST(ts AS DATE) + CAST(isodow(ts) IN (2, 5) AS INT) AS DATE) AS c_day, event_id FROM events WHERE event_type NOT IN ('view', 'error', 'click', 'signup'))
    SELECT coalesce(a_day, b_day, c_day) AS entry_date, a_n, b_n, event_id FROM a FULL JOIN b ON a_day = b_day FULL JOIN c ON a_day = c_day OR b_day = c_day""")
def _(v):
    events, day = v.table("events"), F.to_date("ts")
    # Every event is in one of three sources, each of which leaves out other weekdays.
    first, second = F.col("event_type").isin("view", "error"), F.col("event_type").isin("click", "signup")
    a = events.where(first).groupBy(workday(day).alias("dispatch_date")).agg(F.count(F.lit(1)).alias("a_n"))
    b = events.where(second).groupBy(no_day(no_day(day, 0), 5).alias("report_date")).agg(F.count(F.lit(1)).alias("b_n"))
    c = events.where(~first & ~second).select(no_day(no_day(day, 1), 4).alias("game_date"), "event_id")
    return city.joined_days(a, b, c).select("entry_date", "a_n", "b_n", "event_id")


# --- aggregation ---------------------------------------------------------------


@query("a1_daily_observed_a2_zero_sum", with_views("observed_days", select="""SELECT report_date, max_temp_deg_f, avg_temp_deg_f, min_temp_deg_f,
    CAST(total_precip_inches AS DOUBLE) AS total_precip_inches, daily_count FROM observed_days"""))
def _(v):
    return weather.observed_days(staged_views(v))


@query("a3_count_present_a4_categories", with_views("crime_counts", select="SELECT dispatch_date, dispatch_year, total_incidents, "
       + ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in CATEGORIES) + " FROM crime_counts"))
def _(v):
    return incidents.daily_counts(v.incidents(), CATEGORIES)


@query("a5_rates_per_100k", with_views("gold_crime", select="SELECT * FROM gold_crime"))
def _(v):
    return gold_crime(v)


@query("a6_extent", with_views(_STAT, select="SELECT min(entry_date) AS first, max(entry_date) AS last FROM stat_days"))
def _(v):
    return stats.extent(v.days(), "entry_date")


@query("a7_most_frequent", """SELECT o_orderpriority FROM orders GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1""")
def _(v):
    return stats.most_frequent(v.table("orders"), "o_orderpriority")


_METRICS = {"incidents": "total_incidents_per_100k", "violent": "violent_crime_per_100k", "assaults": "assault_per_100k"}


def means_sql(conditions: dict[str, str]) -> str:
    parts = []
    for metric, column in _METRICS.items():
        for name, test in {"all": "TRUE", **conditions}.items():
            parts.append(f"""SELECT '{metric}' AS metric, '{name}' AS condition, round(avg({column}) FILTER (WHERE {test}), 2) AS mean,
            {'CAST(NULL AS DOUBLE)' if name == 'all' else f'round(avg({column}) FILTER (WHERE {test}) - avg({column}), 2)'} AS delta FROM stat_days""")
    return with_views(_STAT, select="\nUNION ALL ".join(parts))


_WEATHER_SQL = {"hot": "max_temp_deg_f > avg_max_temp_deg_f", "cold": "min_temp_deg_f < avg_min_temp_deg_f", "rainy": "total_precip_inches >= 1"}


@query("a8_means_by_weather", means_sql(_WEATHER_SQL))
def _(v):
    return stats.conditional_means(v.days(), _METRICS, stats.weather_conditions())


@query(
    "a8_means_by_record",
    means_sql(
        {
            "above_500": "team_current_record_wins_lag > team_current_record_losses_lag",
            "below_500": "team_current_record_wins_lag < team_current_record_losses_lag",
            "winning_streak": "team_current_streak >= 4",
            "losing_streak": "team_current_streak <= -4",
        }
    ),
)
def _(v):
    return stats.conditional_means(v.days(), _METRICS, stats.team_conditions())


def record_sql() -> str:
    tests = {"all": "TRUE", **_WEATHER_SQL, "rainy": "total_precip_inches > 1"}
    parts = []
    for name, test in tests.items():
        win, loss = (f"count(*) FILTER (WHERE home_game AND {test} AND team_outcome = '{o}')" for o in ("win", "loss"))
        parts.append(f"SELECT '{name}' AS condition, {win} AS wins, {loss} AS losses FROM stat_days")
    share = "round(CASE WHEN wins + losses > 0 THEN wins / (wins + losses) END, 3)"
    chain = with_views(_STAT, select="\nUNION ALL ".join(parts))
    return f"""SELECT condition, wins, losses, pct AS win_pct,
    CASE WHEN condition <> 'all' THEN round(pct - max(CASE WHEN condition = 'all' THEN pct END) OVER (), 3) END AS delta
    FROM (SELECT *, {share} AS pct FROM ({chain}))"""


@query("a9_win_loss_record", record_sql())
def _(v):
    return stats.win_loss_record(city.home_games(v.days()), stats.weather_conditions(rainy=operator.gt))


FIELDS = [
    "max_temp_deg_f", "min_temp_deg_f", "total_precip_inches", "total_incidents_per_100k", "violent_crime_per_100k", "assault_per_100k",
    "team_score", "team_outcome_as_value", "team_current_streak", "team_current_record_wins_lag", "team_current_record_losses_lag",
]


def corr_sql(source: str, fields: list[str], digits: int) -> str:
    r = lambda a, b: f"CASE WHEN isnan(corr({b}, {a})) THEN NULL ELSE round(corr({b}, {a}), {digits}) END"
    parts = [f"SELECT '{y}' AS x, '{x}' AS y, {r(x, y)} AS r FROM {source}" for i, x in enumerate(fields) for y in fields[i + 1:]]
    return with_views(source, select="\nUNION ALL ".join(parts))


@query("a10_correlation_matrix", corr_sql(_STAT, FIELDS, 6))
def _(v):
    return stats.correlation_matrix(v.days(), FIELDS, digits=6)


@query("a11_correlation_band", with_views(_STAT, select="""SELECT r, CASE WHEN abs(r) < 0.3 THEN 'weak' WHEN abs(r) < 0.7 THEN 'moderate' ELSE 'strong' END AS band
    FROM (SELECT round(corr(total_incidents_per_100k, violent_crime_per_100k), 3) AS r FROM stat_days)"""))
def _(v):
    return stats.correlation_band(v.days(), "total_incidents_per_100k", "violent_crime_per_100k")


@query("a12_linear_fit", with_views(_STAT, select="""SELECT 'y on x' AS axes, round(regr_slope(violent_crime_per_100k, max_temp_deg_f), 6) AS slope,
    round(regr_intercept(violent_crime_per_100k, max_temp_deg_f), 6) AS intercept, round(regr_r2(violent_crime_per_100k, max_temp_deg_f), 6) AS r2,
    CAST(regr_count(violent_crime_per_100k, max_temp_deg_f) AS BIGINT) AS n FROM stat_days
    UNION ALL SELECT 'x on y', round(regr_slope(max_temp_deg_f, violent_crime_per_100k), 6), round(regr_intercept(max_temp_deg_f, violent_crime_per_100k), 6),
    round(regr_r2(max_temp_deg_f, violent_crime_per_100k), 6), CAST(regr_count(max_temp_deg_f, violent_crime_per_100k) AS BIGINT) FROM stat_days"""))
def _(v):
    fits = stats.linear_fits(v.days(), "max_temp_deg_f", "violent_crime_per_100k")
    return fits.withColumns({c: C.round_to(F.col(c), 6) for c in ("slope", "intercept", "r2")})


@query("a13_logistic_fit", with_views(_STAT, select="""SELECT * FROM (WITH RECURSIVE counts AS (
    SELECT CAST(max_temp_deg_f AS DOUBLE) AS x, CAST(team_outcome_as_value AS DOUBLE) AS y, count(*) AS n FROM stat_days
    WHERE max_temp_deg_f IS NOT NULL AND team_outcome_as_value IS NOT NULL GROUP BY 1, 2
), centre AS (SELECT sum(n * x) / sum(n) AS c FROM counts), newton AS (
    SELECT 0 AS step, 0.0::DOUBLE AS a, 0.0::DOUBLE AS b
    UNION ALL
    SELECT step + 1, a + (hbb * ga - hab * gb) / (haa * hbb - hab * hab), b + (haa * gb - hab * ga) / (haa * hbb - hab * hab) FROM (
        SELECT step, a, b, sum(n * (y - p)) AS ga, sum(n * (y - p) * x) AS gb, sum(n * p * (1 - p)) AS haa, sum(n * p * (1 - p) * x) AS hab, sum(n * p * (1 - p) * x * x) AS hbb
        FROM (SELECT step, a, b, n, y, x - c AS x, 1 / (1 + exp(-(a + b * (x - c)))) AS p FROM newton, counts, centre WHERE step < 30)
        GROUP BY step, a, b)
) SELECT round(a - b * c, 6) AS intercept, round(b, 6) AS slope, CAST(2 AS INTEGER) AS classes, true AS converged FROM newton, centre WHERE step = 30)"""))
def _(v):
    fit = stats.logistic_fit(v.days(), "max_temp_deg_f", "team_outcome_as_value")
    return fit.withColumns({c: C.round_to(F.col(c), 6) for c in ("intercept", "slope")})


@query("a13_logistic_fit_two_groups", with_views(_STAT, select="""SELECT round(ln(w0 / l0), 6) AS intercept, round(ln(w1 / l1) - ln(w0 / l0), 6) AS slope FROM (
    SELECT count(*) FILTER (WHERE NOT hot AND won = 1) AS w0, count(*) FILTER (WHERE NOT hot AND won = 0) AS l0,
           count(*) FILTER (WHERE hot AND won = 1) AS w1, count(*) FILTER (WHERE hot AND won = 0) AS l1
    FROM (SELECT max_temp_deg_f > avg_max_temp_deg_f AS hot, team_outcome_as_value AS won FROM stat_days))"""))
def _(v):
    # With a 0/1 predictor the fit has a closed form: log odds and their difference.
    days = v.days().withColumn("hot", stats.weather_conditions()["hot"].cast("int"))
    fit = stats.logistic_fit(days, "hot", "team_outcome_as_value")
    return fit.select(*[C.round_to(F.col(c), 6).alias(c) for c in ("intercept", "slope")])


@query("a14_means_at", with_views(_STAT, select="""SELECT max_temp_deg_f AS x, round(avg(violent_crime_per_100k), 6) AS mean_y, count(*) AS n,
    round(avg(violent_crime_per_100k) - 1.959963984540054 * stddev_samp(violent_crime_per_100k) / sqrt(count(*)), 6) AS low,
    round(avg(violent_crime_per_100k) + 1.959963984540054 * stddev_samp(violent_crime_per_100k) / sqrt(count(*)), 6) AS high FROM stat_days
    WHERE max_temp_deg_f IS NOT NULL AND violent_crime_per_100k IS NOT NULL GROUP BY 1"""))
def _(v):
    return stats.means_at(v.days(), "max_temp_deg_f", "violent_crime_per_100k").withColumns({c: C.round_to(F.col(c), 6) for c in ("mean_y", "low", "high")})


def _mixed(x: str, times: int = 3) -> str:
    """The operator's whole-number mixing of draws, in nested selects."""
    for _ in range(times):
        x = f"SELECT day, a, b, replicate, (u * u + u * 69621 + 12345) % {stats.PRIME} AS u FROM ({x})"
    return x


_BAND = f"""p AS (SELECT CAST(max_temp_deg_f AS DOUBLE) AS x, CAST(violent_crime_per_100k AS DOUBLE) AS y, date_diff('day', DATE '1970-01-01', entry_date) AS day
    FROM stat_days WHERE max_temp_deg_f IS NOT NULL AND violent_crime_per_100k IS NOT NULL),
    facts AS (SELECT avg(x) AS mx, avg(y) AS my, min(x) AS lo, max(x) AS hi FROM p),
    drawn AS ({_mixed(f"""SELECT day, x - mx AS a, y - my AS b, replicate, (day * 48271 + replicate * 16807 + {stats.draw_start(0)}) % {stats.PRIME} AS u
        FROM p, facts, (SELECT unnest(range(1, 1001)) AS replicate)""")}),
    weighed AS (SELECT a, b, replicate, {" + ".join(f"CAST(u >= {limit} AS INT)" for limit in stats.poisson_limits())} AS w FROM drawn
        UNION ALL SELECT x - mx, y - my, 0, 1 FROM p, facts),
    sums AS (SELECT replicate, sum(w) AS n, sum(w * a) AS sx, sum(w * b) AS sy, sum(w * a * a) AS sxx, sum(w * a * b) AS sxy FROM weighed GROUP BY replicate),
    lines AS (SELECT replicate, (n * sxy - sx * sy) / (n * sxx - sx * sx) AS slope, (sy - (n * sxy - sx * sy) / (n * sxx - sx * sx) * sx) / n AS intercept FROM sums),
    values_at AS (SELECT replicate, i, lo + (hi - lo) / 99 * i AS x, my + intercept + slope * (lo + (hi - lo) / 99 * i - mx) AS v
        FROM lines, facts, (SELECT unnest(range(100)) AS i))"""


@query("a15_bootstrap_band", with_views(_STAT, select=f""", {_BAND}
    SELECT round(x, 6) AS x, round(max(v) FILTER (replicate = 0), 6) AS fit, round(quantile_cont(v, 0.025) FILTER (replicate > 0), 6) AS low,
    round(quantile_cont(v, 0.975) FILTER (replicate > 0), 6) AS high FROM values_at GROUP BY i, x"""))
def _(v):
    band = stats.bootstrap_band(v.days(), "max_temp_deg_f", "violent_crime_per_100k", ["entry_date"], number_of_row=F.unix_date("entry_date"))
    return band.select(*[C.round_to(F.col(c), 6).alias(c) for c in ("x", "fit", "low", "high")])


@query("a15_line_inside_its_band", with_views(_STAT, select="""SELECT round(lo + (hi - lo) / 99 * i, 6) AS x,
    round(intercept + slope * (lo + (hi - lo) / 99 * i), 6) AS fit, true AS inside FROM (
    SELECT min(max_temp_deg_f) AS lo, max(max_temp_deg_f) AS hi, regr_slope(violent_crime_per_100k, max_temp_deg_f) AS slope,
           regr_intercept(violent_crime_per_100k, max_temp_deg_f) AS intercept
    FROM stat_days WHERE max_temp_deg_f IS NOT NULL AND violent_crime_per_100k IS NOT NULL), (SELECT unnest(range(100)) AS i)"""))
def _(v):
    band = stats.bootstrap_band(v.days(), "max_temp_deg_f", "violent_crime_per_100k", ["entry_date"])
    return band.select(
        C.round_to(F.col("x"), 6).alias("x"), C.round_to(F.col("fit"), 6).alias("fit"), F.col("fit").between(F.col("low"), F.col("high")).alias("inside")
    )


@query("a16_presence", with_views(_STAT, select="""SELECT count(report_date) > 0 AS weather, coalesce(sum(total_incidents) <> 0, false) AS crime,
    coalesce(sum(total_precip_inches) <> 0, false) AS rain FROM stat_days"""))
def _(v):
    return stats.presence(v.days(), {"weather": "report_date"}, {"crime": "total_incidents", "rain": "total_precip_inches"})


# --- windows -------------------------------------------------------------------


@query("w1_best_estimate_per_key", with_views("best_estimates", select="SELECT geographic_area, \"year\", population FROM best_estimates"))
def _(v):
    return staging.population(v.area_years())


@query("w2_game_numbers", with_views("schedule_games", select="SELECT * FROM schedule_games"))
def _(v):
    return games.current_team_games(staging.current_games(v.raw_current(v.games())))


@query("w3_streak_groups", with_views("counted", select="SELECT game_date, game_id, season, team, outcome, game_number, outcome || island AS streak_group FROM counted"))
def _(v):
    rows = games.streak_group(games.with_running_counts(combined_games(v), rows=64))
    return rows.select("game_date", "game_id", "season", "team", "outcome", "game_number", "streak_group")


@query("w4_signed_streaks_w5_w6_w7_running_records", with_views("records", select="SELECT * FROM records"))
def _(v):
    return games.with_records(games.with_running_counts(combined_games(v), rows=64))


@query("w8_day_norms", with_views("normed_weather", select="""SELECT report_date, max_temp_deg_f, min_temp_deg_f,
    CAST(total_precip_inches AS DOUBLE) AS total_precip_inches, avg_max_temp_deg_f, avg_min_temp_deg_f FROM normed_weather"""))
def _(v):
    return city.with_day_norms(v.weather_days())


def city_rows(v: Views) -> DataFrame:
    """Events as days of a city's table: a third of all rows in one city, views as games."""
    played = F.col("event_type") == "view"
    return v.table("events").select(
        F.when(F.col("event_id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("user_id") % 5)).alias("city"),
        F.to_date("ts").alias("entry_date"), F.col("event_id").alias("game_id"),
        F.when(played, F.col("event_id")).alias("team_game_number"), F.when(played, F.col("user_id")).alias("wins"),
    )


_CITY_ROWS = """SELECT CASE WHEN event_id % 3 = 0 THEN 'hot' ELSE 'c' || (user_id % 5) END AS city, CAST(ts AS DATE) AS entry_date, event_id AS game_id,
    CASE WHEN event_type = 'view' THEN event_id END AS team_game_number, CASE WHEN event_type = 'view' THEN user_id END AS wins FROM events"""


@query("w9_carried_forward", f"""WITH d AS (SELECT * EXCLUDE (city) FROM ({_CITY_ROWS}))
    SELECT *, CASE WHEN team_game_number IS NULL THEN max(wins) OVER (ORDER BY entry_date, game_id ROWS 9 PRECEDING) ELSE wins END AS wins_lag FROM d""")
def _(v):
    return city.carried(city_rows(v).drop("city"), ["wins"], block_rows=1024)


@query("w9_carried_forward_in_each_city", f"""WITH d AS ({_CITY_ROWS})
    SELECT *, CASE WHEN team_game_number IS NULL THEN max(wins) OVER (PARTITION BY city ORDER BY entry_date, game_id ROWS 9 PRECEDING) ELSE wins END AS wins_lag FROM d""")
def _(v):
    return city.carried(city_rows(v), ["wins"], block_rows=512, keys=["city"])


@query("w10_last_row_per_day", """SELECT entry_date, game_id, o_totalprice FROM (
    SELECT CAST(o_orderdate AS DATE) AS entry_date, o_orderkey AS game_id, o_totalprice,
    row_number() OVER (PARTITION BY CAST(o_orderdate AS DATE) ORDER BY o_orderkey DESC) AS place FROM orders) WHERE place = 1""")
def _(v):
    rows = v.table("orders").select(F.to_date("o_orderdate").alias("entry_date"), F.col("o_orderkey").alias("game_id"), "o_totalprice")
    return city.one_row_per_day(rows)


# --- order, limit ----------------------------------------------------------------


@query("o1_ordered_days", with_views(_STAT, select="SELECT entry_date, total_incidents, report_date FROM stat_days ORDER BY entry_date"))
def _(v):
    return v.days().select("entry_date", "total_incidents", "report_date").orderBy(F.col("entry_date").asc_nulls_last())


@query("o2_latest_year_first", with_views("best_estimates", select=f"""SELECT population FROM best_estimates WHERE geographic_area ILIKE '{AREA}' ORDER BY "year" DESC LIMIT 1"""))
def _(v):
    estimates = staging.population(v.area_years()).where(F.col("geographic_area").ilike(AREA))
    return estimates.orderBy(F.col("year").desc_nulls_last()).limit(1).select("population")


# --- scalar functions --------------------------------------------------------------


@query("x1_concat_present_x2_concat_strict", """SELECT o_orderkey, concat(o_orderstatus, nullif(o_orderpriority, '5-LOW'), o_custkey) AS present,
    o_orderstatus || ', ' || nullif(o_orderpriority, '5-LOW') AS strict FROM orders""")
def _(v):
    part = F.nullif("o_orderpriority", F.lit("5-LOW"))
    return v.table("orders").select(
        "o_orderkey", C.concat_present(F.col("o_orderstatus"), part, F.col("o_custkey")).alias("present"),
        C.concat_strict(F.col("o_orderstatus"), ", ", part).alias("strict"),
    )


@query("x4_strict_x6_decimal_x7_text", """SELECT o_orderkey, CAST(left(o_orderpriority, 1) AS INT) AS level, CAST(CAST('0' || o_orderkey AS BIGINT) AS VARCHAR) AS back,
    CAST(CAST(floor(o_totalprice / 1000) || '.125' AS DECIMAL(9, 2)) AS DOUBLE) AS price FROM (SELECT * REPLACE (CAST(o_totalprice AS BIGINT) AS o_totalprice) FROM
    (SELECT * REPLACE (floor(o_totalprice) AS o_totalprice) FROM orders))""".replace("floor(o_totalprice / 1000)", "CAST(o_totalprice AS VARCHAR)"))
def _(v):
    whole = F.floor("o_totalprice").cast("string")
    return v.table("orders").select(
        "o_orderkey", F.substring("o_orderpriority", 1, 1).cast("int").alias("level"),
        F.concat(F.lit("0"), F.col("o_orderkey").cast("string")).cast("bigint").cast("string").alias("back"),
        F.concat(whole, F.lit(".125")).cast("decimal(9,2)").cast("double").alias("price"),
    )


@query("x5_tolerant_numbers", """SELECT o_orderkey, TRY_CAST(CASE WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE CAST(o_custkey AS VARCHAR) END AS INT) AS n FROM orders""")
def _(v):
    text = F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).otherwise(F.col("o_custkey").cast("string"))
    return v.table("orders").select("o_orderkey", text.try_cast("int").alias("n"))


@query("x8_date_parts_x12_day_x15_format", """SELECT event_id, year(ts) AS y, month(ts) AS m, day(ts) AS d, CAST(ts AS DATE) AS day, strftime(ts, '%Y-%m-%d') AS label FROM events""")
def _(v):
    ts = F.col("ts")
    parts = aliased(y=F.year(ts), m=F.month(ts), d=F.dayofmonth(ts))
    return v.table("events").select(
        "event_id", *[p.cast("bigint").alias(n) for p, n in zip(parts, ("y", "m", "d"))], F.to_date(ts).alias("day"), F.date_format(ts, "yyyy-MM-dd").alias("label")
    )


@query("x10_iso_instant_x11_shift", """SELECT event_id, date_trunc('milliseconds', ts) AS instant, date_trunc('milliseconds', ts) - INTERVAL 5 HOUR AS est,
    date_trunc('milliseconds', ts) - INTERVAL 4 HOUR AS edt FROM events""")
def _(v):
    instant = C.iso_instant(F.date_format("ts", schemas.ISO_INSTANT))
    rows = v.table("events").select("event_id", instant.alias("instant"))
    return rows.select("event_id", "instant", *aliased(est=C.hours_earlier(F.col("instant"), 5), edt=C.hours_earlier(F.col("instant"), 4)))


@query("x13_fahrenheit_x14_round", """SELECT event_id, round(value * (9.0 / 5) + 32, 2) AS f, round(value / 7, 1) AS one, round(value / 7, 3) AS three FROM events""")
def _(v):
    value = F.col("value")
    return v.table("events").select("event_id", *aliased(f=C.fahrenheit(value), one=C.round_to(value / 7, 1), three=C.round_to(value / 7, 3)))


@query("x16_calendar", """SELECT d.day AS day, strftime(d.day, '%Y-%m-%d') AS label, (SELECT count(*) FROM orders WHERE CAST(o_orderdate AS DATE) = d.day) AS orders
    FROM (SELECT CAST(unnest(generate_series(DATE '1996-01-01', DATE '1996-12-31', INTERVAL 1 DAY)) AS DATE) AS day) d""")
def _(v):
    per_day = v.table("orders").groupBy(F.to_date("o_orderdate").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    days = stats.calendar(v.spark, 1996)
    return days.join(per_day, F.col("day") == F.col("d"), "left").select("day", "label", F.coalesce("n", F.lit(0)).alias("orders"))


# --- quality -----------------------------------------------------------------


@query("q1_duplicate_keys", "SELECT l_orderkey FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def _(v):
    return quality.duplicate_keys(v.table("lineitem"), "l_orderkey")


@query("q2_numeric_non_negative", """SELECT CAST(number_c AS DOUBLE) AS number_c, CAST(number_p AS DOUBLE) AS number_p FROM (
    SELECT TRY_CAST(c AS DECIMAL(18, 3)) AS number_c, TRY_CAST(p AS DECIMAL(18, 3)) AS number_p FROM (
    SELECT CASE WHEN o_orderstatus = 'P' THEN o_orderpriority ELSE CAST(o_custkey - 100 AS VARCHAR) END AS c, CAST(o_orderkey AS VARCHAR) AS p FROM orders))
    WHERE number_c < 0 OR number_c IS NULL OR number_p < 0 OR number_p IS NULL""")
def _(v):
    text = F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")).otherwise((F.col("o_custkey") - 100).cast("string"))
    failing = quality.not_numeric_non_negative(v.table("orders").select(text.alias("c"), F.col("o_orderkey").cast("string").alias("p")), ["c", "p"])
    return failing.select(*[F.col(c).cast("double").alias(c) for c in failing.columns])


@query("q3_snapshot_freshness", f"""SELECT max(CAST(o_orderdate AS DATE)) AS snapshot_date, max(o_orderdate) IS NULL AS is_stale FROM ({STAMPED})
    WHERE o_orderstatus <> 'P' AND o_orderdate BETWEEN DATE '1998-05-01' AND DATE '1998-05-31'""")
def _(v):
    stamped = F.concat(F.col("o_orderpriority"), F.lit("_"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(".csv"))
    names = v.table("orders").select(F.when(F.col("o_orderstatus") == "P", F.lit("unstamped.csv")).otherwise(stamped).alias("path"))
    return snapshots.snapshot_freshness(names, *snapshots.schedule_window(dt.date(1998, 5, 31)))


# --- composites ----------------------------------------------------------------


def staged_views(v: Views) -> DataFrame:
    return staging.observations(v.raw_observations())


@query("gold_weather", with_views("gold_weather", select="SELECT * FROM gold_weather"))
def gold_weather(v: Views) -> DataFrame:
    return weather.daily_weather(staged_views(v), staging.station_days(v.raw_station_days()), complete_above=67)


@query("gold_crime", with_views("gold_crime", select="SELECT * FROM gold_crime"))
def gold_crime(v: Views) -> DataFrame:
    return incidents.daily_rates(v.incidents(), staging.population(v.area_years()), AREA, CATEGORIES)


def combined_games(v: Views) -> DataFrame:
    base = v.stored_games()
    old = games.historical_team_games(staging.historical_games(v.raw_historical(base)), v.raw_teams())
    return games.combine_sources(old, games.current_team_games(staging.current_games(v.raw_current(base))))


@query("gold_games", with_views("gold_games", select="SELECT * FROM gold_games"))
def gold_games(v: Views) -> DataFrame:
    base = v.stored_games()
    return games.games(staging.historical_games(v.raw_historical(base)), staging.current_games(v.raw_current(base)), v.raw_teams())


def full_city_days(v: Views) -> DataFrame:
    day = workday(F.col("dispatch_date"))
    moved = v.incidents().withColumns({"dispatch_date": day, "dispatch_year": F.year(day).cast("bigint")})
    crime = incidents.daily_rates(moved, staging.population(v.area_years()), AREA, CATEGORIES)
    return city.city_days(crime, v.weather_days(), cut(gold_games(v)), TEAM)


_CITY_SELECT = "SELECT * REPLACE (CAST(total_precip_inches AS DOUBLE) AS total_precip_inches) FROM city_days"


@query("city_days", with_views("city_days", select=_CITY_SELECT))
def _(v):
    return full_city_days(v)


CITY_FIELDS = [
    "max_temp_deg_f", "min_temp_deg_f", "daily_max_temp_deviation_from_max", "daily_min_temp_deviation_from_min",
    "total_incidents_per_100k", "violent_crime_per_100k", "assault_per_100k", "homicide_per_100k", "theft_per_100k",
    "team_score", "team_outcome_as_value", "team_current_streak", "team_current_win_pct", "team_last_10_win_pct", "team_last_40_win_pct",
]


@query("city_correlations", corr_sql("city_days", CITY_FIELDS, 6))
def _(v):
    return stats.correlation_matrix(full_city_days(v), CITY_FIELDS, digits=6)


REGISTRY.update({name: (lambda spark, folder, build=build: build(Views(spark, folder)), sql) for name, (build, sql) in RELATIONS.items()})
