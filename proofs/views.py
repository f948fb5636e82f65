"""Views that give the tables the shape the operators work on, in Spark and in SQL.

``SQL`` holds one body per view; ``with_views`` strings together what a query needs.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from daygrain.functions.columns import round_to
from daygrain.operators.ordered import sequence_number
from daygrain.session import cut

CATEGORIES = {
    "violent_crime": ["%URGENT%", "%high%"],
    "homicide": ["%urgent%"],
    "assault": ["%HIGH%"],
    "rape": ["%rape%"],
    "robbery": ["%robber%"],
    "theft": ["%medium%"],
    "burglary": ["%low%"],
    "arson": ["%-%"],
}
AREA = "nation_7, ASIA"
TEAM = "NATION_7 ASIA"

SQL: dict[str, str] = {}


def with_views(*names: str, select: str) -> str:
    """A WITH chain of the named views and all they refer to, then the select."""
    wanted: list[str] = []

    def visit(name: str) -> None:
        if name in wanted:
            return
        for other in SQL:
            if other != name and re.search(rf"\b{other}\b", SQL[name]):
                visit(other)
        wanted.append(name)

    for name in names:
        visit(name)
    chain = ",\n".join(f"{n} AS ({SQL[n]})" for n in wanted)
    return f"WITH {chain}\n{select}"


_SCHEMAS: dict[str, StructType] = {}


def workday(day: Column) -> Column:
    """Saturdays and Sundays as the Monday after: days without rows, and no row lost."""
    return F.date_add(day, F.when(F.weekday(day) > 4, 7 - F.weekday(day)).otherwise(0))


def no_day(day: Column, weekday: int) -> Column:
    """One weekday (0 is Monday) as the day after."""
    return F.date_add(day, F.when(F.weekday(day) == weekday, 1).otherwise(0))


class Views:
    """Spark side of the views for one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        """A given table; its schema is looked up once per process."""
        path = f"{self.folder}/{name}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    # --- incidents and population ------------------------------------------

    def incidents(self) -> DataFrame:
        day = F.to_date("o_orderdate")
        return self.table("orders").select(
            F.col("o_orderkey").alias("id"),
            day.alias("dispatch_date"),
            F.year(day).cast("bigint").alias("dispatch_year"),
            F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("incident_type"),
        )

    def area_years(self) -> DataFrame:
        """Two estimates for most areas and years; all orders fold into 1996-1999, so other years have none."""
        places = self.table("nation").join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        places = places.select("n_nationkey", F.concat("n_name", F.lit(", "), "r_name").alias("geographic_area"))
        year = (F.year("o_orderdate") % 4 + 1996).cast("bigint")
        orders = self.table("orders").select("o_custkey", "o_orderstatus", year.alias("year"))
        placed = orders.join(self.table("customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        placed = placed.join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        counts = placed.groupBy("geographic_area", "year").agg(
            (F.count(F.lit(1)) * 1000).alias("every"), (F.count_if(F.col("o_orderstatus") == "F") * 3000).alias("finished")
        )
        both = F.explode(F.array("every", "finished")).alias("population")
        return counts.select("geographic_area", "year", both).where(F.col("population") > 0)

    # --- games --------------------------------------------------------------

    def games(self) -> DataFrame:
        odd = F.col("l_linenumber").isin(1, 3, 5, 7)
        lines = self.table("lineitem").groupBy("l_orderkey").agg(
            F.min("l_suppkey").alias("suppkey"),
            F.sum(F.when(odd, F.col("l_quantity"))).cast("int").alias("home_score"),
            F.sum(F.when(~odd, F.col("l_quantity"))).cast("int").alias("away_score"),
            F.count(F.lit(1)).alias("n_lines"),
        )
        places = self.table("nation").join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        home = places.select(F.col("n_nationkey").alias("home_key"), F.concat("n_name", F.lit(" "), "r_name").alias("home_name"))
        away = places.select(F.col("n_nationkey").alias("away_key"), F.concat("n_name", F.lit(" "), "r_name").alias("away_name"))
        customers = self.table("customer").select("c_custkey", F.col("c_nationkey").alias("home_key"))
        suppliers = self.table("supplier").select("s_suppkey", F.col("s_nationkey").alias("away_key"))
        joined = (
            self.table("orders")
            .join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
            .join(customers, F.col("o_custkey") == F.col("c_custkey"))
            .join(suppliers, F.col("suppkey") == F.col("s_suppkey"))
            .where(F.col("home_key") != F.col("away_key"))
            .join(home, "home_key")
            .join(away, "away_key")
        )
        return joined.select(
            F.col("o_orderkey").alias("game_id"),
            F.to_date("o_orderdate").alias("game_date"),
            F.year("o_orderdate").alias("season"),
            "home_key",
            "away_key",
            "home_name",
            "away_name",
            "home_score",
            "away_score",
            F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("night"),
            F.col("o_orderstatus").alias("state"),
            "n_lines",
        )

    def raw_current(self, games: DataFrame) -> DataFrame:
        official = F.col("n_lines") >= 4
        wins = F.when(official, (F.col("n_lines") * 3).cast("int"))
        losses = F.when(official, F.col("n_lines").cast("int"))
        return games.where(F.col("season") >= 1999).select(
            F.col("game_date").alias("date"),
            F.col("game_id").alias("game_pk"),
            F.col("season").cast("string").alias("season"),
            F.col("state").alias("coded_game_state"),
            F.when(F.col("night"), F.lit("night")).otherwise(F.lit("day")).alias("day_night"),
            F.col("away_name").alias("away_team_name"),
            F.col("away_score").alias("away_team_score"),
            wins.alias("away_team_record_wins"),
            losses.alias("away_team_record_losses"),
            F.col("home_name").alias("home_team_name"),
            F.col("home_score").alias("home_team_score"),
            wins.alias("home_team_record_wins"),
            losses.alias("home_team_record_losses"),
            (F.col("home_score") > F.col("away_score")).alias("home_team_is_winner"),
            ((F.col("home_score") == F.col("away_score")) & F.col("night")).alias("is_tie"),
            F.col("n_lines").cast("int").alias("series_game_number"),
        )

    def raw_historical(self, games: DataFrame) -> DataFrame:
        old = games.where(F.col("season") <= 1999)
        sides = old.select("game_id", "game_date", "season", F.inline(F.array(
            F.struct(F.col("home_key").alias("side"), F.lit(True).alias("at_home")),
            F.struct(F.col("away_key").alias("side"), F.lit(False).alias("at_home")),
        )))
        numbered = sequence_number(sides, ["side", "season"], "game_date", [F.col("game_date"), F.col("game_id")], "num")
        both = numbered.groupBy("game_id").agg(
            F.max(F.when(F.col("at_home"), F.col("num"))).alias("home_num"),
            F.max(F.when(~F.col("at_home"), F.col("num"))).alias("away_num"),
        )
        team = lambda c: F.concat(F.lit("T"), F.col(c).cast("string"))
        return old.join(both, "game_id").select(
            "game_date",
            team("away_key").alias("visiting_team"),
            F.col("away_num").cast("string").alias("visiting_team_game_number"),
            team("home_key").alias("home_team"),
            F.col("home_num").cast("string").alias("home_team_game_number"),
            F.col("away_score").cast("string").alias("visiting_team_score"),
            F.col("home_score").cast("string").alias("home_team_score"),
            F.when(F.col("night"), F.lit("N")).otherwise(F.lit("D")).alias("day_night"),
            F.concat(F.lit("P"), F.col("home_key").cast("string")).alias("park_id"),
            (F.col("n_lines") + 100).cast("string").alias("time_of_game_minutes"),
        )

    def raw_teams(self) -> DataFrame:
        places = self.table("nation").join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        return places.select(
            F.concat(F.lit("T"), F.col("n_nationkey").cast("string")).alias("team"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("nickname"),
        )

    def stored_games(self) -> DataFrame:
        return cut(self.games())

    # --- weather ------------------------------------------------------------

    def raw_observations(self) -> DataFrame:
        """Every event as an observation; the station is the event type."""
        value = F.col("value")
        return self.table("events").select(
            "event_id",
            F.col("event_type").alias("station"),
            F.col("ts").alias("reportTime"),
            (F.floor(value / 10) * 5).cast("double").alias("temp"),
            F.when(value > 50, F.floor(value / 50) / 8).cast("double").alias("pcp6hr"),
            F.when(value > 100, F.floor(value / 50) / 4).cast("double").alias("pcp24hr"),
        )

    def raw_station_days(self) -> DataFrame:
        """Daily figures as text, five days on; weekends count to Monday, some figures are unknown."""
        day = workday(F.to_date("ts"))
        weekday = F.weekday("day") + 1
        text = lambda c: F.concat(F.floor(c).cast("string"), F.lit(".125"))
        days = self.table("events").withColumn("day", day).groupBy("day").agg(
            F.max("value").alias("hi"), F.min("value").alias("lo"), F.count(F.lit(1)).alias("n")
        )
        return days.select(
            F.date_add("day", 5).alias("date"),
            F.when(weekday != 1, text(F.col("hi") / 2)).alias("tavg (degrees fahrenheit)"),
            F.when(weekday != 2, text(F.col("hi"))).alias("tmax (degrees fahrenheit)"),
            F.when(weekday != 3, text(F.col("lo"))).alias("tmin (degrees fahrenheit)"),
            F.when(weekday != 4, text(F.col("lo") / 8)).alias("prcp (inches)"),
        )

    def weather_days(self) -> DataFrame:
        """Several years of daily weather; Sunday's lines count to Monday, so Sundays have none."""
        price, quantity = F.floor(F.avg("l_extendedprice") / 1000), F.floor(F.avg("l_quantity"))
        return (
            self.table("lineitem")
            .groupBy(no_day(F.to_date("l_shipdate"), 6).alias("report_date"))
            .agg(
                (price + quantity).cast("double").alias("max_temp_deg_f"),
                (price - quantity).cast("double").alias("min_temp_deg_f"),
                F.greatest(F.lit(0), quantity - 24).cast("double").alias("total_precip_inches"),
            )
        )

    # --- day table for the statistics ----------------------------------------

    def days(self) -> DataFrame:
        """Days with incidents, a record and an outcome beside the weather of the day."""
        of = lambda p: F.count_if(F.col("o_orderpriority") == p)
        orders = self.table("orders").groupBy(no_day(F.to_date("o_orderdate"), 5).alias("d")).agg(
            F.count(F.lit(1)).alias("total_incidents"),
            of("1-URGENT").alias("urgent"), of("2-HIGH").alias("high"), of("3-MEDIUM").alias("medium"), of("5-LOW").alias("low"),
            F.count_if(F.col("o_orderstatus") == "F").alias("finished"), F.count_if(F.col("o_orderstatus") == "O").alias("open"),
        )
        weather = self.weather_days()
        norms = weather.groupBy(F.month("report_date").alias("m"), F.dayofmonth("report_date").alias("dom")).agg(
            round_to(F.avg("max_temp_deg_f"), 2).alias("avg_max_temp_deg_f"), round_to(F.avg("min_temp_deg_f"), 2).alias("avg_min_temp_deg_f")
        )
        normed = weather.join(norms, (F.month("report_date") == F.col("m")) & (F.dayofmonth("report_date") == F.col("dom"))).drop("m", "dom")
        both = orders.join(normed, F.col("d") == F.col("report_date"), "full")
        margin = F.col("urgent") - F.col("low")
        return both.select(
            F.coalesce("d", "report_date").alias("entry_date"),
            "report_date", "max_temp_deg_f", "min_temp_deg_f", "avg_max_temp_deg_f", "avg_min_temp_deg_f", "total_precip_inches",
            F.col("total_incidents"),
            (F.col("total_incidents") / 4).alias("total_incidents_per_100k"),
            (F.col("urgent") / 4).alias("violent_crime_per_100k"),
            (F.col("high") / 4).alias("assault_per_100k"),
            F.when(margin > 0, F.lit("win")).when(margin < 0, F.lit("loss")).alias("team_outcome"),
            F.when(margin > 0, F.lit(1)).when(margin < 0, F.lit(0)).alias("team_outcome_as_value"),
            (margin * 2).alias("team_current_streak"),
            F.col("finished").alias("team_current_record_wins_lag"),
            F.col("open").alias("team_current_record_losses_lag"),
            (F.col("high") > F.col("medium")).alias("home_game"),
            F.col("urgent").alias("team_score"),
        )


SQL["incidents"] = """
SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS dispatch_date, year(o_orderdate) AS dispatch_year,
       nullif(o_orderpriority, '4-NOT SPECIFIED') AS incident_type
FROM orders"""

SQL["area_counts"] = """
SELECT n_name || ', ' || r_name AS geographic_area, year(o_orderdate) % 4 + 1996 AS "year",
       count(*) AS n_all, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_finished
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2"""

SQL["area_years"] = """
SELECT geographic_area, "year", n_all * 1000 AS population FROM area_counts
UNION ALL SELECT geographic_area, "year", n_finished * 3000 FROM area_counts WHERE n_finished > 0"""

SQL["best_estimates"] = """
SELECT geographic_area, "year", population FROM (
  SELECT *, row_number() OVER (PARTITION BY geographic_area, "year" ORDER BY population DESC) AS place FROM area_years)
WHERE place = 1"""

SQL["order_lines"] = """
SELECT l_orderkey, min(l_suppkey) AS suppkey,
       CAST(sum(CASE WHEN l_linenumber IN (1, 3, 5, 7) THEN l_quantity END) AS INT) AS home_score,
       CAST(sum(CASE WHEN l_linenumber NOT IN (1, 3, 5, 7) THEN l_quantity END) AS INT) AS away_score,
       count(*) AS n_lines
FROM lineitem GROUP BY l_orderkey"""

SQL["games"] = """
SELECT o_orderkey AS game_id, CAST(o_orderdate AS DATE) AS game_date, CAST(year(o_orderdate) AS INT) AS season,
       hn.n_nationkey AS home_key, an.n_nationkey AS away_key,
       hn.n_name || ' ' || hr.r_name AS home_name, an.n_name || ' ' || ar.r_name AS away_name,
       home_score, away_score, o_orderpriority IN ('1-URGENT', '2-HIGH') AS night, o_orderstatus AS state, n_lines
FROM orders JOIN order_lines ON o_orderkey = l_orderkey
JOIN customer ON o_custkey = c_custkey JOIN nation hn ON c_nationkey = hn.n_nationkey JOIN region hr ON hn.n_regionkey = hr.r_regionkey
JOIN supplier ON suppkey = s_suppkey JOIN nation an ON s_nationkey = an.n_nationkey JOIN region ar ON an.n_regionkey = ar.r_regionkey
WHERE hn.n_nationkey <> an.n_nationkey"""

SQL["raw_current"] = """
SELECT game_date AS "date", game_id AS game_pk, CAST(season AS VARCHAR) AS season, state AS coded_game_state,
       CASE WHEN night THEN 'night' ELSE 'day' END AS day_night,
       away_name AS away_team_name, away_score AS away_team_score,
       CASE WHEN n_lines >= 4 THEN CAST(n_lines * 3 AS INT) END AS away_team_record_wins,
       CASE WHEN n_lines >= 4 THEN CAST(n_lines AS INT) END AS away_team_record_losses,
       home_name AS home_team_name, home_score AS home_team_score,
       CASE WHEN n_lines >= 4 THEN CAST(n_lines * 3 AS INT) END AS home_team_record_wins,
       CASE WHEN n_lines >= 4 THEN CAST(n_lines AS INT) END AS home_team_record_losses,
       home_score > away_score AS home_team_is_winner, home_score = away_score AND night AS is_tie,
       CAST(n_lines AS INT) AS series_game_number
FROM games WHERE season >= 1999"""

SQL["game_numbers"] = """
SELECT *, row_number() OVER (PARTITION BY side, season ORDER BY game_date, game_id) AS num FROM (
  SELECT game_id, game_date, season, home_key AS side FROM games UNION ALL
  SELECT game_id, game_date, season, away_key FROM games)"""

SQL["raw_historical"] = """
SELECT g.game_date, 'T' || away_key AS visiting_team, CAST(a.num AS VARCHAR) AS visiting_team_game_number,
       'T' || home_key AS home_team, CAST(h.num AS VARCHAR) AS home_team_game_number,
       CAST(away_score AS VARCHAR) AS visiting_team_score, CAST(home_score AS VARCHAR) AS home_team_score,
       CASE WHEN night THEN 'N' ELSE 'D' END AS day_night, 'P' || home_key AS park_id,
       CAST(n_lines + 100 AS VARCHAR) AS time_of_game_minutes
FROM games g JOIN game_numbers h ON h.game_id = g.game_id AND h.side = home_key
JOIN game_numbers a ON a.game_id = g.game_id AND a.side = away_key
WHERE g.season <= 1999"""

SQL["raw_teams"] = """
SELECT 'T' || n_nationkey AS team, n_name AS city, r_name AS nickname FROM nation JOIN region ON n_regionkey = r_regionkey"""

SQL["stg_current"] = """
SELECT "date" AS game_date, game_pk AS game_id, TRY_CAST(season AS INT) AS season,
       away_team_name, away_team_score, away_team_record_wins, away_team_record_losses,
       home_team_name, home_team_score, home_team_record_wins, home_team_record_losses,
       home_team_is_winner, coalesce(day_night = 'night', false) AS night_game, is_tie, series_game_number
FROM raw_current WHERE coded_game_state = 'F'"""

SQL["stg_historical"] = """
SELECT game_date, year(game_date) AS season,
       concat(year(game_date), home_team, home_team_game_number, visiting_team, visiting_team_game_number) AS historical_game_id,
       visiting_team AS away_team, CAST(visiting_team_game_number AS INT) AS away_team_game_number,
       home_team, CAST(home_team_game_number AS INT) AS home_team_game_number,
       CAST(visiting_team_score AS INT) AS away_team_score, CAST(home_team_score AS INT) AS home_team_score,
       coalesce(CAST(home_team_score AS INT) > CAST(visiting_team_score AS INT), false) AS home_team_is_winner,
       coalesce(CAST(home_team_score AS INT) = CAST(visiting_team_score AS INT), false) AS is_tie,
       coalesce(day_night = 'N', false) AS night_game, park_id, CAST(time_of_game_minutes AS INT) AS time_of_game_minutes
FROM raw_historical"""

# Who won, seen from one side of a game: ``at_home`` is that side, and an unknown winner is the visitor.
_RESULT = """CASE WHEN is_tie THEN 'tie' WHEN own = other AND is_tie = false THEN NULL
            WHEN (home_team_is_winner IS TRUE) = at_home THEN 'win' ELSE 'loss' END"""

SQL["log_sides"] = """
SELECT h.*, unnest([
         {'code': home_team, 'at_home': true, 'own': home_team_score, 'other': away_team_score, 'nth': home_team_game_number},
         {'code': away_team, 'at_home': false, 'own': away_team_score, 'other': home_team_score, 'nth': away_team_game_number}], recursive := true)
FROM stg_historical h"""

SQL["log_games"] = f"""
SELECT game_date, season, historical_game_id AS game_id, concat(city, ' ', nickname) AS team, {_RESULT} AS outcome,
       nth AS game_number, own AS score, at_home AS home_team, night_game, time_of_game_minutes
FROM log_sides JOIN raw_teams ON code = raw_teams.team"""

SQL["schedule_sides"] = """
SELECT c.*, unnest([
         {'club': home_team_name, 'at_home': true, 'own': home_team_score, 'other': away_team_score, 'won': home_team_record_wins, 'lost': home_team_record_losses},
         {'club': away_team_name, 'at_home': false, 'own': away_team_score, 'other': home_team_score, 'won': away_team_record_wins, 'lost': away_team_record_losses}], recursive := true)
FROM stg_current c"""

SQL["schedule_games"] = f"""
SELECT *, row_number() OVER (PARTITION BY team, season ORDER BY game_date, series_game_number, game_id) AS game_number FROM (
  SELECT DISTINCT game_date, game_id, season, club AS team, own AS score, at_home AS home_team, won AS current_record_wins, lost AS current_record_losses,
         {_RESULT} AS outcome, series_game_number, night_game
  FROM schedule_sides)"""

SQL["team_games"] = """
SELECT coalesce(c.game_date, h.game_date) AS game_date, coalesce(CAST(c.game_id AS VARCHAR), h.game_id) AS game_id,
       CAST(coalesce(c.season, h.season) AS BIGINT) AS season, coalesce(c.team, h.team) AS team, coalesce(c.score, h.score) AS score,
       coalesce(c.home_team, h.home_team) AS home_team, coalesce(c.outcome, h.outcome) AS outcome,
       CAST(coalesce(c.game_number, h.game_number) AS BIGINT) AS game_number, c.current_record_wins, c.current_record_losses,
       coalesce(c.night_game, h.night_game) AS night_game, h.time_of_game_minutes
FROM log_games h FULL JOIN schedule_games c
ON c.game_date = h.game_date AND c.team = h.team AND c.game_number = h.game_number"""

SQL["counted"] = """
SELECT *, CAST(outcome IS NOT DISTINCT FROM 'win' AS INT) AS win, CAST(outcome IS NOT DISTINCT FROM 'loss' AS INT) AS loss,
       game_number - row_number() OVER (PARTITION BY season, team, outcome ORDER BY game_number, game_date, game_id) AS island
FROM team_games"""

SQL["records"] = """
SELECT game_date, game_id, season, team, score, home_team, outcome,
       (2 * win - 1) * count(game_number) OVER (run ROWS UNBOUNDED PRECEDING) AS current_streak, game_number,
       coalesce(current_record_wins, CAST(sum(win) OVER (past ROWS UNBOUNDED PRECEDING) AS BIGINT)) AS current_record_wins,
       coalesce(current_record_losses, CAST(sum(loss) OVER (past ROWS UNBOUNDED PRECEDING) AS BIGINT)) AS current_record_losses,
       round(avg(win) OVER (past ROWS UNBOUNDED PRECEDING), 3) AS current_win_pct,
       round(avg(win) OVER (past ROWS 9 PRECEDING), 3) AS last_10_win_pct, round(avg(win) OVER (past ROWS 39 PRECEDING), 3) AS last_40_win_pct,
       night_game, time_of_game_minutes
FROM counted
WINDOW past AS (PARTITION BY season, team ORDER BY game_number, game_date, game_id),
       run AS (PARTITION BY season, team, outcome || island ORDER BY game_number, game_date, game_id)"""

_FIGURES = ("team", "score", "outcome", "current_streak", "game_number", "current_record_wins", "current_record_losses",
            "current_win_pct", "last_10_win_pct", "last_40_win_pct")
_named = {"team": "", **{f: "_" + f for f in _FIGURES[1:]}}
SQL["gold_games"] = "SELECT h.game_date, h.game_id, h.season, " + ", ".join(
    f"{s}.{f} AS {n}_team{_named[f]}" for s, n in (("h", "home"), ("a", "away")) for f in _FIGURES
) + """, h.night_game, h.time_of_game_minutes
FROM records h JOIN records a ON h.game_date = a.game_date AND h.game_id = a.game_id
WHERE h.home_team AND NOT a.home_team"""

SQL["raw_observations"] = """
SELECT event_id, event_type AS station, ts AS report_time, CAST(floor(value / 10) * 5 AS DOUBLE) AS temp,
       CASE WHEN value > 50 THEN floor(value / 50) / 8 END AS pcp6hr, CASE WHEN value > 100 THEN floor(value / 50) / 4 END AS pcp24hr
FROM events"""

SQL["stg_observations"] = """
SELECT station, report_time AS report_time_utc, report_time - INTERVAL 4 HOUR AS report_time_edt, report_time - INTERVAL 5 HOUR AS report_time_est,
       temp AS temp_deg_c, round(temp * (9.0 / 5) + 32, 2) AS temp_deg_f, pcp6hr AS precip_last_6hrs_inches, pcp24hr AS precip_last_24hrs_inches
FROM raw_observations"""

SQL["station_days"] = """
SELECT CAST(day + 5 AS DATE) AS report_date,
       CASE WHEN isodow(day) <> 1 THEN CAST(floor(hi / 2) AS BIGINT) || '.125' END AS avg_temp_deg_f,
       CASE WHEN isodow(day) <> 2 THEN CAST(floor(hi) AS BIGINT) || '.125' END AS max_temp_deg_f,
       CASE WHEN isodow(day) <> 3 THEN CAST(floor(lo) AS BIGINT) || '.125' END AS min_temp_deg_f,
       CASE WHEN isodow(day) <> 4 THEN CAST(floor(lo / 8) AS BIGINT) || '.125' END AS total_precip_inches
FROM (SELECT CAST(CAST(ts AS DATE) + CASE isodow(ts) WHEN 6 THEN 2 WHEN 7 THEN 1 ELSE 0 END AS DATE) AS day, max(value) AS hi, min(value) AS lo FROM events GROUP BY 1)"""

SQL["observed_days"] = """
SELECT CAST(report_time_est AS DATE) AS report_date, max(temp_deg_f) AS max_temp_deg_f, round(avg(temp_deg_f), 2) AS avg_temp_deg_f,
       min(temp_deg_f) AS min_temp_deg_f, coalesce(round(sum(precip_last_6hrs_inches), 3), 0) AS total_precip_inches,
       count(report_time_est) AS daily_count
FROM stg_observations GROUP BY 1"""

SQL["official_days"] = """
SELECT report_date, CAST(avg_temp_deg_f AS DECIMAL(5, 2)) AS avg_temp_deg_f, CAST(max_temp_deg_f AS DECIMAL(5, 2)) AS max_temp_deg_f,
       CAST(min_temp_deg_f AS DECIMAL(5, 2)) AS min_temp_deg_f, CAST(total_precip_inches AS DECIMAL(5, 3)) AS total_precip_inches
FROM station_days"""

SQL["gold_weather"] = "SELECT coalesce(o.report_date, s.report_date) AS report_date, " + ", ".join(
    f"""CASE WHEN daily_count > 67 THEN coalesce(o.{c}, CAST(s.{c} AS DOUBLE)) ELSE coalesce(CAST(s.{c} AS DOUBLE), o.{c}) END AS {c},
    CASE WHEN daily_count > 67 AND o.{c} IS NOT NULL THEN 'METAR' WHEN s.{c} IS NOT NULL THEN 'NCEI'
         WHEN o.{c} IS NOT NULL THEN 'METAR - INCOMPLETE' ELSE 'NA' END AS {c}_source"""
    for c in ("avg_temp_deg_f", "max_temp_deg_f", "min_temp_deg_f", "total_precip_inches")
) + " FROM observed_days o FULL JOIN official_days s ON o.report_date = s.report_date"

SQL["weather_days"] = """
SELECT CAST(CAST(l_shipdate AS DATE) + CAST(isodow(l_shipdate) = 7 AS INT) AS DATE) AS report_date,
       floor(avg(l_extendedprice) / 1000) + floor(avg(l_quantity)) AS max_temp_deg_f,
       floor(avg(l_extendedprice) / 1000) - floor(avg(l_quantity)) AS min_temp_deg_f,
       greatest(0, floor(avg(l_quantity)) - 24) AS total_precip_inches
FROM lineitem GROUP BY 1"""

SQL["normed_weather"] = """
SELECT *, round(avg(max_temp_deg_f) OVER (PARTITION BY month(report_date), day(report_date)), 2) AS avg_max_temp_deg_f,
       round(avg(min_temp_deg_f) OVER (PARTITION BY month(report_date), day(report_date)), 2) AS avg_min_temp_deg_f
FROM weather_days"""

_NAMES = ("total_incidents", *CATEGORIES)
SQL["crime_counts"] = "SELECT dispatch_date, dispatch_year, count(incident_type) AS total_incidents, " + ", ".join(
    "sum(CASE WHEN " + " OR ".join(f"incident_type ILIKE '{p}'" for p in ps) + f" THEN 1 ELSE 0 END) AS {c}" for c, ps in CATEGORIES.items()
) + " FROM incidents GROUP BY dispatch_date, dispatch_year"


def crime_sql(source: str) -> str:
    return f"""SELECT dispatch_date, population, {', '.join(
        f"CAST({n} AS BIGINT) AS {n}, round({n} / (population / 100000.0), 3) AS {n}_per_100k" for n in _NAMES)}
FROM (SELECT c.*, coalesce(p.population, d.population) AS population FROM {source} c
  LEFT JOIN (SELECT * FROM best_estimates WHERE geographic_area ILIKE '{AREA}') p ON c.dispatch_year = p."year"
  LEFT JOIN (SELECT population FROM best_estimates WHERE geographic_area ILIKE '{AREA}' ORDER BY "year" DESC LIMIT 1) d ON TRUE)"""


SQL["gold_crime"] = crime_sql("crime_counts")
SQL["weekday_counts"] = f"""SELECT dispatch_date, CAST(year(dispatch_date) AS BIGINT) AS dispatch_year, {', '.join(f'sum({n}) AS {n}' for n in _NAMES)} FROM (
  SELECT * REPLACE (CAST(dispatch_date + CASE isodow(dispatch_date) WHEN 6 THEN 2 WHEN 7 THEN 1 ELSE 0 END AS DATE) AS dispatch_date) FROM crime_counts)
GROUP BY ALL"""
SQL["weekday_crime"] = crime_sql("weekday_counts")

_OWN = _FIGURES[1:]
SQL["team_view"] = f"""
SELECT game_date, game_id, season, CASE WHEN home_team = '{TEAM}' THEN home_team ELSE away_team END AS team,
       home_team = '{TEAM}' AS home_game,
       {', '.join(f"CASE WHEN home_team = '{TEAM}' THEN home_team_{f} ELSE away_team_{f} END AS team_{f}" for f in _OWN)},
       night_game, time_of_game_minutes
FROM gold_games WHERE home_team = '{TEAM}' OR away_team = '{TEAM}'"""

SQL["joined_days"] = """
SELECT coalesce(dispatch_date, report_date, game_date) AS entry_date, *
FROM weekday_crime c FULL JOIN normed_weather w ON c.dispatch_date = w.report_date
FULL JOIN team_view b ON c.dispatch_date = b.game_date OR w.report_date = b.game_date"""

SQL["city_days"] = """
SELECT *, max_temp_deg_f - avg_max_temp_deg_f AS daily_max_temp_deviation_from_max,
       min_temp_deg_f - avg_min_temp_deg_f AS daily_min_temp_deviation_from_min,
       CASE team_outcome WHEN 'win' THEN 1 WHEN 'loss' THEN 0 END AS team_outcome_as_value,
       CASE WHEN team_game_number IS NULL THEN max(team_current_record_wins) OVER ten ELSE team_current_record_wins END AS team_current_record_wins_lag,
       CASE WHEN team_game_number IS NULL THEN max(team_current_record_losses) OVER ten ELSE team_current_record_losses END AS team_current_record_losses_lag
FROM joined_days WINDOW ten AS (ORDER BY entry_date, game_id ROWS 9 PRECEDING)"""

SQL["day_orders"] = """
SELECT CAST(CAST(o_orderdate AS DATE) + CAST(isodow(o_orderdate) = 6 AS INT) AS DATE) AS d, count(*) AS total_incidents,
       count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS urgent, count(*) FILTER (WHERE o_orderpriority = '2-HIGH') AS high,
       count(*) FILTER (WHERE o_orderpriority = '3-MEDIUM') AS medium, count(*) FILTER (WHERE o_orderpriority = '5-LOW') AS low,
       count(*) FILTER (WHERE o_orderstatus = 'F') AS finished, count(*) FILTER (WHERE o_orderstatus = 'O') AS still_open
FROM orders GROUP BY 1"""

SQL["stat_days"] = """
SELECT coalesce(d, report_date) AS entry_date, report_date, max_temp_deg_f, min_temp_deg_f, avg_max_temp_deg_f, avg_min_temp_deg_f,
       total_precip_inches, total_incidents, total_incidents / 4.0 AS total_incidents_per_100k, urgent / 4.0 AS violent_crime_per_100k,
       high / 4.0 AS assault_per_100k, CASE WHEN urgent > low THEN 'win' WHEN urgent < low THEN 'loss' END AS team_outcome,
       CASE WHEN urgent > low THEN 1 WHEN urgent < low THEN 0 END AS team_outcome_as_value,
       (urgent - low) * 2 AS team_current_streak, finished AS team_current_record_wins_lag, still_open AS team_current_record_losses_lag,
       high > medium AS home_game, urgent AS team_score
FROM day_orders FULL JOIN normed_weather ON d = report_date"""
