"""Game results as team records: two sources, streaks, running and trailing records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daygrain.functions.columns import by_side, concat_present, flag, outcome_label, round_to
from daygrain.operators.asof import same_keys
from daygrain.operators.joins import explode_either
from daygrain.operators.ordered import CHUNK_ROWS, add_carried, number_chunk, sequence_number, trailing_share
from daygrain.session import cut

OUTCOMES = ("win", "loss", "tie")
#: Win shares are given over so many last games.
TRAILING = (10, 40)
PLAYED_ORDER = ("game_number", "game_date", "game_id")


def played_order() -> list[Column]:
    """Order inside a season: the team's game number, ties by day and id."""
    return [F.col(c).asc_nulls_last() for c in PLAYED_ORDER]


def historical_team_games(games: DataFrame, teams: DataFrame) -> DataFrame:
    """Each historical game once per participating team that the team table knows."""
    sides = explode_either(games, F.col("home_team"), F.col("away_team"), "side_team", "is_home_key")
    known = teams.select(F.col("team").alias("code"), concat_present(F.col("city"), F.lit(" "), F.col("nickname")).alias("team"))
    at_home = F.col("code") == F.col("home_team")
    won = (at_home & F.col("home_team_is_winner")) | ((F.col("code") == F.col("away_team")) & ~F.col("home_team_is_winner"))
    return sides.join(known, F.col("side_team") == F.col("code")).select(
        "game_date",
        "season",
        F.col("historical_game_id").alias("game_id"),
        "team",
        outcome_label(F.col("is_tie"), F.col("away_team_score"), F.col("home_team_score"), won).alias("outcome"),
        by_side(at_home, F.col("home_team_game_number"), F.col("away_team_game_number")).alias("game_number"),
        by_side(at_home, F.col("home_team_score"), F.col("away_team_score")).alias("score"),
        flag(at_home).alias("home_team"),
        "night_game",
        "time_of_game_minutes",
    )


def current_sides(games: DataFrame) -> DataFrame:
    """Each current game from both sides, distinct. One pass instead of two scans and a union."""

    def side(name: str, home: bool) -> Column:
        # An unknown winner counts against the home side and for the away side.
        won = F.coalesce(F.col("home_team_is_winner"), F.lit(False))
        return F.struct(
            F.col(f"{name}_team_name").alias("team"),
            F.col(f"{name}_team_score").alias("score"),
            F.lit(home).alias("home_team"),
            F.col(f"{name}_team_record_wins").alias("current_record_wins"),
            F.col(f"{name}_team_record_losses").alias("current_record_losses"),
            outcome_label(
                F.col("is_tie"), F.col("away_team_score"), F.col("home_team_score"), won if home else ~won
            ).alias("outcome"),
        )

    both = F.inline(F.array(side("away", False), side("home", True)))
    sides = games.select("game_date", "game_id", "season", both, "series_game_number", "night_game")
    # Equal rows share these three, so one exchange serves the distinct and the numbering after it.
    return sides.repartition("team", "season", "game_date").distinct()


def current_team_games(games: DataFrame) -> DataFrame:
    """Current games by team, numbered per season in playing order."""
    order = [F.col(c).asc_nulls_last() for c in ("game_date", "series_game_number", "game_id")]
    return sequence_number(current_sides(games), ["team", "season"], "game_date", order, "game_number")


def combine_sources(historical: DataFrame, current: DataFrame) -> DataFrame:
    """Both sources on day, team and game number; the current one wins where both know a figure."""
    shared = ("game_date", "season", "team", "score", "home_team", "outcome", "game_number", "night_game")
    old = historical.withColumnsRenamed({c: f"h_{c}" for c in (*shared, "game_id")})
    new = current.withColumn("game_id", F.col("game_id").cast("string")).withColumnsRenamed({c: f"c_{c}" for c in (*shared, "game_id")})
    same = (
        (F.col("c_game_date") == F.col("h_game_date"))
        & (F.col("c_team") == F.col("h_team"))
        & (F.col("c_game_number") == F.col("h_game_number"))
    )
    either = lambda c: F.coalesce(f"c_{c}", f"h_{c}").alias(c)
    return old.join(new, same, "full").select(
        *[either(c) for c in ("game_date", "game_id", "season", "team", "score", "home_team", "outcome", "game_number")],
        "current_record_wins",
        "current_record_losses",
        either("night_game"),
        "time_of_game_minutes",
    )


def with_running_counts(team_games: DataFrame, rows: int = CHUNK_ROWS, trailing_games: Sequence[int] = TRAILING) -> DataFrame:
    """Add the position in the season and the running number of each outcome.

    One exchange by (season, team, chunk) and one stored table serve every count, streak and look back:
    all are counted inside the chunk first. Columns that begin with ``__`` keep these for ``with_records``.
    What earlier chunks add is one small row each; usually a season fits one chunk and there is none.
    """
    keys = ["season", "team", "__chunk"]
    chunked = team_games.withColumn("__chunk", number_chunk(F.col("game_number"), F.col("game_date"), rows))
    counts = {"position": F.lit(True), "unlabelled": F.col("outcome").isNull()}
    counts |= {f"run_{o}": F.col("outcome") == o for o in OUTCOMES}
    here = Window.partitionBy(*keys).orderBy(*played_order())
    so_far = here.rowsBetween(Window.unboundedPreceding, 0)
    counted = chunked.withColumns({f"__{name}": F.count_if(test).over(so_far) for name, test in counts.items()})
    counted = counted.withColumns(
        {**{f"__wins_{n}_ago": F.lag("__run_win", n).over(here) for n in trailing_games}, "__size": F.count("*").over(Window.partitionBy(*keys))}
    )
    # Inside a chunk an island differs from others by its distance there, as all of an outcome's ranks lack the same number.
    island = Window.partitionBy(*keys, "__island").orderBy("__position").rowsBetween(Window.unboundedPreceding, 0)
    counted = counted.withColumn("__island", island_label(distance("__run_", "__unlabelled")))
    stored = cut(counted.withColumn("__streak", F.count("game_number").over(island)).drop("__island"))
    return add_carried(stored, keys[:2], "__chunk", {f"__{name}": name for name in counts}, keep=True)


def distance(prefix: str, unlabelled: str) -> Column:
    """How far the game number is from the rank of its outcome."""
    rank = F.col(unlabelled)
    for outcome in OUTCOMES:
        rank = F.when(F.col("outcome") == outcome, F.col(f"{prefix}{outcome}")).otherwise(rank)
    return F.col("game_number") - rank


def island_label(far: Column) -> Column:
    return F.concat("outcome", far.cast("string"))


def streak_group(counted: DataFrame) -> DataFrame:
    """Label islands of equal outcomes: the outcome and its distance to the game number."""
    return counted.withColumn("distance", distance("run_", "unlabelled")).withColumn("streak_group", island_label(F.col("distance")))


def over_chunk_ends(grouped: DataFrame, trailing_games: Sequence[int]) -> DataFrame:
    """Complete streaks and wins so many games ago where a season has several chunks.

    Few rows matter: those of seasons of several chunks that stand near a chunk's end, and a count for each
    of their islands and chunks.
    """
    keys = ["season", "team"]
    several = grouped.where("position <> __position").select(*[F.col(k).alias(f"__of_{k}") for k in keys]).distinct()
    among = grouped.join(several, same_keys(keys, several.columns), "left_semi")

    # Rows within reach of a chunk's end follow each other without a gap, from before the end to behind it.
    reach = max(trailing_games)
    ends = among.where((F.col("__position") <= reach) | (F.col("__position") > F.col("__size") - reach))
    played = Window.partitionBy(*keys).orderBy("position")
    back = {f"__back_{n}": F.lag("run_win", n).over(played) for n in trailing_games}
    behind = ends.withColumns(back).where((F.col("__position") <= reach) & (F.col("position") > F.col("__position")))
    behind = cut(behind.select(*[F.col(k).alias(f"__of_{k}") for k in (*keys, "position")], *back))

    parts = among.groupBy(*keys, "streak_group", "__chunk").agg(F.max("__streak").alias("__part"))
    earlier = Window.partitionBy(*keys, "streak_group").orderBy(F.col("__chunk").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    before = parts.withColumn("__more", F.sum("__part").over(earlier)).where("__more > 0")
    before = cut(before.select(*[F.col(k).alias(f"__in_{k}") for k in (*keys, "streak_group", "__chunk")], "__more"))

    joined = grouped.join(behind, same_keys([*keys, "position"], behind.columns), "left")
    joined = joined.join(before, same_keys([*keys, "streak_group", "__chunk"], before.columns), "left")
    wins = F.col("run_win") - F.col("__run_win")
    return joined.withColumns(
        {
            "__streak": F.col("__streak") + F.coalesce("__more", F.lit(0)),
            **{f"__wins_{n}_ago": F.coalesce(F.col(f"__wins_{n}_ago") + wins, F.col(f"__back_{n}")) for n in trailing_games},
        }
    )


def with_records(counted: DataFrame, trailing_games: Sequence[int] = TRAILING) -> DataFrame:
    """Signed streak, wins, losses and win shares (so far and over the last games), from ``with_running_counts``."""
    streaks = streak_group(counted)
    if not counted.where("position <> __position").isEmpty():
        streaks = over_chunk_ends(streaks, trailing_games)
    recent = lambda n: trailing_share(F.col("run_win"), F.col(f"__wins_{n}_ago"), F.col("position"), n)
    present = F.col("team").isNotNull()
    return streaks.select(
        "game_date",
        "game_id",
        "season",
        "team",
        "score",
        "home_team",
        "outcome",
        F.when(F.col("outcome") == "win", F.col("__streak")).otherwise(-F.col("__streak")).alias("current_streak"),
        "game_number",
        F.coalesce("current_record_wins", F.when(present, F.col("run_win")).otherwise(F.lit(0))).alias("current_record_wins"),
        F.coalesce("current_record_losses", F.when(present, F.col("run_loss")).otherwise(F.lit(0))).alias("current_record_losses"),
        round_to(F.col("run_win") / F.col("position"), 3).alias("current_win_pct"),
        *[round_to(recent(n), 3).alias(f"last_{n}_win_pct") for n in trailing_games],
        "night_game",
        "time_of_game_minutes",
    )


SIDE_COLUMNS = (
    "score",
    "outcome",
    "current_streak",
    "game_number",
    "current_record_wins",
    "current_record_losses",
    "current_win_pct",
)


def pair_sides(records: DataFrame, trailing_games: Sequence[int] = TRAILING) -> DataFrame:
    """Home and away record of each game in one row."""
    figures = [*SIDE_COLUMNS, *[f"last_{n}_win_pct" for n in trailing_games]]

    def side(name: str) -> dict[str, str]:
        return {"team": f"{name}_team", **{c: f"{name}_team_{c}" for c in figures}}

    home = records.where(F.col("home_team")).select(
        "game_date", "game_id", "season", *[F.col(c).alias(a) for c, a in side("home").items()], "night_game", "time_of_game_minutes"
    )
    away = records.where(~F.col("home_team")).select(
        F.col("game_date").alias("__date"), F.col("game_id").alias("__id"), *[F.col(c).alias(a) for c, a in side("away").items()]
    )
    joined = home.join(away, (F.col("game_date") == F.col("__date")) & (F.col("game_id") == F.col("__id")))
    return joined.select(
        "game_date", "game_id", "season", *side("home").values(), *side("away").values(), "night_game", "time_of_game_minutes"
    )


def games(historical: DataFrame, current: DataFrame, teams: DataFrame, rows: int = CHUNK_ROWS) -> DataFrame:
    """The game table: staged historical and current games to one row per game."""
    combined = combine_sources(historical_team_games(historical, teams), current_team_games(current))
    return pair_sides(with_records(with_running_counts(combined, rows)))
