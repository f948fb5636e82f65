"""Declared schemas of the landed files. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "numeric": T.DecimalType(18, 3),
}


def declared(text: str) -> T.StructType:
    """A flat schema from 'name type, name type, …'. Needs no session, unlike DDL parsing."""
    pairs = [part.split() for part in text.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


def strings(names: list[str]) -> T.StructType:
    """All columns as text."""
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Names and types of the public files and feeds.

ISO_INSTANT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"

OBSERVATION = declared(
    """
    icaoId string, receiptTime string, obsTime bigint, reportTime timestamp_ntz,
    temp double, dewp double, wdir string, wspd bigint, wgst bigint, visib string,
    altim double, slp double, wxString string, presTend double,
    maxT double, minT double, maxT24 double, minT24 double,
    precip double, pcp3hr double, pcp6hr double, pcp24hr double, snow double,
    vertVis bigint, metarType string, rawOb string, lat double, lon double,
    elev bigint, name string, fltCat string
    """
)

STATION_DAY_HEADER = [
    "date",
    "tavg (degrees fahrenheit)",
    "tmax (degrees fahrenheit)",
    "tmin (degrees fahrenheit)",
    "prcp (inches)",
    "snow (inches)",
    "snwd (inches)",
]

INCIDENT = declared(
    """
    cartodb_id bigint, the_geom string, the_geom_webmercator string, objectid bigint,
    dc_dist string, psa string, dispatch_date_time string, dispatch_date string,
    dispatch_time string, hour int, dc_key numeric, location_block string,
    ucr_general string, text_general_code string, point_x double, point_y double
    """
)

TEAM = declared("team string, league string, city string, nickname string, first int, last int")

BALLPARK = declared(
    "parkid string, name string, aka string, city string, state string, start date, end date, league string, notes string"
)

_SIDE = "struct<team:struct<id:int,name:string>,score:int,isWinner:boolean,leagueRecord:struct<wins:int,losses:int,pct:string>>"

SCHEDULED_GAME = (
    "struct<gamePk:bigint,gameGuid:string,link:string,gameType:string,season:string,gameDate:string,officialDate:string,"
    "status:struct<abstractGameState:string,codedGameState:string,detailedState:string,statusCode:string,"
    "startTimeTBD:boolean,abstractGameCode:string>,"
    f"teams:struct<away:{_SIDE},home:{_SIDE}>,"
    "venue:struct<id:int,name:string>,isTie:boolean,gameNumber:int,publicFacing:boolean,doubleHeader:string,"
    "gamedayType:string,tiebreaker:string,calendarEventID:string,seasonDisplay:string,dayNight:string,"
    "description:string,scheduledInnings:int,reverseHomeAwayStatus:boolean,inningBreakLength:int,gamesInSeries:int,"
    "seriesGameNumber:int,seriesDescription:string,recordSource:string,ifNecessary:string,ifNecessaryDescription:string>"
)

SCHEDULE = f"dates array<struct<date:string,games:array<{SCHEDULED_GAME}>>>"

# Output column of the schedule table -> path inside one game.
SCHEDULE_COLUMNS = {
    "game_pk": "gamePk",
    "game_guid": "gameGuid",
    "link": "link",
    "game_type": "gameType",
    "season": "season",
    "game_date": "gameDate",
    "official_date": "officialDate",
    "abstract_game_state": "status.abstractGameState",
    "coded_game_state": "status.codedGameState",
    "detailed_state": "status.detailedState",
    "status_code": "status.statusCode",
    "start_time_tbd": "status.startTimeTBD",
    "abstract_game_code": "status.abstractGameCode",
    "away_team_id": "teams.away.team.id",
    "away_team_name": "teams.away.team.name",
    "away_team_score": "teams.away.score",
    "away_team_is_winner": "teams.away.isWinner",
    "away_team_record_wins": "teams.away.leagueRecord.wins",
    "away_team_record_losses": "teams.away.leagueRecord.losses",
    "away_team_win_pct": "teams.away.leagueRecord.pct",
    "home_team_id": "teams.home.team.id",
    "home_team_name": "teams.home.team.name",
    "home_team_score": "teams.home.score",
    "home_team_is_winner": "teams.home.isWinner",
    "home_team_record_wins": "teams.home.leagueRecord.wins",
    "home_team_record_losses": "teams.home.leagueRecord.losses",
    "home_team_win_pct": "teams.home.leagueRecord.pct",
    "venue_id": "venue.id",
    "venue_name": "venue.name",
    "is_tie": "isTie",
    "game_number": "gameNumber",
    "public_facing": "publicFacing",
    "double_header": "doubleHeader",
    "gameday_type": "gamedayType",
    "tiebreaker": "tiebreaker",
    "calendar_event_id": "calendarEventID",
    "season_display": "seasonDisplay",
    "day_night": "dayNight",
    "description": "description",
    "scheduled_innings": "scheduledInnings",
    "reverse_home_away_status": "reverseHomeAwayStatus",
    "inning_break_length": "inningBreakLength",
    "games_in_series": "gamesInSeries",
    "series_game_number": "seriesGameNumber",
    "series_description": "seriesDescription",
    "record_source": "recordSource",
    "if_necessary": "ifNecessary",
    "if_necessary_description": "ifNecessaryDescription",
}

