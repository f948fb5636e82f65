"""A small landing zone on disk: every reader, then raw to city table."""

import datetime as dt
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from daygrain.operators.quality import StaleSnapshotError, duplicate_keys, not_numeric_non_negative
from daygrain.plans import city_days, games, incidents, raw, staging, weather
from daygrain.sinks import tables
from daygrain.sources import files, snapshots

LOG_NAMES = ["game_date", "visiting_team", "visiting_team_game_number", "home_team", "home_team_game_number", "visiting_team_score",
             "home_team_score", "day_night", "park_id", "time_of_game_minutes"]
LOGS = ["20240401,NYN,1,PHI,1,3,5,D,P1,180", "20240402,NYN,2,PHI,2,4,4,N,P1,200", '20240403,PHI,3,"NYN",3,1,0,N,P2,170']


def text(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")


def scheduled(pk, day, away, home, away_score, home_score, state="F", **more):
    side = lambda name, score, wins, losses: {"team": {"id": 1, "name": name}, "score": score, "leagueRecord": {"wins": wins, "losses": losses, "pct": ".500"}}
    game = {
        "gamePk": pk, "season": "2024", "status": {"codedGameState": state}, "venue": {"id": 3, "name": "Park"},
        "teams": {"away": side(away, away_score, 1, 2), "home": side(home, home_score, 2, 1)},
        "dayNight": "night", "isTie": False, "seriesGameNumber": 1, "unknown": {"a": 1},
    }
    game["teams"]["home"]["isWinner"] = home_score > away_score
    return {"date": day, "games": [{**game, **more}]}


@pytest.fixture(scope="module")
def zone(tmp_path_factory):
    base = tmp_path_factory.mktemp("zone")
    header = "Date,TAVG (Degrees Fahrenheit),TMAX (Degrees Fahrenheit),TMIN (Degrees Fahrenheit),PRCP (Inches),SNOW (Inches),SNWD (Inches)"
    for day, high in (("2024-03-20", 1), ("2024-04-04", 60)):
        text(base / f"weather/philadelphia/ncei/{day}/philadelphia_weather_report_ncei.csv", '"PHILADELPHIA, PA (S)"', header,
             f"2024-03-31,50,{high},40,0.00,,", f"2024-04-01,51,{high + 1},41,1.20,,", "2024-04-02,,70,42,,0.0,")
    report = lambda *found: json.dumps({"rows": [{"dc_key": k, "objectid": k, "dispatch_date": d, "text_general_code": t, "note": 1} for k, d, t in found], "total_rows": 1})
    crime = base / "crime/philadelphia/2024"
    text(crime / "past/philadelphia_crime_report_2023.json", report((1, "2023-04-01", "Thefts")))
    text(crime / "2024-04-01/philadelphia_crime_report_2024.json", report((2, "2024-04-01", "older report")))
    text(crime / "2024-04-05/philadelphia_crime_report_2024.json", report((2, "2024-04-01", "Homicide - Criminal"), (3, "2024-04-01", "Aggravated Assault Firearm"), (4, "2024-04-06", None)))
    season = [scheduled(10, "2024-04-01", "New York Mets", "Philadelphia Phillies", 3, 5), scheduled(11, "2024-04-04", "Philadelphia Phillies", "New York Mets", 2, 1),
              scheduled(12, "2024-04-05", "Philadelphia Phillies", "New York Mets", 0, 0, state="S")]
    text(base / "baseball/current/2024-04-05/mlb_regular_season_scores_2024.json", json.dumps({"totalGames": 3, "dates": season}, indent=1))
    history = base / "baseball/historical"
    text(history / "gamelogs/mlb_gamelogs_2024.csv", *LOGS[:2])
    text(history / "gamelogs/mlb_gamelogs_2025.csv", LOGS[2])
    text(history / "columns/historical_baseball_headers.csv", ",".join(LOG_NAMES))
    text(history / "domain/teams.csv", "TEAM,LEAGUE,CITY,NICKNAME,FIRST,LAST", "PHI,NL,Philadelphia,Phillies,1883,2024", "NYN,NL,New York,Mets,1962,2024")
    text(history / "domain/ballparks.csv", "PARKID,NAME,AKA,CITY,STATE,START,END,LEAGUE,NOTES", 'P1,"Park, One",,Philadelphia,PA,2004-04-12,,NL,')
    census = base / "population"
    years = [f"POPESTIMATE{y}" for y in range(2000, 2010)]
    text(census / "us_census_bureau_pop_estimates_2000-2009.csv", ",".join(["SUMLEV", "NAME", "STNAME", *years]),
         ",".join(["162", "Philadelphia city", "Pennsylvania", *[str(1500000 + i) for i in range(10)]]), ",".join(["162", "Philadelphia city", "Pennsylvania", *["7"] * 10]))
    wide = lambda first, count: ",".join(f'"1,5{first + i:02d},000"' for i in range(count))
    text(census / "us_census_bureau_pop_estimates_2010-2019.csv", "table with titles", '"Estimates, all"', "as of", ",,Census," + ",".join(str(y) for y in range(2010, 2020)),
         f'1,"Philadelphia city, Pennsylvania","9",{wide(0, 10)}', "Note: no area")
    text(census / "us_census_bureau_pop_estimates_2020-2024.csv", "a", "b", "c", "d", ",,Base," + ",".join(str(y) for y in range(2020, 2025)),
         f'1,"Philadelphia city, Pennsylvania","9",{wide(20, 5)}')
    return str(base)


def test_station_report_preamble_window_and_staleness(spark, rows, zone):
    report = lambda as_of: raw.station_days(spark, zone, "philadelphia", dt.date(2024, 4, 1), dt.date(2024, 5, 1), as_of)
    assert rows(report(dt.date(2024, 4, 5)), "date", "tmax (degrees fahrenheit)") == [(dt.date(2024, 4, 1), "61"), (dt.date(2024, 4, 2), "70")]
    # A report dated tomorrow counts, later ones do not, and neither does one 30 days old.
    assert rows(report(dt.date(2024, 4, 3)), "`tmax (degrees fahrenheit)`")[0] == ("61",)
    assert rows(report(dt.date(2024, 4, 2)), "`tmax (degrees fahrenheit)`")[0] == ("2",)
    assert report(dt.date(2024, 5, 3)).count() == 2
    with pytest.raises(StaleSnapshotError):
        report(dt.date(2024, 5, 4))


def test_incidents_past_and_newest(spark, rows, zone):
    found = raw.incidents(spark, zone, "philadelphia", dt.date(2024, 4, 5))
    assert len(found.columns) == 16 and rows(found.select(F.col("dc_key").cast("int"))) == [(1,), (2,), (3,), (4,)]
    early = raw.incidents(spark, zone, "philadelphia", dt.date(2024, 4, 1))
    assert {r.text_general_code for r in early.collect()} == {"Thefts", "older report"}
    assert duplicate_keys(found, "objectid").count() == 0


def test_windows_of_days():
    assert snapshots.station_window(dt.date(2024, 1, 20)) == (dt.date(2023, 12, 22), dt.date(2024, 1, 21))
    assert snapshots.schedule_window(dt.date(2024, 1, 20)) == (dt.date(2023, 12, 21), dt.date(2024, 1, 20))
    assert snapshots.incident_window(dt.date(2024, 12, 30)) == (dt.date(2024, 1, 1), dt.date(2024, 12, 31))


def test_schedule_flattens_49_columns(spark, zone):
    found = raw.current_games(spark, zone, dt.date(2024, 4, 1), dt.date(2024, 4, 5), dt.date(2024, 4, 6))
    assert len(found.columns) == 49 and found.count() == 2
    first = found.where("game_pk = 10").first()
    assert (first.away_team_score, first.home_team_is_winner, first.away_team_is_winner, first.venue_name, first.tiebreaker) == (3, True, None, "Park", None)
    assert raw.current_games(spark, zone, dt.date(1999, 1, 1), dt.date(1999, 2, 1), dt.date(2024, 4, 6)).count() == 0


def test_population_from_three_layouts(spark, zone):
    found = raw.population_estimates(spark, zone)
    assert found.columns == ["geographic_area", "year", "population"] and found.count() == 35
    best = {r.year: r.population for r in staging.population(found).collect()}
    assert len(best) == 25 and best[2000] == 1500000 and best[2010] == 1500000 and best[2024] == 1524000


def test_domain_tables_and_logs(spark, rows, zone):
    assert rows(staging.teams(raw.teams(spark, zone))) == [("NYN", "New York", "Mets"), ("PHI", "Philadelphia", "Phillies")]
    assert rows(staging.ballparks(raw.ballparks(spark, zone))) == [("P1", "Park, One", "Philadelphia", "PA")]
    logs = raw.historical_games(spark, zone, dt.date(2024, 4, 1), dt.date(2024, 4, 3))
    assert logs.columns == LOG_NAMES and logs.count() == 2
    assert not_numeric_non_negative(logs, ["home_team_score", "visiting_team_score"]).count() == 0
    staged = {r.historical_game_id: r for r in staging.historical_games(logs).collect()}
    assert staged["2024PHI1NYN1"].home_team_is_winner and staged["2024PHI2NYN2"].is_tie and staged["2024PHI2NYN2"].night_game


def test_zipped_logs_read_like_plain_ones(spark, rows, zone, tmp_path):
    for name, lines in (("gl1", LOGS[:2]), ("gl2", LOGS[2:])):
        with zipfile.ZipFile(tmp_path / f"{name}.zip", "w") as archive:
            archive.writestr(f"{name}.txt", "\r\n".join(lines) + "\r\n")
    found = files.read_zipped_csv(spark, str(tmp_path / "*.zip"), LOG_NAMES)
    plain = files.read_csv_named_apart(spark, f"{zone}/baseball/historical/gamelogs", f"{zone}/baseball/historical/columns/historical_baseball_headers.csv")
    assert rows(found, *LOG_NAMES) == rows(plain)
    assert {r.member for r in found.select("member").distinct().collect()} == {"gl1.txt", "gl2.txt"}


def test_names_and_stamps(spark, rows):
    assert files.unique_names(["", "", "a", "a", "a", ""]) == ["", "_duplicated_0", "a", "a_duplicated_0", "a_duplicated_1", "_duplicated_1"]
    names = ["x/log_2024-01-02.csv", "x/2024-01-02/other_name.csv", "x/log_2023-05-05.csv", "x/log_2025-01-01.tar.gz", "x/log-2026-01-01.csv", "x/y_2027-01-01.d/"]
    found = snapshots.greatest_stamp(spark.createDataFrame([(n,) for n in names], "path string"))
    assert rows(found) == [("x/2024-01-02/other_name.csv",), ("x/log_2024-01-02.csv",)]


def test_raw_to_city_table(spark, zone, tmp_path):
    as_of = dt.date(2024, 4, 5)
    start, end = dt.date(2024, 1, 1), dt.date(2025, 1, 1)
    population = staging.population(raw.population_estimates(spark, zone))
    crime = incidents.daily_rates(staging.incidents(raw.incidents(spark, zone, "philadelphia", as_of)), population, "philadelphia city, pennsylvania")
    by_day = {r.dispatch_date: r for r in crime.collect()}
    day = by_day[dt.date(2024, 4, 1)]
    assert (day.total_incidents, day.violent_crime, day.homicide, day.assault, day.theft, day.population) == (2, 2, 1, 1, 0, 1524000)
    assert day.violent_crime_per_100k == 0.131 and by_day[dt.date(2024, 4, 6)].total_incidents == 0
    assert by_day[dt.date(2023, 4, 1)].theft_per_100k == 0.066

    observations = tmp_path / "observations"
    observations.mkdir()
    metar = [{"reportTime": f"2024-04-01T{h:02d}:00:00.000Z", "temp": 20.0, "pcp6hr": 0.25} for h in range(5, 22)]
    (observations / "day.json").write_text(json.dumps(metar))
    tables.write_yearly(files.read_observation_arrays(spark, str(observations)).withColumn("city", F.lit("philadelphia")), f"{zone}/weather/observations")
    observed = raw.observations(spark, zone, "philadelphia", dt.datetime(2024, 1, 1), dt.datetime(2025, 1, 1))
    station = staging.station_days(raw.station_days(spark, zone, "philadelphia", start, end, as_of))
    days = weather.daily_weather(staging.observations(observed), station)
    first = days.where("report_date = '2024-04-01'").first()
    assert (first.max_temp_deg_f, first.max_temp_deg_f_source, first.total_precip_inches) == (68.0, "METAR", 4.25)

    table = games.games(
        staging.historical_games(raw.historical_games(spark, zone, start, end)),
        staging.current_games(raw.current_games(spark, zone, start, end, as_of)),
        staging.teams(raw.teams(spark, zone)),
    )
    found = {r.game_id: r for r in table.collect()}
    assert set(found) == {"10", "11", "2024PHI2NYN2", "2024NYN3PHI3"}
    # One game known from both sources; the schedule's id and record win, the log adds the time.
    assert (found["10"].home_team_current_record_wins, found["10"].time_of_game_minutes) == (2, 180)
    # The schedule numbers its second game 2, the log's tie has that number too but another day.
    assert found["2024PHI2NYN2"].home_team_outcome == "tie" and found["2024PHI2NYN2"].home_team_current_streak == -1

    city = city_days.city_days(crime, days, table, "Philadelphia Phillies")
    shown = {(r.entry_date, r.game_id): r for r in city.collect()}
    assert set(shown) == {
        (dt.date(2023, 4, 1), None), (dt.date(2024, 3, 31), None), (dt.date(2024, 4, 1), "10"), (dt.date(2024, 4, 2), "2024PHI2NYN2"),
        (dt.date(2024, 4, 3), "2024NYN3PHI3"), (dt.date(2024, 4, 4), "11"), (dt.date(2024, 4, 6), None),
    }
    opener, idle = shown[(dt.date(2024, 4, 1), "10")], shown[(dt.date(2024, 4, 6), None)]
    assert (opener.home_game, opener.team_outcome_as_value, opener.daily_max_temp_deviation_from_max) == (True, 1, 0.0)
    # The log's last win has no official record, so it counts the wins so far: three.
    assert idle.team_current_record_wins_lag == 3 and shown[(dt.date(2024, 3, 31), None)].team_current_record_wins_lag is None
    assert "Incidents per 100k" in city_days.display(city).columns
    assert city_days.one_row_per_day(city).count() == 7
