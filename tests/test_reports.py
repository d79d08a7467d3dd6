import datetime as dt

import pytest

from faceoff import schemas
from faceoff.operators import choices as C
from faceoff.operators import reports as R

TEAMS = [(1, "Alpha", "ALP", "A-town", "Alphas"), (2, "Beta", "BET", "B-ville", "Betas"), (3, "Gamma", "GAM", "G", "Gs")]
STANDINGS = [
    (1, "Western", "Central", 10, 6, 3, 1, None, 3.1, 2.5),
    (2, "Eastern", "Metropolitan", 10, 2, 8, 0, 1, 1.9, 3.8),
    (3, "Western", "Pacific", 10, 5, 5, 0, 3, 2.0, 2.0),
    (9, "Eastern", "Atlantic", 1, 1, 1, 1, 99, 1.0, 1.0),  # no such team: dropped by the inner join
]


@pytest.fixture
def tables(spark):
    teams = spark.createDataFrame(TEAMS, schemas.TEAMS)
    standings = spark.createDataFrame(STANDINGS, schemas.STANDINGS)
    return teams, standings


def test_teams_all_is_star(tables):
    teams, _ = tables
    assert R.teams(teams).columns == list(schemas.TEAMS.fieldNames())


def test_teams_by_conference_and_division(tables):
    teams, standings = tables
    west = R.teams(teams, standings, conference=C.parse_conference("western"))
    assert west.columns == list(R.CONFERENCE_COLUMNS)
    assert [r.Team for r in R.ordered(west, R.CONFERENCE_ORDER).collect()] == ["Alpha", "Gamma"]
    metro = R.teams(teams, standings, division=C.parse_division("metro"))
    assert metro.columns == list(R.DIVISION_COLUMNS) and [r.Team for r in metro.collect()] == ["Beta"]


def test_standings_null_metric_sorts_last(tables):
    teams, standings = tables
    report = R.standings(standings, teams)
    got = [(r.Team, r.PTS) for r in R.ordered(report, R.standings_order("pts")).collect()]
    assert got == [("Gamma", 3), ("Beta", 1), ("Alpha", None)]  # DESC, nulls last (ORD-3)


def test_standings_every_metric_descending(tables):
    teams, standings = tables
    report = R.standings(standings, teams)
    for metric in C.METRICS:
        vals = [r[metric] for r in R.ordered(report, R.standings_order(metric)).collect() if r[metric] is not None]
        assert vals == sorted(vals, reverse=True)


def test_standings_scope(tables):
    teams, standings = tables
    assert R.standings(standings, teams, division="Pacific").count() == 1
    assert R.standings(standings, teams, conference="Eastern").count() == 1


def test_players(spark, tables):
    teams, _ = tables
    players = spark.createDataFrame(
        [(1, "Ann", "Center", "9", 1), (2, "Bo", "Goalie", None, 2), (3, "Cy", "Center", "4", 5)], schemas.PLAYERS
    )
    assert R.players(players, teams).count() == 2  # team 5 unknown (M8)
    assert [r.FullName for r in R.players(players, teams, position=C.parse_position("center")).collect()] == ["Ann"]
    assert [r.FullName for r in R.players(players, teams, team_id="2").collect()] == ["Bo"]
    with pytest.raises(ValueError):
        R.players(players, teams, team_id=0)
    with pytest.raises(ValueError):
        R.players(players, teams, team_id="abc")


def test_past_games_distinct_and_team_filter(spark, tables):
    teams, _ = tables
    d = dt.date(2021, 3, 1)
    games = spark.createDataFrame(
        [("g1", 1, 3, 2, 2, d), ("g1", 1, 3, 2, 2, d), ("g2", 2, 1, 3, 0, d), ("g3", 1, 3, 2, 2, d)],
        schemas.PAST_GAMES,
    )
    # g1 twice collapses (M1); g3 equals g1 on the projected columns and collapses too (M2)
    assert R.past_games(games, teams).count() == 2
    assert R.past_games(games, teams, team_id=3).count() == 1


def test_next_games_zone_and_preview(spark, tables):
    teams, _ = tables
    games = spark.createDataFrame(
        [("g1", 1, 2, dt.date(2021, 3, 1), dt.datetime(2021, 3, 1, 23, 0)),
         ("g2", 2, 3, dt.date(2021, 3, 2), dt.datetime(2021, 3, 3, 0, 30))],
        schemas.NEXT_GAMES,
    )
    est = R.preview(R.next_games(games, teams, "EST"), R.NEXT_GAMES_ORDER, 1).collect()
    assert [(r.Away, r.Home, r.Time) for r in est] == [("Alpha", "Beta", "19:00")]
    pst = {r.Away: r.Time for r in R.next_games(games, teams, "pst").collect()}
    assert pst == {"Alpha": "16:00", "Beta": "17:30"}
    with pytest.raises(ValueError):
        R.next_games(games, teams, "utc")


def test_parameter_validation():
    with pytest.raises(ValueError):
        C.parse_division("north")
    with pytest.raises(ValueError):
        C.parse_metric("goals")
    with pytest.raises(ValueError):
        C.parse_conference("central")
    assert C.parse_division("Metropolitan") == C.parse_division("metro") == "Metropolitan"
    assert C.parse_position("left  wing") == "Left Wing"
    assert C.parse_team_id("all") is None and C.parse_team_id(" 7 ") == 7
    with pytest.raises(ValueError):
        R.preview(None, [], 0)


def test_total_order_appends_remaining_columns(tables):
    teams, _ = tables
    keys = [str(c) for c in R.total_order(teams, ["Team"])]
    assert len(keys) == len(teams.columns)
