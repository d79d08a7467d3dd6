import datetime as dt
from pathlib import Path

import docs
from faceoff import schemas
from faceoff.sources import documents as D
from faceoff.sources import ingest


def _read(spark, path, schema):
    return D.read_documents(spark, path, schema, multi_line=True)


def test_past_games_each_listing_team_emits_the_game(spark, tmp):
    path = docs.write(tmp, "prev.json", docs.schedule("previousGameSchedule"))
    rows = ingest.past_games(_read(spark, path, schemas.schedule_document())).collect()
    got = sorted(tuple(r) for r in rows)
    assert got == [
        ("2020020001", 1, 3, 2, 2, dt.date(2021, 3, 1)),
        ("2020020001", 1, 3, 2, 2, dt.date(2021, 3, 1)),  # listed by both teams (M1)
        ("2020020002", 4, 5, 1, None, dt.date(2021, 3, 2)),  # missing score is NULL, not inherited
    ]


def test_next_games_keep_document_date_and_utc_start(spark, tmp):
    path = docs.write(tmp, "next.json", docs.schedule("nextGameSchedule"))
    rows = ingest.next_games(_read(spark, path, schemas.schedule_document("nextGameSchedule"))).collect()
    late = [r for r in rows if r.GameID == "2020020002"][0]
    assert late.Date == dt.date(2021, 3, 2)  # the schedule's date, not the UTC date (M4)
    assert late.StartTime == dt.datetime(2021, 3, 3, 2, 30)


def test_players_carry_team_and_keep_odd_names(spark, tmp):
    path = docs.write(tmp, "roster.json", docs.ROSTER)
    rows = ingest.players(_read(spark, path, schemas.roster_document())).orderBy("ID").collect()
    assert [tuple(r) for r in rows] == [
        (10, "Ann One", "Center", "9", 1),
        (11, "Bo: Two, Jr.", "Goalie", None, 1),  # no jersey: NULL, not the previous player's (M21)
        (12, "Cy", "Defenseman", "4", 24),
    ]


def test_teams_missing_name_is_null(spark, tmp):
    path = docs.write(tmp, "teams.json", docs.TEAMS)
    rows = ingest.teams(_read(spark, path, schemas.teams_document())).orderBy("ID").collect()
    assert rows[1].Team == "Beta: Team, Ltd"
    assert rows[2].Team is None and rows[2].ABB == "GAM"


def test_standings_first_split_only(spark, tmp):
    path = docs.write(tmp, "stats.json", docs.STATS)
    df = _read(spark, path, schemas.stats_document())
    flagged = df.filter(df[schemas.CORRUPT_RECORD].isNotNull()).select("teams", schemas.CORRUPT_RECORD).collect()
    assert flagged == []  # ranks as text do not void the record
    rows = ingest.standings(df).orderBy("Division").collect()
    assert [tuple(r) for r in rows] == [
        (2, "Eastern", "Atlantic", 10, 2, 8, 0, 4, 1.9, 3.8),
        (1, "Western", "Central", 10, 6, 3, 1, 13, 3.1, 2.5),
    ]  # team 3 has an empty splits array: no season totals, no row


def test_broken_document_is_kept_as_text(spark, tmp):
    good = docs.write(tmp, "d/good.json", docs.TEAMS)
    Path(tmp, "d", "bad.json").write_text('{"teams": [ {"id": 1, ')
    df = _read(spark, str(Path(good).parent), schemas.teams_document())
    bad = df.filter(df[schemas.CORRUPT_RECORD].isNotNull()).collect()
    assert len(bad) == 1 and bad[0].teams is None
    assert ingest.teams(df).count() == 3


def test_json_lines_documents(spark, tmp):
    import json

    path = Path(tmp) / "lines.json"
    path.write_text("\n".join(json.dumps(d) for d in [docs.TEAMS, docs.TEAMS]))
    df = D.read_documents(spark, str(path), schemas.teams_document())
    assert ingest.teams(df).count() == 6


def test_parse_documents_from_text_column(spark):
    import json

    text = spark.createDataFrame([(json.dumps(docs.TEAMS),)], "value string")
    assert ingest.teams(D.parse_documents(text, schemas.teams_document())).count() == 3


def test_explode_outer_keeps_parent(spark):
    df = spark.createDataFrame([(1, [1, 2]), (2, [])], "id int, xs array<int>")
    assert D.explode_path(df, "xs", keep=["id"]).count() == 2
    assert D.explode_path(df, "xs", keep=["id"], outer=True).count() == 3
    assert df.select(D.first_element("xs")).collect()[1][0] is None
