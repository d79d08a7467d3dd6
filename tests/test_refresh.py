import datetime as dt
from pathlib import Path

import pytest

import docs
from faceoff.operators import reports as R
from faceoff.operators import tables as T
from faceoff.plans.refresh import jobs_for, refresh
from faceoff.streaming.landing import refresh_on_arrival


def test_refresh_all_then_reports(spark, tmp, db):
    sources = docs.write_all(tmp)
    written = refresh(spark, "all", sources, database=db)
    assert set(written) == {"teams", "players", "partiPlayers", "nextGames", "pastGames", "standings"}
    teams = spark.table(f"{db}.teams")
    past = R.past_games(spark.table(f"{db}.pastGames"), teams)
    # the shared game once (DISTINCT); the game of unknown team 4 is dropped (inner join, M8)
    assert [tuple(r) for r in past.collect()] == [(dt.date(2021, 3, 1), "Alpha Club", 3, "Beta: Team, Ltd", 2)]
    nxt = R.next_games(spark.table(f"{db}.nextGames"), teams, "pst").collect()
    assert [r.Time for r in nxt] == ["16:00"]
    parti = spark.table(f"{db}.partiPlayers")
    assert sorted(r.TeamID for r in parti.collect()) == [1, 1, 24]
    st = R.standings(spark.table(f"{db}.standings"), teams, conference="Western").collect()
    assert [r.Team for r in st] == ["Alpha Club"]


def test_refresh_replaces_snapshot(spark, tmp, db):
    sources = docs.write_all(tmp)
    first = refresh(spark, "teams", sources, database=db)["teams"]
    second = refresh(spark, "teams", sources, database=db)["teams"]
    assert first != second
    assert T.snapshot_versions(spark, f"{db}.teams") == [first, second]  # readers of the first can finish
    assert spark.table(f"{db}.teams").count() == 3


def test_unknown_trigger():
    with pytest.raises(ValueError):
        jobs_for("everything")


def test_streaming_refresh_on_arrival(spark, tmp, db):
    landing = {"teams": str(Path(tmp) / "landing" / "teams")}
    docs.write(landing["teams"], "a.json", docs.TEAMS)
    queries = refresh_on_arrival(spark, "teams", landing, str(Path(tmp) / "ckpt"), database=db)
    for q in queries:
        q.awaitTermination(120)
    assert spark.table(f"{db}.teams").count() == 3
    # a second document of the same feed arrives: the first one's teams stay
    more = {"teams": [{**docs.TEAMS["teams"][0], "id": 77}]}
    docs.write(landing["teams"], "b.json", more)
    for q in refresh_on_arrival(spark, "teams", landing, str(Path(tmp) / "ckpt"), database=db):
        q.awaitTermination(120)
        assert q.exception() is None
    assert spark.table(f"{db}.teams").count() == 4


def _generation(landing: str, name: int, ids: list[int], complete: bool = True) -> None:
    for k in ids:  # one file a team
        docs.write(f"{landing}/generation={name}", f"{k}.json", {"teams": [{**docs.TEAMS["teams"][0], "id": k}]})
    if complete:
        (Path(landing) / f"generation={name}" / "COMPLETE").touch()


def test_only_complete_generations_are_published(spark, tmp, db):
    landing = str(Path(tmp) / "generations")
    stored = lambda: sorted(r.ID for r in spark.table(f"{db}.teams").collect())

    def arrive():
        for q in refresh_on_arrival(spark, "teams", {"teams": landing}, str(Path(tmp) / "ckpt-gen"), database=db):
            q.awaitTermination(120)
            assert q.exception() is None
        return stored()

    _generation(landing, 9, [1], complete=False)
    assert refresh(spark, "teams", {"teams": landing}, database=db) == {}
    _generation(landing, 9, [2])
    assert arrive() == [1, 2]
    _generation(landing, 10, [3], complete=False)
    assert arrive() == [1, 2]  # half landed
    (Path(landing) / "generation=10" / "COMPLETE").touch()
    assert arrive() == [3]  # 10 is newer than 9 and replaces it
    _generation(landing, 9, [4])
    assert arrive() == [3]  # late for an old generation
    refresh(spark, "teams", {"teams": landing}, database=db)
    assert stored() == [3]  # the batch form reads no union


def test_kept_corrupt_documents_are_listed(spark, tmp, db):
    folder = Path(tmp) / "mixed"
    docs.write(str(folder), "good.json", docs.TEAMS)
    (folder / "bad.json").write_text('{"teams": [ {"id": 1, ')
    refresh(spark, "teams", {"teams": str(folder)}, database=db, on_corrupt="keep")
    assert spark.table(f"{db}.teams").count() == 3
    (row,) = spark.table(f"{db}.teams__rejected").collect()
    assert row.path.endswith("bad.json") and row.raw.startswith('{"teams"')


def test_partitioned_players_of_other_teams(spark, tmp, db):
    path = docs.write(tmp, "roster-ids/doc.json", docs.ROSTER)
    refresh(spark, "roster", {"roster": path}, database=db, team_ids=[24])
    assert [r.TeamID for r in spark.table(f"{db}.partiPlayers").collect()] == [24]


def test_refresh_fails_on_broken_document_and_keeps_old_snapshot(spark, tmp, db):
    sources = docs.write_all(tmp)
    first = refresh(spark, "teams", sources, database=db)["teams"]
    broken = Path(tmp) / "teams_broken"
    broken.mkdir()
    (broken / "a.json").write_text('{"teams": [ {"id": 1, ')
    with pytest.raises(Exception, match="malformed teams document"):
        refresh(spark, "teams", {"teams": str(broken)}, database=db)
    assert spark.table(f"{db}.teams").count() == 3  # previous snapshot still served
    written = refresh(spark, "teams", {"teams": str(broken)}, database=db, on_corrupt="keep")
    assert spark.table(f"{db}.teams").count() == 0 and written["teams"] != first


def test_refresh_with_other_field_names(spark, tmp, db):
    import json

    doc = json.loads(json.dumps(docs.ROSTER).replace('"roster"', '"squad"'))
    path = docs.write(tmp, "squad/doc.json", doc)
    refresh(spark, "roster", {"roster": path}, database=db, fields={"roster": "squad"})
    assert spark.table(f"{db}.players").count() == 3
    with pytest.raises(ValueError):
        refresh(spark, "roster", {"roster": path}, database=db, fields={"nope": "x"})


def test_team_roster_reads_one_partition(spark, tmp, db):
    sources = docs.write_all(tmp)
    refresh(spark, "all", sources, database=db)
    report = R.players(spark.table(f"{db}.partiPlayers"), spark.table(f"{db}.teams"), team_id=1)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(TeamID" in plan and "(TeamID" in plan
    assert sorted(r.FullName for r in report.collect()) == ["Ann One", "Bo: Two, Jr."]


def test_streaming_roster_writes_partitioned_snapshot(spark, tmp, db):
    landing = {"roster": str(Path(tmp) / "landing" / "roster")}
    docs.write(landing["roster"], "r.json", docs.ROSTER)
    for q in refresh_on_arrival(spark, "roster", landing, str(Path(tmp) / "ckpt-roster"), database=db):
        q.awaitTermination(120)
        assert q.exception() is None
    assert spark.table(f"{db}.players").count() == 3
    assert sorted(r.TeamID for r in spark.table(f"{db}.partiPlayers").collect()) == [1, 1, 24]


def test_streaming_refresh_with_processing_time_trigger(spark, tmp, db):
    landing = {"teams": str(Path(tmp) / "landing-pt" / "teams")}
    docs.write(landing["teams"], "a.json", docs.TEAMS)
    queries = refresh_on_arrival(
        spark, "teams", landing, str(Path(tmp) / "ckpt-pt"), database=db, available_now=False, processing_time="1 second"
    )
    try:
        for q in queries:
            q.processAllAvailable()
            assert q.isActive and q.exception() is None
        assert spark.table(f"{db}.teams").count() == 3
    finally:
        for q in queries:
            q.stop()
