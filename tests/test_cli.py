import docs
from faceoff.__main__ import run


def test_cli_refresh_reports_and_users(spark, tmp, db, capsys):
    src = docs.write_all(tmp)
    run(spark, ["--database", db, "refresh", "all", "--teams", src["teams"], "--roster", src["roster"],
                "--stats", src["stats"], "--schedule-previous", src["schedule_previous"],
                "--schedule-next", src["schedule_next"]])
    run(spark, ["--database", db, "standings", "--conference", "western", "--metric", "gpg"])
    run(spark, ["--database", db, "teams", "--division", "metro"])
    run(spark, ["--database", db, "players", "--position", "goalie"])
    run(spark, ["--database", db, "players", "--team", "1"])  # read from the team-partitioned table
    run(spark, ["--database", db, "games", "both", "--zone", "mst"])
    run(spark, ["--database", db, "users", "register", "Zed", "pw", "admin", "pst"])
    run(spark, ["--database", db, "users", "register", "ZED", "other", "basic", "cst"])
    run(spark, ["--database", db, "users", "set-zone", "zed", "est"])
    run(spark, ["--database", db, "users", "list"])
    run(spark, ["--database", db, "games", "next", "--user", " ZED"])  # zed's zone: est → 19:00
    out = capsys.readouterr().out
    assert "Alpha Club" in out and "Bo: Two, Jr." in out and "17:00" in out
    assert "Ann One" in out  # only the team-1 listing shows this player
    assert "|zed     |admin   |est     |" in out
    assert "|19:00|" in out
    assert "zed: taken" in out


def test_split_commands():
    from faceoff.__main__ import split_commands

    got = split_commands(["--database", "d", "--master", "local[2]", "teams", "::", "games", "next", "--zone", "pst"])
    assert got == [["--database", "d", "--master", "local[2]", "teams"],
                   ["--database", "d", "--master", "local[2]", "games", "next", "--zone", "pst"]]
