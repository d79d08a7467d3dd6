"""Command line: refresh, the reports and account administration.

    python -m faceoff --database league refresh all --teams DIR --roster DIR ...
    python -m faceoff --database league standings --division metro --metric gapg
    python -m faceoff --database league games next --team 7 --zone pst
    python -m faceoff --database league users set-zone bob mst

Reports print a preview (report order, total tie-breakers, ``--limit`` rows),
like the reference's screens; the work is done by the library operators.

Tables live in the session's catalog.  With a persistent catalog (a cluster's
metastore) every invocation sees the tables of earlier ones; with Spark's
default in-memory catalog, chain commands with ``::`` to run them in one
session:

    python -m faceoff --master 'local[8]' --database league refresh all --teams DIR ... :: standings --metric gp

On a cluster submit this module as the application (``spark-submit``);
``--master local[N]`` builds a local session for a single machine.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from faceoff.operators import choices as C
from faceoff.operators import reports as R
from faceoff.plans import accounts
from faceoff.plans.refresh import PARTITIONED_TEAM_IDS, TRIGGERS, refresh


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="faceoff", description=__doc__.split("\n")[0])
    p.add_argument("--database", default="default")
    p.add_argument("--master", default=None, help="only for a local run; spark-submit sets it otherwise")
    sub = p.add_subparsers(dest="command", required=True)

    r = sub.add_parser("refresh", help="ingest documents and replace tables")
    r.add_argument("trigger", choices=sorted(TRIGGERS))
    for doc in ("teams", "roster", "stats", "schedule-previous", "schedule-next"):
        r.add_argument(f"--{doc}", help=f"folder or file of {doc} documents")
    r.add_argument("--json-lines", action="store_true", help="one document per line instead of pretty-printed")
    r.add_argument("--keep-corrupt", action="store_true", help="publish what parsed, list bad documents in <table>__rejected")
    r.add_argument(
        "--field",
        action="append",
        default=[],
        metavar="NAME=VALUE",
        help="intermediate document field name (previous_schedule, next_schedule, roster, team_stats)",
    )

    t = sub.add_parser("teams")
    t.add_argument("--conference")
    t.add_argument("--division")
    t.add_argument("--limit", type=_positive, default=None, help="rows shown (default 32 for all teams, 20 per scope)")

    s = sub.add_parser("standings")
    s.add_argument("--conference")
    s.add_argument("--division")
    s.add_argument("--metric", default=C.DEFAULT_METRIC)
    s.add_argument("--limit", type=_positive, default=32)

    pl = sub.add_parser("players")
    pl.add_argument("--position")
    pl.add_argument("--team")
    pl.add_argument("--limit", type=_positive, default=900)

    g = sub.add_parser("games")
    g.add_argument("which", choices=["past", "next", "both"])
    g.add_argument("--team")
    g.add_argument("--zone", default=None, help="est, cst, mst or pst (default: the user's zone, else est)")
    g.add_argument("--user", help="show upcoming games in this account's zone")
    g.add_argument("--limit", type=_positive, default=20)

    u = sub.add_parser("users")
    us = u.add_subparsers(dest="action", required=True)
    us.add_parser("list").add_argument("--limit", type=_positive, default=100)
    reg = us.add_parser("register")
    for a in ("username", "password", "user_type", "zone"):
        reg.add_argument(a)
    sz = us.add_parser("set-zone")
    sz.add_argument("username")
    sz.add_argument("zone")
    rm = us.add_parser("remove")
    rm.add_argument("username")
    return p


def _positive(text: str) -> int:
    n = int(text)
    if n < 1:
        raise argparse.ArgumentTypeError("must be at least 1")
    return n


def _show(df, limit: int) -> None:
    df.show(limit, truncate=False)


def run(spark: SparkSession, argv: list[str]) -> None:
    args = _parser().parse_args(argv)
    db = args.database
    table = lambda name: spark.table(f"{db}.{name}")

    if args.command == "refresh":
        sources = {
            key: getattr(args, attr)
            for key, attr in (("teams", "teams"), ("roster", "roster"), ("stats", "stats"),
                              ("schedule_previous", "schedule_previous"), ("schedule_next", "schedule_next"))
            if getattr(args, attr)
        }
        fields = dict(item.split("=", 1) for item in args.field)
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
        written = refresh(
            spark,
            args.trigger,
            sources,
            database=db,
            multi_line=not args.json_lines,
            on_corrupt="keep" if args.keep_corrupt else "fail",
            fields=fields,
        )
        for job, table_written in written.items():
            print(f"{job}: {table_written}")
    elif args.command == "teams":
        conf = C.parse_conference(args.conference) if args.conference else None
        div = C.parse_division(args.division) if args.division else None
        scoped = conf is not None or div is not None
        # the plain list needs no standings table
        report = R.teams(table("teams"), table("standings"), conference=conf, division=div) if scoped else R.teams(table("teams"))
        if conf is None and div is None:
            order, limit = R.TEAMS_ORDER, 32 if args.limit is None else args.limit
        elif div is None:
            order, limit = R.CONFERENCE_ORDER, 20 if args.limit is None else args.limit
        else:
            order, limit = ("Team",), 20 if args.limit is None else args.limit
        _show(R.preview(report, order, limit), limit)
    elif args.command == "standings":
        conf = C.parse_conference(args.conference) if args.conference else None
        div = C.parse_division(args.division) if args.division else None
        report = R.standings(table("standings"), table("teams"), conference=conf, division=div)
        _show(R.preview(report, R.standings_order(args.metric), args.limit), args.limit)
    elif args.command == "players":
        pos = C.parse_position(args.position) if args.position else None
        team_id = C.parse_team_id(args.team)
        source = table("players")
        # refresh was run with the default teams of the partitioned table
        if team_id in PARTITIONED_TEAM_IDS and spark.catalog.tableExists(f"{db}.partiPlayers"):
            # the team filter becomes a partition filter: one team's files are read
            source = table("partiPlayers")
        report = R.players(source, table("teams"), position=pos, team_id=team_id)
        _show(R.preview(report, R.PLAYERS_ORDER, args.limit), args.limit)
    elif args.command == "games":
        if args.which in ("past", "both"):
            report = R.past_games(table("pastGames"), table("teams"), team_id=args.team)
            _show(R.preview(report, R.PAST_GAMES_ORDER, args.limit), args.limit)
        if args.which in ("next", "both"):
            zone = args.zone or (accounts.user_zone(spark, f"{db}.users", args.user) if args.user else "est")
            report = R.next_games(table("nextGames"), table("teams"), C.parse_zone(zone), team_id=args.team)
            _show(R.preview(report, R.NEXT_GAMES_ORDER, args.limit), args.limit)
    elif args.command == "users":
        name = f"{db}.users"
        if args.action == "list":
            _show(R.preview(accounts.list_users(spark, name), ("Username",), args.limit), args.limit)
        elif args.action == "register":
            row = [(args.username, args.password, args.user_type, args.zone)]
            refused = accounts.register(spark, name, spark.createDataFrame(
                row, "Username string, Password string, UserType string, Timezone string"))
            # one request, so at most one row
            for r in refused.limit(1).collect():
                print(f"{r['Username']}: {r['reason']}")
        elif args.action == "set-zone":
            change = spark.createDataFrame([(args.username, args.zone)], "Username string, Timezone string")
            accounts.set_timezone(spark, name, change)
        elif args.action == "remove":
            accounts.remove(spark, name, spark.createDataFrame([(args.username,)], "Username string"))


def split_commands(argv: list[str]) -> list[list[str]]:
    """``[globals] cmd1 ... :: cmd2 ...`` → one argv per command, globals repeated."""
    parts, current = [], []
    for token in argv:
        if token == "::":
            parts.append(current)
            current = []
        else:
            current.append(token)
    parts.append(current)
    first = parts[0]
    globals_ = []
    i = 0
    while i < len(first) and first[i] in ("--database", "--master"):
        globals_ += first[i : i + 2]
        i += 2
    return [first] + [globals_ + p for p in parts[1:]]


def main(argv: list[str] | None = None) -> None:
    commands = split_commands(list(sys.argv[1:] if argv is None else argv))
    master = _parser().parse_args(commands[0]).master
    if master:
        from faceoff.session import build_session

        spark = build_session(master=master)
    else:
        spark = SparkSession.builder.appName("faceoff").getOrCreate()
    for command in commands:
        run(spark, command)


if __name__ == "__main__":
    main()
