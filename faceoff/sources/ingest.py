"""Flatten the five source documents into the stored tables (SRC-1 … SRC-5).

Each function takes the DataFrame of parsed documents (see
``documents.read_documents`` with the matching ``schemas.*_document()``) and
returns rows in the table schema of ``faceoff.schemas``.  Real JSON parsing
replaces the reference's line scanner, so a missing field is NULL rather
than the previous record's value (M21) and a value containing ``:`` or ``,``
is kept whole (M22).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faceoff.functions.clock import parse_utc_instant
from faceoff.sources.documents import explode_path, first_element


def _games(doc: DataFrame, schedule_field: str) -> DataFrame:
    teams = explode_path(doc, "teams", alias="t")
    dates = explode_path(teams, F.col(f"t.{schedule_field}.dates"), alias="d")
    return explode_path(dates, "d.games", keep=[F.col("d.date").alias("date")], alias="g")


def past_games(doc: DataFrame, schedule_field: str = "previousGameSchedule") -> DataFrame:
    """teams[] → schedule.dates[] → games[]: one row per (listing team, game).

    A game appears once per team that lists it (M1); reports de-duplicate.
    """
    return _games(doc, schedule_field).select(
        F.col("g.gamePk").cast("string").alias("GameID"),
        F.col("g.teams.away.team.id").alias("AwayID"),
        F.col("g.teams.away.score").alias("AwayScore"),
        F.col("g.teams.home.team.id").alias("HomeID"),
        F.col("g.teams.home.score").alias("HomeScore"),
        F.try_to_date(F.col("date")).alias("Date"),
    )


def next_games(doc: DataFrame, schedule_field: str = "nextGameSchedule") -> DataFrame:
    """As :func:`past_games` for the next-game schedule, keeping the UTC start.

    ``Date`` is the schedule's own date (M4), not the date of the UTC instant.
    """
    return _games(doc, schedule_field).select(
        F.col("g.gamePk").cast("string").alias("GameID"),
        F.col("g.teams.away.team.id").alias("AwayID"),
        F.col("g.teams.home.team.id").alias("HomeID"),
        F.try_to_date(F.col("date")).alias("Date"),
        parse_utc_instant(F.col("g.gameDate")).alias("StartTime"),
    )


def players(doc: DataFrame, roster_field: str = "roster") -> DataFrame:
    """teams[] → roster.roster[]: one row per player with the team id carried down."""
    teams = explode_path(doc, "teams", alias="t")
    roster = explode_path(
        teams, F.col(f"t.{roster_field}.{roster_field}"), keep=[F.col("t.id").alias("team_id")], alias="p"
    )
    return roster.select(
        F.col("p.person.id").alias("ID"),
        F.col("p.person.fullName").alias("FullName"),
        F.col("p.position.name").alias("Position"),
        F.col("p.jerseyNumber").alias("JerseyNumber"),
        F.col("team_id").alias("TeamID"),
    )


def teams(doc: DataFrame) -> DataFrame:
    """teams[]: id, name, abbreviation, location and team name."""
    return explode_path(doc, "teams", alias="t").select(
        F.col("t.id").alias("ID"),
        F.col("t.name").alias("Team"),
        F.col("t.abbreviation").alias("ABB"),
        F.col("t.locationName").alias("Location"),
        F.col("t.teamName").alias("Name"),
    )


def standings(doc: DataFrame, stats_field: str = "teamStats") -> DataFrame:
    """teams[] → teamStats[] → splits[0] (season totals, M23).

    Division and conference come from the team and are carried down.  Stat
    values are text in the document schema and cast with ``try_cast`` after
    taking element 0, so ranks in later splits cannot void the record.  A
    team with no split yields no row.
    """
    teams_df = explode_path(doc, "teams", alias="t")
    stats = explode_path(
        teams_df,
        F.col(f"t.{stats_field}"),
        keep=[F.col("t.division.name").alias("division"), F.col("t.conference.name").alias("conference")],
        alias="ts",
    )
    # a team without a split has no season totals and, as in the reference, no row
    first = stats.select("division", "conference", first_element("ts.splits").alias("s")).filter(
        F.col("s").isNotNull()
    )
    stat = "s.stat."
    return first.select(
        F.col("s.team.id").alias("TeamID"),
        F.col("conference").alias("Conference"),
        F.col("division").alias("Division"),
        F.col(stat + "gamesPlayed").try_cast("int").alias("GP"),
        F.col(stat + "wins").try_cast("int").alias("W"),
        F.col(stat + "losses").try_cast("int").alias("L"),
        F.col(stat + "ot").try_cast("int").alias("OTL"),
        F.col(stat + "pts").try_cast("int").alias("PTS"),
        F.col(stat + "goalsPerGame").try_cast("double").alias("GPG"),
        F.col(stat + "goalsAgainstPerGame").try_cast("double").alias("GAPG"),
    )
