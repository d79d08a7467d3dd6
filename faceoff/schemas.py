"""Fixed schemas: the stored tables and the nested source documents.

Nothing is inferred; every table is created from one of these StructTypes.
The intermediate field names of the documents (marked ``†`` in FIXTURES.md)
are parameters of the ingest functions, the defaults are used here.
"""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT_RECORD = "_corrupt_record"

# ---------------------------------------------------------------- tables

PAST_GAMES = T.StructType(
    [
        T.StructField("GameID", T.StringType()),
        T.StructField("AwayID", T.IntegerType()),
        T.StructField("AwayScore", T.IntegerType()),
        T.StructField("HomeID", T.IntegerType()),
        T.StructField("HomeScore", T.IntegerType()),
        T.StructField("Date", T.DateType()),
    ]
)

# The reference stores four pre-shifted clock strings; the start instant is
# stored instead and the clock for a zone is derived at read time.
NEXT_GAMES = T.StructType(
    [
        T.StructField("GameID", T.StringType()),
        T.StructField("AwayID", T.IntegerType()),
        T.StructField("HomeID", T.IntegerType()),
        T.StructField("Date", T.DateType()),
        T.StructField("StartTime", T.TimestampNTZType()),
    ]
)

PLAYERS = T.StructType(
    [
        T.StructField("ID", T.IntegerType()),
        T.StructField("FullName", T.StringType()),
        T.StructField("Position", T.StringType()),
        T.StructField("JerseyNumber", T.StringType()),
        T.StructField("TeamID", T.IntegerType()),
    ]
)

TEAMS = T.StructType(
    [
        T.StructField("ID", T.IntegerType()),
        T.StructField("Team", T.StringType()),
        T.StructField("ABB", T.StringType()),
        T.StructField("Location", T.StringType()),
        T.StructField("Name", T.StringType()),
    ]
)

STANDINGS = T.StructType(
    [
        T.StructField("TeamID", T.IntegerType()),
        T.StructField("Conference", T.StringType()),
        T.StructField("Division", T.StringType()),
        T.StructField("GP", T.IntegerType()),
        T.StructField("W", T.IntegerType()),
        T.StructField("L", T.IntegerType()),
        T.StructField("OTL", T.IntegerType()),
        T.StructField("PTS", T.IntegerType()),
        T.StructField("GPG", T.DoubleType()),
        T.StructField("GAPG", T.DoubleType()),
    ]
)

USERS = T.StructType(
    [
        T.StructField("Username", T.StringType()),
        T.StructField("Password", T.StringType()),
        T.StructField("UserType", T.StringType()),
        T.StructField("Timezone", T.StringType()),
    ]
)

TABLES = {
    "pastGames": PAST_GAMES,
    "nextGames": NEXT_GAMES,
    "players": PLAYERS,
    "teams": TEAMS,
    "standings": STANDINGS,
    "users": USERS,
}

# ------------------------------------------------------------- documents


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


def _side() -> T.StructType:
    return _struct(score=T.IntegerType(), team=_struct(id=T.IntegerType()))


def schedule_document(schedule_field: str = "previousGameSchedule") -> T.StructType:
    """Schedule document: teams[] → <schedule>.dates[] → games[]."""
    game = _struct(
        gamePk=T.LongType(),
        gameDate=T.StringType(),
        teams=_struct(away=_side(), home=_side()),
    )
    date = _struct(date=T.StringType(), games=T.ArrayType(game))
    team = T.StructType(
        [
            T.StructField("id", T.IntegerType()),
            T.StructField(schedule_field, _struct(dates=T.ArrayType(date))),
        ]
    )
    return _with_corrupt(_struct(teams=T.ArrayType(team)))


def roster_document(roster_field: str = "roster") -> T.StructType:
    """Roster document: teams[] → <roster>.<roster>[] of players."""
    player = _struct(
        person=_struct(id=T.IntegerType(), fullName=T.StringType()),
        jerseyNumber=T.StringType(),
        position=_struct(name=T.StringType()),
    )
    roster = T.StructType([T.StructField(roster_field, T.ArrayType(player))])
    team = T.StructType([T.StructField("id", T.IntegerType()), T.StructField(roster_field, roster)])
    return _with_corrupt(_struct(teams=T.ArrayType(team)))


def teams_document() -> T.StructType:
    team = _struct(
        id=T.IntegerType(),
        name=T.StringType(),
        abbreviation=T.StringType(),
        teamName=T.StringType(),
        locationName=T.StringType(),
    )
    return _with_corrupt(_struct(teams=T.ArrayType(team)))


# Stat values are read as text: the second split holds ranks such as "3rd",
# which would void the whole record if typed; element 0 is cast afterwards.
STAT_FIELDS = ("gamesPlayed", "wins", "losses", "ot", "pts", "goalsPerGame", "goalsAgainstPerGame")


def stats_document(stats_field: str = "teamStats") -> T.StructType:
    """Stats document: teams[] → <teamStats>[] → splits[]."""
    split = _struct(
        stat=T.StructType([T.StructField(f, T.StringType()) for f in STAT_FIELDS]),
        team=_struct(id=T.IntegerType()),
    )
    team = T.StructType(
        [
            T.StructField("id", T.IntegerType()),
            T.StructField("division", _struct(name=T.StringType())),
            T.StructField("conference", _struct(name=T.StringType())),
            T.StructField(stats_field, T.ArrayType(_struct(splits=T.ArrayType(split)))),
        ]
    )
    return _with_corrupt(_struct(teams=T.ArrayType(team)))


# Field names inside the documents that are not fixed by the data the
# reports read (configurable; these are the defaults).
DOCUMENT_FIELDS = {
    "previous_schedule": "previousGameSchedule",
    "next_schedule": "nextGameSchedule",
    "roster": "roster",
    "team_stats": "teamStats",
}


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField(CORRUPT_RECORD, T.StringType())])
