"""The parametrised reports: teams, standings, players, past and next games.

Each report returns the *whole* result as a lazy DataFrame; ordering is a
separate step because a full ``orderBy`` is a range-partitioned shuffle the
caller may not need.  :func:`preview` applies the report's order plus
tie-breakers (M7) and a row count, which Spark plans as a
``TakeOrderedAndProject`` (per-partition top-n, then a merge of n × tasks
rows — bounded by n, never the table).

Joins carry no hints.  The dimension side (teams) is tiny in the real data
and is broadcast by Catalyst because its size estimate is under
``spark.sql.autoBroadcastJoinThreshold``; when a dimension is large the same
plan becomes a sort-merge join and AQE's skew-join handling splits a hot team
key.  Filters are written on plain stored columns so they reach the Parquet
scan as ``PushedFilters``.

Output columns are resolved by name after the join, so a column may come
from either side; ``columns=`` overrides the projection (used by the
test-table analogs whose tables carry different attribute sets).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faceoff.functions.clock import utc_clock
from faceoff.operators.choices import DEFAULT_METRIC, parse_metric, parse_team_id

TEAM_COLUMNS = ("ID", "Team", "ABB", "Location", "Name")
CONFERENCE_COLUMNS = ("Team", "ABB", "Location", "Name", "Conference", "Division")
DIVISION_COLUMNS = ("Team", "ABB", "Location", "Name", "Division")
STANDINGS_COLUMNS = ("Team", "Conference", "Division", "GP", "W", "L", "OTL", "PTS", "GPG", "GAPG")
PLAYER_COLUMNS = ("Team", "FullName", "Position", "JerseyNumber")
PAST_GAME_COLUMNS = ("Date", "Away", "AwayScore", "Home", "HomeScore")
NEXT_GAME_COLUMNS = ("Date", "Away", "Home", "Time")

# Report orders: the reference's sort key first, then total-order tie-breakers.
TEAMS_ORDER = ("Team", "ID")
CONFERENCE_ORDER = ("Division", "Team")
PLAYERS_ORDER = ("Team", "FullName")
PAST_GAMES_ORDER = ("Date", "Away", "Home", "AwayScore", "HomeScore")
NEXT_GAMES_ORDER = ("Date", "Away", "Home", "Time")


def all_of(predicates: Iterable[Column | None]) -> Column | None:
    """Fold optional predicates with AND (FLT-7); ``None`` when there are none."""
    preds = [p for p in predicates if p is not None]
    return reduce(lambda a, b: a & b, preds) if preds else None


def _where(df: DataFrame, predicate: Column | None) -> DataFrame:
    return df if predicate is None else df.filter(predicate)


def _eq(column: str, value) -> Column | None:
    return None if value is None else F.col(column) == F.lit(value)


# ------------------------------------------------------------------ teams


def teams(
    teams_df: DataFrame,
    standings_df: DataFrame | None = None,
    *,
    conference: str | None = None,
    division: str | None = None,
    columns: Sequence[str] | None = None,
    team_key: str = "ID",
    standings_key: str = "TeamID",
) -> DataFrame:
    """Teams, all of them or those of one conference / division.

    Without a scope this is ``SELECT *`` over the teams table; with one it is
    teams ⋈ standings (inner) filtered on the standings attribute.
    """
    if conference is None and division is None:
        return teams_df if columns is None else teams_df.select(*columns)
    if standings_df is None:
        raise ValueError("a conference or division scope needs the standings table")
    joined = teams_df.join(standings_df, teams_df[team_key] == standings_df[standings_key], "inner")
    scoped = _where(joined, all_of([_eq("Conference", conference), _eq("Division", division)]))
    default = CONFERENCE_COLUMNS if division is None else DIVISION_COLUMNS
    return scoped.select(*(columns or default))


# -------------------------------------------------------------- standings


def standings(
    standings_df: DataFrame,
    teams_df: DataFrame,
    *,
    conference: str | None = None,
    division: str | None = None,
    columns: Sequence[str] | None = None,
    standings_key: str = "TeamID",
    team_key: str = "ID",
) -> DataFrame:
    """League / conference / division standings (standings ⋈ teams, inner)."""
    joined = standings_df.join(teams_df, standings_df[standings_key] == teams_df[team_key], "inner")
    scoped = _where(joined, all_of([_eq("Conference", conference), _eq("Division", division)]))
    return scoped.select(*(columns or STANDINGS_COLUMNS))


def standings_order(metric: str = DEFAULT_METRIC, tie_breakers: Sequence[str] | None = None) -> list:
    """Metric descending (nulls last, M6), then tie-breakers ascending."""
    m = parse_metric(metric)
    rest = tie_breakers if tie_breakers is not None else ("Team",) + tuple(c for c in STANDINGS_COLUMNS if c != "Team")
    return [desc(m)] + [c for c in rest if c != m]


# ---------------------------------------------------------------- players


def players(
    players_df: DataFrame,
    teams_df: DataFrame,
    *,
    position: str | None = None,
    team_id: int | str | None = None,
    columns: Sequence[str] | None = None,
    player_team_key: str = "TeamID",
    team_key: str = "ID",
) -> DataFrame:
    """Players with their team name, optionally one position or one team."""
    tid = parse_team_id(team_id)
    fact = _where(
        players_df,
        all_of([_eq("Position", position), None if tid is None else players_df[player_team_key] == F.lit(tid)]),
    )
    joined = fact.join(teams_df, fact[player_team_key] == teams_df[team_key], "inner")
    return joined.select(*(columns or PLAYER_COLUMNS))


# ------------------------------------------------------------------ games


def _two_role_join(
    games_df: DataFrame,
    teams_df: DataFrame,
    home_teams_df: DataFrame | None,
    team_id: int | str | None,
    team_key: str,
    **columns: Column,
) -> DataFrame:
    """games ⋈ teams (away) ⋈ teams (home): one dimension in two roles.

    The games' ``columns`` are made distinct first, so of a game that both teams list
    one row goes through the joins.  Where the dimension is too large to be broadcast, both
    roles read one exchange of it.
    """
    tid = parse_team_id(team_id)
    g = games_df
    if tid is not None:
        g = g.filter((F.col("AwayID") == F.lit(tid)) | (F.col("HomeID") == F.lit(tid)))
    g = g.select("AwayID", "HomeID", *[c.alias(n) for n, c in columns.items()]).distinct().alias("g")
    a = teams_df.alias("a")
    h = (home_teams_df if home_teams_df is not None else teams_df).alias("h")
    return g.join(a, F.col("g.AwayID") == F.col(f"a.{team_key}"), "inner").join(
        h, F.col("g.HomeID") == F.col(f"h.{team_key}"), "inner"
    )


def past_games(
    games_df: DataFrame,
    teams_df: DataFrame,
    *,
    team_id: int | str | None = None,
    home_teams_df: DataFrame | None = None,
    team_key: str = "ID",
    team_name: str = "Team",
) -> DataFrame:
    """Distinct past games (date, teams, scores), league-wide or for one team.

    Each game is listed once per participating team in the source, hence the
    DISTINCT (M1), taken over the projected columns (M2).  Spark plans it as
    partial + final ``HashAggregate``, so duplicates collapse before the
    shuffle.
    """
    kept = {c: F.col(c) for c in ("Date", "AwayScore", "HomeScore")}
    joined = _two_role_join(games_df, teams_df, home_teams_df, team_id, team_key, **kept)
    return joined.select(
        F.col("g.Date").alias("Date"),
        F.col(f"a.{team_name}").alias("Away"),
        F.col("g.AwayScore").alias("AwayScore"),
        F.col(f"h.{team_name}").alias("Home"),
        F.col("g.HomeScore").alias("HomeScore"),
    ).distinct()


def next_games(
    games_df: DataFrame,
    teams_df: DataFrame,
    zone: str = "est",
    *,
    team_id: int | str | None = None,
    home_teams_df: DataFrame | None = None,
    team_key: str = "ID",
    team_name: str = "Team",
    start_column: str = "StartTime",
    clock=utc_clock,
) -> DataFrame:
    """Distinct upcoming games with the start time as a clock in ``zone``."""
    kept = {"Date": F.col("Date"), "Time": clock(F.col(start_column), zone)}
    joined = _two_role_join(games_df, teams_df, home_teams_df, team_id, team_key, **kept)
    return joined.select(
        F.col("g.Date").alias("Date"),
        F.col(f"a.{team_name}").alias("Away"),
        F.col(f"h.{team_name}").alias("Home"),
        F.col("g.Time").alias("Time"),
    ).distinct()


def both_games(
    past_df: DataFrame,
    next_df: DataFrame,
    teams_df: DataFrame,
    zone: str = "est",
    *,
    team_id: int | str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The past and the upcoming games, league-wide or for one team."""
    return past_games(past_df, teams_df, team_id=team_id), next_games(next_df, teams_df, zone, team_id=team_id)


# ---------------------------------------------------------------- preview


class desc(str):
    """Sort key marker: this column descending, nulls last."""


def _sort_column(key: str) -> Column:
    return F.col(key).desc_nulls_last() if isinstance(key, desc) else F.col(key).asc_nulls_first()


def total_order(df: DataFrame, order: Sequence[str]) -> list[Column]:
    """``order`` (names, :class:`desc` for descending) followed by every
    remaining output column ascending, so ties cannot make a top-n ambiguous."""
    named = {str(k) for k in order}
    keys = list(order) + [c for c in df.columns if c not in named]
    return [_sort_column(k) for k in keys]


def preview(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """First ``n`` rows of ``df`` under ``order`` made total (SNK-8 / LIM-1)."""
    if n <= 0:
        raise ValueError("preview needs a positive row count")
    return df.orderBy(*total_order(df, order)).limit(n)


def ordered(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """The whole result in report order (a range-partitioned sort).

    A row id is the last sort key: rows identical in every column are
    interchangeable in the output, but without it they would share one
    range and one sort task however many there are.
    """
    return df.orderBy(*total_order(df, order), F.monotonically_increasing_id())
