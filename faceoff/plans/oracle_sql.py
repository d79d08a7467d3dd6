
from __future__ import annotations

_STANDINGS = (
    "SELECT p.p_name AS team, p.p_type AS conference, p.p_brand AS division, l.l_orderkey, l.l_linenumber, "
    "l.l_quantity, l.l_extendedprice, l.l_discount, l.l_tax, p.p_size, p.p_retailprice FROM lineitem l "
    "INNER JOIN part p ON l.l_partkey * 2 = p.p_partkey {where}"
    "ORDER BY {metric} DESC, l.l_orderkey, l.l_linenumber, l.l_quantity, l.l_extendedprice, l.l_discount, "
    "l.l_tax, team, conference, division, p.p_size, p.p_retailprice LIMIT 32"
)
_METRIC_COLUMNS = {
    "gp": "l.l_linenumber",
    "w": "l.l_quantity",
    "l": "p.p_size",
    "otl": "l.l_discount",
    "pts": "l.l_extendedprice",
    "gpg": "l.l_tax",
    "gapg": "p.p_retailprice",
}

_TEAMS_SCOPED = (
    "SELECT c.c_custkey, c.c_name, c.c_mktsegment, n.n_regionkey AS conference, n.n_name AS division "
    "FROM customer c INNER JOIN nation n ON c.c_custkey % 30 = n.n_nationkey "
)

_PLAYERS = (
    "SELECT c.c_name AS team, o.o_orderkey, o.o_orderpriority AS position, o.o_orderstatus FROM orders o "
    "INNER JOIN customer c ON o.o_custkey * 2 = c.c_custkey"
)

_PAST = (
    "SELECT DISTINCT CAST(g.o_orderdate AS DATE) AS game_date, a.n_name AS away, g.o_orderpriority, "
    "h.n_name AS home, g.o_orderstatus FROM (SELECT *, CAST(o_custkey % 30 AS INT) AS away_id, "
    "CAST(o_orderkey % 25 AS INT) AS home_id FROM (SELECT * FROM orders UNION ALL SELECT * FROM orders) o) g "
    "INNER JOIN nation a ON g.away_id = a.n_nationkey INNER JOIN nation h ON g.home_id = h.n_nationkey"
)


def _clock(offset: int) -> str:
    return (
        f"concat(CAST((hour(e.ts) + 24 - {offset}) % 24 AS VARCHAR(2)), ':', "
        "lpad(CAST(minute(e.ts) AS VARCHAR(2)), 2, '0'))"
    )


def _next(offset: int) -> str:
    return (
        f"SELECT DISTINCT CAST(e.ts AS DATE) AS game_date, a.c_name AS away, h.c_name AS home, {_clock(offset)} "
        "AS Time FROM (SELECT * FROM events UNION ALL SELECT * FROM events) e INNER JOIN customer a "
        "ON e.user_id = a.c_custkey INNER JOIN customer h "
        "ON e.event_id = h.c_custkey"
    )


def _twice(select: str) -> str:
    """Each game is listed by both of its teams."""
    return f"{select} UNION ALL {select}"


_TEAM_IDS_SQL = "24,53,6,7,20,12,16,21,29,25,17,22,13,26,30,8,18,1,2,3,9,4,5,28,55,19,14,10,23,54,15,52"

ORACLE_SQL: dict[str, str] = {
    "teams_all": "SELECT * FROM supplier ORDER BY s_name LIMIT 32",
    "teams_by_conference": _TEAMS_SCOPED + "WHERE n.n_regionkey = 1 ORDER BY division, c.c_custkey LIMIT 20",
    "teams_by_division": _TEAMS_SCOPED + "WHERE n.n_name = 'NATION_3'",
    **{
        f"standings_league_{m}": _STANDINGS.format(where="", metric=col)
        for m, col in _METRIC_COLUMNS.items()
    },
    "standings_conference_pts": _STANDINGS.format(where="WHERE p.p_type = 'ECONOMY' ", metric="l.l_extendedprice"),
    "standings_division_pts": _STANDINGS.format(where="WHERE p.p_brand = 'Brand#17' ", metric="l.l_extendedprice"),
    "standings_ranked": (
        "SELECT CAST(row_number() OVER (ORDER BY l.l_quantity DESC, l.l_orderkey, l.l_linenumber, "
        "l.l_extendedprice, l.l_partkey, l.l_suppkey) AS BIGINT) AS pos, p.p_name AS team, l.l_quantity "
        "FROM lineitem l INNER JOIN part p ON l.l_partkey * 2 = p.p_partkey "
        "WHERE p.p_brand = 'Brand#17'"
    ),
    "players_all": _PLAYERS,
    "players_by_position": _PLAYERS + " WHERE o.o_orderpriority = '1-URGENT'",
    "players_by_team": _PLAYERS + " WHERE o.o_custkey * 2 = 42",
    "players_preview": _PLAYERS + " ORDER BY team, o.o_orderkey LIMIT 900",
    "past_games_all": _PAST,
    "past_games_by_team": _PAST + " WHERE g.away_id = 7 OR g.home_id = 7",
    "past_games_preview": _PAST + " ORDER BY game_date, away, home, g.o_orderpriority, g.o_orderstatus LIMIT 20",
    "next_games_est": _next(4),
    "next_games_cst": _next(5),
    "next_games_mst": _next(6),
    "next_games_pst": _next(7),
    "next_games_by_team": _next(4) + " WHERE e.user_id = 8 OR e.event_id = 8",
    "next_games_preview": _next(4) + " ORDER BY game_date, away, home, Time LIMIT 20",
    "utc_clock_shift": (
        f"SELECT e.event_id, {_clock(4)} AS est, {_clock(5)} AS cst, {_clock(6)} AS mst, {_clock(7)} AS pst "
        "FROM events e"
    ),
    "partitioned_insert_readback": (
        "SELECT o_orderkey, o_orderstatus, o_orderpriority, o_totalprice, o_custkey FROM orders "
        f"WHERE o_custkey IN ({_TEAM_IDS_SQL})"
    ),
    "table_insert_if_absent": (
        "SELECT * FROM customer UNION ALL SELECT x.* FROM (SELECT CAST(5 AS BIGINT) AS c_custkey, 'dup' AS c_name, "
        "1 AS c_nationkey, CAST(0 AS DOUBLE) AS c_acctbal, 'NEW' AS c_mktsegment UNION ALL SELECT CAST(-1 AS BIGINT), "
        "'new', 1, CAST(0 AS DOUBLE), 'NEW') x WHERE NOT EXISTS (SELECT 1 FROM customer c "
        "WHERE c.c_custkey = x.c_custkey)"
    ),
    "table_update_by_key": (
        "SELECT c_custkey, c_name, c_nationkey, c_acctbal, CASE WHEN c_custkey = 42 THEN 'PST' ELSE c_mktsegment "
        "END AS c_mktsegment FROM customer"
    ),
    "table_delete_by_key": "SELECT * FROM customer WHERE c_custkey <> 42",
    "table_keyed_lookup": "SELECT c_mktsegment, c_nationkey FROM customer WHERE c_custkey = 42",
    "table_projection_view": "SELECT c_custkey, c_name, c_mktsegment FROM customer",
    "json_nested_ingest": "SELECT conv_id, turn, role, text FROM conversations",
    "json_first_element": (
        "SELECT conv_id, turn, role FROM conversations c WHERE turn = (SELECT min(turn) FROM conversations m "
        "WHERE m.conv_id = c.conv_id)"
    ),
    "json_scalar": "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
    "normalize_key": (
        "SELECT c_custkey, regexp_replace(lower(concat(' ', c_name, chr(9))), '\\s', '', 'g') AS k, "
        "upper(c_mktsegment) AS label FROM customer"
    ),
    "delimited_roundtrip": "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part",
    "schedule_past_ingest": _twice(
        "SELECT CAST(o_orderkey AS VARCHAR) AS GameID, CAST(o_custkey % 30 AS INTEGER) AS AwayID, "
        "CAST(o_custkey % 7 AS INTEGER) AS AwayScore, CAST(o_orderkey % 25 AS INTEGER) AS HomeID, "
        "CAST(o_orderkey % 5 AS INTEGER) AS HomeScore, CAST(o_orderdate AS DATE) AS \"Date\" FROM orders"
    ),
    "schedule_next_ingest": _twice(
        "SELECT CAST(event_id AS VARCHAR) AS GameID, CAST(user_id % 30 AS INTEGER) AS AwayID, "
        "CAST(event_id % 25 AS INTEGER) AS HomeID, CAST(ts AS DATE) AS \"Date\", "
        "date_trunc('second', ts) AS StartTime FROM events"
    ),
    "roster_ingest": (
        "SELECT CAST(o_orderkey % 2147483647 AS INTEGER) AS ID, 'Player ' || CAST(o_orderkey AS VARCHAR) || ': ' "
        "|| o_orderstatus || ', ' || o_orderpriority AS FullName, o_orderpriority AS Position, "
        "CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE CAST(o_orderkey % 99 AS VARCHAR) END AS JerseyNumber, "
        "CAST(o_custkey % 40 AS INTEGER) AS TeamID FROM orders"
    ),
    "stats_ingest": (
        "SELECT CAST(s_suppkey AS INTEGER) AS TeamID, 'Conference ' || CAST(s_nationkey % 2 AS VARCHAR) AS Conference, "
        "'Division ' || CAST(s_nationkey % 4 AS VARCHAR) AS Division, s_nationkey AS GP, "
        "CAST(s_suppkey % 50 AS INTEGER) AS W, CAST(s_suppkey % 30 AS INTEGER) AS L, "
        "CAST(s_suppkey % 7 AS INTEGER) AS OTL, CAST(s_suppkey % 100 AS INTEGER) AS PTS, "
        "s_acctbal / 1000 AS GPG, s_acctbal AS GAPG FROM supplier"
    ),
    "refresh_standings_report": (
        "SELECT s_name AS Team, 'Conference 1' AS Conference, 'Division ' || CAST(s_nationkey % 4 AS VARCHAR) "
        "AS Division, s_nationkey AS GP, CAST(s_suppkey % 50 AS INTEGER) AS W, CAST(s_suppkey % 30 AS INTEGER) AS L, "
        "CAST(s_suppkey % 7 AS INTEGER) AS OTL, CAST(s_suppkey % 100 AS INTEGER) AS PTS, s_acctbal / 1000 AS GPG, "
        "s_acctbal AS GAPG FROM supplier WHERE s_nationkey % 2 = 1 ORDER BY PTS DESC, Team LIMIT 32"
    ),
    "refresh_past_games_report": (
        "SELECT DISTINCT CAST(o.o_orderdate AS DATE) AS \"Date\", a.s_name AS Away, "
        "CAST(o.o_custkey % 7 AS INTEGER) AS AwayScore, h.s_name AS Home, CAST(o.o_orderkey % 5 AS INTEGER) "
        "AS HomeScore FROM orders o INNER JOIN supplier a ON a.s_suppkey = o.o_custkey % 30 "
        "INNER JOIN supplier h ON h.s_suppkey = o.o_orderkey % 25"
    ),
    "stream_refresh_teams": (
        "SELECT CAST(s_suppkey AS INTEGER) AS ID, s_name AS Team, right(s_name, 3) AS ABB, "
        "'Nation ' || CAST(s_nationkey AS VARCHAR) AS Location, 'Club ' || CAST(s_suppkey AS VARCHAR) AS Name "
        "FROM supplier"
    ),
    "refresh_roster_partitions": (
        "SELECT CAST(o_orderkey % 2147483647 AS INTEGER) AS ID, 'Player ' || CAST(o_orderkey AS VARCHAR) || ': ' "
        "|| o_orderstatus || ', ' || o_orderpriority AS FullName, o_orderpriority AS Position, "
        "CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE CAST(o_orderkey % 99 AS VARCHAR) END AS JerseyNumber, "
        f"CAST(o_custkey % 40 AS INTEGER) AS TeamID FROM orders WHERE o_custkey % 40 IN ({_TEAM_IDS_SQL})"
    ),
    "refresh_next_games_report": (
        f"SELECT DISTINCT CAST(e.ts AS DATE) AS \"Date\", a.s_name AS Away, h.s_name AS Home, {_clock(7)} AS \"Time\" "
        "FROM events e INNER JOIN supplier a ON a.s_suppkey = e.user_id % 30 "
        "INNER JOIN supplier h ON h.s_suppkey = e.event_id % 25"
    ),
    "refresh_rejects": "SELECT '{\"teams\": [{\"id\": ' || CAST(s_suppkey AS VARCHAR) AS raw FROM supplier",
    "refresh_changes": """
WITH team AS (
  SELECT CAST(s_suppkey AS INTEGER) AS ID, s_name AS Team, right(s_name, 3) AS ABB,
         'Nation ' || CAST(s_nationkey AS VARCHAR) AS Location, 'Club ' || CAST(s_suppkey AS VARCHAR) AS Name FROM supplier
)
SELECT 'removed' AS change, * FROM team WHERE ID % 7 = 0
UNION ALL SELECT 'changed', ID, Team || '*', ABB, Location, Name FROM team WHERE ID % 7 = 1
UNION ALL SELECT 'added', -ID, Team, ABB, Location, Name FROM team WHERE ID % 7 = 2
""",
    "partitioned_append": (
        "SELECT o_orderkey, o_orderstatus, o_orderpriority, o_totalprice, o_custkey % 25 AS o_custkey FROM orders"
    ),
    "snapshot_as_of": (
        "SELECT p_partkey, p_name, r AS read_as FROM part, (VALUES ('begun before'), ('version 1')) v(r) "
        "UNION ALL SELECT p_partkey, upper(p_name), 'now' FROM part WHERE p_partkey % 3 <> 0"
    ),
    "table_merge": """
WITH change AS (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal, 'MERGED' AS c_mktsegment,
         CASE c_custkey % 5 WHEN 1 THEN 'update' WHEN 2 THEN 'delete' ELSE 'insert' END AS op,
         CASE c_custkey % 5 WHEN 1 THEN 'updated' WHEN 2 THEN 'deleted' ELSE 'refused' END AS outcome
  FROM customer WHERE c_custkey % 5 IN (1, 2, 3)
  UNION ALL
  SELECT -c_custkey, c_name, c_nationkey, c_acctbal, 'MERGED',
         CASE c_custkey % 5 WHEN 1 THEN 'upsert' WHEN 2 THEN 'update' WHEN 3 THEN 'delete' ELSE 'insert' END,
         CASE WHEN c_custkey % 5 IN (1, 2, 3) THEN 'refused' ELSE 'inserted' END
  FROM customer WHERE c_custkey <> 0
), after AS (
  SELECT c.c_custkey, c.c_name, c.c_nationkey, c.c_acctbal,
         CASE WHEN c.c_custkey % 5 = 1 THEN 'MERGED' ELSE c.c_mktsegment END AS c_mktsegment
  FROM customer c WHERE c.c_custkey % 5 <> 2
  UNION ALL
  SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM change WHERE outcome = 'inserted'
)
SELECT coalesce(a.c_custkey, x.c_custkey) AS c_custkey, a.c_name, a.c_nationkey, a.c_acctbal, a.c_mktsegment, x.op, x.outcome
FROM after a FULL OUTER JOIN change x ON a.c_custkey = x.c_custkey
""",
    "table_growth": "SELECT o_orderkey, o_custkey, o_totalprice, TRUE AS kept_size FROM orders",
    "table_delete_many": "SELECT * FROM supplier WHERE s_suppkey NOT IN (SELECT 2 * o_custkey FROM orders)",
    "table_truncate_reload": "SELECT c_custkey, lower(c_name) AS c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "accounts_register": (
        "WITH a AS (SELECT 'customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS u, "
        "list_extract(['est', 'cst', 'mst', 'pst'], o_orderkey % 4 + 1) AS z, "
        "row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k FROM orders) "
        "SELECT u AS \"Username\", 'basic' AS \"UserType\", z AS \"Timezone\", "
        "CASE WHEN k = 1 THEN 'account' ELSE 'repeated' END AS outcome FROM a UNION ALL "
        "SELECT lower(c_name), 'admin', 'est', CASE WHEN lower(c_name) IN (SELECT u FROM a) THEN 'taken' "
        "ELSE 'account' END FROM customer"
    ),
    "delimited_guard": (
        "SELECT doc_id, CASE WHEN refused THEN NULL ELSE text END AS text, refused FROM (SELECT doc_id, text, "
        "coalesce(contains(text, ',') OR contains(text, chr(10)) OR contains(text, chr(13)) OR text = '\\N', false) "
        "AS refused FROM documents)"
    ),
    "java_trim_text": (
        "SELECT doc_id, regexp_replace(text, '\\A[\\x00-\\x20]+|[\\x00-\\x20]+\\z', '', 'g') AS trimmed FROM documents"
    ),
    "refresh_all_games": (
        "SELECT DISTINCT CAST(o.o_orderdate AS DATE) AS \"Date\", a.s_name AS Away, "
        "CAST(o.o_custkey % 7 AS INTEGER) AS AwayScore, h.s_name AS Home, CAST(o.o_orderkey % 5 AS INTEGER) "
        "AS HomeScore, CAST(NULL AS VARCHAR) AS \"Time\" FROM orders o INNER JOIN supplier a "
        "ON a.s_suppkey = o.o_custkey % 30 INNER JOIN supplier h ON h.s_suppkey = o.o_orderkey % 25 UNION ALL "
        f"SELECT DISTINCT CAST(e.ts AS DATE), a.s_name, NULL, h.s_name, NULL, {_clock(6)} "
        "FROM events e INNER JOIN supplier a ON a.s_suppkey = e.user_id % 30 "
        "INNER JOIN supplier h ON h.s_suppkey = e.event_id % 25"
    ),
}
ORACLE_SQL["refresh_not_next"] = f"SELECT *, FALSE AS has_next_games FROM ({ORACLE_SQL['refresh_past_games_report']})"
