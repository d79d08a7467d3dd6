"""Named queries over the driver's test tables.

ingest functions on documents built from whole tables, refreshes followed by
a report, and the table, account and text operators that the 38 leave out.  Every callable takes ``(spark, sf_dir)`` and
returns a DataFrame built with the library's operators over the whole test
tables.  ``oracle_sql.ORACLE_SQL`` holds the DuckDB text each result is
compared with.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql import types as Types

from faceoff import functions as Fn
from faceoff import schemas as S
from faceoff.functions import utc_clock
from faceoff.operators import reports as R
from faceoff.operators import tables as T
from faceoff.operators.ranking import global_row_number
from faceoff.plans import accounts as Acc
from faceoff.plans import analogs as A
from faceoff.plans.refresh import PARTITIONED_TEAM_IDS, refresh
from faceoff.plans.refresh import refresh_changes as changes_of_refresh
from faceoff.session import scratch_dir
from faceoff.sources import delimited as Dl
from faceoff.sources import documents as D
from faceoff.sources import ingest
from faceoff.streaming.landing import refresh_on_arrival

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
EXTRA: set[str] = set()


def register(name: str, extra: bool = False):
    def wrap(fn: Query) -> Query:
        QUERIES[name] = fn
        if extra:
            EXTRA.add(name)
        return fn

    return wrap


# ------------------------------------------------------------------ teams


@register("teams_all")
def teams_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = R.teams(A.supplier_teams(spark, sf_dir))
    return A.rename(R.preview(report, R.TEAMS_ORDER, 32), A.inverse(A.SUPPLIER_AS_TEAMS))


def _teams_scoped(spark: SparkSession, sf_dir: str, **scope) -> DataFrame:
    return R.teams(
        A.customer_teams(spark, sf_dir),
        A.nation_standings(spark, sf_dir),
        columns=A.TEAMS_SCOPE_COLUMNS,
        **scope,
    )


@register("teams_by_conference")
def teams_by_conference(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = _teams_scoped(spark, sf_dir, conference=1)
    return A.rename(R.preview(report, R.CONFERENCE_ORDER, 20), A.TEAMS_SCOPE_OUT)


@register("teams_by_division")
def teams_by_division(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.rename(_teams_scoped(spark, sf_dir, division="NATION_3"), A.TEAMS_SCOPE_OUT)


# -------------------------------------------------------------- standings


def _standings(spark: SparkSession, sf_dir: str, metric: str, n: int = 32, **scope) -> DataFrame:
    report = R.standings(
        A.lineitem_standings(spark, sf_dir),
        A.part_teams(spark, sf_dir),
        columns=A.STANDINGS_ANALOG_COLUMNS,
        **scope,
    )
    top = R.preview(report, R.standings_order(metric, A.STANDINGS_ANALOG_TIES), n)
    return A.rename(top, A.STANDINGS_OUT)


def _standings_query(metric: str):
    return lambda spark, sf_dir: _standings(spark, sf_dir, metric)


for _metric in ("GP", "W", "L", "OTL", "PTS", "GPG", "GAPG"):
    register(f"standings_league_{_metric.lower()}")(_standings_query(_metric))


@register("standings_conference_pts")
def standings_conference_pts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _standings(spark, sf_dir, "PTS", conference="ECONOMY")


@register("standings_division_pts")
def standings_division_pts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _standings(spark, sf_dir, "PTS", division="Brand#17")


@register("standings_ranked")
def standings_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole division table with each row's position under the W ordering."""
    report = R.standings(
        A.lineitem_standings(spark, sf_dir),
        A.part_teams(spark, sf_dir),
        division="Brand#17",
        columns=("Team", "W", "l_orderkey", "GP", "PTS", "TeamID", "l_suppkey"),
    )
    ranked = global_row_number(
        report, [R.desc("W"), "l_orderkey", "GP", "PTS", "TeamID", "l_suppkey"], name="pos"
    )
    return ranked.select("pos", F.col("Team").alias("team"), F.col("W").alias("l_quantity"))


# ---------------------------------------------------------------- players


def _players(spark: SparkSession, sf_dir: str, **params) -> DataFrame:
    return R.players(A.orders_players(spark, sf_dir), A.customer_player_teams(spark, sf_dir), **params)


@register("players_all")
def players_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.rename(_players(spark, sf_dir), A.PLAYERS_OUT)


@register("players_by_position")
def players_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.rename(_players(spark, sf_dir, position="1-URGENT"), A.PLAYERS_OUT)


@register("players_by_team")
def players_by_team(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.rename(_players(spark, sf_dir, team_id=42), A.PLAYERS_OUT)


@register("players_preview")
def players_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.rename(R.preview(_players(spark, sf_dir), R.PLAYERS_ORDER, 900), A.PLAYERS_OUT)


# ------------------------------------------------------------------ games


def _past(spark: SparkSession, sf_dir: str, **params) -> DataFrame:
    return R.past_games(A.orders_past_games(spark, sf_dir), A.nation_teams(spark, sf_dir), **params)


@register("past_games_all")
def past_games_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.rename(_past(spark, sf_dir), A.PAST_GAMES_OUT)


@register("past_games_by_team")
def past_games_by_team(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.rename(_past(spark, sf_dir, team_id=7), A.PAST_GAMES_OUT)


@register("past_games_preview")
def past_games_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.rename(R.preview(_past(spark, sf_dir), R.PAST_GAMES_ORDER, 20), A.PAST_GAMES_OUT)


def _next(spark: SparkSession, sf_dir: str, zone: str, **params) -> DataFrame:
    return R.next_games(
        A.events_next_games(spark, sf_dir),
        A.customer_game_teams(spark, sf_dir),
        zone,
        home_teams_df=A.customer_game_teams(spark, sf_dir),
        **params,
    )


def _next_query(zone: str):
    return lambda spark, sf_dir: A.rename(_next(spark, sf_dir, zone), A.NEXT_GAMES_OUT)


for _zone in ("est", "cst", "mst", "pst"):
    register(f"next_games_{_zone}")(_next_query(_zone))


@register("next_games_by_team")
def next_games_by_team(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.rename(_next(spark, sf_dir, "est", team_id=8), A.NEXT_GAMES_OUT)


@register("next_games_preview")
def next_games_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.rename(R.preview(_next(spark, sf_dir, "est"), R.NEXT_GAMES_ORDER, 20), A.NEXT_GAMES_OUT)


@register("utc_clock_shift")
def utc_clock_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = A.table(spark, sf_dir, "events")
    return events.select("event_id", *[utc_clock("ts", z).alias(z) for z in ("est", "cst", "mst", "pst")])


# ------------------------------------------------------ partitioned insert

TEAM_IDS = PARTITIONED_TEAM_IDS


@register("partitioned_insert_readback")
def partitioned_insert_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = T.create_database(spark)
    name = f"{db}.partiPlayers"
    T.insert_partitioned(spark, A.orders_roster(spark, sf_dir), name, "TeamID", TEAM_IDS, sort_by=["Position"])
    back = T.read_partitions(spark, name, "TeamID", TEAM_IDS)
    return A.rename(back, A.inverse(A.ORDERS_AS_ROSTER))


@register("partitioned_append", extra=True)
def partitioned_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-4 adding rows: two batches go to the same partitions, and the first is run again."""
    name = f"{T.create_database(spark)}.rosters"
    rows = A.orders_roster(spark, sf_dir).withColumn("TeamID", F.pmod("TeamID", F.lit(25)))
    halves = {str(k): rows.filter(F.pmod(F.col("ID"), F.lit(2)) == k) for k in (0, 1)}
    for batch in ("0", "1", "0"):
        T.append_partitioned(spark, halves[batch], name, "TeamID", batch, sort_by=["Position"])
    return A.rename(T.read_partitions(spark, name, "TeamID"), A.inverse(A.ORDERS_AS_ROSTER))


@register("snapshot_as_of", extra=True)
def snapshot_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-2: the first snapshot by a reader that began before the switch and by its number, beside the second."""
    name, part = f"{T.create_database(spark)}.parts", A.table(spark, sf_dir, "part").select("p_partkey", "p_name")
    T.replace_snapshot(spark, name, part)
    began = spark.table(name).withColumn("read_as", F.lit("begun before"))
    T.replace_snapshot(spark, name, part.filter("p_partkey % 3 <> 0").withColumn("p_name", F.upper("p_name")))
    numbered = T.snapshot_as_of(spark, name, version=1).withColumn("read_as", F.lit("version 1"))
    return began.union(numbered).union(spark.table(name).withColumn("read_as", F.lit("now")))


# ------------------------------------------------------------ keyed tables


# the same at every size, so that pruning and partial rewrites are at work in small runs too
USER_BUCKETS = T.DEFAULT_BUCKETS


def _users(spark: SparkSession, sf_dir: str) -> str:
    customer = A.table(spark, sf_dir, "customer")
    name = f"{T.create_database(spark)}.users"
    T.create_keyed_table(spark, name, customer.schema, A.USERS_KEY, buckets=USER_BUCKETS)
    T.append_rows(spark, name, customer)
    return name


_KEPT_USERS: dict[tuple, str] = {}


def _kept_users(spark: SparkSession, sf_dir: str) -> str:
    """The users table of queries that only read it: filled once a session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _KEPT_USERS or not T.table_exists(spark, _KEPT_USERS[key]):
        _KEPT_USERS[key] = _users(spark, sf_dir)
    return _KEPT_USERS[key]


@register("table_insert_if_absent")
def table_insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _users(spark, sf_dir)
    schema = spark.table(name).drop(T.BUCKET).schema
    new = spark.createDataFrame([(5, "dup", 1, 0.0, "NEW"), (-1, "new", 1, 0.0, "NEW")], schema)
    T.insert_if_absent(spark, name, new)
    return T.read_table(spark, name)


@register("table_update_by_key")
def table_update_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _users(spark, sf_dir)
    T.update_by_key(spark, name, spark.createDataFrame([(42, "PST")], "c_custkey BIGINT, c_mktsegment STRING"))
    return T.read_table(spark, name)


@register("table_delete_by_key")
def table_delete_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _users(spark, sf_dir)
    T.delete_by_key(spark, name, spark.createDataFrame([(42,)], "c_custkey BIGINT"))
    return T.read_table(spark, name)


@register("table_keyed_lookup")
def table_keyed_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.lookup(spark, _kept_users(spark, sf_dir), 42, ["c_mktsegment", "c_nationkey"])


@register("table_projection_view")
def table_projection_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _kept_users(spark, sf_dir)
    return T.projection_view(spark, name, f"users_public_{name.split('.')[0]}", ["c_custkey", "c_name", "c_mktsegment"])


@register("table_merge", extra=True)
def table_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MNT-1/2/3 as one change set over every customer: the table afterwards, beside each change's outcome."""
    customer = A.table(spark, sf_dir, "customer")
    name, fifth = _users(spark, sf_dir), F.col("c_custkey") % 5
    of_old = F.when(fifth == 1, "update").when(fifth == 2, "delete").when(fifth == 3, "insert")
    of_new = F.when(fifth == 1, "upsert").when(fifth == 2, "update").when(fifth == 3, "delete").otherwise("insert")
    old = customer.filter(fifth.isin(1, 2, 3)).withColumn("op", of_old)
    new = customer.filter("c_custkey <> 0").withColumn("op", of_new).withColumn("c_custkey", -F.col("c_custkey"))
    changes = old.unionByName(new).withColumn("c_mktsegment", F.lit("MERGED"))
    outcome = T.merge(spark, name, changes, update_columns=["c_mktsegment"])
    return T.read_table(spark, name).join(outcome, "c_custkey", "full_outer")


GROWING_BUCKET_ROWS = 1500


@register("table_growth", extra=True)
def table_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MNT-6: a keyed table of two buckets loaded in ten rounds; its rows, and whether their bucket kept its size."""
    orders = A.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    name = f"{T.create_database(spark)}.growing"
    T.create_keyed_table(spark, name, orders.schema, "o_orderkey", buckets=2, rows_per_bucket=GROWING_BUCKET_ROWS)
    for k in range(10):
        T.append_rows(spark, name, orders.filter(F.col("o_orderkey") % 10 == k))
    rows = spark.table(name)
    # a bucket not split yet in its level holds up to twice the mean
    sizes = rows.groupBy(T.BUCKET).agg((F.count("*") < 3 * GROWING_BUCKET_ROWS).alias("kept_size"))
    return rows.join(sizes, T.BUCKET).drop(T.BUCKET)


@register("table_delete_many", extra=True)
def table_delete_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MNT-3 with the keys of a whole table; in small runs many buckets lose all of their rows."""
    supplier = A.table(spark, sf_dir, "supplier")
    name = f"{T.create_database(spark)}.suppliers"
    T.create_keyed_table(spark, name, supplier.schema, "s_suppkey", buckets=64)
    T.append_rows(spark, name, supplier)
    T.delete_by_key(spark, name, A.table(spark, sf_dir, "orders").select((2 * F.col("o_custkey")).alias("s_suppkey")))
    return T.read_table(spark, name)


@register("table_truncate_reload", extra=True)
def table_truncate_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-9, SNK-7, MNT-6: the table is created unless it exists, filled, emptied and filled anew."""
    customer = A.table(spark, sf_dir, "customer")
    name = f"{T.create_database(spark)}.users"
    for rows in (customer, customer.withColumn("c_name", F.lower("c_name"))):
        if T.table_exists(spark, name):
            T.truncate(spark, name)
        else:
            T.create_keyed_table(spark, name, customer.schema, A.USERS_KEY, buckets=USER_BUCKETS)
        T.append_rows(spark, name, rows)
    return T.read_table(spark, name)


@register("accounts_register", extra=True)
def accounts_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MNT-1, MNT-6: accounts asked for by every order, then by every customer; who got one, who was refused and why."""
    name = f"{T.create_database(spark)}.users"
    zones = F.array(*[F.lit(z) for z in ("EST", "CST", "MST", "PST")])
    of_orders = A.table(spark, sf_dir, "orders").select(
        F.concat(F.lit(" Customer #\t"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("Username"),
        F.lit("pw").alias("Password"), F.lit("Basic").alias("UserType"),
        F.get(zones, (F.col("o_orderkey") % 4).cast("int")).alias("Timezone"), "o_orderkey",
    )
    of_customers = A.table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("Username"), F.lit("pw").alias("Password"), F.lit("admin").alias("UserType"),
        F.lit("est").alias("Timezone"),
    )
    refused = Acc.register(spark, name, of_orders, order_by="o_orderkey").union(Acc.register(spark, name, of_customers))
    accounts = Acc.list_users(spark, name).withColumn("reason", F.lit("account"))
    return accounts.union(refused).withColumnRenamed("reason", "outcome")


# -------------------------------------------------------------- documents


def _conversation_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the conversation documents as JSON lines, read them back typed."""
    path = scratch_dir(spark, "docs")
    A.conversation_documents(spark, sf_dir).write.json(path)
    return D.read_documents(spark, path, Types.StructType.fromDDL(A.CONVERSATION_DOC_DDL))


@register("json_nested_ingest")
def json_nested_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _conversation_docs(spark, sf_dir)
    turns = D.explode_path(docs, "turns", keep=["conv_id"], alias="t")
    return turns.select("conv_id", "t.turn", "t.role", "t.text")


@register("json_first_element")
def json_first_element(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First turn of each conversation: element 0 of each (sorted) document page,
    then the smallest of those per conversation (partial aggregation)."""
    docs = _conversation_docs(spark, sf_dir)
    first = D.first_element("turns")
    firsts = docs.select("conv_id", F.struct(first["turn"].alias("turn"), first["role"].alias("role")).alias("f"))
    per_conv = firsts.groupBy("conv_id").agg(F.min("f").alias("f"))
    return per_conv.select("conv_id", "f.turn", "f.role")


@register("json_scalar")
def json_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = A.table(spark, sf_dir, "events")
    return events.select("event_id", Fn.json_scalar("props", "k", cast="int").alias("k"))


@register("normalize_key")
def normalize_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = A.table(spark, sf_dir, "customer")
    padded = F.concat(F.lit(" "), F.col("c_name"), F.lit("\t"))
    return customer.select("c_custkey", Fn.normalize_key(padded).alias("k"), Fn.label("c_mktsegment").alias("label"))


@register("delimited_roundtrip")
def delimited_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = A.table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"
    )
    path = scratch_dir(spark, "delimited")
    Dl.write_delimited(part, path)
    return Dl.read_delimited(spark, path, part.schema)


@register("delimited_guard", extra=True)
def delimited_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN-12: texts that the format can carry go through it, the others are named."""
    docs = A.table(spark, sf_dir, "documents").select("doc_id", "text", Dl.unreadable(F.col("text")).alias("refused"))
    path = scratch_dir(spark, "delimited")
    carried = docs.filter("NOT refused").select("doc_id", "text")
    Dl.write_delimited(carried, path)
    back = Dl.read_delimited(spark, path, carried.schema).withColumn("refused", F.lit(False))
    return back.union(docs.filter("refused").select("doc_id", F.lit(None).cast("string").alias("text"), "refused"))


@register("java_trim_text", extra=True)
def java_trim_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN-2 over whole texts set between control characters and blanks."""
    padded = F.concat(F.lit("\x01\t "), F.col("text"), F.lit(" \r\n\x1f"))
    return A.table(spark, sf_dir, "documents").select("doc_id", Fn.java_trim(padded).alias("trimmed"))


# ------------------------------------------ league documents through ingest


def _write_read(spark: SparkSession, docs: DataFrame, schema: Types.StructType, text: bool = False) -> DataFrame:
    path = scratch_dir(spark, "league-docs")
    (docs.write.text(path) if text else docs.write.json(path))
    return D.read_documents(spark, path, schema)


@register("schedule_past_ingest", extra=True)
def schedule_past_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-1: schedule documents (3 nesting levels, games listed by both teams) → past games."""
    docs = _write_read(spark, A.orders_schedule(spark, sf_dir), S.schedule_document("previousGameSchedule"))
    return ingest.past_games(docs)


@register("schedule_next_ingest", extra=True)
def schedule_next_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-2: next-schedule documents → next games with the UTC start instant."""
    docs = _write_read(spark, A.events_schedule(spark, sf_dir), S.schedule_document("nextGameSchedule"))
    return ingest.next_games(docs)


@register("roster_ingest", extra=True)
def roster_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-3: roster documents → players with the team id carried down."""
    return ingest.players(_write_read(spark, A.orders_roster_documents(spark, sf_dir), S.roster_document()))


@register("stats_ingest", extra=True)
def stats_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-5: stats documents (numbers in split 0, rank text in split 1) → standings."""
    return ingest.standings(_write_read(spark, A.supplier_stats_text(spark, sf_dir), S.stats_document(), text=True))


# ------------------------------------------- refresh, then report (end to end)


def _landing(spark: SparkSession, docs: DataFrame, text: bool = False) -> str:
    path = scratch_dir(spark, "landing")
    (docs.write.text(path) if text else docs.write.json(path))
    return path


@register("refresh_standings_report", extra=True)
def refresh_standings_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """§2.4 + SNK-2: teams and stats documents → refresh → conference standings, top 32 by points."""
    db = T.create_database(spark)
    sources = {
        "teams": _landing(spark, A.supplier_teams_documents(spark, sf_dir)),
        "stats": _landing(spark, A.supplier_stats_text(spark, sf_dir), text=True),
    }
    refresh(spark, "teams", sources, database=db, multi_line=False)
    refresh(spark, "standings", sources, database=db, multi_line=False)
    report = R.standings(spark.table(f"{db}.standings"), spark.table(f"{db}.teams"), conference="Conference 1")
    return R.preview(report, R.standings_order("PTS"), 32)


@register("refresh_past_games_report", extra=True)
def refresh_past_games_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """§2.4 + SNK-2: teams and schedule documents → refresh → distinct past games."""
    db = T.create_database(spark)
    sources = {
        "teams": _landing(spark, A.supplier_teams_documents(spark, sf_dir)),
        "schedule_previous": _landing(spark, A.orders_schedule(spark, sf_dir)),
    }
    refresh(spark, "teams", sources, database=db, multi_line=False)
    refresh(spark, "last game", sources, database=db, multi_line=False)
    return R.past_games(spark.table(f"{db}.pastGames"), spark.table(f"{db}.teams"))


@register("refresh_roster_partitions", extra=True)
def refresh_roster_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """§2.4 + SNK-4: roster documents → refresh → the players table partitioned by team."""
    db = T.create_database(spark)
    sources = {"roster": _landing(spark, A.orders_roster_documents(spark, sf_dir))}
    refresh(spark, "roster", sources, database=db, multi_line=False)
    return T.read_partitions(spark, f"{db}.partiPlayers", "TeamID", PARTITIONED_TEAM_IDS)


@register("refresh_next_games_report", extra=True)
def refresh_next_games_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """§2.4 + SNK-2: teams and schedule documents → refresh → upcoming games in Pacific time."""
    db = T.create_database(spark)
    sources = {
        "teams": _landing(spark, A.supplier_teams_documents(spark, sf_dir)),
        "schedule_next": _landing(spark, A.events_schedule(spark, sf_dir)),
    }
    refresh(spark, "teams", sources, database=db, multi_line=False)
    refresh(spark, "next game", sources, database=db, multi_line=False)
    return R.next_games(spark.table(f"{db}.nextGames"), spark.table(f"{db}.teams"), "pst")


@register("refresh_all_games", extra=True)
def refresh_all_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """§2.4, §2.14: every document kind → one refresh of all tables → past and upcoming games together."""
    db = T.create_database(spark)
    sources = {
        "teams": _landing(spark, A.supplier_teams_documents(spark, sf_dir)),
        "roster": _landing(spark, A.orders_roster_documents(spark, sf_dir)),
        "stats": _landing(spark, A.supplier_stats_text(spark, sf_dir), text=True),
        "schedule_previous": _landing(spark, A.orders_schedule(spark, sf_dir)),
        "schedule_next": _landing(spark, A.events_schedule(spark, sf_dir)),
    }
    refresh(spark, "all", sources, database=db, multi_line=False)
    past, upcoming = R.both_games(*[spark.table(f"{db}.{t}") for t in ("pastGames", "nextGames", "teams")], "mst")
    return past.unionByName(upcoming, allowMissingColumns=True)


@register("refresh_changes", extra=True)
def refresh_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """§2.4 by difference: four generations of teams documents, two of them repeats, which write nothing; what the last change was."""
    db, folder = T.create_database(spark), scratch_dir(spark, "landing")
    old = A.supplier_teams_documents(spark, sf_dir)
    seventh = lambda t: t["id"] % 7
    renamed = lambda t: F.when(seventh(t) == 1, t.withField("name", F.concat(t["name"], F.lit("*")))).otherwise(t)
    stayed = old.select(F.transform(F.filter("teams", lambda t: seventh(t) != 0), renamed).alias("teams"))
    joined = old.select(F.transform(F.filter("teams", lambda t: seventh(t) == 2), lambda t: t.withField("id", -t["id"])).alias("teams"))
    for k, docs in enumerate([old, old, stayed.union(joined), joined.union(stayed)], 1):
        docs.write.json(f"{folder}/generation={k}")
        D.mark_complete(spark, f"{folder}/generation={k}")
        refresh(spark, "teams", {"teams": folder}, database=db, multi_line=False, only_changed=True)
    return changes_of_refresh(spark, "teams", db)


@register("refresh_not_next", extra=True)
def refresh_not_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    """§2.4, trigger ``notNext``: every table but the upcoming games, of which there is no document; then the past games."""
    db = T.create_database(spark)
    sources = {
        "teams": _landing(spark, A.supplier_teams_documents(spark, sf_dir)),
        "roster": _landing(spark, A.orders_roster_documents(spark, sf_dir)),
        "stats": _landing(spark, A.supplier_stats_text(spark, sf_dir), text=True),
        "schedule_previous": _landing(spark, A.orders_schedule(spark, sf_dir)),
    }
    refresh(spark, "notNext", sources, database=db, multi_line=False)
    past = R.past_games(spark.table(f"{db}.pastGames"), spark.table(f"{db}.teams"))
    return past.withColumn("has_next_games", F.lit(T.table_exists(spark, f"{db}.nextGames")))


@register("refresh_rejects", extra=True)
def refresh_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents cut off in the middle, one a supplier, among whole ones: all are listed with their text."""
    db, path = T.create_database(spark), _landing(spark, A.supplier_teams_documents(spark, sf_dir))
    cut = F.concat(F.lit('{"teams": [{"id": '), F.col("s_suppkey").cast("string"))
    A.table(spark, sf_dir, "supplier").select(cut.alias("value")).write.mode("append").text(path)
    refresh(spark, "teams", {"teams": path}, database=db, multi_line=False, on_corrupt="keep")
    return spark.table(f"{db}.teams__rejected").select("raw")


@register("stream_refresh_teams", extra=True)
def stream_refresh_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streaming refresh: a generation of teams documents lands in two parts; ``availableNow``
    file-source queries see both, and the snapshot is replaced once the generation is complete."""
    db, folder, progress = T.create_database(spark), scratch_dir(spark, "landing"), scratch_dir(spark, "stream-ckpt")
    docs = A.supplier_teams_documents(spark, sf_dir)
    part = F.pmod(F.hash(F.to_json("teams")), F.lit(2))
    for k in (0, 1):
        docs.filter(part == k).write.mode("append").json(f"{folder}/generation=1")
        if k == 1:
            D.mark_complete(spark, f"{folder}/generation=1")
        for query in refresh_on_arrival(spark, "teams", {"teams": folder}, progress, database=db, multi_line=False):
            query.awaitTermination()
            if query.exception() is not None:
                raise RuntimeError(f"streaming refresh failed: {query.exception()}")
    return spark.table(f"{db}.teams")
