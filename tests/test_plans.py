"""Plan-shape checks: pushdown, pruning, join strategy, top-k, no single-task window."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from faceoff.operators import reports as R
from faceoff.plans import analogs as A


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_standings_plan(spark):
    p = plan(E.queries()["standings_conference_pts"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in p
    assert "BroadcastHashJoin" in p
    assert any("EqualTo(p_type,ECONOMY)" in chunk.split("]")[0] for chunk in p.split("PushedFilters: [")[1:])
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int" in p
    assert "l_shipdate" not in p and "l_returnflag" not in p  # pruned columns


def test_players_team_filter_reaches_scan(spark):
    # on a stored team id; the registered query's id is computed, and filters the customers' scan alone
    orders = A.table(spark, SF_SMALL, "orders").withColumn("team_id", F.col("o_custkey"))
    report = R.players(A.rename(orders, A.ORDERS_AS_PLAYERS), A.customer_player_teams(spark, SF_SMALL), team_id=42)
    assert "EqualTo(o_custkey,42)" in plan(report)
    assert "EqualTo(c_custkey,42)" in plan(E.queries()["players_by_team"](spark, SF_SMALL))


def test_no_dimension_is_cut(spark):
    """Whole dimensions, and still every fact has rows without a partner: INNER shows."""
    for fact, key, dim, dim_key in (
        (A.customer_teams, "ID", A.nation_standings, "TeamID"),
        (A.lineitem_standings, "TeamID", A.part_teams, "ID"),
        (A.orders_players, "TeamID", A.customer_player_teams, "ID"),
        (A.orders_past_games, "AwayID", A.nation_teams, "ID"),
        (A.events_next_games, "HomeID", A.customer_game_teams, "ID"),
    ):
        f, d = fact(spark, SF_SMALL), dim(spark, SF_SMALL)
        missing = f.join(d.select(F.col(dim_key).alias("_k")), F.col(key) == F.col("_k"), "left_anti").count()
        assert 0 < missing < f.count()
    for dim, name in ((A.nation_standings, "nation"), (A.part_teams, "part"), (A.customer_player_teams, "customer")):
        assert dim(spark, SF_SMALL).count() == A.table(spark, SF_SMALL, name).count()


def test_games_distinct_is_two_phase(spark):
    p = plan(E.queries()["past_games_all"](spark, SF_SMALL))
    assert p.count("HashAggregate") == 4  # before the joins and after them: partial before the shuffle, final after
    assert p.count("BroadcastHashJoin") == 2


def test_large_dimension_falls_back_to_shuffle_join(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(E.queries()["players_all"](spark, SF_SMALL))
        assert "SortMergeJoin" in p and "BroadcastHashJoin" not in p
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_ranking_has_no_single_partition_window_over_rows(spark):
    df = E.queries()["standings_ranked"](spark, SF_SMALL)
    p = plan(df)
    # the only window runs over the per-partition counts, behind a broadcast
    assert "SinglePartition" not in p.split("BroadcastExchange")[0]
    rows = df.orderBy("pos").collect()
    assert [r.pos for r in rows] == list(range(1, len(rows) + 1))


def test_partitioned_readback_prunes(spark):
    p = plan(E.queries()["partitioned_insert_readback"](spark, SF_SMALL))
    filters = p.split("PartitionFilters: [")[1].split("]")[0]
    assert filters.startswith("TeamID#") and " INSET " in filters  # the 32 ids prune partitions
