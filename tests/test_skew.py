"""A third of all rows on one key: AQE must split the hot key, not send it through one task."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from faceoff.operators import reports as R
from faceoff.operators import tables as T
from faceoff.plans import analogs as A

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _hot_players(spark):
    """Orders-as-players with a third of the rows on team 42.

    The test file is a single row group (one map task); AQE splits a hot
    reducer partition along map outputs, so the rows are first spread over
    16 map tasks, as a multi-file fact table would be.
    """
    players = A.orders_players(spark, SF_SMALL).repartition(16)
    hot = F.when(F.pmod(F.col("FullName"), F.lit(3)) == 0, F.lit(42)).otherwise(F.col("TeamID"))
    return players.withColumn("TeamID", hot)


def test_hot_team_join_is_split(spark, skew_conf):
    out = R.players(_hot_players(spark), A.customer_player_teams(spark, SF_SMALL))
    rows = out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan
    assert "isSkewJoin=true" in plan or "skew=true" in plan
    # same rows as the unsplit plan (checked with the join strategy restored)
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        plain = R.players(_hot_players(spark), A.customer_player_teams(spark, SF_SMALL)).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    assert sorted(map(tuple, rows)) == sorted(map(tuple, plain))


def test_hot_partition_written_by_several_tasks(spark, skew_conf, db):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    roster = A.orders_roster(spark, SF_SMALL).repartition(16)
    hot = roster.withColumn("TeamID", F.when(F.pmod("ID", F.lit(3)) == 0, F.lit(7)).otherwise(F.col("TeamID")))
    name = f"{db}.parti_hot"
    T.insert_partitioned(spark, hot, name, "TeamID", None, sort_by=["Position"])
    files = spark.table(name).filter("TeamID = 7").select(F.input_file_name()).distinct().count()
    assert files > 1
    assert spark.table(name).count() == hot.count()
