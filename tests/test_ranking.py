from pyspark.sql import functions as F

from faceoff.operators.ranking import global_row_number
from faceoff.operators.reports import desc


def test_positions_are_dense_and_follow_the_order(spark):
    # 20k rows over many range partitions, heavy ties on the first key, exact duplicates
    df = spark.range(20000).select(
        (F.col("id") % 7).alias("a"), (F.col("id") % 1000).alias("b"), F.lit("x").alias("c")
    ).repartition(13)
    ranked = global_row_number(df, [desc("a"), "b"], name="pos")
    rows = ranked.orderBy("pos").collect()
    assert [r.pos for r in rows] == list(range(1, 20001))
    keys = [(-r.a, r.b) for r in rows]
    assert keys == sorted(keys)


def test_single_partition_and_empty(spark):
    one = spark.createDataFrame([(3,), (1,), (2,)], "v int").coalesce(1)
    assert [(r.v, r.pos) for r in global_row_number(one, ["v"]).orderBy("pos").collect()] == [(1, 1), (2, 2), (3, 3)]
    empty = spark.createDataFrame([], "v int")
    assert global_row_number(empty, ["v"]).count() == 0
