"""Differences of two contents, refreshes that write only what changed, and the two-role join's plan."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from faceoff.operators import difference as Diff
from faceoff.operators import tables as T
from faceoff.plans import analogs as A
from faceoff.plans.refresh import refresh, refresh_changes
from faceoff.sources import documents as D

ROWS = "k int, v string, change string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], ROWS).repartition(3)


def found(before, after):
    return sorted(((r[0], r[1], r[2]) for r in Diff.changes(before, after, ["k"]).drop("n").collect()), key=str)


def test_changes_by_key(spark):
    cols = lambda rows: spark.createDataFrame(rows, "k int, v string")
    before = cols([(1, "a"), (2, "b"), (3, "c"), (None, "n"), (4, "d"), (4, "d"), (5, None), (6, "")])
    after = cols([(1, "a"), (2, "B"), (7, "e"), (None, "m"), (4, "d"), (5, ""), (6, "")])
    assert found(before, after) == sorted([("changed", 2, "B"), ("removed", 3, "c"), ("added", 7, "e"), ("changed", None, "m"),
                                           ("changed", 4, "d"), ("changed", 5, "")], key=str)
    assert found(before, before) == [] and len(found(before.limit(0), before)) == 8
    assert [r[0] for r in found(before, before.limit(0))] == ["removed"] * 8


def test_digests_do_not_depend_on_order_and_survive_as_text(spark):
    rows = spark.range(5000).select((F.col("id") % 997).cast("int").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    one = Diff.part_digests(rows, ["k"])
    assert one == Diff.part_digests(rows.orderBy(F.rand(3)).repartition(5), ["k"])
    text = Diff.to_text(one)
    assert Diff.from_text(text) == one and len(text) < 4000 and len(one) == Diff.PARTS
    other = rows.withColumn("v", F.when(F.col("k") == 5, "x").otherwise(F.col("v")))
    assert len(Diff.differing(one, Diff.part_digests(other, ["k"]))) == 1


def test_an_unchanged_refresh_writes_nothing(spark, tmp, db):
    docs = A.supplier_teams_documents(spark, SF_SMALL)
    land = lambda k, d: (d.write.json(f"{tmp}/generation={k}"), D.mark_complete(spark, f"{tmp}/generation={k}"))
    go = lambda: refresh(spark, "teams", {"teams": tmp}, database=db, multi_line=False, only_changed=True)
    land(1, docs)
    assert list(go()) == ["teams"]
    versions = T.snapshot_versions(spark, f"{db}.teams")
    assert go() == {}  # the same generation
    land(2, docs.repartition(2))
    assert go() == {} and T.snapshot_versions(spark, f"{db}.teams") == versions  # the same rows
    assert refresh_changes(spark, "teams", db).filter("change = 'added'").count() == spark.table(f"{db}.teams").count()
    land(3, docs.select(F.filter("teams", lambda t: t["id"] != 3).alias("teams")))
    assert list(go()) == ["teams"]
    assert [(r["change"], r["ID"]) for r in refresh_changes(spark, "teams", db).collect()] == [("removed", 3)]
    with pytest.raises(ValueError, match="never refreshed"):
        refresh_changes(spark, "standings", db)


def test_both_roles_read_one_exchange_of_the_dimension(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = E.queries()["next_games_est"](spark, SF_SMALL)
        df.collect()
        text = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        scans = re.findall(r"FileScan parquet \[c_custkey[^\n]*", text)
        assert "ReusedExchange" in text and len(scans) == 1, text
        # the games are made distinct before the first join
        assert text.index("SortMergeJoin") < text.rindex("HashAggregate")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
