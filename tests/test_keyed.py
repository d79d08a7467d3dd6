"""Keyed tables: merge, plans without an exchange of the table, growth by splitting buckets, lookups that skip rows."""

import random
import re

import pytest
from pyspark.sql import functions as F

from faceoff.operators import keyed as K
from faceoff.operators import tables as T

SCHEMA = "k string, v int, w string"


def filled(spark, db, rows, buckets=4, **kwargs):
    name = f"{db}.t"
    K.create_keyed_table(spark, name, spark.createDataFrame([], SCHEMA).schema, "k", buckets=buckets, **kwargs)
    if rows:
        K.append_rows(spark, name, spark.createDataFrame(rows, SCHEMA))
    return name


def content(spark, name):
    return sorted((tuple(r) for r in T.read_table(spark, name).collect()), key=str)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def table_side_is_unmoved(df, table):
    """No exchange stands above a scan of the table's files."""
    lines = plan(df).split("\n")
    scans = [i for i, x in enumerate(lines) if "FileScan parquet" in x and table.lower() in x.lower()]
    assert scans, plan(df)
    for i in scans:
        depth = len(re.match(r"[\s:+|-]*", lines[i])[0])
        for x in reversed(lines[:i]):
            at = len(re.match(r"[\s:+|-]*", x)[0])
            if at < depth:
                depth = at
                if "Exchange" in x:
                    return False
        assert "Bucketed: true" in lines[i], lines[i]
    return True


# ------------------------------------------------------------------- merge
def test_merge_outcomes(spark, db):
    name = filled(spark, db, [("a", 1, "x"), ("b", 2, "y"), (None, 3, "z"), ("d", 4, "u")])
    changes = [("a", 10, "A", "update"), ("b", 0, None, "delete"), ("c", 30, "C", "insert"), ("d", 40, "D", "insert"),
               ("e", 50, "E", "update"), ("f", 60, "F", "delete"), ("g", 70, "G", "upsert"), (None, 33, None, "update"), ("h", 8, "H", None)]
    found = K.merge(spark, name, spark.createDataFrame(changes, SCHEMA + ", op string"))
    got = {r["k"]: r["outcome"] for r in found.collect()}
    assert got == {"a": "updated", "b": "deleted", "c": "inserted", "d": "refused", "e": "refused", "f": "refused", "g": "refused",
                   None: "updated", "h": "refused"}
    assert content(spark, name) == sorted([("a", 10, "A"), ("c", 30, "C"), ("d", 4, "u"), (None, 33, None)], key=str)


@pytest.mark.parametrize("op, outcome, left", [("delete", "deleted", 1), ("insert", "refused", 2), ("update", "updated", 2)])
def test_merge_of_the_null_key(spark, db, op, outcome, left):
    name = filled(spark, db, [(None, 3, "z"), ("a", 1, "x")])
    found = K.merge(spark, name, spark.createDataFrame([(None, 9, "n", op)], SCHEMA + ", op string"))
    assert [tuple(r) for r in found.collect()] == [(None, op, outcome)]
    assert len(content(spark, name)) == left and ("a", 1, "x") in content(spark, name)
    absent = K.merge(spark, filled(spark, T.create_database(spark, "t"), [("a", 1, "x")]),
                     spark.createDataFrame([(None, 9, "n", "insert")], SCHEMA + ", op string"))
    assert absent.first()["outcome"] == "inserted"


def test_merge_sets_only_the_update_columns(spark, db):
    name = filled(spark, db, [("a", 1, "x"), ("b", 2, "y")])
    changes = spark.createDataFrame([("a", 10, "A", "update"), ("n", 5, "N", "insert")], SCHEMA + ", op string")
    K.merge(spark, name, changes, update_columns=["v"])
    assert content(spark, name) == [("a", 10, "x"), ("b", 2, "y"), ("n", 5, "N")]
    K.merge(spark, name, spark.createDataFrame([("m", "insert", 7)], "k string, op string, v int"))
    assert ("m", 7, None) in content(spark, name)


def test_merge_rejects_repeats_and_unknown_columns(spark, db):
    name = filled(spark, db, [("a", 1, "x")])
    with pytest.raises(ValueError, match="duplicate"):
        K.merge(spark, name, spark.createDataFrame([("a", 1, "x", "update"), ("a", 1, "x", "delete")], SCHEMA + ", op string"))
    with pytest.raises(ValueError, match="unknown"):
        K.merge(spark, name, spark.createDataFrame([("a", 1, "update")], "k string, nope int, op string"))
    assert K.merge(spark, name, spark.createDataFrame([], SCHEMA + ", op string")).count() == 0
    assert content(spark, name) == [("a", 1, "x")]


def test_refused_changes_touch_no_bucket(spark, db):
    name = filled(spark, db, [(f"u{i}", i, "x") for i in range(100)], buckets=8)
    files = lambda: {r[0] for r in spark.table(name).select(F.input_file_name()).distinct().collect()}
    before = files()
    K.merge(spark, name, spark.createDataFrame([("u1", 1, "y", "insert"), ("zz", 1, "y", "update")], SCHEMA + ", op string"))
    assert files() == before
    K.merge(spark, name, spark.createDataFrame([("u1", 1, "y", "update")], SCHEMA + ", op string"))
    assert len(before - files()) == 1


def test_random_merges_against_a_dictionary(spark, db):
    rng, held = random.Random(3), {}
    name = filled(spark, db, [], buckets=2, rows_per_bucket=20)
    for _ in range(4):
        keys = rng.sample([None, *map(str, range(150))], 90)
        changes = [(k, rng.randrange(99), f"w{rng.randrange(9)}", rng.choice([*K.OPERATIONS, "insert"])) for k in keys]
        want = []
        for k, v, w, op in changes:
            done = {"insert": k not in held, "update": k in held, "delete": k in held}[op]
            if done and op == "delete":
                del held[k]
            elif done:
                held[k] = (v, w)
            want.append((k, op, {"insert": "inserted", "update": "updated", "delete": "deleted"}[op] if done else "refused"))
        found = K.merge(spark, name, spark.createDataFrame(changes, SCHEMA + ", op string"))
        assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)
        assert content(spark, name) == sorted(((k, *v) for k, v in held.items()), key=str)
    assert K.layout_of(spark, name).rows == len(held)


# ------------------------------------------------------------------- plans
@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_the_table_is_not_exchanged(spark, db, threshold):
    name = filled(spark, db, [(f"u{i}", i, "x") for i in range(300)], buckets=6)
    layout = K.layout_of(spark, name)
    keys = K._normalised(layout, spark.createDataFrame([(f"u{i}", -i) for i in range(0, 300, 7)], "k string, v int"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        (part,), _ = K._touched(layout, keys, unique=True)
        judged = keys.withColumn("__outcome", F.when(F.col("v") % 2 == 0, "updated").otherwise("deleted"))
        for df in (
            K.updated_rows(spark, layout, part, keys, ["v"]),
            K.remaining_rows(spark, layout, part, keys, False),
            K.present_keys(spark, layout, [part], keys, ["k", "w"], False),
            K.merged_rows(spark, layout, part, judged, ["v"]),
        ):
            text = plan(df)
            if threshold == "-1":
                assert table_side_is_unmoved(df, "t__l0") and "SortMergeJoin" in text
            else:  # a small change set is broadcast: the table streams through
                assert "BroadcastHashJoin" in text and "hashpartitioning" not in text
            assert text.count("t__l0[") <= 1 and len(re.findall(r"FileScan parquet [^\n]*t__l0", text)) == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


# ------------------------------------------------------------------ growth
def test_a_table_loaded_in_ten_rounds_keeps_its_bucket_size(spark, db):
    name, seen = filled(spark, db, [], buckets=2, rows_per_bucket=50), []
    for k in range(10):
        K.append_rows(spark, name, spark.createDataFrame([(f"u{k * 100 + i}", i, "x") for i in range(100)], SCHEMA))
        sizes = [r["count"] for r in spark.table(name).groupBy(T.BUCKET).count().collect()]
        seen.append(K.layout_of(spark, name).buckets)
        assert sum(sizes) == (k + 1) * 100 and max(sizes) < 4 * 50
        assert K.lookup(spark, name, f"u{k * 100 + 7}", ["v"]).first()[0] == 7
    assert seen == [2, 4, 6, 8, 10, 12, 14, 16, 18, 20]
    layout = K.layout_of(spark, name)
    assert (layout.level, layout.split) == (3, 4) and layout.rows == 1000
    assert not T.table_exists(spark, f"{name}__l2")  # tables of finished levels are gone
    K.update_by_key(spark, name, spark.createDataFrame([(f"u{i}", -1) for i in range(0, 1000, 3)], "k string, v int"))
    K.delete_by_key(spark, name, spark.createDataFrame([(f"u{i}",) for i in range(1, 1000, 3)], "k string"))
    K.insert_if_absent(spark, name, spark.createDataFrame([(f"u{i}", 5, "n") for i in range(0, 1000, 2)], SCHEMA))
    got = {r["k"]: r["v"] for r in T.read_table(spark, name).collect()}
    want = {f"u{i}": -1 if i % 3 == 0 else i % 100 for i in range(1000) if i % 3 != 1}
    want.update({f"u{i}": 5 for i in range(0, 1000, 2) if f"u{i}" not in want})
    assert got == want
    found = K.lookup_many(spark, name, spark.createDataFrame([("u0",), ("u4",), ("u1",), ("zz",)], "k string"), ["k"])
    assert sorted(r[0] for r in found.collect()) == ["u0", "u4"]


def test_a_reader_in_a_split_sees_each_row_once(spark, db):
    name = filled(spark, db, [(f"u{i}", i, "x") for i in range(200)], buckets=4)
    layout = K.layout_of(spark, name)
    # rows dealt into the next level are not seen until the pointer moves, and then not in the old one
    K._create_level(spark, layout.table(True), T.T.StructType([f for f in spark.table(name).schema if f.name != T.BUCKET]), "k", 8)
    moved = spark.table(layout.table()).filter(f"{T.BUCKET} = 0")
    moved.select(*layout.columns, K.bucket_of(F.col("k"), 8).alias(T.BUCKET)).write.insertInto(layout.table(True), overwrite=True)
    assert spark.table(name).count() == 200
    K._publish(spark, K.replace(layout, split=1))
    assert spark.table(name).count() == 200 and len(content(spark, name)) == len(set(content(spark, name)))
    assert all(K.lookup(spark, name, f"u{i}").count() == 1 for i in range(0, 200, 37))


def test_truncate_empties_both_levels(spark, db):
    name = filled(spark, db, [(f"u{i}", i, "x") for i in range(90)], buckets=2, rows_per_bucket=30)
    assert K.layout_of(spark, name).split == 1
    T.truncate(spark, name)
    assert spark.table(name).count() == 0 and K.layout_of(spark, name).rows == 0


# ----------------------------------------------------------------- lookups
def test_a_lookup_reads_a_part_of_its_bucket(spark, db):
    name = f"{db}.big"
    rows = spark.range(400_000).select((F.col("id") * 7919 % 400_009).alias("id"), F.sha2(F.col("id").cast("string"), 256).alias("w"))
    spark.conf.set("parquet.block.size", str(1 << 20))
    K.create_keyed_table(spark, name, rows.schema, "id", buckets=1)
    K.append_rows(spark, name, rows)
    spark.conf.unset("parquet.block.size")
    df = K.lookup(spark, name, 7919, ["w"])
    assert len(df.collect()) == 1
    scans = df._jdf.queryExecution().executedPlan().collectLeaves()  # one scan and a filter: not an adaptive plan
    read = sum(scans.apply(k).metrics().apply("numOutputRows").value() for k in range(scans.size()))
    assert 0 < read < 100_000, read
    absent = K.lookup(spark, name, 400_020, ["w"])
    assert absent.count() == 0


def test_lookup_filters_reach_the_files(spark, db):
    name = filled(spark, db, [(f"u{i}", i, "x") for i in range(50)], buckets=2, rows_per_bucket=20)
    assert K.layout_of(spark, name).split
    text = plan(K.lookup(spark, name, "u3", ["v"]))
    assert "EqualTo(k,u3)" in text and text.count("FileScan") == 1 and "__l1" in text or "__l0" in text
    assert sum(K.lookup(spark, name, f"u{i}").count() for i in range(50)) == 50
