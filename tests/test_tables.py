import pytest
from pyspark.sql import functions as F

from faceoff import schemas
from faceoff.operators import tables as T


def _users(spark, db, rows, buckets=4):
    name = f"{db}.users"
    T.create_keyed_table(spark, name, schemas.USERS, "Username", buckets=buckets)
    T.append_rows(spark, name, spark.createDataFrame(rows, schemas.USERS))
    return name


ROWS = [("a", "pa", "basic", "est"), ("b", "pb", "admin", "pst"), (None, "pn", "basic", "cst")]


def _all(spark, name):
    return sorted((tuple(r) for r in T.read_table(spark, name).collect()), key=str)


def test_exists_and_create(spark, db):
    name = f"{db}.users"
    assert not T.table_exists(spark, name)
    T.create_keyed_table(spark, name, schemas.USERS, "Username")
    assert T.table_exists(spark, name)
    assert T.read_table(spark, name).columns == schemas.USERS.fieldNames()


def test_insert_if_absent(spark, db):
    name = _users(spark, db, ROWS)
    new = spark.createDataFrame([("a", "x", "admin", "mst"), ("c", "pc", "basic", "est")], schemas.USERS)
    T.insert_if_absent(spark, name, new)
    got = _all(spark, name)
    assert ("a", "pa", "basic", "est") in got and ("c", "pc", "basic", "est") in got and len(got) == 4


def test_insert_duplicate_keys_rejected(spark, db):
    name = _users(spark, db, ROWS)
    new = spark.createDataFrame([("d", "1", "basic", "est"), ("d", "2", "basic", "est")], schemas.USERS)
    with pytest.raises(ValueError, match="duplicate"):
        T.insert_if_absent(spark, name, new)


def test_update_present_and_absent_keys(spark, db):
    name = _users(spark, db, ROWS)
    T.update_by_key(spark, name, spark.createDataFrame([("a", "pst"), ("zz", "cst")], "Username string, Timezone string"))
    got = _all(spark, name)
    assert ("a", "pa", "basic", "pst") in got
    assert ("b", "pb", "admin", "pst") in got
    assert (None, "pn", "basic", "cst") in got  # NULL key survives (M13)
    assert len(got) == 3  # absent key is a no-op, row count unchanged (M14, M15)


def test_update_rejects_unknown_column_and_duplicates(spark, db):
    name = _users(spark, db, ROWS)
    with pytest.raises(ValueError):
        T.update_by_key(spark, name, spark.createDataFrame([("a", 1)], "Username string, Nope int"))
    with pytest.raises(ValueError, match="duplicate"):
        T.update_by_key(spark, name, spark.createDataFrame([("a", "est"), ("a", "pst")], "Username string, Timezone string"))


def test_delete_keeps_null_keys_and_ignores_absent(spark, db):
    name = _users(spark, db, ROWS)
    T.delete_by_key(spark, name, spark.createDataFrame([("b",), ("nobody",)], "Username string"))
    assert _all(spark, name) == sorted([("a", "pa", "basic", "est"), (None, "pn", "basic", "cst")], key=str)


def test_delete_empties_a_bucket(spark, db):
    # one bucket per key: deleting the only key of a bucket must empty it
    name = _users(spark, db, [("solo", "p", "basic", "est")], buckets=64)
    T.delete_by_key(spark, name, spark.createDataFrame([("solo",)], "Username string"))
    assert T.read_table(spark, name).count() == 0


def test_update_only_rewrites_touched_buckets(spark, db):
    rows = [(f"user{i}", "p", "basic", "est") for i in range(200)]
    name = _users(spark, db, rows, buckets=16)
    before = {r[0]: r[1] for r in spark.table(name).select(F.input_file_name(), T.BUCKET).distinct().collect()}
    T.update_by_key(spark, name, spark.createDataFrame([("user7", "pst")], "Username string, Timezone string"))
    after = {r[0]: r[1] for r in spark.table(name).select(F.input_file_name(), T.BUCKET).distinct().collect()}
    changed_buckets = {b for f, b in after.items() if f not in before}
    assert len(changed_buckets) == 1
    assert T.lookup(spark, name, "user7", ["Timezone"]).first()[0] == "pst"
    assert spark.table(name).count() == 200


def test_lookup_prunes_to_one_bucket(spark, db):
    name = _users(spark, db, ROWS, buckets=8)
    df = T.lookup(spark, name, "a", ["UserType", "Timezone"])
    assert [tuple(r) for r in df.collect()] == [("basic", "est")]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(key_bucket" in plan and "(key_bucket" in plan


def test_lookup_many(spark, db):
    name = _users(spark, db, ROWS)
    keys = spark.createDataFrame([("a",), ("b",), ("q",)], "Username string")
    assert sorted(r[0] for r in T.lookup_many(spark, name, keys, ["Username"]).collect()) == ["a", "b"]


def test_projection_view_hides_columns(spark, db):
    name = _users(spark, db, ROWS)
    view = T.projection_view(spark, name, "users_public_test", ["Username", "UserType", "Timezone"])
    assert view.columns == ["Username", "UserType", "Timezone"]
    assert view.count() == 3


def test_truncate(spark, db):
    name = _users(spark, db, ROWS)
    T.truncate(spark, name)
    assert spark.table(name).count() == 0


def test_snapshot_replace_switches_view(spark, db):
    name = f"{db}.teams"
    v1 = T.replace_snapshot(spark, name, spark.createDataFrame([(1, "A", "a", "x", "y")], schemas.TEAMS))
    reader = spark.table(name)
    v2 = T.replace_snapshot(spark, name, spark.createDataFrame([(2, "B", "b", "x", "y"), (3, "C", "c", "x", "y")], schemas.TEAMS))
    assert v1.startswith(f"{name}__v1_") and v2.startswith(f"{name}__v2_")
    assert T.snapshot_versions(spark, name) == [v1, v2]
    assert reader.count() == 1  # opened before the switch
    assert spark.table(name).count() == 2
    # a rewrite that reads the current snapshot is allowed (new version, then switch)
    T.replace_snapshot(spark, name, spark.table(name).filter("ID = 3"))
    assert [r.ID for r in spark.table(name).collect()] == [3]


def test_insert_partitioned_replaces_only_written_partitions(spark, db):
    name = f"{db}.parti"
    df = spark.createDataFrame([(i, f"p{i}", "Center", str(i), t) for i, t in enumerate([1, 1, 2, 3, 99])], schemas.PLAYERS)
    T.insert_partitioned(spark, df, name, "TeamID", [1, 2, 3], sort_by=["Position"])
    assert sorted(r.TeamID for r in spark.table(name).collect()) == [1, 1, 2, 3]
    again = spark.createDataFrame([(7, "new", "Goalie", "1", 2)], schemas.PLAYERS)
    T.insert_partitioned(spark, again, name, "TeamID", [1, 2, 3])
    got = sorted((r.TeamID, r.ID) for r in spark.table(name).collect())
    assert got == [(1, 0), (1, 1), (2, 7), (3, 3)]
    back = T.read_partitions(spark, name, "TeamID", [2])
    assert "PartitionFilters: [isnotnull(TeamID" in back._jdf.queryExecution().executedPlan().toString()


def test_multi_bucket_delete_and_update(spark, db):
    rows = [(f"u{i}", "p", "basic", "est") for i in range(10)]
    name = _users(spark, db, rows, buckets=64)
    keys = spark.createDataFrame([("u1",), ("u2",), ("u3",)], "Username string")
    T.delete_by_key(spark, name, keys)
    assert sorted(r[0] for r in T.read_table(spark, name).collect()) == [f"u{i}" for i in (0, 4, 5, 6, 7, 8, 9)]
    changes = spark.createDataFrame([("u4", "mst"), ("u9", "pst")], "Username string, Timezone string")
    T.update_by_key(spark, name, changes)
    got = {r.Username: r.Timezone for r in T.read_table(spark, name).collect()}
    assert got == {"u0": "est", "u4": "mst", "u5": "est", "u6": "est", "u7": "est", "u8": "est", "u9": "pst"}


def test_suggest_buckets_grows_with_rows(spark):
    small = spark.range(100)
    assert T.suggest_buckets(small) == 1
    assert T.suggest_buckets(spark.range(1000), rows_per_bucket=10) == 128
    assert T.suggest_buckets(spark.range(1000), rows_per_bucket=10, minimum=8) == 128
    assert T.suggest_buckets(spark.range(1000), rows_per_bucket=10, maximum=32) == 32


def test_lookup_null_key(spark, db):
    name = _users(spark, db, ROWS)
    assert [tuple(r) for r in T.lookup(spark, name, None, ["Password"]).collect()] == [("pn",)]


def test_failed_update_leaves_table_intact(spark, db):
    name = _users(spark, db, ROWS)
    before = _all(spark, name)
    bad = spark.createDataFrame([("a",)], "Username string").select(
        "Username", F.raise_error(F.lit("boom")).cast("string").alias("Timezone")
    )
    with pytest.raises(Exception, match="boom"):
        T.update_by_key(spark, name, bad)
    assert _all(spark, name) == before


def test_leftover_version_folders_are_not_in_the_way(spark, db):
    from pathlib import Path

    name = f"{db}.teams"
    T.replace_snapshot(spark, name, spark.createDataFrame([(1, "A", "a", "x", "y")], schemas.TEAMS))
    location = spark.sql(f"DESCRIBE DATABASE {db}").filter("info_name = 'Location'").first()["info_value"]
    for k in range(2, 8):  # what crashed writes may have left
        leftover = Path(location.replace("file:", "")) / f"teams__v{k}"
        leftover.mkdir(parents=True)
        (leftover / "part-crashed.parquet").write_bytes(b"x")
    written = T.replace_snapshot(spark, name, spark.createDataFrame([(2, "B", "b", "x", "y")], schemas.TEAMS))
    assert written.startswith(f"{name}__v2_")
    assert [r.ID for r in spark.table(name).collect()] == [2]


def test_the_null_key_is_a_key(spark, db):
    from faceoff.operators import tables as T

    schema = "k string, v int"
    name = f"{db}.null_keys"
    T.create_keyed_table(spark, name, spark.createDataFrame([], schema).schema, "k", buckets=4)
    rows = spark.createDataFrame([(None, 1), ("a", 2)], schema)
    T.insert_if_absent(spark, name, rows)
    T.insert_if_absent(spark, name, spark.createDataFrame([(None, 3), ("b", 4)], schema))
    got = sorted(((r["k"], r["v"]) for r in spark.table(name).collect()), key=str)
    assert got == [("a", 2), ("b", 4), (None, 1)]
    found = T.lookup_many(spark, name, spark.createDataFrame([(None,), ("a",)], "k string"))
    assert sorted(r["v"] for r in found.collect()) == [1, 2]


def test_a_change_set_that_differs_every_time_is_read_once(spark, db):
    rows = [(f"u{i}", "p", "basic", "est") for i in range(200)]
    name = _users(spark, db, rows, buckets=16)
    some = spark.createDataFrame(rows, schemas.USERS).filter(F.rand() < 0.5).select("Username")
    before = spark.table(name).count()
    T.delete_by_key(spark, name, some)
    left = spark.table(name).count()
    assert 0 < left < before
    T.insert_if_absent(spark, name, spark.createDataFrame(rows, schemas.USERS))
    assert _all(spark, name) == sorted(rows, key=str)


def test_delete_and_update_read_the_table_they_change(spark, db):
    rows = [(f"u{i}", "p", "basic", "est" if i % 2 else "pst") for i in range(50)]
    name = _users(spark, db, rows, buckets=16)
    T.delete_by_key(spark, name, spark.table(name).filter("Timezone = 'est'").select("Username"))
    assert _all(spark, name) == sorted((r for r in rows if r[3] == "pst"), key=str)
    T.update_by_key(spark, name, spark.table(name).select("Username", F.lit("cst").alias("Timezone")))
    assert {r[3] for r in _all(spark, name)} == {"cst"} and spark.table(name).count() == 25


def test_superseded_snapshots_stay_for_a_while(spark, db):
    name, one = f"{db}.n", lambda k: spark.createDataFrame([(k,)], "k int")
    versions = [T.replace_snapshot(spark, name, one(k)) for k in range(1, 4)]
    assert T.snapshot_versions(spark, name) == versions[1:]
    assert T.snapshot_as_of(spark, name, version=2).first()[0] == 2 and spark.table(name).first()[0] == 3
    with pytest.raises(ValueError, match="kept are \\[2, 3\\]"):
        T.snapshot_as_of(spark, name, version=1)
    third = float(T.snapshot_property(spark, versions[2], "written"))
    assert T.snapshot_as_of(spark, name, at=third - 0.001).first()[0] == 2
    assert T.snapshot_as_of(spark, name, at=third + 60).first()[0] == 3
    with pytest.raises(ValueError):
        T.snapshot_as_of(spark, name, at=1.0)
    T.replace_snapshot(spark, name, one(4), keep=0, keep_seconds=3600)
    assert len(T.snapshot_versions(spark, name)) == 3  # superseded less than an hour ago
    T.replace_snapshot(spark, name, one(5), keep=0)
    assert len(T.snapshot_versions(spark, name)) == 1 and spark.table(name).first()[0] == 5


def test_appends_add_and_repeats_do_not(spark, db):
    name, schema = f"{db}.adding", "v int, team int"
    first, second = ([(1, 7), (2, 8)], [(3, 7), (3, 7)])
    for rows, batch in ((first, "a"), (second, "b"), (first, "a"), (second, "b"), ([], "c")):
        T.append_partitioned(spark, spark.createDataFrame(rows, schema), name, "team", batch)
    got = sorted(tuple(r) for r in T.read_partitions(spark, name, "team").collect())
    assert got == sorted(first + second) and T.batches(spark, name) == ["a", "b"]
    assert sorted(tuple(r) for r in T.read_partitions(spark, name, "team", [7]).collect()) == [(1, 7), (3, 7), (3, 7)]
    with pytest.raises(ValueError):
        T.append_partitioned(spark, spark.createDataFrame(first, schema), name, "team", "")
    T.insert_partitioned(spark, spark.createDataFrame(first, schema), f"{db}.whole", "team")
    with pytest.raises(ValueError, match="no batch ids"):
        T.append_partitioned(spark, spark.createDataFrame(first, schema), f"{db}.whole", "team", "a")
