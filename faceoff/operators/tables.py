"""Stored tables: snapshot replace, partitioned insert; keyed tables come from ``keyed``.

Snapshot tables (SNK-2/3)
    A refresh writes ``<name>__v<N>_<unique>`` and then points the view ``<name>`` at
    it with ``CREATE OR REPLACE VIEW``; readers see the old or the new
    snapshot, never a truncated table (M16).  Superseded versions stay for a while (the
    last ones, or those superseded a short time ago), so that a reader that has begun can
    finish, and can be read by number or by time.

Partitioned tables (SNK-4)
    Rows are filtered to the wanted partition values, rebalanced on the
    partition column (AQE splits a hot partition value over several tasks
    instead of sending a third of the table through one writer) and sorted
    within partitions.  ``insert_partitioned`` replaces the partitions it writes;
    ``append_partitioned`` adds to them, once for each batch id.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faceoff.operators import keyed
from faceoff.operators.keyed import (  # noqa: F401 - the keyed tables' operators are part of this module
    BUCKET,
    DEFAULT_BUCKETS,
    append_rows,
    bucket_of,
    create_keyed_table,
    delete_by_key,
    insert_if_absent,
    lookup,
    lookup_many,
    merge,
    projection_view,
    suggest_buckets,
    update_by_key,
    written_once,
)
from faceoff.session import scratch_dir

BATCH = "insert_batch"


# ----------------------------------------------------------------- catalog


def table_exists(spark: SparkSession, name: str) -> bool:
    """SRC-9: does the table (or view) exist in the catalog?"""
    return spark.catalog.tableExists(name)


def create_database(spark: SparkSession, prefix: str = "faceoff") -> str:
    """A fresh database located in a new folder under the shared checkpoint root."""
    db = f"{prefix}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{scratch_dir(spark, 'db')}'")
    return db


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def create_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    partition_by: Sequence[str] = (),
    properties: dict[str, str] | None = None,
) -> None:
    """SNK-3: create an empty Parquet table with an explicit schema.

    A partitioned table is declared with dynamic partition overwrite, so an
    overwrite replaces only the partitions it writes.
    """
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    options = " OPTIONS ('partitionOverwriteMode' = 'dynamic')" if partition_by else ""
    props = ""
    if properties:
        props = " TBLPROPERTIES (" + ", ".join(f"'{k}' = '{v}'" for k, v in properties.items()) + ")"
    spark.sql(f"CREATE TABLE {name} ({_ddl(schema)}) USING parquet{options}{parts}{props}")


def truncate(spark: SparkSession, name: str) -> None:
    """SNK-7: remove every row, keep the table."""
    if keyed.is_keyed(spark, name):
        keyed.truncate(spark, name)
    else:
        spark.sql(f"TRUNCATE TABLE {name}")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """SRC-8: scan a table by name (keyed tables without their bucket column)."""
    df = spark.table(name)
    return df.drop(BUCKET) if BUCKET in df.columns else df


# --------------------------------------------------------------- snapshots


def _split_name(name: str) -> tuple[str | None, str]:
    db, _, table = name.rpartition(".")
    return (db or None), table


def snapshot_versions(spark: SparkSession, name: str) -> list[str]:
    """The stored snapshot tables of ``name``, oldest first; the catalog lists only these."""
    db, table = _split_name(name)
    exact = re.compile(rf"^{re.escape(table.lower())}__v(\d+)_[0-9a-f]{{8}}$")
    found = []
    for t in spark.catalog.listTables(db, f"{table.lower()}__v*"):
        m = exact.match(t.name.lower())
        if m and not t.isTemporary:
            found.append((int(m.group(1)), f"{db + '.' if db else ''}{t.name}"))
    return [full for _, full in sorted(found)]


def _number(version: str) -> int:
    return int(version.rsplit("__v", 1)[1].split("_")[0])


def snapshot_property(spark: SparkSession, version: str, name: str, default: str | None = None) -> str | None:
    """A property of one snapshot version (catalog metadata)."""
    props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {version}").collect()}
    return props.get(f"faceoff.{name}", default)


def replace_snapshot(
    spark: SparkSession,
    name: str,
    df: DataFrame,
    partition_by: Sequence[str] = (),
    keep: int = 1,
    keep_seconds: float = 0,
    properties: dict[str, str] | None = None,
) -> str:
    """SNK-2: store ``df`` as the new whole content of ``name``.

    Returns the versioned table written.  Writing the new version completes
    before the view switches, so a failed refresh leaves the old snapshot in
    place.  Version names are unique, so files left by a crashed write are
    never in the way.  Of the superseded versions the last ``keep`` stay, and those
    superseded less than ``keep_seconds`` ago.
    """
    db, table = _split_name(name)
    versions = snapshot_versions(spark, name)
    number = _number(versions[-1]) + 1 if versions else 1
    target = f"{db + '.' if db else ''}{table}__v{number}_{uuid.uuid4().hex[:8]}"
    writer = df.write.format("parquet").mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(target)
    now = time.time()
    stored = {**(properties or {}), "written": f"{now:.3f}"}
    props = ", ".join("'faceoff.{}' = '{}'".format(k, v.replace("\\", "\\\\").replace("'", "\\'")) for k, v in stored.items())
    spark.sql(f"ALTER TABLE {target} SET TBLPROPERTIES ({props})")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {target}")
    superseded = now
    for back, old in enumerate(reversed(versions), 1):
        # a version without a date was never published
        written = float(snapshot_property(spark, old, "written", "0"))
        if back > keep and not now - superseded < keep_seconds:
            spark.sql(f"DROP TABLE IF EXISTS {old}")
        superseded = written
    return target


def snapshot_as_of(spark: SparkSession, name: str, version: int | None = None, at: float | None = None) -> DataFrame:
    """An earlier content of ``name``: of a version's number, or the one that was current at a time (Unix seconds)."""
    if (version is None) == (at is None):
        raise ValueError("name a version or a time")
    kept = [(v, float(snapshot_property(spark, v, "written", "inf"))) for v in snapshot_versions(spark, name)]
    if version is not None:
        found = [v for v, _ in kept if _number(v) == version]
    else:
        found = [v for v, written in kept if written <= at]
    if not found:
        raise ValueError(f"{name} has no such snapshot; kept are {[_number(v) for v, _ in kept]}")
    return spark.table(found[-1])


# ------------------------------------------------------ partitioned insert


def for_partitioned_write(
    df: DataFrame, partition_column: str, values: Iterable | None = None, sort_by: Sequence[str] = ()
) -> DataFrame:
    """Rows laid out for a write partitioned by ``partition_column``.

    ``values`` keeps only those partition values (FLT-4, one ``In``
    predicate).  The partition column goes last (Hive insert order); the
    rows are rebalanced on it and sorted within each task (ORD-5) — no
    global sort.
    """
    src = df if values is None else df.filter(F.col(partition_column).isin(list(values)))
    cols = [c for c in src.columns if c != partition_column] + [partition_column]
    return src.select(*cols).hint("rebalance", partition_column).sortWithinPartitions(partition_column, *sort_by)


def insert_partitioned(
    spark: SparkSession,
    df: DataFrame,
    name: str,
    partition_column: str,
    values: Iterable | None = None,
    sort_by: Sequence[str] = (),
) -> None:
    """SNK-4: write ``df`` into ``name`` partitioned by ``partition_column``.

    Creates the table on first use; afterwards an insert replaces only the
    partitions it writes (dynamic partition overwrite).
    """
    out = for_partitioned_write(df, partition_column, values, sort_by)
    if table_exists(spark, name):
        out.write.insertInto(name, overwrite=True)
    else:
        writer = out.write.format("parquet").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(partition_column).saveAsTable(name)


def append_partitioned(
    spark: SparkSession,
    df: DataFrame,
    name: str,
    partition_column: str,
    batch: str,
    values: Iterable | None = None,
    sort_by: Sequence[str] = (),
) -> None:
    """SNK-4 as the reference has it: add rows to a partitioned table, safely on a repeat.

    Every partition keeps the batch id of what was added to it (a second partition level, ``BATCH``); a job
    that is run again with its id replaces exactly its own rows, whole or half written, and so adds
    nothing.  Creates the table on first use.
    """
    if not batch:
        raise ValueError("an append needs a batch id")
    out = for_partitioned_write(df, partition_column, values, sort_by).withColumn(BATCH, F.lit(str(batch)))
    if not table_exists(spark, name):
        create_table(spark, name, out.schema, partition_by=[partition_column, BATCH])
    elif BATCH not in spark.table(name).columns:
        raise ValueError(f"{name} keeps no batch ids: it was written by insert_partitioned")
    out.select(*spark.table(name).columns).write.insertInto(name, overwrite=True)


def batches(spark: SparkSession, name: str) -> list[str]:
    """The batch ids that a table has rows of, from its partitions alone."""
    # one short string a batch
    return sorted(r[BATCH] for r in spark.table(name).select(BATCH).distinct().collect())


def read_partitions(spark: SparkSession, name: str, partition_column: str, values: Iterable | None = None) -> DataFrame:
    """Read a partitioned table (without its batch ids); a value list becomes a partition filter."""
    df = spark.table(name).drop(BATCH)
    return df if values is None else df.filter(F.col(partition_column).isin(list(values)))
