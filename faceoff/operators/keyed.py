"""Keyed tables: insert, update, delete, merge and look up by key, in buckets that grow with the table.

Layout
    A keyed table ``name`` is a view over one or two physical tables ``name__l<level>``.
    Each is stored in Spark's own buckets of the key, sorted by key, and also
    partitioned by the bucket's number (``key_bucket``), so a bucket is both what a join
    by key needs unmoved and what an overwrite can replace alone.  Files carry a Parquet
    Bloom filter on the key; with the sort order, a lookup skips the row groups and pages
    that cannot hold it.

Growth (linear hashing)
    Level L has ``base * 2**L`` buckets.  When rows outgrow ``rows_per_bucket``, the
    buckets from the split pointer on are dealt into two each, in the table of level L+1;
    a key whose level-L bucket lies before the pointer is found there.  Level and
    pointer are properties of the view, which one ``CREATE OR REPLACE VIEW`` changes
    together with its text, so readers see the buckets before or after the split.
    At the end of a level its table is dropped.

Changes
    A change set is written down first, with one row a key.  It touches only its keys'
    buckets: the table side of each join is a scan of those buckets without any
    exchange, and their new rows go straight from the join to the write, a dynamic
    partition overwrite.  Keys are compared by ``=``, for which Spark knows the
    buckets; the NULL key, at most one row of a change set, is set against the
    rows without a key by a literal.  Only bucket numbers, table properties and that one
    row reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faceoff.session import scratch_dir

BUCKET = "key_bucket"
DEFAULT_BUCKETS = 16
# About 0.5-1 GB a bucket: a change rewrites whole buckets.
ROWS_PER_BUCKET = 4_000_000
OPERATIONS = ("insert", "update", "delete")
_PROP = "faceoff."


@dataclass(frozen=True)
class Layout:
    """What the view's properties and columns say of a keyed table."""

    name: str
    key: str
    key_type: T.DataType
    columns: tuple[str, ...]
    base: int
    level: int
    split: int
    rows: int
    rows_per_bucket: int

    @property
    def low(self) -> int:
        """Buckets of the current level."""
        return self.base << self.level

    @property
    def buckets(self) -> int:
        return self.low + self.split

    def table(self, high: bool = False) -> str:
        return f"{self.name}__l{self.level + high}"

    def bucket(self, key: Column) -> Column:
        """The bucket of a key in the table that holds it."""
        of_low = bucket_of(key, self.low)
        return F.when(of_low < self.split, bucket_of(key, 2 * self.low)).otherwise(of_low) if self.split else of_low

    def is_high(self, key: Column) -> Column:
        """Whether a key's bucket was split."""
        return bucket_of(key, self.low) < self.split

    def parts(self) -> list[tuple[bool, str, str]]:
        """(high, table, condition): the physical tables in use and their valid rows."""
        found = [(False, self.table(), f"{BUCKET} >= {self.split}")]
        return found + ([(True, self.table(True), f"{BUCKET} % {self.low} < {self.split}")] if self.split else [])


def bucket_of(key: Column, buckets: int) -> Column:
    """Spark's own bucket number of a key (constant-folds for literals)."""
    return F.pmod(F.hash(key), F.lit(buckets)).cast("int")


def suggest_buckets(df: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET, minimum: int = 1, maximum: int = 1 << 16) -> int:
    """First bucket count for a table loaded from ``df``: a power of two giving about ``rows_per_bucket`` rows each."""
    rows = df.count()
    buckets = minimum
    while buckets < maximum and buckets * rows_per_bucket < rows:
        buckets *= 2
    return buckets


def written_once(changes: DataFrame) -> DataFrame:
    """The change set as files, so that its bucket list and its join see the same rows
    even where evaluating it twice would not give them."""
    path = scratch_dir(changes.sparkSession, "changes")
    changes.write.parquet(path)
    return changes.sparkSession.read.schema(changes.schema).parquet(path)


# ------------------------------------------------------------------ layout


def _create_level(spark: SparkSession, table: str, schema: T.StructType, key: str, buckets: int) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    options = {
        "partitionOverwriteMode": "dynamic",
        f"parquet.bloom.filter.enabled#{key}": "true",
        "parquet.bloom.filter.adaptive.enabled": "true",
    }
    listed = ", ".join(f"'{k}' = '{v}'" for k, v in options.items())
    spark.sql(
        f"CREATE TABLE {table} ({columns}, {BUCKET} INT) USING parquet OPTIONS ({listed}) "
        f"PARTITIONED BY ({BUCKET}) CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS"
    )


def _publish(spark: SparkSession, layout: Layout) -> None:
    """Properties and text of the view, changed in one step."""
    names = ", ".join(f"`{c}`" for c in (*layout.columns, BUCKET))
    text = " UNION ALL ".join(f"SELECT {names} FROM {table} WHERE {valid}" for _, table, valid in layout.parts())
    kept = ("key", "base", "level", "split", "rows", "rows_per_bucket")
    props = ", ".join(f"'{_PROP}{k}' = '{getattr(layout, k)}'" for k in kept)
    spark.sql(f"CREATE OR REPLACE VIEW {layout.name} TBLPROPERTIES ({props}) AS {text}")


def create_keyed_table(spark: SparkSession, name: str, schema: T.StructType, key: str, buckets: int = DEFAULT_BUCKETS,
                       rows_per_bucket: int = ROWS_PER_BUCKET) -> None:
    """MNT-6: an empty keyed table of ``buckets`` buckets, which are split as it outgrows ``rows_per_bucket`` each."""
    if key not in schema.fieldNames():
        raise ValueError(f"key {key!r} is not a column of the schema")
    layout = Layout(name, key, schema[key].dataType, tuple(schema.fieldNames()), buckets, 0, 0, 0, rows_per_bucket)
    _create_level(spark, layout.table(), schema, key, buckets)
    _publish(spark, layout)


def layout_of(spark: SparkSession, name: str) -> Layout:
    """The layout of a keyed table, from the catalog alone."""
    # a handful of properties
    props = {r["key"][len(_PROP):]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect() if r["key"].startswith(_PROP)}
    if "key" not in props:
        raise ValueError(f"{name} is not a keyed table")
    fields = spark.table(name).schema
    columns = tuple(f.name for f in fields if f.name != BUCKET)
    numbers = {k: int(props[k]) for k in ("base", "level", "split", "rows", "rows_per_bucket")}
    return Layout(name, props["key"], fields[props["key"]].dataType, columns, **numbers)


def is_keyed(spark: SparkSession, name: str) -> bool:
    return any(r["key"] == f"{_PROP}key" for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect())


def truncate(spark: SparkSession, name: str) -> None:
    """Remove every row, keep the table and its buckets."""
    layout = layout_of(spark, name)
    for _, table, _ in layout.parts():
        spark.sql(f"TRUNCATE TABLE {table}")
    _publish(spark, replace(layout, rows=0))


# ------------------------------------------------------------------ growth


def _grow(spark: SparkSession, layout: Layout, more: int) -> None:
    """Counts ``more`` rows in and splits as many buckets as the table has outgrown."""
    layout = replace(layout, rows=max(0, layout.rows + more))
    while True:
        wanted = -(-layout.rows // layout.rows_per_bucket)
        upto = min(layout.split + max(0, wanted - layout.buckets), layout.low)
        if upto == layout.split:
            return _publish(spark, layout) if more else None
        layout = _split(spark, layout, upto)
        more = 0


def _split(spark: SparkSession, layout: Layout, upto: int) -> Layout:
    """Deals the buckets from the split pointer to ``upto`` into two each and moves the pointer on."""
    low, high = layout.table(), layout.table(True)
    if not layout.split:
        spark.sql(f"DROP TABLE IF EXISTS {high}")  # what a split that failed may have left
        schema = T.StructType([f for f in spark.table(low).schema if f.name != BUCKET])
        _create_level(spark, high, schema, layout.key, 2 * layout.low)
    moved = spark.table(low).filter(F.col(BUCKET).between(layout.split, upto - 1))
    rows = moved.select(*layout.columns, bucket_of(F.col(layout.key), 2 * layout.low).alias(BUCKET))
    rows.hint("rebalance", BUCKET).write.insertInto(high, overwrite=True)
    before, layout = layout.split, replace(layout, split=upto)
    if upto == layout.low:
        layout = replace(layout, level=layout.level + 1, split=0)
        _publish(spark, layout)
        spark.sql(f"DROP TABLE {low}")
    else:
        _publish(spark, layout)
        _drop_buckets(spark, low, range(before, upto))
    return layout


def _drop_buckets(spark: SparkSession, table: str, buckets: Iterable[int]) -> None:
    parts = ", ".join(f"PARTITION ({BUCKET} = {int(b)})" for b in buckets)
    if parts:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {parts}")


# ------------------------------------------------------------- change sets


@dataclass(frozen=True)
class _Part:
    """One physical table's share of a change set."""

    high: bool
    table: str
    touched: list[int]
    n_buckets: int
    valid: str

    def rows(self, spark: SparkSession) -> DataFrame:
        """The table's valid rows in the touched buckets (no list where these are all)."""
        df = spark.table(self.table).filter(self.valid)
        return df if len(self.touched) >= self.n_buckets else df.filter(F.col(BUCKET).isin(self.touched))


def _normalised(layout: Layout, changes: DataFrame) -> DataFrame:
    """The change set written down with its keys in the table's type."""
    return written_once(changes.withColumn(layout.key, F.col(layout.key).cast(layout.key_type)))


def _touched(layout: Layout, changes: DataFrame, unique: bool) -> tuple[list[_Part], bool]:
    """The physical tables and buckets that a written change set touches, and whether it has the NULL key.

    With ``unique`` a key that occurs twice fails.
    """
    key = F.col(layout.key)
    of = changes.select(layout.is_high(key).alias("high"), layout.bucket(key).alias(BUCKET), key.alias("__k"))
    distinct = F.count_distinct("__k") if unique else F.lit(0)
    # one row a touched bucket: small numbers
    stats = of.groupBy("high", BUCKET).agg(
        F.count(F.lit(1)).alias("n"), distinct.alias("keys"), F.sum(F.col("__k").isNull().cast("int")).alias("nulls")).collect()
    for r in stats:
        if unique and (r["n"] != r["keys"] + min(r["nulls"], 1) or r["nulls"] > 1):
            raise ValueError(f"change set has a duplicate key (bucket {r[BUCKET]})")
    parts = []
    for high, table, valid in layout.parts():
        buckets = sorted(r[BUCKET] for r in stats if bool(r["high"]) == high)
        if buckets:
            parts.append(_Part(high, table, buckets, layout.low << high, valid))
    return parts, any(r["nulls"] for r in stats)


def _share(layout: Layout, changes: DataFrame, part: _Part) -> DataFrame:
    """The changes that belong to one physical table."""
    return changes if not layout.split else changes.filter(layout.is_high(F.col(layout.key)) == F.lit(part.high))


def _with_bucket(layout: Layout, rows: DataFrame, high: bool) -> DataFrame:
    of = bucket_of(F.col(layout.key).cast(layout.key_type), layout.low << high)
    return rows.select(*layout.columns, of.alias(BUCKET))


def _observed(counted: Observation) -> dict:
    """What a write observed; a plan found to be empty is folded away together with its observation."""
    try:
        return counted.get
    except Py4JJavaError:
        return {"n": 0, "filled": []}


def _append(spark: SparkSession, layout: Layout, rows: DataFrame) -> int:
    """Adds rows to their buckets; how many."""
    total = 0
    for high, table, _ in layout.parts():
        mine = rows if not layout.split else rows.filter(layout.is_high(F.col(layout.key).cast(layout.key_type)) == F.lit(high))
        counted = Observation()
        out = _with_bucket(layout, mine, high).observe(counted, F.count(F.lit(1)).alias("n"))
        out.hint("rebalance", BUCKET).write.insertInto(table)
        total += _observed(counted)["n"]
    return total


def _overwrite(spark: SparkSession, part: _Part, rows: DataFrame) -> int:
    """Replaces the touched buckets by ``rows``, in one write, and drops those without any; the rows written.

    A dynamic partition overwrite replaces partitions only when the job commits: the
    plan may read the table that it replaces, and a failed job leaves the old buckets in place.
    """
    counted = Observation()
    # at most one small number a touched bucket
    out = rows.observe(counted, F.count(F.lit(1)).alias("n"), F.collect_set(BUCKET).alias("filled"))
    out.write.insertInto(part.table, overwrite=True)
    seen = _observed(counted)
    filled = set(seen["filled"])
    _drop_buckets(spark, part.table, [b for b in part.touched if b not in filled])
    return seen["n"]


def append_rows(spark: SparkSession, name: str, rows: DataFrame) -> None:
    """SNK-5/SNK-6: append rows to a keyed table (no key check; see insert_if_absent)."""
    layout = layout_of(spark, name)
    _grow(spark, layout, _append(spark, layout, rows))


def _null_row(layout: Layout, changes: DataFrame, has_null: bool):
    """The change of the NULL key: one row, as a change set names a key once."""
    return changes.filter(F.col(layout.key).isNull()).first() if has_null else None


def updated_rows(spark: SparkSession, layout: Layout, part: _Part, changes: DataFrame, set_cols: Sequence[str], null_row=None) -> DataFrame:
    """The rows of the touched buckets with the change set's columns set; no exchange of the table."""
    mine = _share(layout, changes, part).select(
        F.col(layout.key).alias("__key"), F.lit(True).alias("__hit"), *[F.col(c).alias(f"__new_{c}") for c in set_cols])
    rows = part.rows(spark)
    merged = rows.join(mine, rows[layout.key] == mine["__key"], "left")
    types = {f.name: f.dataType for f in rows.schema}
    out = []
    for c in layout.columns:
        value = F.col(c)
        if c in set_cols:
            value = F.when(F.col("__hit"), F.col(f"__new_{c}").cast(types[c])).otherwise(value)
            if null_row is not None:
                value = F.when(F.col(layout.key).isNull(), F.lit(null_row[c]).cast(types[c])).otherwise(value)
        out.append(value.alias(c))
    return merged.select(*out, BUCKET)


def remaining_rows(spark: SparkSession, layout: Layout, part: _Part, keys: DataFrame, null_key: bool) -> DataFrame:
    """The rows of the touched buckets whose key is not among ``keys``; no exchange of the table."""
    mine = _share(layout, keys, part).select(F.col(layout.key).alias("__key"))
    rows = part.rows(spark)
    rows = rows.filter(F.col(layout.key).isNotNull()) if null_key else rows
    return rows.join(mine, rows[layout.key] == mine["__key"], "left_anti").select(*layout.columns, BUCKET)


def present_keys(spark: SparkSession, layout: Layout, parts: list[_Part], keys: DataFrame, columns: Sequence[str],
                 null_key: bool) -> DataFrame:
    """``columns`` of the rows whose key is among ``keys``: scans of those columns, no exchange of the table."""
    found = None
    for part in parts:
        mine = _share(layout, keys, part).select(F.col(layout.key).alias("__key"))
        rows = part.rows(spark).select(*dict.fromkeys([layout.key, *columns]))
        got = rows.join(mine, rows[layout.key] == mine["__key"], "left_semi").select(*columns)
        found = got if found is None else found.union(got)
    if null_key:
        found = found.union(lookup(spark, layout.name, None, columns))
    return found if found is not None else spark.table(layout.name).select(*columns).limit(0)


# -------------------------------------------------------------- operations


def insert_if_absent(spark: SparkSession, name: str, rows: DataFrame) -> None:
    """MNT-1: append the rows whose key is not in the table yet.

    Of the table only the key column of the touched buckets is read.
    """
    layout = layout_of(spark, name)
    rows = _normalised(layout, rows)
    parts, has_null = _touched(layout, rows, unique=True)
    if not parts:
        return
    present = present_keys(spark, layout, parts, rows, [layout.key], False).select(F.col(layout.key).alias("__key"))
    fresh = rows.join(present, rows[layout.key] == present["__key"], "left_anti")
    if has_null and lookup(spark, name, None, [layout.key]).limit(1).count():
        fresh = fresh.filter(F.col(layout.key).isNotNull())
    _grow(spark, layout, _append(spark, layout, fresh))


def update_by_key(spark: SparkSession, name: str, changes: DataFrame) -> None:
    """MNT-2: set the change set's non-key columns on the rows with its keys.

    Absent keys change nothing (M15); row count never changes (M14).
    """
    layout = layout_of(spark, name)
    set_cols = [c for c in changes.columns if c != layout.key]
    unknown = [c for c in set_cols if c not in layout.columns]
    if unknown:
        raise ValueError(f"unknown columns in change set: {unknown}")
    changes = _normalised(layout, changes)
    parts, has_null = _touched(layout, changes, unique=True)
    null_row = _null_row(layout, changes, has_null)
    for part in parts:
        _overwrite(spark, part, updated_rows(spark, layout, part, changes, set_cols, null_row))


def delete_by_key(spark: SparkSession, name: str, keys: DataFrame) -> None:
    """MNT-3: remove the rows whose key is in ``keys`` (the NULL key too; M13)."""
    layout = layout_of(spark, name)
    doomed = _normalised(layout, keys.select(layout.key))
    parts, has_null = _touched(layout, doomed, unique=False)
    for part in parts:
        _overwrite(spark, part, remaining_rows(spark, layout, part, doomed, has_null))


def merge(spark: SparkSession, name: str, changes: DataFrame, op_col: str = "op",
          update_columns: Sequence[str] | None = None) -> DataFrame:
    """MNT-1/2/3 in one change set: each row names a key and an operation.

    ``insert`` adds the row if its key is absent, ``update`` sets ``update_columns`` (default: every column that
    the change set shares with the table) if it is present, ``delete`` removes it if it is present.  A key
    may occur once.  Returns one row a change: (key, op, outcome); the outcome is inserted, updated, deleted, or
    refused: what an insert of a present key, an update or delete of an absent one and an unknown operation get.

    The key column of the touched buckets is read first, to judge the changes.  Then only
    buckets with an accepted update or delete are rewritten, each once, from one scan and one join; accepted inserts
    into other buckets are appended.  Buckets whose changes were all refused are not touched.
    """
    layout = layout_of(spark, name)
    key = layout.key
    set_cols = [c for c in (update_columns or changes.columns) if c in layout.columns and c != key]
    unknown = [c for c in changes.columns if c not in layout.columns and c != op_col]
    if unknown:
        raise ValueError(f"unknown columns in change set: {unknown}")
    changes = _normalised(layout, changes)
    parts, has_null = _touched(layout, changes, unique=True)
    present = present_keys(spark, layout, parts, changes, [key], False).select(F.col(key).alias("__key")).distinct()
    held = F.col("__key").isNotNull()
    if has_null and lookup(spark, name, None, [key]).limit(1).count():
        held = held | F.col(key).isNull()
    outcome = (
        F.when((F.col(op_col) == "insert") & ~held, "inserted").when((F.col(op_col) == "update") & held, "updated")
        .when((F.col(op_col) == "delete") & held, "deleted").otherwise("refused")
    )
    judged = written_once(changes.join(present, changes[key] == present["__key"], "left").withColumn("__outcome", outcome).drop("__key"))
    new = judged.filter("__outcome = 'inserted'")
    moved = judged.filter("__outcome IN ('updated', 'deleted')")
    rewritten, _ = _touched(layout, moved, unique=False)
    more = 0
    missing = [F.lit(None).alias(c) for c in layout.columns if c not in changes.columns]
    new = new.select("*", *missing)
    for part in rewritten:
        null_row = _null_row(layout, judged.filter("__outcome = 'updated'"), has_null)
        doomed = moved.filter("__outcome = 'deleted'")
        null_dies = has_null and doomed.filter(F.col(key).isNull()).limit(1).count() > 0
        rows = merged_rows(spark, layout, part, moved, set_cols, null_row, null_dies)
        into = _with_bucket(layout, _share(layout, new, part), part.high)
        _overwrite(spark, part, rows.union(into.filter(F.col(BUCKET).isin(part.touched))))
    elsewhere = new
    for part in rewritten:
        here = (layout.is_high(F.col(key)) == F.lit(part.high)) & layout.bucket(F.col(key)).isin(part.touched)
        elsewhere = elsewhere.filter(~here)
    _append(spark, layout, elsewhere)
    # three numbers at most
    for r in judged.groupBy("__outcome").agg(F.count("*").alias("n")).collect():
        more += {"inserted": r["n"], "deleted": -r["n"]}.get(r["__outcome"], 0)
    _grow(spark, layout, more)
    return judged.select(key, op_col, F.col("__outcome").alias("outcome"))


def merged_rows(spark: SparkSession, layout: Layout, part: _Part, moved: DataFrame, set_cols: Sequence[str], null_row=None,
                null_dies: bool = False) -> DataFrame:
    """The rows of the touched buckets after accepted updates and deletes: one scan, one join, no exchange of the table."""
    mine = _share(layout, moved, part).select(
        F.col(layout.key).alias("__key"), (F.col("__outcome") == "deleted").alias("__dies"), *[F.col(c).alias(f"__new_{c}") for c in set_cols])
    rows = part.rows(spark)
    joined = rows.join(mine, rows[layout.key] == mine["__key"], "left").filter(~F.coalesce("__dies", F.lit(False)))
    if null_dies:
        joined = joined.filter(F.col(layout.key).isNotNull())
    types = {f.name: f.dataType for f in rows.schema}
    out = []
    for c in layout.columns:
        value = F.col(c)
        if c in set_cols:
            value = F.when(F.col("__dies").isNotNull(), F.col(f"__new_{c}").cast(types[c])).otherwise(value)
            if null_row is not None:
                value = F.when(F.col(layout.key).isNull(), F.lit(null_row[c]).cast(types[c])).otherwise(value)
        out.append(value.alias(c))
    return joined.select(*out, BUCKET)


def lookup(spark: SparkSession, name: str, key_value, columns: Sequence[str] | None = None) -> DataFrame:
    """MNT-4: the row(s) of one key; its bucket becomes a partition filter, the key a filter on row groups."""
    layout = layout_of(spark, name)
    literal = F.lit(key_value).cast(layout.key_type)
    same = F.col(layout.key).isNull() if key_value is None else F.col(layout.key) == literal
    found = None
    for high, table, _ in layout.parts():
        # constants: of two physical tables the one that cannot hold the key folds away
        there = F.col(BUCKET) == bucket_of(literal, layout.low << high)
        there = there & (layout.is_high(literal) == F.lit(high)) if layout.split else there
        df = spark.table(table).filter(there & same).select(*(columns or layout.columns))
        found = df if found is None else found.union(df)
    return found


def lookup_many(spark: SparkSession, name: str, keys: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """MNT-4 for a key set: a semi join restricted to the keys' buckets, without an exchange of the table."""
    layout = layout_of(spark, name)
    keys = _normalised(layout, keys.select(layout.key))
    parts, has_null = _touched(layout, keys, unique=False)
    return present_keys(spark, layout, parts, keys, list(columns or layout.columns), has_null)


def projection_view(spark: SparkSession, name: str, view: str, columns: Sequence[str]) -> DataFrame:
    """MNT-5: a view listing only ``columns`` (e.g. users without passwords)."""
    spark.table(name).select(*columns).createOrReplaceTempView(view)
    return spark.table(view)
