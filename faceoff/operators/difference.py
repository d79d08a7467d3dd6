"""The difference of two contents of a table, found by digests before rows are compared.

Rows are dealt into ``PARTS`` parts by the hash of their key.  A part's digest (its row
count and two combinations of its rows' hashes that do not depend on their order) comes from one
aggregation, combined before the shuffle; at most ``PARTS`` rows of it reach the
driver.  Parts of equal digests hold equal rows and take no further part, so an unchanged table is known from
its digests alone, and the comparison by key reads only the parts that differ.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARTS = 64


def _part(key: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(PARTS)).cast("int")


def _row_hash(columns: Sequence[str], seed: int) -> Column:
    # hashes pass over nulls: the flags tell a null from an empty value
    flags = [F.col(c).isNull() for c in columns]
    return F.xxhash64(F.lit(seed), *columns, *flags)


def part_digests(df: DataFrame, key: Sequence[str]) -> dict[int, list]:
    """{part: [rows, exclusive or, sum of the rows' hashes]}."""
    columns = sorted(df.columns)
    found = df.groupBy(_part(key).alias("part")).agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(_row_hash(columns, 1)).alias("x"),
        F.sum(_row_hash(columns, 2).cast("decimal(38,0)")).cast("string").alias("s"))
    return {r["part"]: [r["n"], r["x"], r["s"]] for r in found.collect()}  # at most PARTS rows


def to_text(digests: dict[int, list]) -> str:
    """The digests as text without quotes, for a table property."""
    return ";".join(f"{p}:{n}:{x}:{s}" for p, (n, x, s) in sorted(digests.items()))


def from_text(text: str) -> dict[int, list]:
    parts = (t.split(":") for t in text.split(";") if t)
    return {int(p): [int(n), int(x), s] for p, n, x, s in parts}


def differing(before: dict[int, list], after: dict[int, list]) -> list[int]:
    """The parts whose rows are not the same."""
    return sorted(p for p in before.keys() | after.keys() if before.get(p) != after.get(p))


def changes(before: DataFrame, after: DataFrame, key: Sequence[str], parts: Sequence[int] | None = None) -> DataFrame:
    """``change`` (added, changed, removed) and the rows: of ``after`` for added and changed keys, of ``before`` for removed ones.

    Keys need not be unique: the rows of a key are compared as a whole, repeats included.  Null is a key.
    ``parts`` are the parts that differ, if that is known.
    """
    parts = differing(part_digests(before, key), part_digests(after, key)) if parts is None else list(parts)
    columns = list(after.columns)
    old, new = (d.select(*columns).filter(_part(key).isin(parts)) for d in (before, after))

    def by_key(df: DataFrame, side: str) -> DataFrame:
        hashes = _row_hash(sorted(columns), 1), _row_hash(sorted(columns), 2)
        return df.groupBy(F.struct(*key).alias("key")).agg(
            F.struct(F.count(F.lit(1)), F.bit_xor(hashes[0]), F.sum(hashes[1].cast("decimal(38,0)"))).alias(side))

    # a struct is never null and equals itself where its fields are null
    both = by_key(old, "was").join(by_key(new, "is_now"), "key", "full_outer")
    verdict = (
        F.when(F.col("was").isNull(), "added").when(F.col("is_now").isNull(), "removed")
        .when(F.col("was") != F.col("is_now"), "changed")
    )
    judged = both.select("key", verdict.alias("change")).filter("change IS NOT NULL")
    rows = new.withColumn("key", F.struct(*key)).join(judged.filter("change <> 'removed'"), "key")
    gone = old.withColumn("key", F.struct(*key)).join(judged.filter("change = 'removed'"), "key")
    return rows.select("change", *columns).unionByName(gone.select("change", *columns))
