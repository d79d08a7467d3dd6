"""Header-less comma-delimited text: sink (SNK-1) and loader (SRC-7).

The format has no quoting or escaping (M19).  The loader follows the
semantics of a Hive ``ROW FORMAT DELIMITED`` text table (M20):

* a malformed int / double becomes NULL, an int written with a fraction
  (``3.9``) keeps its integer part;
* a short row gets trailing NULLs, extra fields are dropped;
* ``\\N`` is NULL, an empty string stays ``''``;
* quotes are literal characters;
* a blank line is a row of NULLs.

Both directions are plain Spark text jobs (split per line, one task per file
split), so they scale with the number of input splits / output partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faceoff.functions.text import without_separator

NULL_TOKEN = "\\N"
_INT_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_INT_TEXT = r"^[+-]?[0-9]+(\.[0-9]*)?$"


def unreadable(c: Column, sep: str = ",", single: bool = False) -> Column:
    """Whether the format cannot carry a text: it holds ``sep`` or a line break, is the
    NULL token, or is empty in a table of one column (FN-12).  NULL can be carried."""
    bad = (F.instr(c, sep) > 0) | c.rlike("[\\r\\n]") | (c == NULL_TOKEN) | ((c == "") if single else F.lit(False))
    return F.coalesce(bad, F.lit(False))


def to_delimited_line(df: DataFrame, sep: str = ",", guard: bool = True) -> DataFrame:
    """One ``value`` string column per row: fields joined by ``sep``.

    NULL is written as ``\\N`` (``concat_ws`` would skip it and shift the
    columns).  With ``guard`` a value that would read back as something else
    fails the job (FN-12): one with ``sep`` or a line break in it, the text
    ``\\N``, and in a table of one column the empty text (a blank line).
    """
    fields = []
    single = len(df.columns) == 1
    for name in df.columns:
        text = F.col(name).cast("string")
        if guard:
            what = f"column {name}"
            failed = F.raise_error(F.lit(f"{what} holds a value that the format cannot carry"))
            text = F.when(unreadable(without_separator(text, sep, what=what), sep, single), failed).otherwise(text)
        fields.append(F.coalesce(text, F.lit(NULL_TOKEN)))
    return df.select(F.concat_ws(sep, *fields).alias("value"))


def write_delimited(df: DataFrame, path: str, sep: str = ",", mode: str = "errorifexists", guard: bool = True) -> None:
    """Write ``df`` as delimited text files under ``path`` (one file per partition)."""
    to_delimited_line(df, sep, guard).write.mode(mode).text(path)


def _field(parts: Column, i: int) -> Column:
    raw = F.get(parts, i)
    return F.when(raw == F.lit(NULL_TOKEN), F.lit(None).cast("string")).otherwise(raw)


def _typed(text: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.StringType):
        return text
    if isinstance(data_type, _INT_TYPES):
        whole = F.regexp_extract(text, r"^([+-]?[0-9]+)", 1)
        return F.when(text.rlike(_INT_TEXT), whole.try_cast(data_type)).otherwise(F.lit(None).cast(data_type))
    return text.try_cast(data_type)


def parse_delimited(lines: DataFrame, schema: T.StructType, sep: str = ",", column: str = "value") -> DataFrame:
    """Typed rows from a DataFrame of text lines."""
    parts = F.split(F.col(column), _split_pattern(sep), -1)
    blank = F.col(column) == F.lit("")
    cols = [
        F.when(blank, F.lit(None).cast(f.dataType)).otherwise(_typed(_field(parts, i), f.dataType)).alias(f.name)
        for i, f in enumerate(schema.fields)
    ]
    return lines.select(*cols)


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",") -> DataFrame:
    """Load delimited text with a fixed schema (no inference)."""
    return parse_delimited(spark.read.text(path), schema, sep)


def _split_pattern(sep: str) -> str:
    return "".join("\\" + ch if ch in r".[]{}()\*+?^$|" else ch for ch in sep)
