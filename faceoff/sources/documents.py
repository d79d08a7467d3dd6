"""Nested JSON documents: reading and flattening (SRC-1 … SRC-6).

Documents are read with a fixed schema that includes ``_corrupt_record``: a
field of the wrong type becomes NULL while the rest of the record survives
and the raw text is kept, a broken document keeps only its text.  JSON
lines (one document per line) are splittable; pretty-printed single-document
files need ``multi_line=True`` and parallelise over files only.

Flattening is ``explode`` over the nested arrays — a narrow ``Generate``
operator, no shuffle — with parent fields carried down to each child row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faceoff.schemas import CORRUPT_RECORD

GENERATION, COMPLETE = "generation", "COMPLETE"


def read_documents(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType,
    multi_line: bool = False,
) -> DataFrame:
    """Read JSON documents with a fixed schema, keeping malformed text."""
    if CORRUPT_RECORD not in schema.fieldNames():
        schema = T.StructType(list(schema.fields) + [T.StructField(CORRUPT_RECORD, T.StringType())])
    reader = (
        spark.read.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_RECORD)
        .option("multiLine", str(multi_line).lower())
    )
    paths = [path] if isinstance(path, str) else list(path)
    return reader.json(paths)


def newest_generation(spark: SparkSession, path: str) -> str | None:
    """The folder of the documents to read under ``path``.

    A feed that publishes generations has a folder ``generation=<name>`` each
    (numbers, or times written alike) and adds an empty file ``COMPLETE`` when all
    of a generation's documents are there: the newest complete one is taken, or
    None while there is none.  A path without such folders is one generation.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    folders = [s.getPath() for s in fs.globStatus(hadoop.Path(root, f"{GENERATION}=*")) or []]
    if not folders:
        return path
    complete = [f for f in folders if fs.exists(hadoop.Path(f, COMPLETE))]
    if not complete:
        return None
    return max(complete, key=lambda f: f.getName().split("=", 1)[1].zfill(32)).toString()


def mark_complete(spark: SparkSession, folder: str) -> None:
    """Says that all documents of the generation in ``folder`` are there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{COMPLETE}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True).close()


def rejected(docs: DataFrame) -> DataFrame:
    """(path, raw, parsed) of the malformed documents: file, text, and what could be read of it as JSON."""
    # the JSON source does not give the raw text alone, so what was parsed comes with it
    data = [c for c in docs.columns if c != CORRUPT_RECORD]
    return docs.filter(F.col(CORRUPT_RECORD).isNotNull()).select(
        F.input_file_name().alias("path"), F.col(CORRUPT_RECORD).alias("raw"), F.to_json(F.struct(*data)).alias("parsed")
    )


def fail_on_corrupt(docs: DataFrame, what: str = "document") -> DataFrame:
    """Keep ``docs`` unchanged but fail the job at the first malformed document.

    The check is a filter evaluated while the documents are flattened, so it
    costs no extra pass over the input.
    """
    bad = F.col(CORRUPT_RECORD).isNotNull()
    message = F.concat(F.lit(f"malformed {what}: "), F.substring(F.col(CORRUPT_RECORD), 1, 200))
    return docs.filter(F.when(bad, F.raise_error(message)).otherwise(F.lit(True)))


def parse_documents(text: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """Parse a column of JSON document text (one document per row)."""
    data = T.StructType([f for f in schema.fields if f.name != CORRUPT_RECORD])
    parsed = F.from_json(F.col(column), data, {"mode": "PERMISSIVE"})
    return text.select(parsed.alias("doc")).select("doc.*")


def explode_path(
    df: DataFrame,
    array: str | Column,
    keep: Sequence[str | Column] = (),
    alias: str = "item",
    outer: bool = False,
) -> DataFrame:
    """One row per element of ``array`` with the ``keep`` columns repeated.

    ``outer=True`` keeps a parent whose array is NULL or empty (one row with a
    NULL element) — the inner form drops it, as the reference's scanners emit
    nothing for a team without games.
    """
    gen = F.explode_outer if outer else F.explode
    array_col = F.col(array) if isinstance(array, str) else array
    return df.select(*keep, gen(array_col).alias(alias))


def first_element(array: str | Column) -> Column:
    """Element 0 of an array, NULL when the array is NULL or empty (not an error)."""
    return F.get(F.col(array) if isinstance(array, str) else array, 0)
