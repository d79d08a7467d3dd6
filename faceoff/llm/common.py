"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import faceoff
from faceoff.session import scratch_dir

# crc32 of the id's text, modulo this, is 0 for the rows that are held out of every fit.
FOLDS = 5


def ship_code(spark: SparkSession) -> None:
    """Gives the Python workers this package, once a session (as ``--py-files`` would)."""
    context = spark.sparkContext
    if getattr(context, "_faceoff_shipped", False):
        return
    package = Path(faceoff.__file__).parent
    handle, path = tempfile.mkstemp(prefix="faceoff-", suffix=".zip")  # the driver serves it to the executors
    os.close(handle)
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    context.addPyFile(path)
    context._faceoff_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_code(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back.

    Cuts the lineage: what follows reads files that every executor can reach,
    so a lost executor never makes Spark run the Python work above again.
    """
    path = scratch_dir(df.sparkSession, f"llm-{label}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(taken: list[str], name: str) -> str:
    """``name``, or one like it that is no column of ``taken``."""
    while name.lower() in {t.lower() for t in taken}:
        name = "_" + name
    return name


def held_out(id_col: str = "doc_id") -> Column:
    """True for the rows whose labels must not be learned (null ids: held out)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def sample_labelled(docs: DataFrame, labels: DataFrame, label_col: str, max_rows: int,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """At most ``max_rows`` labelled rows outside the held-out fold: (text, label).

    The rows with the smallest hash of their id are taken, so the sample is the
    same in every run.  Its ids are at most ``max_rows`` longs, which bounds
    what the join broadcasts; of documents that share an id the text with the least hash
    is taken, reduced before the shuffle, which bounds the rows.  Rows whose label is null or not 0/1
    and rows of ids labelled twice in contradiction take no part.
    """
    ids = (
        labels.filter(F.col(label_col).isin(0, 1) & ~held_out(id_col))
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.min(label_col).alias("label"), F.max(label_col).alias("_other"))
        .filter(F.col("label") == F.col("_other"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(max_rows)
        .select("_id", F.col("label").cast("int").alias("label"))
    )
    pairs = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    one = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("one")
    return pairs.join(F.broadcast(ids), "_id").groupBy("_id", "label").agg(one).select("one.text", "label")
