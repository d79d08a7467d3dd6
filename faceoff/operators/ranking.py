"""Global row numbers without a single-partition window.

``row_number() OVER (ORDER BY …)`` with no PARTITION BY moves every row into
one task.  Here the rows are range-partitioned by the (total) sort key, each
row is tagged with its partition and its index inside it, the tagged result
is checkpointed to the shared checkpoint folder (so partition boundaries
cannot change between the count and the numbering, and lineage is cut), and
each partition's offset is the running sum of the preceding partitions'
counts.  The offsets table has one row per partition — a bound fixed by the
partition count, not by the data — and is the only thing broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faceoff.operators.reports import total_order
from faceoff.session import ensure_checkpoint_dir

_PID, _MID, _N, _OFF = "__pid", "__mid", "__n", "__offset"


def global_row_number(df: DataFrame, order: Sequence[str], name: str = "pos") -> DataFrame:
    """``df`` plus a 1-based ``name`` column numbering the rows in ``order``.

    ``order`` holds column names (``reports.desc(c)`` for descending); the
    remaining columns are appended as tie-breakers so the numbering is
    deterministic up to fully identical rows.
    """
    ensure_checkpoint_dir(df.sparkSession)
    columns = df.columns
    tagged = (
        # the row id splits runs of identical rows over several ranges
        df.orderBy(*total_order(df, order), F.monotonically_increasing_id())
        .select("*", F.spark_partition_id().alias(_PID), F.monotonically_increasing_id().alias(_MID))
        .checkpoint(eager=True)
    )
    counts = tagged.groupBy(_PID).agg(F.count(F.lit(1)).alias(_N))
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(_PID, F.coalesce(F.sum(_N).over(before), F.lit(0)).alias(_OFF))
    local_index = F.col(_MID) - F.shiftleft(F.col(_PID).cast("bigint"), 33)
    return tagged.join(F.broadcast(offsets), _PID).select(
        *columns, (F.col(_OFF) + local_index + F.lit(1)).cast("bigint").alias(name)
    )
