"""Refresh on arrival: documents dropped into landing folders drive the refresh.

The reference refreshes when asked and replaces each table with the content
of the freshly fetched document.  The streaming form watches one landing
folder per document kind with the file source.  A micro-batch only says that
something arrived: the table's new snapshot is made by the batch refresh
from the whole newest complete generation in the folder (see
``documents.newest_generation``), so a document that arrives a trigger later than
the others of its generation never replaces them, a half-landed generation
changes nothing until its ``COMPLETE`` file lands, and a late document of
an old generation changes nothing.  A folder without generation folders is one
generation, all of which is read again.

Progress is kept in a checkpoint location; a batch that is run again gives the
same snapshot.  ``availableNow`` processes what is there and stops; a
processing-time trigger keeps watching.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from faceoff.plans.refresh import JOBS, PARTITIONED_TEAM_IDS, document_fields, jobs_for, publish


def _arrivals(spark: SparkSession, folder: str) -> DataFrame:
    """The files of a landing folder and its generation folders, ``COMPLETE`` files too (not read)."""
    return spark.readStream.option("recursiveFileLookup", "true").text(folder)


def refresh_on_arrival(
    spark: SparkSession,
    trigger: str,
    landing: Mapping[str, str],
    checkpoint_root: str,
    database: str | None = None,
    multi_line: bool = True,
    available_now: bool = True,
    processing_time: str | None = None,
    on_corrupt: str = "fail",
    fields: Mapping[str, str] | None = None,
    team_ids: Sequence[int] = PARTITIONED_TEAM_IDS,
) -> list[StreamingQuery]:
    """Start one streaming refresh per job of ``trigger``; returns the queries.

    A micro-batch that brings no newer complete generation, or one with the published rows, writes nothing.
    With ``on_corrupt="fail"`` a malformed document fails its micro-batch (the
    snapshot is not replaced and the query stops at that batch); ``"keep"``
    publishes what parsed and lists the rest in ``<table>__rejected``.
    """
    if on_corrupt not in ("fail", "keep"):
        raise ValueError("on_corrupt must be 'fail' or 'keep'")
    document_fields(fields)
    started = []
    for job in jobs_for(trigger):
        document = JOBS[job].document
        if document not in landing:
            raise ValueError(f"no landing folder for document {document!r} (job {job})")

        def apply(batch: DataFrame, epoch_id: int, job=job, folder=landing[document]) -> None:
            publish(spark, job, folder, database, multi_line, on_corrupt, fields, team_ids, only_changed=True)

        writer = (
            _arrivals(spark, landing[document])
            .writeStream.queryName(f"refresh_{job}_{uuid.uuid4().hex[:8]}")
            .option("checkpointLocation", f"{checkpoint_root.rstrip('/')}/{job}")
            .foreachBatch(apply)
        )
        if available_now:
            writer = writer.trigger(availableNow=True)
        elif processing_time:
            writer = writer.trigger(processingTime=processing_time)
        started.append(writer.start())
    return started
