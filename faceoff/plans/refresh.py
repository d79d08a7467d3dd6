"""Refresh: documents → flat tables → new snapshots (§2.4).

``refresh(spark, trigger, sources)`` runs the ingest jobs a trigger names,
each one ``read documents → explode → select → write snapshot`` as a single
lazy plan, parallel over input files / JSON lines.  The roster job also
writes the partitioned players table.  Documents come from a landing folder
(``sources`` maps a document kind to a path) instead of an HTTP download.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faceoff import schemas
from faceoff.operators import difference, tables
from faceoff.sources import documents, ingest

# Fixed values that must equal the reference's: the 32 team ids kept in the
# partitioned players table, in the reference's order.
PARTITIONED_TEAM_IDS = (24, 53, 6, 7, 20, 12, 16, 21, 29, 25, 17, 22, 13, 26, 30, 8, 18, 1, 2, 3, 9, 4, 5, 28, 55, 19,
                        14, 10, 23, 54, 15, 52)


@dataclass(frozen=True)
class Job:
    table: str
    document: str
    schema: Callable[[Mapping[str, str]], object]
    flatten: Callable[[DataFrame, Mapping[str, str]], DataFrame]


JOBS = {
    "teams": Job("teams", "teams", lambda f: schemas.teams_document(), lambda d, f: ingest.teams(d)),
    "players": Job(
        "players",
        "roster",
        lambda f: schemas.roster_document(f["roster"]),
        lambda d, f: ingest.players(d, f["roster"]),
    ),
    "nextGames": Job(
        "nextGames",
        "schedule_next",
        lambda f: schemas.schedule_document(f["next_schedule"]),
        lambda d, f: ingest.next_games(d, f["next_schedule"]),
    ),
    "pastGames": Job(
        "pastGames",
        "schedule_previous",
        lambda f: schemas.schedule_document(f["previous_schedule"]),
        lambda d, f: ingest.past_games(d, f["previous_schedule"]),
    ),
    "standings": Job(
        "standings",
        "stats",
        lambda f: schemas.stats_document(f["team_stats"]),
        lambda d, f: ingest.standings(d, f["team_stats"]),
    ),
}


def document_fields(overrides: Mapping[str, str] | None = None) -> dict[str, str]:
    """Default intermediate field names, with ``overrides`` applied."""
    fields = dict(schemas.DOCUMENT_FIELDS)
    unknown = set(overrides or {}) - set(fields)
    if unknown:
        raise ValueError(f"unknown document fields: {sorted(unknown)}")
    fields.update(overrides or {})
    return fields


# Within-task sort of each written snapshot: rows of one team / date sit in
# few row groups, so Parquet min/max statistics let scans filtering on them
# skip the rest.  No shuffle, one sort per task.
LAYOUT = {
    "players": ("TeamID", "Position"),
    "pastGames": ("Date",),
    "nextGames": ("Date",),
    "standings": ("TeamID",),
}



def laid_out(job: str, rows: DataFrame) -> DataFrame:
    """``rows`` sorted within tasks by the job's layout columns (if any)."""
    return rows.sortWithinPartitions(*LAYOUT[job]) if job in LAYOUT else rows


# What names a row in a difference of two refreshes (its rows are compared as a whole).
KEYS = {"teams": ("ID",), "players": ("ID", "TeamID"), "standings": ("TeamID",), "pastGames": ("GameID",),
        "nextGames": ("GameID",)}

TRIGGERS = {
    "teams": ("teams",),
    "next game": ("nextGames",),
    "last game": ("pastGames",),
    "roster": ("players",),
    "standings": ("standings",),
    "all": ("teams", "players", "nextGames", "pastGames", "standings"),
    "notNext": ("teams", "players", "pastGames", "standings"),
    # the same by the words of the refresh menu
    "players": ("players",),
    "next games": ("nextGames",),
    "last games": ("pastGames",),
}


def jobs_for(trigger: str) -> tuple[str, ...]:
    if trigger not in TRIGGERS:
        raise ValueError(f"unknown refresh trigger {trigger!r}; expected one of {', '.join(TRIGGERS)}")
    return TRIGGERS[trigger]


def flatten_documents(
    spark: SparkSession,
    job: str,
    path: str,
    multi_line: bool = True,
    on_corrupt: str = "fail",
    fields: Mapping[str, str] | None = None,
) -> DataFrame:
    """Rows of one table from the documents at ``path`` (lazy).

    ``on_corrupt="fail"`` makes the job fail on a malformed document (checked
    row by row in the same pass, no extra scan); ``"keep"`` flattens what
    parsed (``rejected_documents`` has the rest).
    """
    spec = JOBS[job]
    names = document_fields(fields)
    docs = documents.read_documents(spark, path, spec.schema(names), multi_line=multi_line)
    if on_corrupt == "fail":
        docs = documents.fail_on_corrupt(docs, what=f"{spec.document} document")
    elif on_corrupt != "keep":
        raise ValueError("on_corrupt must be 'fail' or 'keep'")
    return spec.flatten(docs, names)


def rejected_documents(
    spark: SparkSession, job: str, path: str, multi_line: bool = True, fields: Mapping[str, str] | None = None
) -> DataFrame:
    """(path, raw, parsed) of the malformed documents at ``path``."""
    schema = JOBS[job].schema(document_fields(fields))
    return documents.rejected(documents.read_documents(spark, path, schema, multi_line=multi_line))


def publish(
    spark: SparkSession,
    job: str,
    source: str,
    database: str | None = None,
    multi_line: bool = True,
    on_corrupt: str = "fail",
    fields: Mapping[str, str] | None = None,
    team_ids: Sequence[int] = PARTITIONED_TEAM_IDS,
    only_changed: bool = False,
) -> dict[str, str]:
    """Snapshots of one job from the newest complete generation under ``source``.

    Nothing is written while no generation is complete.  With
    ``on_corrupt="keep"`` the malformed documents become the snapshot
    ``<table>__rejected``.

    With ``only_changed`` nothing is written either if the newest generation is the one that is published, or
    if its rows are: the digests of the new rows' parts, from one more pass, are compared with those kept
    with the published snapshot.
    """
    path = documents.newest_generation(spark, source)
    if path is None:
        return {}
    spec, prefix = JOBS[job], f"{database}." if database else ""
    rows = flatten_documents(spark, job, path, multi_line, on_corrupt, fields)
    written, properties, unchanged = {}, {"generation": path}, False
    if only_changed:
        current = tables.snapshot_versions(spark, prefix + spec.table)[-1:]
        known = tables.snapshot_property(spark, current[0], "generation") if current else None
        if known == path and path.rstrip("/") != source.rstrip("/"):
            return {}  # a complete generation does not change
        digests = difference.part_digests(rows, KEYS[job])
        properties["digests"] = difference.to_text(digests)
        unchanged = bool(current) and tables.snapshot_property(spark, current[0], "digests") == properties["digests"]
    if on_corrupt == "keep":
        name = f"{spec.table}__rejected"
        bad = rejected_documents(spark, job, path, multi_line, fields)
        written[name] = tables.replace_snapshot(spark, prefix + name, bad)
    if unchanged:
        return written
    written[job] = tables.replace_snapshot(spark, prefix + spec.table, laid_out(job, rows), properties=properties)
    if job == "players":
        # The partitioned copy is replaced whole, like the flat table.
        parti_rows = tables.for_partitioned_write(
            spark.table(prefix + spec.table), "TeamID", team_ids, sort_by=["Position"]
        )
        written["partiPlayers"] = tables.replace_snapshot(
            spark, prefix + "partiPlayers", parti_rows, partition_by=["TeamID"]
        )
    return written


def refresh(
    spark: SparkSession,
    trigger: str,
    sources: Mapping[str, str],
    database: str | None = None,
    multi_line: bool = True,
    on_corrupt: str = "fail",
    fields: Mapping[str, str] | None = None,
    team_ids: Sequence[int] = PARTITIONED_TEAM_IDS,
    only_changed: bool = False,
) -> dict[str, str]:
    """Run the ingest jobs of ``trigger``; returns table → snapshot written.

    A failing job leaves that table's previous snapshot in place: the view
    switches only after the new version is fully written.  A source with
    generation folders gives its newest complete generation (see
    ``documents.newest_generation``); without a complete one its job is left
    out of the result.  ``team_ids`` are the teams of the partitioned players table.
    """
    written = {}
    for job in jobs_for(trigger):
        document = JOBS[job].document
        if document not in sources:
            raise ValueError(f"no source given for document {document!r} (job {job})")
        written |= publish(spark, job, sources[document], database, multi_line, on_corrupt, fields, team_ids, only_changed)
    return written


def refresh_changes(spark: SparkSession, job: str, database: str | None = None) -> DataFrame:
    """The rows that the last refresh of a job added, changed or removed (``change`` and the table's columns).

    Compares the published snapshot with the one before it, in the parts whose digests differ; digests that
    were kept with the snapshots are not taken again.
    """
    name = (f"{database}." if database else "") + JOBS[job].table
    versions = tables.snapshot_versions(spark, name)
    if not versions:
        raise ValueError(f"{name} was never refreshed")
    after = spark.table(versions[-1])
    if len(versions) == 1:
        return after.select(F.lit("added").alias("change"), "*")
    before, kept = spark.table(versions[-2]), []
    for version, rows in ((versions[-2], before), (versions[-1], after)):
        text = tables.snapshot_property(spark, version, "digests")
        kept.append(difference.part_digests(rows, KEYS[job]) if text is None else difference.from_text(text))
    return difference.changes(before, after, KEYS[job], difference.differing(*kept))
