"""Session construction and shared scratch locations."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    app_name: str = "faceoff",
    driver_memory: str = "8g",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session used by tests and the bench.

    On a cluster the caller's own session is used instead; every operator
    reads what it needs (checkpoint directory, partition counts) from the
    session it is handed.
    """
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Python call-site capture costs several py4j round trips per Column
        # call on the driver; plans are built from many small calls.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    extra = dict(extra or {})
    if _single_machine(master):
        # a local run keeps its warehouse and checkpoints out of the working directory
        root = tempfile.mkdtemp(prefix="faceoff-")
        extra.setdefault("spark.sql.warehouse.dir", f"{root}/warehouse")
        extra.setdefault(CHECKPOINT_CONF, f"{root}/checkpoints")
    for key, value in extra.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _single_machine(master: str) -> bool:
    # local-cluster[...] has executors of its own, which do not share the driver's folders
    return master == "local" or master.startswith("local[")


def _is_local(spark: SparkSession) -> bool:
    return _single_machine(spark.conf.get("spark.master", ""))


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - a Spark Connect session has no local context
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint root named by the session.

    A cluster names a shared folder in ``spark.checkpoint.dir``; it is used as
    is.  Only a local session without that setting (tests, the bench) gets a
    fresh temporary folder of its own.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        if not _is_local(spark):
            raise RuntimeError(
                f"{CHECKPOINT_CONF} is not set; name a shared folder for checkpoints "
                "and scratch tables"
            )
        root = tempfile.mkdtemp(prefix="faceoff-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, root)
    sc = _context(spark)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root.rstrip("/") + "/rdd")
    return root


def scratch_dir(spark: SparkSession, label: str = "scratch") -> str:
    """A fresh, never-reused folder under the shared checkpoint root."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/{label}-{uuid.uuid4().hex[:12]}"
