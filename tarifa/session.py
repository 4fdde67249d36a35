"""Spark session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of an Arrow batch for rows that are whole files; a larger row is a batch of its own.
BATCH_BYTES = 4 << 20


def build_session(app: str = "tarifa", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; settings that exist already win over the defaults here."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
        # Call sites of each column expression cost more than building the plan.
        builder = builder.config("spark.python.sql.dataFrameDebugging.enabled", "false")
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.parquet.compression.codec": "zstd",
    }
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for key, value in defaults.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    spark.conf.set("spark.sql.ansi.enabled", "true")  # the casts of staging rely on it
    return spark


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared folder the cluster names in ``spark.checkpoint.dir``.

    A machine-local folder is only used for a local master, where driver and executors are one process.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_CONF} must name a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="tarifa-")
        spark.conf.set(CHECKPOINT_CONF, root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def bound_batches(spark: SparkSession) -> None:
    """Rows go to Python in batches of a few megabytes instead of up to ten thousand rows, however large these are.

    It is a setting of the session and read when a query runs; one that is lower already stays.
    """
    now = spark.conf.get(BATCH_CONF, None)
    if now is None or not now.isdigit() or int(now) > BATCH_BYTES:
        spark.conf.set(BATCH_CONF, str(BATCH_BYTES))
