"""Session helpers: a local session for tests/bench and the shared folder
used for checkpoints, stream state and intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8,
                  app: str = "tidemark") -> SparkSession:
    """Local session used by tests and bench; on a cluster use spark-submit
    settings instead (nothing here is required by the library)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_base(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or
    the context's checkpoint folder.  Where neither is set, a session whose
    tasks run in the driver's own process (``local[...]``) gets a temporary
    folder; on a cluster that is an error, as executors would not see it."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh folder below the shared folder (see ``checkpoint_base``)."""
    return "/".join([checkpoint_base(spark), "tidemark", *parts, uuid.uuid4().hex])


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``df.checkpoint()`` usable: register the shared folder if unset."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(checkpoint_base(spark))


def materialize(df):
    """Cut lineage: reliable ``checkpoint`` into the shared checkpoint folder
    (survives executor loss; never a local checkpoint).  The frame is
    persisted while it is written, otherwise the eager checkpoint computes the
    plan twice (once to count, once to write)."""
    ensure_checkpoint_dir(df.sparkSession)
    df.persist()
    try:
        return df.checkpoint(eager=True)
    finally:
        df.unpersist()
