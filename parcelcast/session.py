"""Session helpers: the shared folder and durable intermediate results."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "parcelcast", cpus: int | str | None = None) -> SparkSession:
    """A session for tests and benches; a cluster brings its own session."""
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a local master may fall back to a scratch folder of its own; on a cluster a missing setting is an
    error, because a machine-local folder would vanish together with its machine.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    current = sc.getCheckpointDir()
    if current is None:
        if not configured:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
            configured = tempfile.mkdtemp(prefix="parcelcast-")
        sc.setCheckpointDir(configured)
        current = sc.getCheckpointDir()
    return configured or current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written rows.

    Used where two branches of a plan must see the very same rows and partitions, and where a long lineage
    would be recomputed; the copy survives the loss of executors.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def for_sketches(df: DataFrame) -> DataFrame:
    """``df`` in as many partitions as there are cores: quantile sketches of one column are merged one by one in a single task.

    A sketch takes the same memory however many rows a task reads. Meant for rows that are written or scanned.
    """
    return df.coalesce(df.sparkSession.sparkContext.defaultParallelism)
