"""Session set-up shared by the jobs, and scratch space for the checks."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def use_utc(spark: SparkSession) -> SparkSession:
    """Dates are taken from timestamps in the session zone, so every entry point pins it."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def build_session(app_name: str) -> SparkSession:
    """Session for a job. Sizing (shuffle partitions, split size, memory) stays with spark-submit."""
    spark = SparkSession.builder.appName(app_name).getOrCreate()
    # The runtime re-plan coalesces small marts to one file and splits skewed joins.
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    return use_utc(spark)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """Path of a new folder, not made yet, that every executor can reach.

    Uses the shared folder named by ``spark.checkpoint.dir``. Only a local session without that
    setting falls back to the machine's temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/creditweave/{label}-{uuid.uuid4().hex}"
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a shared folder: a cluster cannot use a local one")
    return f"{tempfile.mkdtemp(prefix='creditweave-')}/{label}"
