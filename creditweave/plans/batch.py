"""The batch plan: one cleaned table and four marts."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from creditweave.operators.applications import clean_applications
from creditweave.operators.marts import MARTS
from creditweave.operators.rules import decision_rules
from creditweave.operators.watch import check_limits, violation_counts
from creditweave.schemas import CLEAN_APPLICATIONS
from creditweave.sinks.files import write_mart, write_table
from creditweave.sources.files import read_source
from creditweave.tables.versions import VersionLog

CLEAN_TABLE = "clean_applications"


class _Watch:
    """Counts of the clean rows and of those that break a decision rule, taken by the job that writes them."""

    def __init__(self, limits: Mapping[str, int] | None):
        self.limits, self._seen = limits, Observation("clean")

    def over(self, clean: DataFrame) -> DataFrame:
        return clean.observe(self._seen, F.count(F.lit(1)).alias("row_count"), *violation_counts(decision_rules()))

    @property
    def rows(self) -> int:
        return self._seen.get["row_count"]

    @property
    def violations(self) -> dict[str, int]:
        return {name: n for name, n in self._seen.get.items() if name != "row_count"}

    def check(self) -> None:
        if self.limits is not None:
            check_limits({name: n for name, n in self.violations.items() if name in self.limits}, self.limits)


def run_batch(
    spark: SparkSession,
    input_path: str,
    output_root: str,
    source_format: str = "csv",
    keep_in_memory: bool = False,
    max_records_per_file: int | None = None,
    run_id: str | None = None,
    watch: _Watch | None = None,
) -> dict[str, str]:
    """Write the five outputs under ``output_root``; returns name to directory.

    The input is read and parsed once. The marts read the clean table back from Parquet, each only
    its own columns: together they read about as many column chunks as one pass over the table.
    They are submitted side by side, so that the few-task end of one overlaps the scan of the next.
    ``keep_in_memory`` caches the clean rows instead, for inputs that fit in executor memory.

    The five outputs are overwritten one by one, so a run that fails midway leaves old ones beside new
    ones. With ``run_id`` they go to a folder of that name, which a reader takes up once the run is over;
    :func:`publish_batch` does that with a record of versions. Sets adaptive execution, which makes one
    file of a small mart. ``watch`` counts clean rows and broken rules while they are written.
    """
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    root = output_root.rstrip("/") + (f"/{run_id}" if run_id else "")
    paths = {name: f"{root}/{name}" for name in (CLEAN_TABLE, *MARTS)}
    clean = clean_applications(read_source(spark, input_path, source_format))
    if watch:
        clean = watch.over(clean)
    if keep_in_memory:
        clean = clean.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        write_table(clean, paths[CLEAN_TABLE], max_records_per_file)
        if watch:
            watch.check()
        stored = (
            clean
            if keep_in_memory
            else spark.read.schema(CLEAN_APPLICATIONS).parquet(paths[CLEAN_TABLE])
        )

        @inheritable_thread_target(spark)
        def write(name: str) -> None:
            write_mart(MARTS[name](stored), paths[name])

        with ThreadPoolExecutor(len(MARTS)) as pool:
            list(pool.map(write, MARTS))
    finally:
        if keep_in_memory:
            clean.unpersist()
    return paths


def publish_batch(
    spark: SparkSession,
    input_path: str,
    output_root: str,
    source_format: str = "csv",
    keep_in_memory: bool = False,
    max_records_per_file: int | None = None,
    limits: Mapping[str, int] | None = None,
) -> int:
    """Write the five outputs as one version below ``output_root``; returns its number.

    They go to a folder of their own. Once all five stand there, the record of the next version is
    written, which names the folder, the number of clean rows and how many break each decision rule. Readers
    (:func:`read_output`) follow the record: a run that stops midway leaves the version before whole. The
    rules are counted by the job that writes the clean rows. ``limits`` (rule to number of rows) stops the
    run before the marts if a rule is broken more often.
    """
    log, run, watch = VersionLog(spark, output_root), uuid.uuid4().hex, _Watch(limits)
    version = log.latest() + 1
    try:
        run_batch(spark, input_path, f"{log.folder.path}/runs", source_format, keep_in_memory, max_records_per_file, run, watch)
        outputs = {name: f"runs/{run}/{name}" for name in (CLEAN_TABLE, *MARTS)}
        log.commit(version, {"outputs": outputs, "rows": watch.rows, "violations": watch.violations})
    except BaseException:
        log.folder.delete(f"runs/{run}")
        raise
    return version


def batch_record(spark: SparkSession, output_root: str, version: int | None = None) -> dict[str, Any]:
    """What a version holds: folder of each output, ``rows`` of the clean table, ``violations`` of each rule."""
    return VersionLog(spark, output_root).record(version)


def read_output(spark: SparkSession, output_root: str, name: str, version: int | None = None) -> DataFrame:
    """One of the five outputs at the newest or another version."""
    log = VersionLog(spark, output_root)
    return spark.read.parquet(f"{log.folder.path}/{log.record(version)['outputs'][name]}")


def remove_old_runs(spark: SparkSession, output_root: str, keep: int = 2) -> list[int]:
    """Forget and delete all but the newest ``keep`` versions; returns their numbers."""
    if keep < 1:
        raise ValueError("at least the newest version stays")
    log = VersionLog(spark, output_root)
    old = sorted(log.versions())[:-keep]
    for version in old:
        folder = log.record(version)["outputs"][CLEAN_TABLE].rpartition("/")[0]
        log.drop(version)
        log.folder.delete(folder)
    return old
