"""A keyed table as Parquet files, cut into buckets by a hash of the key.

Every version of the table is a record that says in which folder each bucket stands. An upsert reads and
rewrites the buckets that hold a changed key and leaves the other files where they are, so its cost goes
with the buckets it touches, not with the table. Readers follow the record of the version they took up.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass
from functools import reduce
from operator import or_
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditweave.operators.keyed import latest_per_key, with_keys
from creditweave.operators.watch import check_limits, violation_counts
from creditweave.tables.versions import VersionLog


@dataclass(frozen=True)
class UpsertReport:
    """What an upsert did, counted by the jobs that wrote it: in their last stages, where a repeated task does not count twice."""

    version: int
    buckets: int
    inserted: int
    replaced: int
    #: Rows of the touched buckets that stayed as they were.
    kept: int
    #: Changes that were not applied since their key holds a NULL.
    without_key: int
    violations: dict[str, int]


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _paths(root: str, record: Mapping[str, Any], among: set[int] | None = None) -> list[str]:
    return [f"{root}/data/{run}/__bucket={b}" for run, held in record["runs"].items() for b in held if among is None or b in among]


def _read(spark: SparkSession, record: Mapping[str, Any], paths: list[str]) -> DataFrame:
    schema = T.StructType.fromJson(record["schema"])
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read_buckets(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table at its newest or another version."""
    log = VersionLog(spark, path)
    record = log.record(version)
    return _read(spark, record, _paths(log.folder.path, record))


def create_buckets(
    rows: DataFrame, path: str, keys: Sequence[str], buckets: int, order: Sequence[str] = (), rules: Mapping[str, Column] | None = None
) -> UpsertReport:
    """Version 1 of a table from ``rows``, by the rules of :func:`upsert_buckets`.

    ``buckets`` is fixed for the table's life. One task writes a bucket, so there should be as many as
    keep it to some hundred megabytes at the size that the table will grow to.
    """
    log = VersionLog(rows.sparkSession, path)
    if log.latest():
        raise ValueError(f"there is a table at {log.folder.path} already")
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema if f.name not in order])
    return _write(log, {"keys": list(keys), "n_buckets": buckets, "schema": schema.jsonValue(), "runs": {}}, 0, rows, order, rules)


def upsert_buckets(
    spark: SparkSession, path: str, changes: DataFrame, order: Sequence[str] = (), rules: Mapping[str, Column] | None = None
) -> UpsertReport:
    """Insert or replace whole rows by key, as :func:`creditweave.operators.keyed.upsert` does, in place.

    The changes are written beside the table first; that job also counts the rows that break one of
    ``rules`` (name to condition). Then the touched buckets are read, merged and written to a new folder, and the record of the next version is written last. If a rule is broken, if a touched
    bucket turns out to hold a key twice, or if another job takes the version, nothing changes and the
    error tells why. Columns only used for ordering are not stored; changes without a key are counted.
    """
    log = VersionLog(spark, path)
    version = log.latest()
    return _write(log, log.record(version), version, changes, order, rules)


def _write(log: VersionLog, record: dict[str, Any], version: int, changes: DataFrame, order: Sequence[str], rules: Mapping[str, Column] | None) -> UpsertReport:
    spark, run = changes.sparkSession, uuid.uuid4().hex
    staged = f"_staged/{run}"
    try:
        counted = _stage(log, record, changes, order, rules or {}, staged)
        without_key = counted.pop("__without_key")
        check_limits(counted, {})
        done, touched = _merge(spark, log, record, run, staged)
        if done["repeated"]:
            raise ValueError(f"{log.folder.path} holds {done['repeated']} keys more than once")
        # Buckets that stay, and the new ones under this run.
        runs = {old: [b for b in held if b not in touched] for old, held in record["runs"].items()}
        runs = {old: held for old, held in runs.items() if held} | ({run: sorted(touched)} if touched else {})
        report = UpsertReport(version + 1, len(touched), done["inserted"], done["replaced"], done["kept"], without_key, counted)
        log.commit(version + 1, record | {"runs": runs, "report": asdict(report)})
        return report
    except BaseException:
        log.folder.delete(f"data/{run}")
        raise
    finally:
        log.folder.delete(staged)


def _stage(log: VersionLog, record: Mapping[str, Any], changes: DataFrame, order: Sequence[str], rules: Mapping[str, Column], staged: str) -> dict[str, int]:
    """Writes the changes with a key, in the table's types; returns what was counted on the way."""
    schema, keys = T.StructType.fromJson(record["schema"]), record["keys"]
    stored = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]
    ordering = [F.col(name).alias(f"__order_{k}") for k, name in enumerate(order)]
    no_key = reduce(or_, [F.col(key).isNull() for key in keys])
    watch = Observation("changes")
    rows = changes.select(*stored, *ordering).observe(watch, F.count_if(no_key).alias("__without_key"), *violation_counts(rules))
    with_keys(rows, keys).withColumn("__bucket", _bucket(keys, record["n_buckets"])).write.parquet(f"{log.folder.path}/{staged}")
    return dict(watch.get)


def _merge(spark: SparkSession, log: VersionLog, record: Mapping[str, Any], run: str, staged: str) -> tuple[dict[str, int], set[int]]:
    """Writes the touched buckets; returns what became of their rows, and which they are (at most ``n_buckets`` numbers)."""
    root, keys = log.folder.path, record["keys"]
    changes = spark.read.parquet(f"{root}/{staged}")
    touched = {row[0] for row in changes.select("__bucket").distinct().collect()}
    if not touched:
        return {"inserted": 0, "replaced": 0, "kept": 0, "repeated": 0}, touched
    ordering = [c for c in changes.columns if c.startswith("__order_")]
    # A key with many changes comes down to one row in every task before anything is dealt out.
    newest = latest_per_key(changes, keys, ordering).drop(*ordering)
    held = _read(spark, record, _paths(root, record, touched)).withColumn("__bucket", _bucket(keys, record["n_buckets"]))
    rows = held.withColumn("__new", F.lit(False)).unionByName(newest.withColumn("__new", F.lit(True)))
    # Rows are dealt by bucket once: that also brings the rows of a key together, and the files need no further sort.
    by_key = Window.partitionBy("__bucket", *keys)
    rows = rows.repartition("__bucket").withColumns(
        {"__rank": F.row_number().over(by_key.orderBy(F.desc("__new"))), "__old": F.count_if(~F.col("__new")).over(by_key)}
    )
    watch = Observation("merged")
    new, known = F.col("__new"), F.col("__old") > 0
    merged = rows.filter("__rank = 1").observe(
        watch,
        F.count_if(new & ~known).alias("inserted"),
        F.count_if(new & known).alias("replaced"),
        F.count_if(~new).alias("kept"),
        F.count_if(F.col("__old") > 1).alias("repeated"),
    )
    merged.drop("__new", "__rank", "__old").write.partitionBy("__bucket").parquet(f"{root}/data/{run}")
    return dict(watch.get), touched


def remove_old_versions(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Forget all but the newest ``keep`` versions and delete the files that only they name; returns their numbers.

    What a running upsert has written is named by no record yet, and stays.
    """
    if keep < 1:
        raise ValueError("at least the newest version stays")
    log = VersionLog(spark, path)
    versions = sorted(log.versions())
    old, kept = versions[:-keep], versions[-keep:]
    needed = {p for v in kept for p in _paths("", log.record(v))}
    stale = {p for v in old for p in _paths("", log.record(v))} - needed
    for version in old:
        log.drop(version)
    for name in sorted(stale):
        log.folder.delete(name.removeprefix("/"))
    return old
