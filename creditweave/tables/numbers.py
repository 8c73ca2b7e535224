"""Dense integer numbers for the values of a text column, kept as a table that grows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditweave.tables.versions import VersionLog

_DDL = "value string, number bigint"


def read_numbers(spark: SparkSession, path: str) -> DataFrame:
    """``value, number``: every value that has a number, from 1 without gaps; none if there is no table yet."""
    log = VersionLog(spark, path)
    runs = log.record()["runs"] if log.latest() else []
    return spark.read.schema(_DDL).parquet(*[f"{log.folder.path}/{run}" for run in runs]) if runs else spark.createDataFrame([], _DDL)


def number_values(values: DataFrame, path: str) -> DataFrame:
    """Numbers the values of a one-column frame that have none yet, and returns all; NULL gets none.

    New values are numbered in the partitions that their de-duplication leaves them in, each sorted, so the
    values of a partition follow each other; the partitions' sizes are added up in a table of one row each.
    """
    spark, run = values.sparkSession, uuid.uuid4().hex
    log = VersionLog(spark, path)
    version = log.latest()
    record = log.record(version) if version else {"runs": [], "count": 0}
    known = read_numbers(spark, path).select("value")
    new = values.toDF("value").filter("value is not null").distinct().join(known, "value", "left_anti").sortWithinPartitions("value")
    place = F.monotonically_increasing_id()
    new = new.select("value", F.shiftright(place, 33).cast("int").alias("part"), place.bitwiseAND(F.lit((1 << 33) - 1)).alias("place"))
    staged = f"_staged/{run}"
    try:
        new.write.parquet(f"{log.folder.path}/{staged}")
        new = spark.read.schema("value string, part int, place bigint").parquet(f"{log.folder.path}/{staged}")
        sizes = sorted((r["part"], r["n"]) for r in new.groupBy("part").agg(F.count("*").alias("n")).collect())
        if not sizes:
            return read_numbers(spark, path)
        starts, count = [], record["count"]
        for part, n in sizes:
            starts.append((part, count))
            count += n
        # One row for each partition of the shuffle above.
        begins = F.broadcast(spark.createDataFrame(starts, "part int, begin bigint"))
        numbered = new.join(begins, "part").select("value", (F.col("begin") + F.col("place") + 1).alias("number"))
        numbered.write.parquet(f"{log.folder.path}/{run}")
        log.commit(version + 1, {"runs": [*record["runs"], run], "count": count})
    except BaseException:
        log.folder.delete(run)
        raise
    finally:
        log.folder.delete(staged)
    return read_numbers(spark, path)
