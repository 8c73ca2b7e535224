"""CSV directories whose files have different headers."""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Headers read at a time, and bytes that the line of a header may have.
THREADS, LONGEST = 32, 1 << 20

Groups = dict[tuple[str, ...], list[str]]


def data_files(spark: SparkSession, path: str) -> list[str]:
    """The filled files that the reader would take for a path: a file, a folder's files, or what a pattern matches."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    found = fs.globStatus(at) or []
    files = [s for status in found for s in (fs.listStatus(status.getPath()) if status.isDirectory() else [status])]
    kept = [s.getPath() for s in files if s.isFile() and s.getLen() > 0]
    return sorted(p.toString() for p in kept if p.getName()[0] not in "_.")


def header_of(spark: SparkSession, file: str) -> tuple[str, ...]:
    """Column names of a file, compressed or not: its first line that is not blank, or none. Reads no further."""
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    at = jvm.org.apache.hadoop.fs.Path(file)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(at)
    stream = at.getFileSystem(conf).open(at)
    try:
        lines = jvm.org.apache.hadoop.util.LineReader(stream if codec is None else codec.createInputStream(stream), conf)
        line = jvm.org.apache.hadoop.io.Text()
        while taken := lines.readLine(line, LONGEST, LONGEST):
            if taken >= LONGEST:
                raise ValueError(f"the header of {file} has more than {LONGEST} bytes")
            text = line.toString().removeprefix("﻿")
            if text.strip():
                return tuple(next(csv.reader([text])))
        return ()
    finally:
        stream.close()


def files_by_header(spark: SparkSession, files: list[str]) -> Groups:
    """Files under their column names; a file without a line is in no group."""
    read = inheritable_thread_target(spark)(lambda file: header_of(spark, file))
    with ThreadPoolExecutor(THREADS) as pool:
        headers = list(pool.map(read, files))
    groups: Groups = {}
    for file, header in zip(files, headers, strict=True):
        if header:
            groups.setdefault(header, []).append(file)
    return groups


def read_by_header(spark: SparkSession, groups: Groups, options: dict[str, object], schema: T.StructType | None) -> DataFrame:
    """Each group of files by its own column order, united by name; a column that a file lacks is NULL there.

    Names are the same whatever their case. ``schema`` gives the columns of the result; without it they
    are all that occur, as text, in the order in which the files bring them up. One scan for each header.
    """
    fields = {f.name.casefold(): f for f in schema or ()}
    for header, files in groups.items():
        names = [name.casefold() for name in header]
        if len(set(names)) < len(names) or not all(names):
            raise ValueError(f"the header of {files[0]} has a column twice or one without a name: {','.join(header)}")
        if schema is None:
            for name in header:
                fields.setdefault(name.casefold(), T.StructField(name, T.StringType()))

    def of_group(header: tuple[str, ...], files: list[str]) -> DataFrame:
        own = [fields.get(name.casefold(), T.StructField(name, T.StringType())) for name in header]
        rows = spark.read.format("csv").schema(T.StructType([T.StructField(n, f.dataType) for n, f in zip(header, own, strict=True)]))
        there = {name.casefold(): name for name in header}

        def column(key: str, field: T.StructField) -> Column:
            found = F.col(f"`{there[key].replace('`', '``')}`") if key in there else F.lit(None).cast(field.dataType)
            return found.alias(field.name)

        return rows.options(**options).load(files).select(*[column(key, f) for key, f in fields.items()])

    tables = [of_group(header, files) for header, files in groups.items()]
    first, *rest = tables
    for table in rest:
        first = first.unionAll(table)
    return first
