"""Helpers that several operators share."""

from __future__ import annotations

import ctypes
import gc
import re
import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditweave.session import scratch_dir

#: White space of the Unicode standard, as the public pre-tokenizer patterns mean it by ``\s``.
UNICODE_SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"

#: Pieces that byte-level pre-tokenization never joins: a word with one leading blank, or white space.
CHUNKS = re.compile(
    f" ?[^{UNICODE_SPACE}]+|[{UNICODE_SPACE}]+(?![^{UNICODE_SPACE}])|[{UNICODE_SPACE}]"
)
_CUT = re.compile(f"(?<=[^{UNICODE_SPACE}]) (?=[^{UNICODE_SPACE}])")
_PIECE = 1 << 20


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Sends this package to the executors, once for each application, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="creditweave-code-")) / "creditweave.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def remainder(key: Column, modulus: int) -> Column:
    """``crc32(key as text) mod modulus``; a null key counts as the empty text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % F.lit(modulus)


#: Tables of the pipeline stage that runs, and of the last one, by application.
_stage_tables: list[str] | None = None
_last_stage: dict[str, list[str]] = {}


@contextmanager
def stage_tables(spark: SparkSession) -> Iterator[None]:
    """Notes the tables a pipeline stage writes, and drops those of the stage before, whose result is stored by now."""
    global _stage_tables
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    for path in _last_stage.pop(spark.sparkContext.applicationId, []):
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).delete(folder, True)
    _stage_tables = []
    try:
        yield
    finally:
        _last_stage[spark.sparkContext.applicationId], _stage_tables = _stage_tables, None


def written(spark: SparkSession, frame: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared folder: lineage ends there, a lost executor costs nothing."""
    path = scratch_dir(spark, label)
    if _stage_tables is not None:
        _stage_tables.append(path)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def free_memory() -> None:
    """Gives back to the system what a task has used, at its end: the Python worker lives on and serves later stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def pieces(text: str) -> Iterator[str]:
    """A text in pieces of about a million characters, cut only between two words and one blank."""
    start = 0
    while len(text) - start > _PIECE:
        cut = _CUT.search(text, start + _PIECE)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:] if start else text


def quoted(name: str) -> Column:
    """The column of exactly this name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(rows: DataFrame, name: str = "row") -> Column:
    """All columns of ``rows`` as one struct, so that an operator's own columns cannot clash with them."""
    return F.struct(*[quoted(c) for c in rows.columns]).alias(name)


class Memo(dict):
    """Results by key, computed on first use.

    Emptied when it holds ``most`` keys, or text keys of ``most_chars`` characters together, so memory is bounded.
    """

    def __init__(self, make, most: int = 200_000, most_chars: int = 8_000_000):
        super().__init__()
        self.make, self.most, self.most_chars, self.chars = make, most, most_chars, 0

    def __missing__(self, key):
        self.chars += len(key) if isinstance(key, str) else 0
        if len(self) >= self.most or self.chars > self.most_chars:
            self.clear()
            self.chars = len(key) if isinstance(key, str) else 0
        self[key] = value = self.make(key)
        return value
