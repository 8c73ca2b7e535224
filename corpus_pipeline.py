"""The corpus pipeline: documents in, clean and encoded documents out, one stage after the other."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditweave.llm import bpe, decontaminate, jaccard, suffix_dedup, toxicity
from creditweave.llm.common import packed, ship_code, stage_tables, written
from creditweave.llm.queries import BYTE_BPE

#: SQL has no form for the stages; tests hold them against brute force.
ORACLE_SQL = None


def _stage(function):
    """A stage sends the code along and drops the tables that the stage before it made on its way."""

    @wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_code(spark)
        with stage_tables(spark):
            return function(spark, docs, sf_dir)

    return run


@_stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject; a null or empty text stays."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs.select("text", packed(docs)), model).filter("predicted = 0").select("row.*")


@_stage
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id.

    Null ids count as smaller than others, in an order made from their texts. Texts without a word are
    linked with nothing and stay, all of them. Of rows with words that share an id, one stays.
    """
    found = written(spark, jaccard.near_duplicates(docs.select("doc_id", "text")), "near-duplicates")
    has_words = F.regexp_like(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]"))
    keyed = docs.select(packed(docs), jaccard.doc_key(F.col("doc_id"), F.col("text")).alias("key"), has_words.alias("has_words"))
    kept = found.filter("key = component_key").select("key", (F.col("n_shingles") > 0).alias("has_words"))
    rows = keyed.join(kept, ["key", "has_words"], "left_semi")
    repeated = kept.filter("has_words").groupBy("key", "has_words").count().filter("count > 1").drop("count")
    if not repeated.isEmpty():
        once = rows.join(repeated, ["key", "has_words"], "left_semi").dropDuplicates(["key"])
        rows = rows.join(repeated, ["key", "has_words"], "left_anti").unionByName(once)
    return rows.select("row.*")


@_stage
def drop_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that repeat an earlier 100-byte string; documents left empty go, null texts stay.

    A character of which only a part is repeated goes as a whole. ``n_chars`` follows the text.
    """
    done = suffix_dedup.deduplicated(docs.select("doc_id", "text", packed(docs))).filter("n_removed = 0 or n_removed < n_bytes")
    text = F.when(F.col("text").isNotNull(), F.col("kept"))
    changed = {"text": text}
    if "n_chars" in docs.columns:
        n_chars = F.when(F.col("n_removed") > 0, F.length(text)).otherwise(F.col("row.n_chars"))
        changed["n_chars"] = n_chars.cast(docs.schema["n_chars"].dataType)
    return done.select(*(changed.get(name, F.col("row").getField(name)).alias(name) for name in docs.columns))


@_stage
def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark; a null or empty text stays."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@_stage
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids; a null or empty text has none. A column ``token_ids`` is replaced."""
    return bpe.encode_ids(docs, BYTE_BPE)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("suffix_array_dedup", drop_repeated_strings),
    ("benchmark_decontamination", drop_leaks),
    ("bpe_encoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
