"""Exact top-k inner-product search by aggregation of sorted lists without random access.

Every dimension of a block of vectors is one sorted list. A query reads the lists it weighs
positively from the top and those it weighs negatively from the bottom. What has been read gives each
vector a lower and an upper bound; reading stops for a query once no vector outside a short list can
reach its k-th lower bound. The short list is then resolved to exact scores. Blocks of vectors meet
blocks of queries in separate tasks, and the block results are merged by rank.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS, BLOCK_QUERIES = 8192, 1024
_BLOCK = "dim int, block int, uids binary, ids binary, data binary"
_FOUND = "query_uid long, query_id long, uid long, vec_id long, score long"


def quantized(vectors: DataFrame, scale: int = 64) -> DataFrame:
    """``uid, vec_id, v``: components as ``floor(scale * x)``.

    Vectors that are null, or hold a null or non-finite component, and rows without an id are left out.
    """
    x = F.col("embedding")
    usable = ~F.exists(x, lambda e: F.coalesce(F.isnan(e) | (F.abs(e) == float("inf")), F.lit(True)))
    rows = vectors.select(F.monotonically_increasing_id().alias("uid"), F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    rows = rows.filter(F.col("vec_id").isNotNull() & x.isNotNull() & usable)
    return rows.select("uid", "vec_id", F.transform(x, lambda e: F.floor(F.lit(float(scale)) * e.cast("double")).cast("long")).alias("v"))


def _packed(rows: DataFrame, blocks: int) -> DataFrame:
    """Rows of ``quantized`` as ``blocks`` blocks for each vector length; a block never follows an id."""
    def pack(key: tuple[Any, ...], group: pd.DataFrame) -> pd.DataFrame:
        data = np.array(group["v"].tolist(), np.int64).reshape(len(group), key[0])
        return pd.DataFrame([[key[0], key[1], group["uid"].to_numpy(np.int64).tobytes(), group["vec_id"].to_numpy(np.int64).tobytes(), data.tobytes()]], columns=["dim", "block", "uids", "ids", "data"])

    spread = rows.withColumns({"dim": F.size("v"), "block": F.pmod(F.xxhash64("uid"), F.lit(blocks)).cast("int")})
    return spread.groupBy("dim", "block").applyInPandas(pack, _BLOCK)


def _exact(bound: float):
    """The narrowest type that holds every sum exactly."""
    return np.float32 if bound < 2**24 else np.float64 if bound < 2**53 else np.int64


def search_block(x: np.ndarray, q: np.ndarray, own: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query its vectors that can be among the k best (ties included), with exact scores.

    ``own[j]`` is the row of ``x`` that query ``j`` itself is, or -1.
    """
    n, d = x.shape
    kind = _exact(float(d or 1) * max(1, np.abs(x).max(initial=0)) * max(1, np.abs(q).max(initial=0)))
    x, q = x.astype(kind), q.astype(kind)
    order = np.argsort(x, axis=0, kind="stable")
    lists = np.take_along_axis(x, order, axis=0)
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(n)[:, None], axis=0)
    weights = np.hstack([np.maximum(q, 0), np.minimum(q, 0)])
    left, depth, short = np.arange(len(q)), max(1, n // 4), max(8 * k, 64)
    while len(left):
        depth = min(depth, n)
        top, bottom = rank >= n - depth, rank < depth
        best = np.hstack([np.where(top, x, lists[n - depth]), np.where(bottom, x, lists[depth - 1])])
        worst = np.hstack([np.where(top, x, lists[0]), np.where(bottom, x, lists[n - 1])])
        upper = weights[left] @ best.T
        lower = upper.copy() if depth == n else weights[left] @ worst.T
        mine = np.flatnonzero(own[left] >= 0)
        out = np.iinfo(np.int64).min if kind is np.int64 else -np.inf
        lower[mine, own[left[mine]]] = out
        upper[mine, own[left[mine]]] = out
        bar = np.partition(lower, n - k, axis=1)[:, n - k] if n > k else np.full(len(left), out, kind)
        alive = (upper >= bar[:, None]) & (upper != out)
        done = (alive.sum(axis=1) <= short) | (depth == n)
        for j in np.flatnonzero(done):
            rows = np.flatnonzero(alive[j])
            yield int(left[j]), rows, x[rows] @ q[left[j]]
        left, depth = left[~done], depth * 2


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k best other rows for each row that ``is_query`` marks.

    The score is the integer inner product; equal scores rank by ``vec_id``, then by row. A query's own
    row is no candidate, a repeated row is. Vectors of another length than the query's take no part. An
    empty table gives no rows; fewer than k candidates give all of them. Other columns are left out.
    """
    rows = quantized(vectors, scale)
    queries = rows.filter(is_query)
    n_rows, n_queries = rows.count(), queries.count()
    c_blocks, q_blocks = max(1, -(-n_rows // BLOCK_ROWS)), max(1, -(-n_queries // BLOCK_QUERIES))
    candidates = _packed(rows, c_blocks).withColumn("q_block", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))
    asked = _packed(queries, q_blocks).select(
        "dim", F.col("block").alias("q_block"), F.col("uids").alias("q_uids"), F.col("ids").alias("q_ids"), F.col("data").alias("q_data"),
        F.explode(F.sequence(F.lit(0), F.lit(c_blocks - 1))).alias("block"),
    )
    pairs = candidates.join(asked, ["dim", "block", "q_block"])

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                uids, ids, q_uids, q_ids = (np.frombuffer(row[c], np.int64) for c in ("uids", "ids", "q_uids", "q_ids"))
                x = np.frombuffer(row["data"], np.int64).reshape(len(ids), row["dim"])
                q = np.frombuffer(row["q_data"], np.int64).reshape(len(q_ids), row["dim"])
                by_uid = np.argsort(uids)
                at = by_uid[np.minimum(np.searchsorted(uids, q_uids, sorter=by_uid), len(uids) - 1)]
                own = np.where(uids[at] == q_uids, at, -1)
                found = []
                for j, near, scores in search_block(x, q, own, k):
                    best = np.lexsort((uids[near], ids[near], -scores))[:k]
                    near, scores = near[best], scores[best]
                    found.append((np.full(len(near), q_uids[j]), np.full(len(near), q_ids[j]), uids[near], ids[near], scores.astype(np.int64)))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)], ["query_uid", "query_id", "uid", "vec_id", "score"])

    best = Window.partitionBy("query_uid").orderBy(F.desc("score"), "vec_id", "uid")
    ranked = pairs.mapInArrow(run, _FOUND).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
