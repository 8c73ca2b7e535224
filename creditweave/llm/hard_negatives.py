"""Hard negatives by matrix products in a residue number system.

Integer vectors are reduced modulo several small primes; the residues are multiplied as float32 matrices
of so few columns that every sum is exact, and Chinese remaindering puts the exact signed scores together.
A first pass finds the positives of each anchor, a second one selects, for each anchor and positive, the
best rows of other labels inside a window of scores that the positive's own score sets.

Blocks of anchors meet the candidates in groups: a task reads one block of anchors, then candidates piece
by piece, and keeps only the best rows so far.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from creditweave.llm.common import written

#: Candidates of a piece, anchors of a block, and anchors whose scores with a piece are held at once.
PIECE_ROWS, BLOCK_ANCHORS, AT_ONCE = 2048, 32768, 512
#: Columns multiplied at once: sums of so many products of centred residues stay below 2 ** 24.
DEPTH = 1024
#: The primes below 252, largest first, as many as a score may need.
PRIMES = tuple(p for p in range(251, 2, -1) if all(p % k for k in range(2, p)))[:12]

_WIDTHS = (np.int8, np.int16, np.int32, np.int64)
_PIECE = "dim int, kind int, block int, uids binary, ids binary, labels binary, marks binary, width int, data binary"
_FIELDS = pa.schema([(n, pa.binary() if t == "binary" else pa.int32()) for n, t in (c.split() for c in _PIECE.split(", "))])
_FOUND = "anchor_uid long, anchor_id long, slot long, score long, vec_id long, uid long"
_LEAST = int(np.iinfo(np.int64).min)


def centred(x: np.ndarray, prime: int) -> np.ndarray:
    """Residues of integers between ``-prime / 2`` and ``prime / 2``, as float32."""
    rest = np.mod(x, prime)
    return np.where(rest > prime // 2, rest - prime, rest).astype(np.float32)


def primes_for(bound: int) -> tuple[int, ...]:
    """So many primes that their product tells all numbers from ``-bound`` to ``bound`` apart."""
    product, count = 1, 0
    while product <= 2 * bound:
        if count == len(PRIMES) or product * PRIMES[count] >= 2**63:
            raise OverflowError(f"scores up to {bound} do not fit 64 bits with room for the signs")
        product *= PRIMES[count]
        count += 1
    return PRIMES[:count]


def residue_product(a: np.ndarray, b: np.ndarray, prime: int) -> np.ndarray:
    """``a @ b.T`` modulo a prime, between 0 and the prime, from centred residues; exact in float32."""
    total = np.zeros((len(a), len(b)), np.float32)
    for at in range(0, a.shape[1], DEPTH):
        total += a[:, at : at + DEPTH] @ b[:, at : at + DEPTH].T
        total -= prime * np.floor(total * np.float32(1 / prime))
        # The factor is rounded, so the floor can be one off.
        total += np.where(total < 0, np.float32(prime), np.float32(0))
        total -= np.where(total >= prime, np.float32(prime), np.float32(0))
    return total


def reconstructed(residues: list[np.ndarray], primes: tuple[int, ...]) -> np.ndarray:
    """Signed integers from their residues: Chinese remaindering in mixed radix."""
    value = residues[0].astype(np.int64)
    product = primes[0]
    for rest, prime in zip(residues[1:], primes[1:], strict=True):
        # The digit of the next place, from small numbers that float64 divides exactly enough.
        gap = (rest - np.mod(value, prime)) * pow(product, -1, prime)
        digit = gap - prime * np.floor(gap / prime)
        value += product * digit.astype(np.int64)
        product *= prime
    return np.where(value > product // 2, value - product, value)


class Residues:
    """A block of integer vectors with its residues, computed once for each prime."""

    def __init__(self, x: np.ndarray):
        self.x, self.largest, self._by_prime = x, max((abs(int(x.min())), abs(int(x.max()))) if x.size else (0,)), {}

    def modulo(self, prime: int) -> np.ndarray:
        if prime not in self._by_prime:
            self._by_prime[prime] = centred(self.x, prime)
        return self._by_prime[prime]


def exact_scores(a: Residues, b: Residues, rows: slice) -> np.ndarray:
    """Inner products of some rows of ``a`` with all of ``b``."""
    primes = primes_for(max(1, a.x.shape[1]) * a.largest * b.largest)
    if not primes:
        return np.zeros((len(a.x[rows]), len(b.x)), np.int64)
    return reconstructed([residue_product(a.modulo(p)[rows], b.modulo(p), p) for p in primes], primes)


def best_in_rows(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the ``k`` highest scores of each row, ties to the left; ``_LEAST`` takes no part."""
    n = scores.shape[1]
    if n > k:
        bar = np.partition(scores, n - k, axis=1)[:, n - k, None]
        above, even = scores > bar, scores == bar
        crowded = np.flatnonzero(above.sum(axis=1) + even.sum(axis=1) > k)
        for r in crowded:
            columns = np.flatnonzero(even[r])
            even[r, columns[k - int(above[r].sum()) :]] = False
        picked = above | even
    else:
        picked = np.ones(scores.shape, bool)
    rows, columns = np.nonzero(picked & (scores != _LEAST))
    return rows, columns


def _vectors(vectors: DataFrame, scale: int) -> DataFrame:
    """``uid, vec_id, label, v``: rows that take part, components as ``floor(scale * x)``."""
    x = F.col("embedding")
    usable = ~F.exists(x, lambda e: F.coalesce(F.isnan(e) | (F.abs(e) == float("inf")), F.lit(True)))
    rows = vectors.select("vec_id", "label", "embedding").filter("vec_id is not null and label is not null and embedding is not null").filter(usable)
    v = F.transform(x, lambda e: F.floor(F.lit(float(scale)) * e.cast("double")).cast("long"))
    return rows.select(F.monotonically_increasing_id().alias("uid"), F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), v.alias("v"))


def _pieces(kind: int, blocks: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Packs rows, integers as narrow as they allow: anchors (``kind`` 0) by block, candidates (1) as they come."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uid, vec_id, label, block = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("uid", "vec_id", "label", "block"))
            vectors, marks = (_Lists(batch.column(c)) for c in ("v", "marks"))
            found = []
            for dim in np.unique(vectors.sizes):
                rows = np.flatnonzero(vectors.sizes == dim)
                cuts = [(0, rows)] if kind else [(b, rows[block[rows] == b]) for b in range(blocks)]
                for b, own in cuts:
                    for some in (own[k : k + PIECE_ROWS] for k in range(0, len(own), PIECE_ROWS)):
                        data = vectors.take(some)
                        width = next(k for k, t in enumerate(_WIDTHS) if not data.size or (data.min() >= np.iinfo(t).min and data.max() <= np.iinfo(t).max))
                        packed = (c[some].tobytes() for c in (uid, vec_id, label))
                        found.append((int(dim), kind, b, *packed, marks.take(some).tobytes(), width, data.astype(_WIDTHS[width]).tobytes()))
            if found:
                yield pa.RecordBatch.from_pylist([dict(zip(_FIELDS.names, r, strict=True)) for r in found], schema=_FIELDS)

    return pack


class _Lists:
    """A list column as one flat array of integers."""

    def __init__(self, column: pa.Array):
        self.starts = column.offsets.to_numpy()[:-1] - column.offsets[0].as_py()
        self.sizes = np.diff(column.offsets.to_numpy())
        self.flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)

    def take(self, rows: np.ndarray) -> np.ndarray:
        """Rows of equal size as a matrix."""
        return self.flat[self.starts[rows][:, None] + np.arange(self.sizes[rows[0]])] if self.sizes[rows[0]] else np.zeros((len(rows), 0), np.int64)


def _unpacked(row: dict) -> tuple[np.ndarray, ...]:
    """Row numbers, ids, labels, marks and vectors of a piece."""
    uids, ids, labels = (np.frombuffer(row[c], np.int64) for c in ("uids", "ids", "labels"))
    marks = np.frombuffer(row["marks"], np.int64).reshape(len(ids), -1)
    data = np.frombuffer(row["data"], _WIDTHS[row["width"]]).reshape(len(ids), row["dim"])
    return uids, ids, labels, marks, data.astype(np.int64)


class _Best:
    """The ``k`` best rows of each slot so far, cut down whenever they have grown fourfold."""

    def __init__(self, k: int):
        self.k, self.size, self.least = k, 0, 1 << 18
        self.held = [tuple(np.zeros(0, np.int64) for _ in range(4))]

    def add(self, slot: np.ndarray, score: np.ndarray, vec_id: np.ndarray, uid: np.ndarray) -> None:
        self.held.append((slot, score, vec_id, uid))
        self.size += len(slot)
        if self.size > self.least:
            self.held = [self.columns()]
            self.size = len(self.held[0][0])
            self.least = max(4 * self.size, 1 << 18)

    def columns(self) -> tuple[np.ndarray, ...]:
        """Slots in order, with score, ``vec_id`` and row number."""
        slot, score, vec_id, uid = (np.concatenate(c) for c in zip(*self.held, strict=True))
        order = np.lexsort((uid, vec_id, -score, slot))
        sorted_slots = slot[order]
        place = np.arange(len(order)) - np.searchsorted(sorted_slots, sorted_slots)
        order = order[place < self.k]
        return slot[order], score[order], vec_id[order], uid[order]


def _searched(k: int, slots: int, qualifies: Callable[..., Iterator[np.ndarray]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A search over sorted groups, anchors first and then candidates: the ``k`` best rows of each anchor's slots.

    ``qualifies(scores, labels, other_labels, same_row, marks)`` yields, slot by slot, which rows take part.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = (row for batch in batches for row in batch.to_pylist())
        for _, group in groupby(pieces, key=lambda r: (r["dim"], r["block"], r["part"])):
            heads: list[tuple[np.ndarray, ...]] = []
            asked, best = None, _Best(k)
            for piece in group:
                if piece["kind"] == 0:
                    heads.append(_unpacked(piece))
                    continue
                if not heads:
                    break
                if asked is None:
                    own, own_ids, own_labels, marks, data = (np.concatenate(c) for c in zip(*heads, strict=True))
                    asked = Residues(data)
                uids, ids, labels, _, data = _unpacked(piece)
                # Ties go to the left, so the smaller id stands there.
                order = np.lexsort((uids, ids))
                uids, ids, labels, given = uids[order], ids[order], labels[order], Residues(data[order])
                for at in range(0, len(own), AT_ONCE):
                    some = slice(at, at + AT_ONCE)
                    scores = exact_scores(asked, given, some)
                    same_row = own[some, None] == uids
                    for slot, taking in enumerate(qualifies(scores, own_labels[some, None], labels, same_row, marks[some])):
                        rows = np.flatnonzero(taking.any(axis=1))
                        r, c = best_in_rows(np.where(taking[rows], scores[rows], _LEAST), k)
                        best.add((at + rows[r]) * slots + slot, scores[rows[r], c], ids[c], uids[c])
            if asked is not None:
                slot, *rest = best.columns()
                columns = (own[slot // slots], own_ids[slot // slots], slot % slots, *rest)
                for cut in range(0, len(slot), 1 << 16):
                    yield pa.RecordBatch.from_arrays([pa.array(c[cut : cut + (1 << 16)]) for c in columns], [c.split()[0] for c in _FOUND.split(", ")])

    return run


def _search(spark: SparkSession, anchors: DataFrame, candidates: DataFrame, blocks: int, k: int, slots: int, qualifies: Callable[..., Iterator[np.ndarray]]) -> DataFrame:
    """Columns of ``_FOUND`` and ``rank``: the ``k`` best candidates of each anchor's slots, over all parts.

    The anchors of a block are copied to each part of the candidates, so there are no more parts than the
    session's shuffle partitions; a candidate is copied to each block of anchors.
    """
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // blocks)
    to_parts = anchors.mapInArrow(_pieces(0, blocks), _PIECE).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    to_blocks = candidates.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    to_blocks = to_blocks.withColumn("part", F.pmod(F.xxhash64("uids"), F.lit(parts)).cast("int"))
    group = ("dim", "block", "part")
    met = to_parts.unionByName(to_blocks).repartition(blocks * parts, *group).sortWithinPartitions(*group, "kind")
    order = Window.partitionBy("anchor_uid", "slot").orderBy(F.desc("score"), "vec_id", "uid")
    found = met.mapInArrow(_searched(k, slots, qualifies), _FOUND)
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _hundredths(part: int, of: np.ndarray) -> np.ndarray:
    """``floor(part * of / 100)`` without leaving 64 bits."""
    return part * (of // 100) + part * (of % 100) // 100


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, window: tuple[int, int] = (30, 90), scale: int = 256) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the rows that ``is_anchor`` marks.

    A score is the integer inner product of ``floor(scale * x)``. An anchor's positives are its best other
    rows of the same label; for each, the best rows of other labels with a score from ``window[0]`` to
    ``window[1]`` hundredths of the positive's are listed. Higher scores come first, ties by smaller
    ``vec_id``, then by row. An anchor is no positive of itself, a repeated row is; repeated anchors are
    listed each for itself. Rows with a null ``vec_id``, label or vector, or a null or non-finite component,
    take no part; vectors of another length than the anchor's have no score with it. An empty table gives
    no rows; other columns are left out. Scores that 61 bits cannot hold raise an error.
    """
    spark = vectors.sparkSession
    rows = written(spark, _vectors(vectors, scale), "mining-vectors")
    asking = rows.filter(is_anchor)
    blocks = max(1, -(-asking.count() // BLOCK_ANCHORS))
    unmarked = F.array().cast("array<bigint>").alias("marks")
    candidates = rows.select("*", F.lit(0).alias("block"), unmarked).mapInArrow(_pieces(1, blocks), _PIECE)
    candidates = written(spark, candidates, "mining-pieces")
    anchors = asking.withColumn("block", F.pmod(F.xxhash64("uid"), F.lit(blocks)).cast("int"))

    def same_label(scores, labels, other_labels, same_row, marks):
        yield (labels == other_labels) & ~same_row

    def in_windows(scores, labels, other_labels, same_row, marks):
        others = labels != other_labels
        for score in marks.T[:, :, None]:
            low, high = -_hundredths(window[0], -score), _hundredths(window[1], score)
            yield others & (scores >= low) & (scores <= high) & (score != _LEAST)

    best = _search(spark, anchors.select("*", unmarked), candidates, blocks, positives, 1, same_label)
    best = best.select("anchor_uid", (F.col("rank") - 1).cast("long").alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    best = written(spark, best, "mining-positives")
    # An anchor carries its positives' scores to the second search.
    scores = best.groupBy(F.col("anchor_uid").alias("uid")).agg(F.sort_array(F.collect_list(F.struct("slot", "positive_score"))).alias("of"))
    marks = F.transform(F.sequence(F.lit(0), F.lit(positives - 1)), lambda k: F.coalesce(F.get("of.positive_score", k), F.lit(_LEAST)))
    marked = anchors.join(scores, "uid").withColumn("marks", marks).drop("of")
    found = _search(spark, marked, candidates, blocks, negatives, positives, in_windows).join(best, ["anchor_uid", "slot"])
    return found.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
