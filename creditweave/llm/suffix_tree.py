"""Language-model scores by a probabilistic suffix tree over words.

The root predicts by smoothed word counts. A context, one to ``depth`` preceding words, becomes a state if
it is frequent and its next-word distribution diverges from the one of the shorter context by more than
the entries it adds cost. A state stores the words it predicts differently, discounted; what is left goes
to the shorter context. Each token is scored in the longest state that its preceding words have.

How often a context or an entry must occur is fixed, so the tree grows with the input. Counts, states and
entries are Spark tables throughout. While they hold at most ``max_local`` rows, tasks keep them as sorted arrays;
beyond that each table is cut into parts by key, and a task takes a million tokens past one part after the
other. Tokens are never shuffled. Both ways count and score the same.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditweave.llm.common import free_memory, written
from creditweave.llm.shingles import batch_words, mix

#: Occurrences that a context needs to become a state, and a sequence to become an entry, at any size.
CONTEXT_LEAST, ENTRY_LEAST = 64, 16
#: Rows of tables that tasks may keep as arrays, 100 MB of keys, numbers and places; a part of a larger table has a quarter.
MAX_LOCAL = 4_000_000
#: An entry's probability differs from the shorter context's by this factor at least.
RATIO = 1.5
DISCOUNT = 0.5
_END = np.uint64(0x5F3759DF5F3759DF)
_LEFT = np.uint64(0x9E3779B97F4A7C15)
_MOST_KEYS = 4_000_000
#: Tokens that go past the parts of a table at once, and bytes of the batches they come from.
_HELD_TOKENS, _HELD_BYTES = 1_000_000, 1 << 22
_BLOCK = 1 << 18
_BATCH_ROWS, _BATCH_SETTING = 1_000, "spark.sql.execution.arrow.maxRecordsPerBatch"


@dataclass
class Level:
    """The states of one context length: ``ctx, rest`` and their entries ``key, log``."""

    states: DataFrame
    entries: DataFrame


@dataclass
class SuffixTree:
    train_tokens: int
    train_types: int
    #: ``k, n``: word hashes (the end of a text is one) and their counts.
    vocabulary: DataFrame
    levels: list[Level]

    @property
    def log_total(self) -> float:
        return float(np.log10(self.train_tokens + self.train_types + 1))


class _Keys:
    """Distinct 64-bit keys in order. As they are hashes, their leading bits say almost where each one stands."""

    def __init__(self, keys: np.ndarray):
        bits = max(1, len(keys).bit_length())
        self.size, self.shift = len(keys), np.uint64(64 - bits)
        self.starts = np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << self.shift).astype(np.int32)
        self.keys = np.append(keys, np.uint64(2**64 - 1))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key, -1 where it is not there."""
        at = self.starts[keys >> self.shift]
        later = np.flatnonzero(self.keys[at] < keys)
        while len(later):
            at[later] += 1
            later = later[self.keys[at[later]] < keys[later]]
        at[(self.keys[at] != keys) | (at == self.size)] = -1
        return at


class _Parts:
    """A table by 64-bit key in tasks, as sorted arrays; beyond ``most`` rows in parts that are there one at a time."""

    def __init__(self, table: DataFrame, key: str, value: str, most: int, keep: bool, of=lambda values: values):
        context, rows = table.sparkSession.sparkContext, table.count()
        self.keep, self.shared, self.begins = keep, [], [0]
        self.mask = 0 if rows <= most else (1 << (-(-rows // max(most, 64)) - 1).bit_length()) - 1
        for part in range(self.mask + 1):
            mine = table.filter(F.col(key).bitwiseAND(F.lit(self.mask).cast("long")) == part) if self.mask else table
            keys, values = _pulled(mine, key, value)
            self.shared.append(context.broadcast((_Keys(keys), of(values))))
            self.begins.append(self.begins[-1] + len(keys))

    def _part(self, part: int) -> tuple[_Keys, np.ndarray]:
        shared = self.shared[part]
        loaded = shared.value
        if not self.keep and "_path" in vars(shared):  # it can be read from its file again
            vars(shared).pop("_value", None)
        return loaded

    def meet(self, keys: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Part by part: which of the ``keys`` are in the table, the places they have there, and their values."""
        if not self.mask:
            order, bounds = None, [0, len(keys)]
        else:
            part = (keys & np.uint64(self.mask)).astype(np.uint16 if self.mask < 1 << 16 else np.uint64)
            order = np.argsort(part, kind="stable")
            bounds = np.searchsorted(part[order], np.arange(self.mask + 2))
        for k in range(self.mask + 1):
            if bounds[k] == bounds[k + 1]:
                continue
            known, values = self._part(k)
            mine = None if order is None else order[bounds[k] : bounds[k + 1]]
            at = known.find(keys if mine is None else keys[mine])
            there = np.flatnonzero(at >= 0)
            at = at[there]
            yield there if mine is None else mine[there], at + np.int64(self.begins[k]), values[at]
            known = values = None

    def keys_at(self, places: np.ndarray) -> np.ndarray:
        out = np.empty(len(places), np.uint64)
        for k in range(self.mask + 1):
            mine = np.flatnonzero((places >= self.begins[k]) & (places < self.begins[k + 1]))
            if len(mine):
                out[mine] = self._part(k)[0].keys[places[mine] - self.begins[k]]
        return out

    def destroy(self) -> None:
        for shared in self.shared:
            shared.destroy()


def _token_runs(column: pa.Array):
    """For runs of rows: tokens with an end after each row, each token's place in its row, and the rows' lengths."""
    for hashes, bounds in batch_words(column):
        tokens = np.insert(hashes, bounds[:, 1], _END)
        lengths = bounds[:, 1] - bounds[:, 0] + 1
        starts = np.cumsum(lengths) - lengths
        yield tokens, (np.arange(len(tokens)) - np.repeat(starts, lengths)).astype(np.int32), lengths


def _held_runs(columns: Iterable[pa.Array], least: int):
    """The runs of the columns, put together until they have ``least`` tokens."""
    held, size = [], 0
    for column in columns:
        for run in _token_runs(column):
            held.append(run)
            size += len(run[0])
            if size >= least:
                run = tuple(map(np.concatenate, zip(*held, strict=True))) if held[1:] else run
                held, size = [], 0
                yield run
    if held:
        yield tuple(map(np.concatenate, zip(*held, strict=True)))


def _held_batches(batches: Iterable[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """The batches, put together until they have ``least`` bytes."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= least:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """At most a thousand texts go to Python at once: the buffers of ten thousand are much of an executor's memory."""
    before = spark.conf.get(_BATCH_SETTING)
    if not 0 < int(before) <= _BATCH_ROWS:
        spark.conf.set(_BATCH_SETTING, str(_BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(_BATCH_SETTING, before)


def _free_shuffles(spark: SparkSession) -> None:
    """Shuffle files go when the driver's JVM finds nobody needs them; this lets it look, after a large shuffle is used up."""
    spark.sparkContext._jvm.System.gc()


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Key of a sequence, from the keys of it without its last word and without its first."""
    return mix(left * _LEFT + right, 3)


def _longer(keys: np.ndarray) -> np.ndarray:
    """Keys of the sequences one word longer that end at each token; the first is none."""
    out = np.zeros_like(keys)
    for at in range(0, len(keys) - 1, _BLOCK):
        out[at + 1 : at + 1 + _BLOCK] = _joined(keys[:-1][at : at + _BLOCK], keys[at + 1 : at + 1 + _BLOCK])
    return out


def _sequences(tokens: np.ndarray, length: int) -> np.ndarray:
    """Keys of the sequences of ``length`` words that end at each token, whatever row they begin in."""
    for _ in range(length - 1):
        tokens = _longer(tokens)
    return tokens


def _shifted(keys: np.ndarray) -> np.ndarray:
    """The key of the token before; the first has none."""
    return np.concatenate([np.zeros(1, np.uint64), keys[:-1]])


class _Counter:
    """Counts of 64-bit keys, merged now and then and handed on before they are many, so that memory is bounded."""

    def __init__(self):
        self.keys, self.counts, self.pending, self.held = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0

    def add(self, keys: np.ndarray):
        self.pending.append(keys)
        self.held += len(keys)
        if self.held > max(1 << 19, len(self.keys) // 2):
            self.merge()
            if len(self.keys) > _MOST_KEYS:
                yield from self.batches()

    def merge(self) -> None:
        if not self.pending:
            return
        keys, counts = np.unique(np.concatenate(self.pending), return_counts=True)
        self.pending, self.held = [], 0
        at = np.searchsorted(self.keys, keys)
        old = np.flatnonzero(at < len(self.keys))
        old = old[self.keys[at[old]] == keys[old]]
        self.counts[at[old]] += counts[old]
        new = np.ones(len(keys), bool)
        new[old] = False
        at = at[new]
        self.keys, self.counts = np.insert(self.keys, at, keys[new]), np.insert(self.counts, at, counts[new])

    def batches(self):
        self.merge()
        for at in range(0, len(self.keys), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(self.keys[at : at + 100_000]), pa.array(self.counts[at : at + 100_000])], ["k", "n"])
        self.keys, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)


def _counted(texts: DataFrame, keys_of, held: int = 0) -> DataFrame:
    """``k, n``: counts of what ``keys_of(tokens, place)`` gives, added up in each task before the shuffle."""

    def run(batches):
        counter = _Counter()
        for tokens, place, _ in _held_runs((batch.column(0) for batch in batches), held):
            yield from counter.add(keys_of(tokens, place))
        yield from counter.batches()
        del counter
        free_memory()

    # Tasks have added up; to do it once more in the JVM before the shuffle would cost its memory and spare no row.
    return texts.select("text").mapInArrow(run, "k long, n long").repartition("k").groupBy("k").agg(F.sum("n").alias("n"))


def word_counts(texts: DataFrame) -> DataFrame:
    """``k, n``: counts of word hashes, one end for each text among them."""
    return _counted(texts, lambda tokens, place: tokens.view(np.int64))


def _pulled(table: DataFrame, key: str, value: str | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """Sorted keys of a table whose size is known to be bounded, and their values."""
    rows = table.select(key, *([value] if value else [])).toArrow()
    keys = rows.column(0).to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return keys[order], rows.column(1).to_numpy()[order] if value else None


def _sequence_counts(texts: DataFrame, known: DataFrame, length: int, max_local: int) -> DataFrame:
    """``ctx, short, n, key`` of the frequent sequences: the parts without its last word and without its first are ``known``.

    The places of both parts among the known make one number to shuffle.
    """
    # A task holds its counts besides, so only half as much is kept here.
    spark, most = texts.sparkSession, max_local // 2
    keep = known.count() <= most
    parts = _Parts(known.select("key", (F.col("n") >= CONTEXT_LEAST).alias("is_context")), "key", "is_context", most if keep else most // 2, keep)

    def keys_of(tokens, place):
        shorter = _sequences(tokens, length - 1)
        at, is_context = np.full(len(tokens), -1, np.int32), np.zeros(len(tokens), bool)
        for there, places, flags in parts.meet(shorter):
            at[there], is_context[there] = places, flags
        good = np.flatnonzero((place[1:] >= length - 1) & is_context[:-1] & (at[1:] >= 0))
        pairs = at[good].astype(np.int64)
        pairs <<= 32
        good += 1
        pairs |= at[good]
        return pairs

    def spelled(batches):
        for batch in _held_batches(batches, 0 if keep else _HELD_BYTES):
            k = batch.column(0).to_numpy()
            ctx, short = parts.keys_at(k >> 32), parts.keys_at(k & 0xFFFFFFFF)
            columns = [pa.array(a.view(np.int64)) for a in (ctx, short, _joined(ctx, short))]
            yield pa.RecordBatch.from_arrays([*columns[:2], batch.column(1), columns[2]], ["ctx", "short", "n", "key"])

    counts = _counted(texts, keys_of, 0 if keep else _HELD_TOKENS).filter(F.col("n") >= ENTRY_LEAST)
    # What is left is little: it is dealt anew, so that few tasks take up the parts.
    counts = counts if keep else counts.repartition("k")
    found = written(spark, counts.mapInArrow(spelled, "ctx long, short long, n long, key long"), f"counts-{length}")
    parts.destroy()
    _free_shuffles(spark)
    return found


def _grams(texts: DataFrame, known: DataFrame, length: int, max_local: int) -> DataFrame:
    """``key, n, ctx_n, parent, ctx`` of the frequent sequences whose first ``length - 1`` words are a frequent context.

    ``known`` (``key, n, final``) holds the sequences one word shorter, with their log-probabilities.
    """
    contexts = known.filter(F.col("n") >= CONTEXT_LEAST).select(F.col("key").alias("ctx"), F.col("n").alias("ctx_n"))
    parents = known.select(F.col("key").alias("short"), F.col("final").alias("parent"))
    counts = _sequence_counts(texts, known, length, max_local)
    return counts.join(contexts, "ctx").join(parents, "short").select("key", "n", "ctx_n", "parent", "ctx")


def _states(grams: DataFrame) -> DataFrame:
    """``ctx, rest`` of the contexts that pass the divergence test; ``rest`` scales what the shorter context says."""
    by = grams.filter("differs").groupBy("ctx").agg(
        F.max("ctx_n").alias("ctx_n"),
        F.count("*").alias("entries"),
        F.sum("n").alias("n"),
        F.sum(F.pow(F.lit(10.0), "own")).alias("kept"),
        F.sum(F.pow(F.lit(10.0), "parent")).alias("below"),
        F.sum(F.col("n") * (F.col("own") - F.col("parent"))).alias("gain"),
    )
    by = by.filter("kept < 1 - 1e-9 and below < 1 - 1e-9").withColumn("rest", F.log10((1 - F.col("kept")) / (1 - F.col("below"))))
    # Gained nats against half a logarithm for each entry and the state itself.
    gained = (F.col("gain") + (F.col("ctx_n") - F.col("n")) * F.col("rest")) * float(np.log(10))
    return by.filter(gained > 0.5 * (F.col("entries") + 1) * F.log(F.col("ctx_n"))).select("ctx", "rest")


def train(texts: DataFrame, vocabulary: DataFrame, depth: int = 4, max_local: int = MAX_LOCAL) -> SuffixTree:
    """The tree from the training ``texts`` and their ``vocabulary`` (of ``word_counts``)."""
    spark = texts.sparkSession
    totals = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    tree = SuffixTree(int(totals["n"]), int(totals["v"]), vocabulary, [])
    known = vocabulary.filter(F.col("n") >= ENTRY_LEAST).select(F.col("k").alias("key"), "n", (F.log10(F.col("n") + 1.0) - tree.log_total).alias("final"))
    for length in range(1, depth + 1):
        own = F.log10((F.col("n") - DISCOUNT) / F.col("ctx_n"))
        grams = _grams(texts, known, length + 1, max_local).withColumn("own", own)
        grams = grams.withColumn("differs", F.abs(F.col("own") - F.col("parent")) >= float(np.log10(RATIO)))
        grams = written(spark, grams, f"sequences-{length + 1}")
        states = written(spark, _states(grams), f"states-{length}")
        placed = grams.join(states, "ctx", "left")
        final = F.when(F.col("rest").isNull(), F.col("parent")).when(F.col("differs"), F.col("own")).otherwise(F.col("parent") + F.col("rest"))
        entries = placed.filter("differs and rest is not null").select("key", F.col("own").alias("log"))
        tree.levels.append(Level(states, written(spark, entries, f"entries-{length}")))
        if length < depth:
            known = written(spark, placed.select("key", "n", final.alias("final")), f"known-{length + 1}")
    return tree


def _scored(rows: DataFrame, tree: SuffixTree, max_local: int) -> DataFrame:
    """Sums by row with the tree in arrays, and the words whose counts are not in them."""
    spark = rows.sparkSession
    words = tree.vocabulary.filter(F.col("n") >= ENTRY_LEAST)
    tables = [(words, "k", "n"), *(t for level in tree.levels for t in ((level.states, "ctx", "rest"), (level.entries, "key", "log")))]
    keep = sum(table.count() for table, _, _ in tables) <= max_local
    most = max_local if keep else max_local // 4
    words, *levels = [_Parts(*t, most, keep, *([lambda n: np.log10(n + 1.0)] if t is tables[0] else [])) for t in tables]
    levels = list(zip(levels[::2], levels[1::2], strict=True))
    held, log_total = 0 if keep else _HELD_TOKENS, tree.log_total

    def run(batches):
        for batch in _held_batches(batches, 0 if keep else _HELD_BYTES):
            out = [[] for _ in range(6)]
            for tokens, place, lengths in _held_runs([batch.column(1)], held):
                base, known = np.full(len(tokens), -log_total), np.zeros(len(tokens), bool)
                for there, _, logs in words.meet(tokens):
                    base[there] += logs
                    known[there] = True
                total, hit = base.copy(), np.zeros(len(tokens), bool)
                keys = tokens
                for n, (states, entries) in enumerate(levels, 1):
                    before, keys = _shifted(keys), _longer(keys)
                    in_state = [np.zeros(0, np.int64)]
                    for found, _, rest in states.meet(before):
                        within = place[found] >= n
                        in_state.append(found[within])
                        total[in_state[-1]] += rest[within]
                    there = np.concatenate(in_state)
                    for found, _, logs in entries.meet(keys[there]):
                        total[there[found]] = logs
                        hit[there[found]] = True
                starts = np.cumsum(lengths) - lengths
                out[0].append(lengths)
                out[1].append(np.add.reduceat(known.astype(np.int64), starts))
                out[2].append(np.add.reduceat(base, starts))
                out[3].append(np.add.reduceat(total, starts))
                rare = np.flatnonzero(~known)
                cuts = np.searchsorted(rare, starts[1:])
                out[4].extend(np.split(tokens[rare].view(np.int64), cuts))
                out[5].extend(np.split(hit[rare], cuts))
            if not out[0]:
                continue
            numbers = [pa.array(np.concatenate(c)) for c in out[:4]]
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(r) for r in out[4]])]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(c))) for c in out[4:]]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *numbers, *lists], ["doc_id", "held_out", "n_tokens", "n_local", "base", "model", "rare", "hit"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    parts = rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, n_tokens long, n_local long, base double, model double, rare array<long>, hit array<boolean>")
    parts = written(spark, parts.withColumn("row", F.monotonically_increasing_id()), "score-parts")
    for table in (words, *(t for level in levels for t in level)):
        table.destroy()
    # Counts of the other words meet them by a join, then go back to their rows in sums.
    rare = parts.select("row", F.explode(F.arrays_zip("rare", "hit")).alias("r")).select("row", F.col("r.rare").alias("k"), F.col("r.hit").alias("hit"))
    log = F.log10(F.col("n") + 1.0)
    sums = rare.join(tree.vocabulary, "k").groupBy("row").agg(
        F.count("*").alias("found"), F.sum(log).alias("add"), F.sum(F.when(~F.col("hit"), log)).alias("add_model")
    )
    found, add, add_model = (F.coalesce(c, F.lit(0)) for c in ("found", "add", "add_model"))
    return parts.join(sums, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_local") + found).alias("n_known"), (F.col("base") + add).alias("base_score"), (F.col("model") + add_model).alias("score")
    )


def score(docs: DataFrame, is_training: Column, depth: int = 4, max_local: int = MAX_LOCAL) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row of ``docs``.

    Tokens are the words (A-Z lower-cased) and one end. ``base_score`` adds log10((c + 1) / (N + V + 1)),
    ``score`` the tree's log10 probabilities; ``is_training`` (on ``doc_id``) marks the rows that both learn
    from. A null or empty text has the end alone. Every row gives a row; copies and shared ids get equal
    scores for equal texts. With nothing to learn from, N and V are 0. Other columns are left out.
    Tables of more than ``max_local`` rows are taken through tasks in parts, not held.
    """
    spark = docs.sparkSession
    texts = docs.filter(is_training).select("text")
    rows = docs.select("doc_id", "text", (~is_training).alias("held_out"))
    with _small_batches(spark):
        vocabulary = written(spark, word_counts(texts), "word-counts")
        _free_shuffles(spark)
        tree = train(texts, vocabulary, depth, max_local)
        scored = _scored(rows, tree, max_local)
    n_tokens = F.lit(tree.train_tokens).cast("long").alias("train_tokens")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", n_tokens, "base_score", "score")
