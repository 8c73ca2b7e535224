"""Removal of byte strings that already occurred, by suffix sorting with induced order.

A string of ``LENGTH`` bytes always holds an anchor, a position that its own bytes select (the least
hash of all ``ANCHOR``-byte words inside). Suffixes are sorted at anchors only. Spark's external sort is
the disk-backed queue: it carries tuples of anchor, context and position, range-partitioned so that one
anchor may spread over many tasks. Tuples with one context prove each other's copies. Where an anchor
has several contexts, the order of the suffixes before it is induced from the order at the anchor, one
byte to the left at a time, and the common-prefix values are carried along by range minima; runs of
common prefixes of ``LENGTH`` bytes are the repeated strings.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from creditweave.llm.common import packed, written
from creditweave.llm.jaccard import doc_key
from creditweave.llm.shingles import mix, powers

LENGTH, ANCHOR = 100, 32
_REACH = LENGTH - ANCHOR
#: Contexts that one task sorts at once; an anchor with more of them is split by window instead.
SHARD = 16_384
_BLOCK = 1 << 19
_BASE = np.uint64(0x9E3779B97F4A7C15)
_CODE = np.random.default_rng(11).integers(1, 2**63, 256, dtype=np.uint64)
_UP = powers(int(_BASE), _BLOCK + 2 * LENGTH)
_DOWN = powers(pow(int(_BASE), -1, 1 << 64), _BLOCK + 2 * LENGTH)


def _sums(data: np.ndarray) -> np.ndarray:
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_CODE[data] * _UP[: len(data)], out=out[1:])
    return out


def _between(sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the byte strings from ``begin`` to ``end``, which do not depend on where they stand."""
    return mix((sums[end] - sums[begin]) * _DOWN[begin])


def _slide(x: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every run of ``width`` values, by doubling."""
    done = 1
    while done * 2 <= width:
        x = pick(x[:-done], x[done:])
        done *= 2
    rest = width - done
    return pick(x[: len(x) - rest], x[rest:]) if rest else x


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions, anchor hashes and context hashes of a text. Every ``LENGTH``-byte string holds one."""
    n, found = len(data), []
    for begin in range(0, max(0, n - LENGTH + 1), _BLOCK - LENGTH):
        # Contexts reach beyond the block on both sides.
        low, high = max(0, begin - _REACH), min(n, begin + _BLOCK + LENGTH)
        part = data[low:high]
        sums = _sums(part)
        size = min(n, begin + _BLOCK) - low
        words = np.arange(begin - low, size - ANCHOR + 1)
        if len(words) < _REACH + 1:
            continue
        h = _between(sums, words, words + ANCHOR)
        least = _slide(h, _REACH + 1, np.minimum)
        edge = np.zeros(_REACH, np.uint64)
        at = np.flatnonzero(_slide(np.concatenate([edge, least, edge]), _REACH + 1, np.maximum) == h)
        pos = words[at]
        left, right = np.minimum(pos + low, _REACH), np.minimum(n - low - pos, LENGTH)
        context = mix(_between(sums, pos - left, pos + right) + (left * 256 + right).astype(np.uint64), 5)
        found.append((pos + low, h[at], context))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    pos, h, context = (np.concatenate(c) for c in zip(*found, strict=True))
    if len(found) > 1:
        pos, first = np.unique(pos, return_index=True)
        h, context = h[first], context[first]
    return pos, h, context


_TUPLE = "anchor long, context long, key long, tag int, pos long, size long, known boolean"
_NAMES = ["anchor", "context", "key", "tag", "pos", "size", "known"]


def _arrow(columns, names=_NAMES) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64) if c.dtype == np.uint64 else c) for c in columns], names)


def _first_of_runs(*sorted_columns: np.ndarray) -> np.ndarray:
    n = len(sorted_columns[0])
    new = np.ones(n, bool)
    if n:
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in sorted_columns])
    return new


def _tuples(texts: DataFrame) -> DataFrame:
    """One tuple per anchor; of equal contexts met in one task only the earliest stays unknown."""

    def flush(rows):
        pos, anchor, context = (np.concatenate([r[1][k] for r in rows]) for k in range(3))
        n = [len(r[1][0]) for r in rows]
        key, tag, size = (np.repeat(np.array([r[0][k] for r in rows], np.int64), n) for k in range(3))
        order = np.lexsort((pos, tag, key, context, anchor))
        pos, anchor, context, key, tag, size = (x[order] for x in (pos, anchor, context, key, tag, size))
        # A row that is repeated gives the same tuples again; they are no copies of themselves.
        once = _first_of_runs(anchor, context, key, tag, pos)
        pos, anchor, context, key, tag, size = (x[once] for x in (pos, anchor, context, key, tag, size))
        known = ~_first_of_runs(anchor, context)
        # Known copies need no meeting any more: they go anywhere, so no partition fills with them.
        anchor = np.where(known, mix(key.view(np.uint64) * np.uint64(31) + pos.view(np.uint64), 6), anchor)
        return _arrow((anchor, context, key, tag.astype(np.int32), pos, size, known))

    def run(batches):
        rows, held = [], 0
        for batch in batches:
            for key, tag, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                data = np.frombuffer(text.as_buffer(), np.uint8)
                found = anchors(data)
                if len(found[0]):
                    rows.append(((key, tag, len(data)), found))
                    held += len(found[0])
                if held > 150_000:
                    yield flush(rows)
                    rows, held = [], 0
        if rows:
            yield flush(rows)

    return texts.mapInArrow(run, _TUPLE)


_FOUND = "copy boolean, anchor long, key long, tag int, pos long, size long"


def _compared(tuples: DataFrame) -> DataFrame:
    """Repeated tuples: copies of an earlier equal context, and first contexts of anchors that may have others."""

    def split(rows, border: bool):
        once = _first_of_runs(*rows[:5])
        anchor, context, key, tag, pos, size, known = (c[once] for c in rows)
        copy = known | ~_first_of_runs(anchor, context)
        own = ~known
        run = np.cumsum(_first_of_runs(anchor)) - 1
        alone = np.bincount(run, weights=own & ~copy, minlength=int(run[-1]) + 1) < 2
        # An anchor at the border of a partition may go on in the next one; it is kept, which costs no result.
        if border:
            alone[[0, -1]] = False
        keep = copy | ~alone[run]
        return _arrow([c[keep] for c in (copy, anchor, key, tag, pos, size)], ["copy", "anchor", "key", "tag", "pos", "size"])

    def run(batches):
        held, first = None, True
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if held is not None:
                rows = [np.concatenate([a, b]) for a, b in zip(held, rows, strict=True)]
            # The last two contexts' worth of the last anchor wait for the next batch.
            cut = int(np.searchsorted(rows[0], rows[0][-1]))
            if cut == 0:
                if len(rows[0]) > 500_000:  # one anchor with very many contexts: it surely has others
                    turn = len(rows[0]) - 1 - int(np.argmax(~(rows[1][::-1] == rows[1][-1]))) + 1
                    turn = turn if 0 < turn < len(rows[0]) else 0
                    if turn:
                        yield split([c[:turn] for c in rows], True)
                        rows = [c[turn:] for c in rows]
                        first = True
                held = rows
                continue
            yield split([c[:cut] for c in rows], first)
            held, first = [c[cut:] for c in rows], False
        if held is not None:
            yield split(held, True)

    order = ["anchor", "context", "key", "tag", "pos"]
    return tuples.repartitionByRange("anchor", "context").sortWithinPartitions(*order).mapInArrow(run, _FOUND)


_CONTEXT = "anchor long, key long, tag int, pos long, left int, right int, bytes binary"
_WINDOW = "anchor long, window long, key long, tag int, begin long"


def _cut_out(found: DataFrame, texts: DataFrame, schema: str, rows_of) -> DataFrame:
    """What ``rows_of(anchor, key, tag, pos, left, right, bytes)`` makes of the contexts of the tuples in ``found``.

    ``bytes`` has one row for each anchor, with ``_REACH`` bytes before it and ``LENGTH`` from it on; ``left``
    and ``right`` tell how many of them exist.
    """
    wanted = found.groupBy("key", "tag").agg(F.collect_list(F.struct("pos", "anchor")).alias("at"))

    def run(batches):
        last = None
        for batch in batches:
            for key, tag, text, at in zip(*(batch.column(c) for c in ("key", "tag", "text", "at")), strict=True):
                # Most repeated rows end here; the rest are left out where their contexts meet.
                if (key, tag) == last:
                    continue
                last = key, tag
                data = np.frombuffer(text.as_buffer(), np.uint8)
                places, anchors_ = at.values.field("pos").to_numpy(), at.values.field("anchor").to_numpy()
                for first in range(0, len(places), 4096):
                    pos, anchor = places[first : first + 4096], anchors_[first : first + 4096]
                    left, right = np.minimum(pos, _REACH), np.minimum(len(data) - pos, LENGTH)
                    reach = pos[:, None] + np.arange(-_REACH, LENGTH)[None, :]
                    inside = (reach >= 0) & (reach < len(data))
                    cut = np.where(inside, data[np.clip(reach, 0, len(data) - 1)], 0).astype(np.uint8)
                    n = len(pos)
                    yield rows_of(anchor, np.full(n, key.as_py()), np.full(n, tag.as_py(), np.int32), pos, left, right, cut)

    joined = texts.join(wanted, ["key", "tag"]).select("key", "tag", "text", "at")
    return joined.mapInArrow(run, schema)


def _contexts(found: DataFrame, texts: DataFrame) -> DataFrame:
    """``anchor, key, tag, pos, left, right, bytes`` for the tuples in ``found``, cut from the texts."""

    def rows_of(anchor, key, tag, pos, left, right, cut):
        sizes = pa.py_buffer(np.arange(0, cut.size + 1, cut.shape[1], dtype=np.int32).tobytes())
        fixed = pa.Array.from_buffers(pa.binary(), len(pos), [None, sizes, pa.py_buffer(cut.tobytes())])
        columns = [*map(pa.array, (anchor, key, tag, pos, left.astype(np.int32), right.astype(np.int32))), fixed]
        return pa.RecordBatch.from_arrays(columns, ["anchor", "key", "tag", "pos", "left", "right", "bytes"])

    return _cut_out(found, texts, _CONTEXT, rows_of)


def _range_minima(x: np.ndarray) -> list[np.ndarray]:
    table, step = [x], 1
    while step * 2 <= len(x):
        table.append(np.minimum(table[-1][:-step], table[-1][step:]))
        step *= 2
    return table


def induced(bytes_: np.ndarray, left: np.ndarray, right: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest distance from the anchor to the start of a string that an earlier context holds too.

    ``bytes_`` has ``_REACH`` bytes before each anchor and ``LENGTH`` from it on; ``left`` and ``right`` tell
    how many of them exist; ``rank`` orders the contexts. A largest value of -1: no such string.
    """
    n = len(bytes_)
    tails = np.ascontiguousarray(bytes_[:, _REACH:])
    order = np.argsort(tails.view(f"S{LENGTH}").ravel(), kind="stable")
    same = tails[order[1:]] == tails[order[:-1]]
    lcp = np.concatenate([[0], np.where(same.all(axis=1), LENGTH, same.argmin(axis=1))]).astype(np.int64)
    least, most = np.full(n, LENGTH, np.int64), np.full(n, -1, np.int64)
    for before in range(_REACH + 1):
        if before:
            # Induce: sort by the byte to the left, keep the order of what follows.
            letter = bytes_[order, _REACH - before]
            turn = np.argsort(letter, kind="stable")
            minima = _range_minima(lcp)
            a, b = turn[:-1] + 1, turn[1:] + 1
            meets = letter[turn[1:]] == letter[turn[:-1]]
            width = np.where(meets, b - a, 1)
            level = np.frexp(width.astype(float))[1] - 1
            low = np.zeros(len(a), np.int64)
            for k in range(len(minima)):
                here = meets & (level == k)
                low[here] = np.minimum(minima[k][a[here]], minima[k][b[here] - (1 << k)])
            lcp = np.concatenate([[0], np.where(meets, np.minimum(low + 1, LENGTH), 0)])
            order = order[turn]
        starts = np.flatnonzero(lcp < LENGTH)
        if len(starts) == n:
            continue
        real = (left[order] >= before) & (right[order] >= LENGTH - before)
        ranks = np.where(real, rank[order], np.iinfo(np.int64).max)
        earliest = np.repeat(np.minimum.reduceat(ranks, starts), np.diff(np.append(starts, n)))
        copies = order[real & (ranks > earliest)]
        least[copies] = np.minimum(least[copies], before)
        most[copies] = before
    return least, most


_SPAN = "key long, tag int, begin long, end long"


def _resolved(contexts: DataFrame) -> DataFrame:
    """Spans of the contexts that repeat an earlier one, anchors sorted in shards of a bounded number."""

    def solve(rows):
        anchor, key, tag, pos, left, right, data = rows
        if len(pos) < 2:
            return None
        rank = np.empty(len(pos), np.int64)
        rank[np.lexsort((pos, tag, key))] = np.arange(len(pos))
        least, most = induced(data, left, right, rank)
        hit = most >= 0
        return _arrow((key[hit], tag[hit], (pos - most)[hit], (pos - least)[hit] + LENGTH), ["key", "tag", "begin", "end"])

    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(6)]
            flat = b"".join(batch.column(6).to_pylist())
            rows.append(np.frombuffer(flat, np.uint8).reshape(len(rows[0]), LENGTH + _REACH))
            held = rows if held is None else [np.concatenate([a, b]) for a, b in zip(held, rows, strict=True)]
            once = _first_of_runs(*held[:4])
            held = held if once.all() else [c[once] for c in held]
            cut = int(np.searchsorted(held[0], held[0][-1]))
            if cut and len(held[0]) >= SHARD:
                if (out := solve([c[:cut] for c in held])) is not None:
                    yield out
                held = [c[cut:] for c in held]
        if held is not None and (out := solve(held)) is not None:
            yield out

    return contexts.repartition("anchor").sortWithinPartitions("anchor", "key", "tag", "pos").mapInArrow(run, _SPAN)


def _windows(found: DataFrame, texts: DataFrame) -> DataFrame:
    """The same spans for anchors with too many contexts for one task: their strings meet one by one."""

    def rows_of(anchor, key, tag, pos, left, right, cut):
        sums = np.zeros((len(cut), cut.shape[1] + 1), np.uint64)
        np.cumsum(_CODE[cut] * _UP[: cut.shape[1]], axis=1, out=sums[:, 1:])
        before = np.arange(_REACH + 1)
        begin = _REACH - before
        window = mix((sums[:, begin + LENGTH] - sums[:, begin]) * _DOWN[begin])
        row, step = np.nonzero((before <= left[:, None]) & (before >= LENGTH - right[:, None]))
        return _arrow((anchor[row], window[row, step], key[row], tag[row], pos[row] - step), ["anchor", "window", "key", "tag", "begin"])

    rows = _cut_out(found, texts, _WINDOW, rows_of)
    place = F.struct("key", "tag", "begin")
    first = rows.groupBy("anchor", "window").agg(F.min(place).alias("first"))
    later = rows.join(first, ["anchor", "window"]).filter(place != F.col("first"))
    return later.select("key", "tag", "begin", (F.col("begin") + LENGTH).alias("end"))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``key, tag, begin, end``: byte spans, which may overlap, that repeat earlier strings; see ``deduplicated``."""
    spark = docs.sparkSession
    texts = _keyed(docs).select("key", "tag", F.col("text").cast("binary").alias("text")).filter(F.length("text") >= LENGTH)
    found = written(spark, _compared(_tuples(texts)), "suffix-tuples")
    begin = F.greatest(F.col("pos") - _REACH, F.lit(0))
    spans = found.filter("copy").select("key", "tag", begin.alias("begin"), F.least(F.col("pos") + LENGTH, F.col("size")).alias("end"))
    several = found.filter("not copy")
    crowded = several.groupBy("anchor").count().filter(F.col("count") > SHARD).select("anchor")
    spans = spans.unionAll(_resolved(_contexts(several.join(crowded, "anchor", "left_anti"), texts)))
    if not crowded.isEmpty():
        spans = spans.unionAll(_windows(several.join(crowded, "anchor", "left_semi"), texts))
    return spans


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumns({"key": doc_key(F.col("doc_id"), F.col("text")), "tag": F.hash(F.coalesce("text", F.lit("")))})


_RESULT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` with ``n_bytes, n_removed, n_spans, kept_sha256`` and the ``kept`` text.

    Removed is every byte covered by a ``LENGTH``-byte string of UTF-8 that also starts earlier: in a
    document with a smaller id, or earlier in the same one. Strings are judged on the input; overlaps
    count; none crosses documents. ``kept`` leaves out the rest of a character that was cut. A null text counts as empty. Null ids come before all others, in an
    order made from their texts; rows that share an id are ordered by a hash of the text, and rows that
    repeat both id and text all keep what one of them keeps. Columns with the names above are replaced,
    others of any name stay.
    """
    found = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")
    rows = docs.drop(*found)
    kept = rows.select("doc_id", "text", packed(rows, "given"))
    merged = repeated_spans(docs.select("doc_id", "text")).groupBy("key", "tag").agg(F.sort_array(F.collect_set(F.struct("begin", "end"))).alias("spans"))
    joined = _keyed(kept).join(merged, ["key", "tag"], "left")
    columns = kept.columns
    names = [*columns, *found]

    def run(batches):
        for batch in batches:
            out = [[], [], [], [], []]
            for text, spans in zip(batch.column("text"), batch.column("spans"), strict=True):
                data = (text.as_py() or "").encode()
                pieces, at, removed, n = [], 0, 0, 0
                if spans.is_valid:
                    begin, end = (spans.values.field(c).to_numpy() for c in ("begin", "end"))
                    reach = np.maximum.accumulate(end)
                    turns = np.flatnonzero(np.concatenate([[True], begin[1:] > reach[:-1]]))
                    for b, e in zip(begin[turns], reach[np.append(turns[1:], len(begin)) - 1], strict=True):
                        pieces.append(data[at:b])
                        removed, n, at = removed + int(e - b), n + 1, int(e)
                pieces.append(data[at:])
                text_left = "".join(p.decode("utf-8", "ignore") for p in pieces)
                for column, value in zip(out, (len(data), removed, n, hashlib.sha256(b"".join(pieces)).hexdigest(), text_left), strict=True):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), *(pa.array(v, k) for v, k in zip(out, kinds, strict=True))], names)

    schema = StructType([*kept.schema.fields, *StructType.fromDDL(_RESULT + ", kept string").fields])
    return joined.select(*kept.columns, "spans").mapInArrow(run, schema).select("given.*", *found)
