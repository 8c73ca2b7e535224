"""Token-id files: an adaptive context-mixing range coder over independently reset, checksummed blocks.

Within a block, the two ids before predict one id and the id before predicts another, each with its
run of successes; the longer run names the predicted id. Logistic mixing of adaptive probabilities tells
how likely it is to come. If it does not, the id is coded by an adaptive order-0 distribution over
magnitudes of ids and its remaining bits. Blocks know nothing of each other, so any task can read any block. Many blocks are
coded in step, one id of each at a time, which is what makes numpy fast enough: an id is one step of the
range coder, and blocks are short so that many go along. All arithmetic is on integers, so every machine
decodes what another one wrote.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from creditweave.llm.common import CHUNKS, UNICODE_SPACE, free_memory, pieces
from creditweave.session import scratch_dir

#: Ids in a block, and blocks coded in step.
BLOCK, LANES = 1024, 8192
_SLOTS2, _SLOTS1 = 10, 9
_CLASSES = 16
_U64 = np.uint64


def _stretch_tables() -> tuple[np.ndarray, np.ndarray]:
    """Integer logit of a 12-bit probability, and its inverse over -2047 to 2047 (rounded once, so exact everywhere)."""
    p = (np.arange(4096) + 0.5) / 4096
    stretch = np.clip(np.rint(np.log(p / (1 - p)) * 256), -2047, 2047).astype(np.int64)
    squash = np.clip(np.rint(4096 / (1 + np.exp(-np.arange(-2048, 2048) / 256))), 1, 4095).astype(np.int64)
    return stretch, squash


_STRETCH, _SQUASH = _stretch_tables()


def _magnitude(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class of an id (its bit length, small ids together; class + 2 bits remain) and its remaining bits."""
    x = ids + 4
    classes = np.frexp(x.astype(np.float32))[1] - 3
    return classes, x - (4 << classes)


#: Cumulative probabilities of the classes are of 15 bits; each class keeps this many parts, so any id can come.
_KEPT = 16
_FLOOR = (np.arange(_CLASSES + 1, dtype=np.int16) * _KEPT)[:, None]
_FIRST = np.minimum(np.arange(_CLASSES + 1) * 2048, 32767).astype(np.int16)[:, None]


class _Model:
    """Predictions and probabilities of many blocks at once; the same steps run on both sides of the coder."""

    def __init__(self, lanes: int):
        self.lane = np.arange(lanes)
        self.base2, self.base1, self.base = self.lane << _SLOTS2, self.lane << _SLOTS1, self.lane << 4
        # A slot holds an id and twice its run of successes (0 to 7), in 28 and 4 bits.
        self.table2, self.table1 = np.zeros(lanes << _SLOTS2, np.int32), np.zeros(lanes << _SLOTS1, np.int32)
        self.by_run2, self.by_run1 = np.full(lanes << 4, 1 << 15, np.int64), np.full(lanes << 4, 1 << 15, np.int64)
        self.weight2, self.weight1 = np.full(lanes, 40_000), np.full(lanes, 25_000)
        self.total = np.repeat(_FIRST, lanes, 1)
        self.last, self.before, self.step = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64), 0

    def keep(self, lanes: int) -> None:
        """Goes on with the first blocks only; the others are at their end."""
        for name in ("lane", "base2", "base1", "base", "weight2", "weight1", "last", "before"):
            setattr(self, name, getattr(self, name)[:lanes])
        self.total = np.ascontiguousarray(self.total[:, :lanes])

    def predict(self) -> tuple[np.ndarray, np.ndarray]:
        """The predicted ids, and the 12-bit probabilities that they come."""
        mixed = self.last * 0x2F0B4C47
        self.slot1 = ((mixed >> 15) & ((1 << _SLOTS1) - 1)) + self.base1
        mixed += self.before * 0x1B873593
        self.slot2 = ((mixed >> 13) & ((1 << _SLOTS2) - 1)) + self.base2
        self.entry2, self.entry1 = self.table2.take(self.slot2), self.table1.take(self.slot1)
        run2, run1 = self.entry2 & 14, self.entry1 & 14
        self.id = np.where(run2 + 2 >= run1, self.entry2, self.entry1) >> 4
        cell = self.base + ((self.entry2 ^ self.entry1) < 16)
        self.cell2, self.cell1 = cell + run2, cell + run1
        self.old2, self.old1 = self.by_run2.take(self.cell2), self.by_run1.take(self.cell1)
        self.logit2, self.logit1 = _STRETCH.take(self.old2 >> 4), _STRETCH.take(self.old1 >> 4)
        mixed = (self.weight2 * self.logit2 + self.weight1 * self.logit1) >> 16
        mixed += 2048
        self.p = _SQUASH.take(mixed, mode="clip")
        return self.id, self.p

    def share(self, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where in 12 bits the classes begin, and their widths."""
        index = classes * len(self.lane) + self.lane
        total = self.total.reshape(-1)
        begin = total.take(index) >> 3
        index += len(self.lane)
        width = (total.take(index) >> 3) - begin
        return begin.astype(_U64), width.astype(_U64)

    def find(self, values: np.ndarray) -> np.ndarray:
        """The classes in which values of 12 bits lie."""
        return (self.total[1:_CLASSES] <= (values << 3 | 7).astype(np.int16)).view(np.int8).sum(axis=0, dtype=np.int8)

    def learn(self, ids: np.ndarray, hit: np.ndarray, classes: np.ndarray) -> None:
        """Takes in the ids that really came, whether they were predicted, and their classes (16 bits)."""
        # A class learns from ids that were not predicted, fast at first.
        rate = 4 if self.step < 48 else 5 if self.step < 192 else 6
        inner = self.total[1:_CLASSES]
        move = classes - np.arange(1, _CLASSES, dtype=np.int16)[:, None]
        move >>= 15
        move &= 32767 - _KEPT * _CLASSES
        move += _FLOOR[1:_CLASSES]
        move -= inner
        move >>= rate
        move &= hit.astype(np.int16) - np.int16(1)
        inner += move
        target = hit.astype(np.int64) << 12
        error = target - self.p
        for weight, logit in ((self.weight2, self.logit2), (self.weight1, self.logit1)):
            logit *= error
            logit += 8192
            logit >>= 14
            weight += logit
            if not self.step & 15:
                np.minimum(np.maximum(weight, -400_000, out=weight), 400_000, out=weight)
        target <<= 4
        for cells, cell, old in ((self.by_run2, self.cell2, self.old2), (self.by_run1, self.cell1, self.old1)):
            new = target - old
            new >>= 5
            new += old
            cells[cell] = new
        kept = ids << 4
        top = kept + 14
        for table, slot, entry in ((self.table2, self.slot2, self.entry2), (self.table1, self.slot1, self.entry1)):
            same = (kept ^ entry) < 16
            entry += 2
            table[slot] = np.where(same, np.minimum(entry, top, out=entry), kept)
        self.before, self.last = self.last, ids.astype(np.int64)
        self.step += 1


# An id takes one step of a range coder of 64 bits: 41 bits name it (12 whether it was predicted, 12 its class, up to
# 17 what remains). The range is kept at 48 bits or more by shifts of 16.


def _words(span: np.ndarray) -> np.ndarray:
    """How many words of 16 bits bring ranges back to 48 bits."""
    n = (span < _U64(1 << 48)).astype(np.int8)
    n += span < _U64(1 << 32)
    n += span < _U64(1 << 16)
    return n


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """Payloads of blocks of ids (all below 2 ** 17); shorter blocks ride along and stop early."""
    lanes, lengths = len(blocks), np.array([len(b) for b in blocks])
    order = np.argsort(-lengths, kind="stable")
    ids = np.zeros((int(lengths.max(initial=0)), lanes), np.int32)
    for column, k in enumerate(order):
        ids[: lengths[k], column] = blocks[k]
    active = np.searchsorted(-lengths[order], -np.arange(len(ids)), side="left")
    model, now = _Model(lanes), lanes
    # A word of 16 bits in 32, so that a carry can wait in it; the one before the first never gets any.
    room = 3 * len(ids) + 8
    out = np.zeros(lanes * room, np.uint32)
    every_low, every_at = np.zeros(lanes, _U64), np.arange(lanes) * room + 1
    low, at, wide = every_low, every_at, np.full(lanes, (1 << 64) - 1, _U64)
    for step in range(len(ids)):
        turn = step & 63
        if not turn:
            classes, low_bits = _magnitude(ids[step : step + 64])
            unit = _U64(1) << (15 - classes).astype(_U64)
            low_bits = low_bits.astype(_U64) * unit
            narrow, classes = classes.astype(np.int16), classes.astype(np.int64)
        if active[step] != now:
            now = int(active[step])
            model.keep(now)
            low, at, wide = low[:now], at[:now], wide[:now]
        real = ids[step, :now]
        guess, p = model.predict()
        hit = real == guess
        begin, share = model.share(classes[turn, :now])
        q = p.view(_U64)
        hits, rest = q << _U64(29), _U64(4096) - q
        start = ((begin << _U64(17)) + share * low_bits[turn, :now]) * rest
        start += hits
        start[hit] = 0
        share *= rest
        share *= unit[turn, :now]
        wide >>= _U64(41)
        start *= wide
        wide *= np.where(hit, hits, share)
        low += start
        over = np.flatnonzero(low < start)
        out[at[over] - 1] += np.uint32(1)
        n = _words(wide)
        out[at] = low >> _U64(48)
        more = np.flatnonzero(n > 1)
        part, place = low[more], at[more]
        out[place + 1] = (part >> _U64(32)) & _U64(0xFFFF)
        out[place + 2] = (part >> _U64(16)) & _U64(0xFFFF)
        at += n
        shift = (n << 4).astype(_U64)
        low <<= shift
        wide <<= shift
        model.learn(real, hit, narrow[turn, :now])
    for shift in (48, 32, 16, 0):
        out[every_at] = (every_low >> _U64(shift)) & _U64(0xFFFF)
        every_at += 1
    sizes = every_at - np.arange(lanes) * room
    del model, ids  # the words need the room
    words = out.reshape(lanes, room)[:, : int(sizes.max(initial=0))]
    for first in range(0, lanes, 512):
        carried = np.arange(first, min(first + 512, lanes))
        while len(carried):
            part = words[carried]
            carry = part >> 16
            part &= 0xFFFF
            part[:, :-1] += carry[:, 1:]
            words[carried] = part
            carried = carried[carry.any(axis=1)]
    back: list[bytes] = [b""] * lanes
    for column, k in enumerate(order):
        back[k] = words[column, 1 : sizes[column]].astype("<u2").tobytes()
    return back


def decode_blocks(payloads: list[bytes], lengths: np.ndarray) -> list[np.ndarray]:
    """The ids of blocks, given how many each holds."""
    order = np.argsort(-lengths, kind="stable")
    longest, lanes = int(lengths.max(initial=0)), len(payloads)
    if not longest:
        return [np.zeros(0, np.int32) for _ in payloads]
    room = max(map(len, payloads)) // 2 + 4
    words = np.zeros((lanes, room), np.uint16)
    for column, k in enumerate(order):
        words[column, : len(payloads[k]) // 2] = np.frombuffer(payloads[k], "<u2", len(payloads[k]) // 2)
    words = words.reshape(-1)
    # Three words from each place on.
    ahead = np.zeros(len(words), _U64)
    for k in range(3):
        ahead[: len(words) - k] |= words[k:].astype(_U64) << _U64(32 - 16 * k)
    at = np.arange(lanes) * room + 4
    code = (ahead[at - 4] << _U64(16)) | words[at - 1]
    wide = np.full(lanes, (1 << 64) - 1, _U64)
    model, now = _Model(lanes), lanes
    ids = np.zeros((longest, lanes), np.int32)
    active = np.searchsorted(-lengths[order], -np.arange(longest), side="left")
    for step in range(longest):
        if active[step] != now:
            now = int(active[step])
            model.keep(now)
            code, at, wide = code[:now], at[:now], wide[:now]
        guess, p = model.predict()
        q = p.view(_U64)
        wide >>= _U64(41)
        hits, rest = (q << _U64(29)) * wide, (_U64(4096) - q) * wide
        hit = code < hits
        over = code - hits
        unit = rest << _U64(17)
        narrow = model.find(np.minimum(over // unit, _U64(4094)))
        classes = narrow.astype(np.int64)
        begin, share = model.share(classes)
        over -= unit * begin
        rest *= share
        rest <<= (15 - classes).view(_U64)
        low_bits = over // rest
        over -= low_bits * rest
        code, wide = np.where(hit, code, over), np.where(hit, hits, rest)
        n = _words(wide)
        shift = (n << 4).astype(_U64)
        wide <<= shift
        code <<= shift
        code |= ahead.take(at, mode="clip") >> (_U64(48) - shift)
        at += n
        real = np.where(hit, guess, ((4 << classes) - 4 + low_bits.view(np.int64)).astype(np.int32))
        model.learn(real, hit, narrow.astype(np.int16))
        ids[step, :now] = real
    back: list[np.ndarray] = [np.zeros(0, np.int32)] * lanes
    for column, k in enumerate(order):
        back[k] = ids[: lengths[k], column].copy()
    return back


_POLYNOMIAL = 0xEDB88320


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo the one of CRC-32, bits reversed."""
    out = 0
    for k in range(31, -1, -1):
        if a >> k & 1:
            out ^= b
        b = (b >> 1) ^ _POLYNOMIAL if b & 1 else b >> 1
    return out


@lru_cache(maxsize=100_000)
def _zeros(n: int) -> int:
    """What ``n`` zero bytes do to a checksum: x to the power 8 n."""
    out, square = 1 << 31, 1 << 23
    while n:
        if n & 1:
            out = _times(square, out)
        square = _times(square, square)
        n >>= 1
    return out


def joined_crc(parts: list[tuple[int, int]]) -> int:
    """CRC-32 of joined byte strings from each one's CRC-32 and length."""
    crc = 0
    for own, n in parts:
        crc = _times(_zeros(n), crc) ^ own
    return crc


#: Letters, each one of them so in every Unicode version, and signs that are no letters, digits, apostrophes or white space.
_LETTERS, _SIGNS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f\u0400-\u0481\u4e00-\u9fa5", "!#$%&*+,./:;=?@"
#: What byte-level pre-tokenization leaves in one piece: such letters or signs that end before the other kind or white space.
_PIECE = f" ?[{_LETTERS}]++(?=[{UNICODE_SPACE}{_SIGNS}]|\\Z)| ?[{_SIGNS}]++(?=[{UNICODE_SPACE}{_LETTERS}]|\\Z)"
_FINE = re.compile(f"{_PIECE}|{CHUNKS.pattern}")
_ONE_PIECE = re.compile(_PIECE)


class _Numbers(dict):
    """Numbers of chunks; a new chunk gets the next one and is put on a list."""

    def __init__(self):
        super().__init__({None: 0})
        self.new: list[str] = []

    def __missing__(self, chunk):
        self[chunk] = number = len(self)
        self.new.append(chunk)
        return number


class _Encoder:
    """Ids of texts by the tokenizers library. Chunks that pre-tokenization keeps apart are encoded once and remembered.

    At most ``most`` chunks are known: whenever half as many are, those that did not come since the last time are forgotten.
    """

    def __init__(self, path: str, most: int = 600_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task's core is all it has
        self.coder = Tokenizer.from_file(path)
        self.coder.no_truncation()
        self.coder.no_padding()
        self.special = [t.content for t in self.coder.get_added_tokens_decoder().values()]
        self.most = most
        before = self.coder.pre_tokenizer
        # One piece may go to the library's model as it is, each byte as its sign, without pre-tokenization.
        self.plain = self.coder.normalizer is None and isinstance(before, ByteLevel) and before.use_regex and not before.add_prefix_space
        printed = {*range(33, 127), *range(161, 173), *range(174, 256)}
        others = iter(range(256, 512))
        self.signs = {b: chr(b if b in printed else next(others)) for b in range(256)}
        self._clear()
        self.older, self.older_ids, self.older_starts = self.known, self.ids, self.starts
        self._clear()

    def _clear(self) -> None:
        self.known = _Numbers()
        self.ids, self.starts = np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int64)
        self.starts[1] = self.used = 1

    def _of_chunk(self, chunk: str) -> list[int]:
        place = self.older.get(chunk)
        if place is not None:
            return self.older_ids[self.older_starts[place] : self.older_starts[place + 1]].tolist()
        if self.plain and _ONE_PIECE.fullmatch(chunk):
            return [t.id for t in self.coder.model.tokenize(chunk.encode().decode("latin-1").translate(self.signs))]
        return self.coder.encode(chunk, add_special_tokens=False).ids

    def _learn(self) -> None:
        missing, self.known.new = self.known.new, []
        found = [self._of_chunk(c) for c in missing]
        ends = self.used + np.cumsum([len(i) for i in found])
        last = len(self.known)
        while len(self.starts) <= last:
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
        while len(self.ids) < ends[-1]:
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.starts[last - len(missing) + 1 : last + 1] = ends
        self.ids[self.used : ends[-1]] = list(chain.from_iterable(found))
        self.used = int(ends[-1])

    def _of_chunks(self, chunks: list[str | None], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of chunks in one array, and how many each has; None stands for the end of a text."""
        if len(self.known) > self.most // 2:
            self.older, self.older_ids, self.older_starts = self.known, self.ids, self.starts
            self._clear()
        try:
            numbers = np.fromiter(map(self.known.__getitem__, chunks), np.int64, len(chunks))
            if self.known.new:
                self._learn()
        except BaseException:
            self._clear()  # chunks that got no ids must not be met again
            raise
        self.ids[0] = end_id
        start = self.starts[numbers]
        size = self.starts[numbers + 1] - start
        place = np.repeat(start - (np.cumsum(size) - size), size)
        place += np.arange(len(place))
        return self.ids[place], size

    def encode(self, texts: list[str], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, an end after each, in one array, and how many each has."""
        parts: list[np.ndarray] = []
        lengths = np.zeros(len(texts), np.int64)
        chunks: list[str | None] = []
        begins: list[int] = []  # where in the chunks a text or a piece of one begins, and which text it is
        owners: list[int] = []

        def flush():
            if chunks:
                ids, size = self._of_chunks(chunks, end_id)
                parts.append(ids)
                np.add.at(lengths, owners, np.add.reduceat(size, begins))
                for used in (chunks, begins, owners):
                    used.clear()

        def put(k: int, found: list):
            if found:
                begins.append(len(chunks))
                owners.append(k)
                chunks.extend(found)
            if len(chunks) > 1 << 16:
                flush()

        for k, text in enumerate(texts):
            # A special token's text splits its surroundings, so such a text is encoded as it is.
            if any(s in text for s in self.special):
                flush()
                parts.append(np.array(self.coder.encode(text, add_special_tokens=False).ids, np.int32))
                lengths[k] = len(parts[-1])
            else:
                for piece in pieces(text):
                    put(k, _FINE.findall(piece))
            put(k, [None])
        flush()
        return np.concatenate(parts) if parts else np.zeros(0, np.int32), lengths


@lru_cache(maxsize=2)
def _encoder(path: str) -> _Encoder:
    return _Encoder(path)


_FILE = "kind string, part int, seq long, doc_id long, at long, n long, crc long, docs array<long>, sizes array<long>, payload binary"
_FILE_TYPES = pa.schema(
    [("kind", pa.string()), ("part", pa.int32()), ("seq", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int64()), ("n", pa.int64()), ("crc", pa.int64()), ("docs", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("payload", pa.binary())]
)


def _groups(texts: pa.Array) -> Iterator[list[str]]:
    """Texts (null: empty) in their order, in groups of about a million characters."""
    group: list[str] = []
    room = 1 << 20
    for text in texts:
        group.append(text.as_py() or "")
        room -= len(group[-1])
        if room < 0 or len(group) >= 512:
            yield group
            group, room = [], 1 << 20
    if group:
        yield group


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0) -> None:
    """Writes the ids of all documents, each with ``end_id`` after it, in ascending order of ``doc_id``.

    The folder holds one file for each range of ids. Its ``block`` rows have ``BLOCK`` ids each (the last
    of a range fewer), their CRC-32, and which documents' ids they are; its ``doc`` rows have each
    document's place in the range. Null ids come first; rows with one id follow each other in the order of
    a hash of the text. A null or empty text has the end id alone.
    """

    def run(batches):
        part = TaskContext.get().partitionId()
        held: list[np.ndarray] = []  # ids not yet written, and of which documents
        owners: list[int] = []
        sizes: list[int] = []
        seq = at = number = done = count = 0

        def packed(kind: str, count: int, **columns):
            given = {"kind": pa.array([kind] * count), "part": pa.array([part] * count, pa.int32())} | columns
            return pa.RecordBatch.from_arrays([given[f.name] if f.name in given else pa.nulls(count, f.type) for f in _FILE_TYPES], schema=_FILE_TYPES)

        def blocks(last: bool):
            nonlocal seq, count
            ids = np.concatenate(held) if held else np.zeros(0, np.int32)
            held.clear()
            stop = len(ids) if last else len(ids) // BLOCK * BLOCK
            ends, numbers = np.cumsum(sizes), np.array(owners, np.int64)
            for first in range(0, stop, BLOCK * LANES):
                cuts = np.arange(first, min(first + BLOCK * LANES, stop), BLOCK)
                tops = np.minimum(cuts + BLOCK, stop)
                parts = [ids[b:e] for b, e in zip(cuts.tolist(), tops.tolist(), strict=True)]
                # Documents of a block: from the one its first id is of to the one its last id is of.
                begin, end = np.searchsorted(ends, cuts, "right"), np.searchsorted(ends, tops, "left") + 1
                offsets = np.concatenate([[0], np.cumsum(end - begin)])
                inside = np.repeat(begin - offsets[:-1], end - begin) + np.arange(offsets[-1])
                block = np.repeat(np.arange(len(cuts)), end - begin)
                share = np.minimum(ends[inside], tops[block]) - np.maximum(ends[inside] - np.array(sizes)[inside], cuts[block])
                yield packed(
                    "block",
                    len(cuts),
                    seq=pa.array(np.arange(seq, seq + len(cuts))),
                    n=pa.array(tops - cuts),
                    crc=pa.array([zlib.crc32(p.astype("<u4", copy=False)) for p in parts], pa.int64()),
                    docs=pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(numbers[inside])),
                    sizes=pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(share)),
                    payload=pa.array(encode_blocks(parts), pa.binary()),
                )
                seq += len(cuts)
            count = len(ids) - stop
            if count:
                held.append(ids[stop:].copy())
                rest = int(np.searchsorted(ends, stop, "right"))
                owners[:], sizes[:] = owners[rest:], [int(ends[rest]) - stop, *sizes[rest + 1 :]]
            else:
                owners.clear()
                sizes.clear()

        for batch in batches:
            for texts in _groups(batch.column(1)):
                ids, lengths = _encoder(tokenizer).encode(texts, end_id)
                begin = at + np.cumsum(lengths) - lengths
                numbers = np.arange(number, number + len(texts))
                first = number - done
                yield packed("doc", len(texts), seq=pa.array(numbers), doc_id=batch.column(0).slice(first, len(texts)), at=pa.array(begin), n=pa.array(lengths))
                held.append(ids)
                owners += numbers.tolist()
                sizes += lengths.tolist()
                number, at, count = number + len(texts), at + len(ids), count + len(ids)
                if count >= BLOCK * LANES:
                    yield from blocks(False)
            done = number
        yield from blocks(True)
        free_memory()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h"))
    ordered = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "text")
    ordered.mapInArrow(run, _FILE).write.parquet(path)


def _decoded(blocks: DataFrame) -> Iterator:
    """``part, seq, ids, docs, sizes`` of block rows; a block that fails its checksum raises."""

    def run(batches):
        _encoder.cache_clear()  # a worker that wrote has known chunks, which reading does not need
        for batch in batches:
            for first in range(0, batch.num_rows, LANES):
                part = batch.slice(first, LANES)
                lengths, sums = part.column("n").to_numpy(), part.column("crc").to_pylist()
                for k, ids in enumerate(decode_blocks(part.column("payload").to_pylist(), lengths)):
                    if zlib.crc32(ids.astype("<u4", copy=False)) != sums[k]:
                        raise ValueError(f"block {part.column('seq')[k]} of part {part.column('part')[k]} is damaged")
                    yield part, k, ids

    return run


def read_ids(spark, path: str) -> DataFrame:
    """``part, seq, ids`` of all blocks, in which order the ids of the documents follow each other."""
    blocks = spark.read.parquet(path).filter("kind = 'block'").select("part", "seq", "n", "crc", "payload")
    decode = _decoded(blocks)

    def run(batches):
        for part, k, ids in decode(batches):
            yield pa.RecordBatch.from_arrays([part.column("part")[k : k + 1], part.column("seq")[k : k + 1], pa.array([ids], pa.list_(pa.int32()))], ["part", "seq", "ids"])

    return blocks.mapInArrow(run, "part int, seq long, ids array<int>")


def read_checksums(spark, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the blocks as they are read back."""
    rows = spark.read.schema(T.StructType.fromDDL(_FILE)).parquet(path)
    blocks = rows.filter("kind = 'block'").select("part", "seq", "n", "crc", "payload", "docs", "sizes")
    decode = _decoded(blocks)

    def run(batches):
        out: list[list] = [[] for _ in range(5)]

        def packed():
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["part", "doc", "seq", "n", "crc"])
            for column in out:
                column.clear()
            return batch

        for part, k, ids in decode(batches):
            if not k:
                places, seqs, docs, sizes = (part.column(c).to_pylist() for c in ("part", "seq", "docs", "sizes"))
            data, at = memoryview(ids.astype("<u4", copy=False)).cast("B"), 0
            for doc, size in zip(docs[k], sizes[k], strict=True):
                for column, value in zip(out, (places[k], doc, seqs[k], size, zlib.crc32(data[4 * at : 4 * (at + size)])), strict=True):
                    column.append(value)
                at += size
            if len(out[0]) > 10_000:
                yield packed()
        yield packed()

    found = blocks.mapInArrow(run, "part int, doc long, seq long, n long, crc long")
    # Few documents span blocks, and those that do have one piece for each block they fill.
    by_doc = found.groupBy("part", "doc").agg(F.sum("n").alias("n_tokens"), F.sort_array(F.collect_list(F.struct("seq", "crc", "n"))).alias("pieces"))

    def join(batches):
        for batch in batches:
            crc = [joined_crc([(p["crc"], 4 * p["n"]) for p in row]) for row in batch.column("pieces").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(crc, pa.int64())], ["part", "doc", "n_tokens", "ids_crc32"])

    sums = by_doc.mapInArrow(join, "part int, doc long, n_tokens long, ids_crc32 long")
    index = rows.filter("kind = 'doc'").select("part", F.col("seq").alias("doc"), "doc_id", "at", "n")
    # One row for each range, so no more than the write had partitions.
    totals = {r["part"]: r["n"] for r in index.groupBy("part").agg(F.sum("n").alias("n")).collect()}
    begins, before = [], 0
    for part in sorted(totals):
        begins.append((part, before))
        before += totals[part]
    begin = spark.createDataFrame(begins, "part int, begin long")
    placed = index.join(F.broadcast(begin), "part").join(sums, ["part", "doc"])
    return placed.select("doc_id", (F.col("begin") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def ids_round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Writes the ids of ``docs`` to a new shared folder and reads the documents' checksums back."""
    path = scratch_dir(docs.sparkSession, "token-ids")
    write_ids(docs, path, tokenizer)
    return read_checksums(docs.sparkSession, path)
