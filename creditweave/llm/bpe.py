"""Byte-pair encoding and decoding by dynamic programming over prefixes.

Every prefix of a pre-token has exactly one encoding, so it has exactly one last token. A suffix automaton
of all tokens names the tokens that end at a position; the one that fits the last token of the
prefix before it is the last token here. Back-pointers then give the ids. Two tokens fit when
encoding their joined bytes gives the two again; that is decided from the merges alone, along the
right edge of the left token and the left edge of the right one. Unknown pre-tokens of some million
characters of text are read in step, a byte of each at a time.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from creditweave.llm.common import CHUNKS, Memo, free_memory, pieces
from creditweave.llm.suffix_automaton import SuffixAutomaton

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
_NEVER = 1 << 60
#: Stands before the first token of a word.
_START = -2
#: Characters whose words are encoded together, and bytes of the longest word that is read in step with others.
_LOT, _IN_STEP = 1 << 21, 128
#: Chunks, and characters of chunks, that are remembered at most beside those of a lot.
_MOST, _MOST_CHARS = 400_000, 8_000_000
_PAIR_BITS = 21


def byte_letters() -> dict[str, int]:
    """Letters by which byte-level vocabularies write bytes: visible Latin-1 as it is, others from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in visible}
    hidden = [b for b in range(256) if b not in letters.values()]
    return letters | {chr(256 + n): b for n, b in enumerate(hidden)}


class Bpe:
    """Encoder and decoder for one byte-level vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        vocab = {bytes(map(letters.get, t)): n for t, n in spec["model"]["vocab"].items() if all(c in letters for c in t)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"]}
        self.bytes_of = {n: t for t, n in vocab.items()} | {n: t.encode() for t, n in self.special.items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b = (bytes(map(letters.get, t)) for t in (left, right))
            pair = vocab[a], vocab[b]
            self.rank.setdefault(pair, rank)
            self.parts.setdefault(vocab[a + b], (*pair, rank))
        self._edges = [Memo(lambda t: self._edge(t, 0), 1 << 20), Memo(lambda t: self._edge(t, 1), 1 << 20)]
        special = set(self.special.values())
        tokens = {}
        for token, n in vocab.items():
            made = self.parts.get(n)
            # A token whose own parts would merge in another way first is never the result of encoding.
            if n not in special and (made is None or self.first_merge_across(*made) == made[2]):
                tokens[token] = n
        self.automaton = SuffixAutomaton(tokens)
        self.lengths = np.zeros(max(self.bytes_of) + 1, np.int64)
        for n, token in self.bytes_of.items():
            self.lengths[n] = len(token)
        self.names = {n: str(n) for n in self.bytes_of}
        self._pairs = np.full(1 << _PAIR_BITS, -1, np.int64)
        #: The pattern of byte-level pre-tokenization (a fixed value).
        self.words = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
        self._plain = regex.compile(r" ?[A-Za-z]+")
        self.chunk: dict[str, tuple[str, bytes]] = {}
        self._chars = 0

    def release(self) -> None:
        """Empties what is kept for repeated text, so that a worker goes on to other work without it."""
        for memo in (*self._edges, self.chunk):
            memo.clear()
        self._chars = 0

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """Tokens that once stood at an edge (0 left, 1 right), each with the rank that consumed it."""
        nodes, consumed = [], _NEVER
        while True:
            nodes.append((token, consumed))
            if token not in self.parts:
                return nodes
            consumed = self.parts[token][2]
            token = self.parts[token][side]

    def first_merge_across(self, left: int, right: int, *_) -> int:
        """Rank of the earliest merge across the border of two tokens, or a huge number if none comes.

        Of equal ranks the leftmost goes first: before one inside the right token, after one inside the left.
        """
        first = _NEVER
        for a, a_gone in self._edges[1][left]:
            for b, b_gone in self._edges[0][right]:
                rank = self.rank.get((a, b), _NEVER)
                if rank < a_gone and rank <= b_gone and rank < first:
                    first = rank
        return first

    def fits(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Which tokens ``right`` may follow ``left``; answers are kept in a table of fixed size."""
        key = (left.astype(np.int64) << 32) | right
        at = self._place(key)
        known = self._pairs[at]
        fit = (known & 1) == 1
        start = left == _START
        new = ~start & (known >> 1 != key)
        if new.any():
            pairs, where = np.unique(key[new], return_inverse=True)
            found = np.array([self.first_merge_across(k >> 32, k & 0xFFFFFFFF) == _NEVER for k in pairs.tolist()])
            fit[new] = found[where]
            self._pairs[self._place(pairs)] = pairs << 1 | found
        return start | fit

    @staticmethod
    def _place(key: np.ndarray) -> np.ndarray:
        mixed = key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - _PAIR_BITS)).view(np.int64)

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pre-tokens that are not empty, one word after the other, and the bounds of each word's ids."""
        if not words:
            return np.zeros(0, np.int64), np.zeros(1, np.int64)
        size = np.array([len(w) for w in words])
        begin = np.cumsum(size) - size
        # The longest first, so those with a byte left are always in front.
        order = np.argsort(-size, kind="stable")
        left, first = size[order], begin[order]
        data = np.frombuffer(b"".join(words), np.uint8)
        # A place for each prefix of each word, the empty one included.
        place = first + order
        last = np.full(len(data) + len(words), -1, np.int64)
        last[place] = _START
        automaton = self.automaton
        state, matched = np.zeros(len(words), np.int32), np.zeros(len(words), np.int32)
        for at in range(left[0]):
            n = int(np.searchsorted(-left, -at, side="left"))
            state, matched = automaton.step(state[:n], matched[:n], data[first[:n] + at])
            ending, todo = automaton.first(state, matched), np.arange(n)
            while len(todo):
                if not ending[todo].all():
                    raise ValueError("the vocabulary does not hold every byte")
                token = automaton.token[ending[todo]]
                end = place[todo] + at + 1
                fit = self.fits(last[end - self.lengths[token]], token)
                last[end[fit]] = token[fit]
                todo = todo[~fit]
                ending[todo] = automaton.above[ending[todo]]
        row, token, turn = [], [], []
        todo = np.arange(len(words))
        while len(todo):
            token.append(last[place[todo] + left[todo]])
            row.append(order[todo])
            turn.append(np.full(len(todo), -len(turn)))
            left[todo] -= self.lengths[token[-1]]
            todo = todo[left[todo] > 0]
        row, token, turn = map(np.concatenate, (row, token, turn))
        bounds = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(words)))])
        return token[np.lexsort((turn, row))], bounds

    def encode_long(self, word: bytes) -> list[int]:
        """Ids of one long pre-token, a byte after the other; the same rule on plain numbers."""
        automaton, fits = self.automaton, Memo(lambda pair: self.first_merge_across(*pair) == _NEVER)
        last, start = [_START], [0]
        for end, ending in enumerate(automaton.walk(word), 1):
            while True:
                token, length = automaton.token_at[ending]
                if length == end or fits[last[end - length], token]:
                    break
                ending = automaton.above_at[ending]
            last.append(token)
            start.append(end - length)
        ids, end = [], len(word)
        while end:
            ids.append(last[end])
            end = start[end]
        return ids[::-1]

    def _learn(self, chunks: set[str]) -> None:
        """Ids, as text, and their bytes for all ``chunks`` that are not known yet."""
        missing = [c for c in chunks if c not in self.chunk]
        if len(self.chunk) + len(missing) > _MOST or self._chars > _MOST_CHARS:
            self.release()
            missing = list(chunks)
        self._chars += sum(map(len, missing))
        for chunk in self.special.keys() & set(missing):
            self.chunk[chunk] = str(self.special[chunk]), self.bytes_of[self.special[chunk]]
            missing.remove(chunk)
        plain, findall = self._plain.fullmatch, self.words.findall
        parts = [[c] if plain(c) else findall(c) for c in missing]
        number: dict[str, int] = {}
        index = np.array([number.setdefault(w, len(number)) for part in parts for w in part], np.int64)
        ids, bounds = self._encode([w.encode() for w in number])
        # The ids of all chunks in a row, from those of their words.
        count = np.diff(bounds)[index]
        after = np.cumsum(count)
        ids = ids[np.repeat(bounds[index] - after + count, count) + np.arange(count.sum())]
        words = np.cumsum([0, *map(len, parts)])
        ends = np.concatenate([[0], after])[words]
        byte_ends = np.concatenate([[0], np.cumsum(self.lengths[ids])])[ends].tolist()
        ends, ids = ends.tolist(), ids.tolist()
        names = list(map(self.names.__getitem__, ids))
        decoded = b"".join(map(self.bytes_of.__getitem__, ids))
        known = self.chunk
        for chunk, a, b, first, last in zip(missing, ends, ends[1:], byte_ends, byte_ends[1:], strict=False):
            known[chunk] = ",".join(names[a:b]), decoded[first:last]

    def _encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode_words``, long words apart."""
        size = np.array([len(w) for w in words], np.int64)
        ids, bounds = self.encode_words([w for w in words if len(w) <= _IN_STEP])
        long = np.flatnonzero(size > _IN_STEP)
        if not len(long):
            return ids, bounds
        parts = np.split(ids, bounds[1:-1]) if len(long) < len(words) else []
        for at in long:
            parts.insert(at, np.array(self.encode_long(words[at])))
        return np.concatenate(parts), np.cumsum([0, *map(len, parts)])

    def encoded(self, texts: Iterable[str]) -> Iterator[tuple[int, list[tuple[str, bytes]]]]:
        """Number of a text, with ids and decoded bytes of the chunks of a piece of it; every text has a piece."""
        held, size = [], 0
        for row, text in enumerate(texts):
            for segment, special in self._segments(text):
                for piece in pieces(segment):
                    held.append((row, CHUNKS.findall(piece)))
                    size += len(piece)
                    if size > _LOT:
                        yield from self._known(held)
                        held, size = [], 0
                if special:
                    held.append((row, [special]))
        yield from self._known(held)

    def _known(self, held: list[tuple[int, list[str]]]) -> Iterator[tuple[int, list[tuple[str, bytes]]]]:
        self._learn(set().union(*(chunks for _, chunks in held)))
        for row, chunks in held:
            yield row, list(map(self.chunk.__getitem__, chunks))

    def _segments(self, text: str) -> Iterator[tuple[str, str]]:
        if not any(s in text for s in self.special):
            yield text, ""
            return
        parts = regex.split("(" + "|".join(map(regex.escape, self.special)) + ")", text)
        for k in range(0, len(parts), 2):
            yield parts[k], parts[k + 1] if k + 1 < len(parts) else ""

    def encode_all(self, texts: Iterable[str]) -> Iterator[list[int]]:
        """Ids of each text."""
        for _, found in groupby(self.encoded(texts), key=lambda piece: piece[0]):
            yield [int(n) for _, chunks in found for c in chunks for n in c[0].split(",")]

    def encode(self, text: str) -> list[int]:
        return next(self.encode_all([text]))

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.get, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def bpe(path: str) -> Bpe:
    """One encoder for each file and Python worker."""
    return Bpe(path)


def _digests(coder: Bpe, texts: Iterable[str]) -> Iterator[tuple[int, str, str]]:
    """Number of ids of each text, and hashes of the ids and of the text decoded from them."""
    for _, found in groupby(coder.encoded(texts), key=lambda piece: piece[0]):
        ids, plain, count = hashlib.sha256(), hashlib.sha256(), 0
        for _, chunks in found:
            if not chunks:
                continue
            if count:
                ids.update(b",")
            named = ",".join([c[0] for c in chunks])
            count += named.count(",") + 1
            ids.update(named.encode())
            plain.update(b"".join([c[1] for c in chunks]))
        yield count, ids.hexdigest(), plain.hexdigest()


def encode_digests(docs: DataFrame, path: str) -> DataFrame:
    """One row per document: number of ids, and hashes of the ids and of the text decoded from them.

    A null or empty text has no ids. Every row gives a row, so nulls, copies and ties need no rule.
    Other columns are left out. A map over rows: no shuffle; a lost task is simply run again.
    """

    def run(batches):
        coder = bpe(path)
        for batch in batches:
            rows = list(_digests(coder, (t.as_py() or "" for t in batch.column(1))))
            columns = list(zip(*rows, strict=True)) if rows else [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(columns[0], pa.int64()), *(pa.array(c, pa.string()) for c in columns[1:])],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA.replace("doc_id long", f"doc_id {docs.schema['doc_id'].dataType.simpleString()}"))


def encode_ids(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with a column ``token_ids`` (array of int); a null text gives an empty array, a column of that name is replaced."""

    def run(batches):
        coder = bpe(path)
        for batch in batches:
            ids = [np.array(i, np.int32) for i in coder.encode_all(t.as_py() or "" for t in batch.column("text"))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.list_(pa.int32()))], [*batch.schema.names, "token_ids"])
        coder.release()
        free_memory()

    kept = docs.drop("token_ids")
    return kept.mapInArrow(run, StructType([*kept.schema.fields, StructField("token_ids", ArrayType(IntegerType()))]))
