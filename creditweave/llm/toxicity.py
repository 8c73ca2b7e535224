"""Toxicity scores of texts after noisy-channel deobfuscation.

The channel writes words with look-alike signs, repeated letters and blanks or dots between letters.
Each suspicious token becomes a lattice of what its signs may stand for; Viterbi decoding under a
character language model of the corpus picks the likely readings. A logistic regression on the words
of the restored text, learned from labelled rows, gives the score.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from creditweave.llm.common import Memo, free_memory, pieces, remainder, written

#: Letters that a sign is used for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i",
}
SEPARATORS = " .-_*·,'~"
SIGN_COST, DROP_COST, SPLIT_COST, REPEAT_COST, RUN_COST = 1.0, 1.0, 1.5, 2.0, 0.3
#: Readings this much worse than the best one (in nats) still count, three at most.
MARGIN, READINGS = 6.0, 3

_S, _ORDER = 28, 4  # boundary, a to z, other letters
#: Characters whose grams are counted at once.
_LOT = 1 << 20
_SPACED = re.compile(r"(?<!\S)\S(?:\s+\S){2,}(?!\S)")
#: A word may be cut into chunks of so many signs.
_CHUNK = 3
#: One letter for all that a sign may stand for (i and l, b and g share one); separators vanish.
_ALIKE = str.maketrans({s: {"l": "i", "g": "b"}.get(c[0], c[0]) for s, c in LOOKALIKES.items()} | {"l": "i", "g": "b"} | dict.fromkeys(SEPARATORS, ""))
_DOUBLED = re.compile(r"([a-z])\1")
_SIGNS = re.compile("[" + re.escape("".join(LOOKALIKES) + SEPARATORS) + "]")
_EDGES = re.compile(r"^(?:[^\w@$!|+(€£¡]|_|([^\w])\1{2,})+|(?:[^\w@$|+€£]|_|([^\w])\2{2,})+$")
_PLAIN = re.compile(r"[a-z]+")


def _symbols() -> np.ndarray:
    table = np.zeros(0x250, np.int64)
    for c in range(0x250):
        letter = chr(c).lower()
        table[c] = ord(letter) - 96 if "a" <= letter <= "z" and len(letter) == 1 else 27 if letter.isalpha() else 0
    table[-1] = 27
    return table


_SYMBOLS = _symbols()


def char_counts(docs: DataFrame) -> DataFrame:
    """``gram, n``: counts of the character four-grams of all words, each word padded with boundaries."""

    def run(batches):
        total = np.zeros(_S**_ORDER, np.int64)

        def count(held):
            # One sign that is no letter parts two texts as it parts two words.
            points = np.frombuffer("\n".join(held).encode("utf-32-le", "replace"), np.uint32)
            code = np.concatenate([[0], _SYMBOLS[np.minimum(points, len(_SYMBOLS) - 1)], [0]])
            code = np.repeat(code, np.where(code == 0, _ORDER - 1, 1))
            gram = ((code[:-3] * _S + code[1:-2]) * _S + code[2:-1]) * _S + code[3:]
            np.add(total, np.bincount(gram[gram > 0], minlength=len(total)), out=total)

        held, size = [], 0
        for batch in batches:
            for text in batch.column(0):
                for piece in pieces(text.as_py() or ""):
                    held.append(piece)
                    size += len(piece)
                    # The table of all grams is much longer than most texts.
                    if size > _LOT:
                        count(held)
                        held, size = [], 0
        count(held)
        gram = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(total[gram])], ["gram", "n"])

    return docs.select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def char_model(counts: DataFrame, strength: float = 4.0) -> np.ndarray:
    """Log-probabilities by four-gram, each order smoothed by the next lower one.

    The table has ``28 ** 4`` cells however large the corpus is, so it may pass through the driver.
    """
    full = np.zeros(_S**_ORDER)
    for gram, n in counts.toPandas().itertuples(index=False):
        full[gram] = n
    below = np.full(_S, 1.0 / _S)
    for order in range(1, _ORDER + 1):
        n = full.reshape(-1, *[_S] * order).sum(axis=0)
        context = n.sum(axis=-1, keepdims=True)
        below = (n + strength * below) / (context + strength)
    return np.log(below).reshape(-1).astype(np.float32)


class Decoder:
    """Viterbi over the lattice of a token; a state is the last three symbols."""

    def __init__(self, model: np.ndarray):
        self.model = model

    def readings(self, token: str) -> list[str]:
        """Likely readings of a lower-case token, the best first; blanks in them part words."""
        states: dict[int, list[tuple[float, str]]] = {0: [(0.0, "")]}
        run = 0
        for at, sign in enumerate(token):
            same = at > 0 and token[at - 1] == sign
            run = run + 1 if same else 1
            options = self._options(sign)
            drop = None
            if same:
                long = run > 2 or token[at + 1 : at + 2] == sign
                drop = RUN_COST if long else REPEAT_COST
            elif at > 1 and sign not in SEPARATORS and token[at - 1] in SEPARATORS and token[at - 2] == sign:
                drop = REPEAT_COST
            elif sign in SEPARATORS or sign in LOOKALIKES and not sign.isdigit():
                drop = 0.1 if sign in SEPARATORS else DROP_COST
            ahead: dict[int, list[tuple[float, str]]] = {}
            for state, paths in states.items():
                if drop is not None:
                    ahead.setdefault(state, []).extend((s - drop, t) for s, t in paths)
                for symbol, letter, cost in options:
                    gain = float(self.model[state * _S + symbol]) - cost
                    to = (state * _S + symbol) % _S**3 if symbol else 0
                    ahead.setdefault(to, []).extend((s + gain, t + letter) for s, t in paths)
            states = {k: sorted(set(v), reverse=True)[:READINGS] for k, v in ahead.items()}
        ends = sorted(((s + float(self.model[k * _S]), t) for k, v in states.items() for s, t in v), reverse=True)
        return list(dict.fromkeys(t for s, t in ends if s >= ends[0][0] - MARGIN))[:READINGS] if ends else []

    @staticmethod
    def _options(sign: str) -> list[tuple[int, str, float]]:
        if "a" <= sign <= "z":
            return [(ord(sign) - 96, sign, 0.0)]
        if sign in LOOKALIKES:
            return [(ord(c) - 96, c, SIGN_COST) for c in LOOKALIKES[sign]]
        if sign.isalpha():
            return [(27, sign, 0.0)]
        return [(0, " ", SPLIT_COST)]


def _core(token: str) -> str:
    return _EDGES.sub("", token)


def _squeezed(word: str) -> str:
    return re.sub(r"(.)\1+", r"\1", word)


def _rough(word: str) -> str:
    """What all disguises of a word by signs and repeats have in common."""
    return _squeezed(word.translate(_ALIKE))


class Restorer:
    """Words of the restored text. With ``wanted``, only those matter, and tokens that cannot give one are not decoded."""

    def __init__(self, model: np.ndarray, wanted: set[str] | None = None):
        decoder = Decoder(model)
        self.chars, self.decode, self.wanted = model, decoder.readings, wanted
        self.skeletons = None if wanted is None else {_squeezed(w) for w in wanted}
        self.rough = {_rough(w) for w in wanted or ()}
        self.prefixes = {w[:k] for w in self.rough for k in range(1, len(w) + 1)}
        self.rough_of = Memo(_rough)
        self.of_token = Memo(self._of_token)

    def _of_token(self, token: str) -> tuple[str, ...]:
        core = _core(token)
        if not core:
            return ()
        if _PLAIN.fullmatch(core):
            # Of letters alone, the lattice only shortens runs.
            if not _DOUBLED.search(core) or self.skeletons is not None and _squeezed(core) not in self.skeletons:
                return self._kept([core])
        elif not _SIGNS.search(core):
            return self._kept([core])
        return self._kept([core, *(w for r in self.decode(core) for w in r.split())])

    def _kept(self, words: list[str]) -> tuple[str, ...]:
        return tuple(dict.fromkeys(w for w in words if self.wanted is None or w in self.wanted))

    def words(self, text: str) -> set[str]:
        found: set[str] = set()
        for piece in pieces(text):
            lower = piece.lower()
            words = lower.split()
            tokens = set(words)
            tokens.update(" ".join(run.split()) for run in _SPACED.findall(lower))
            if self.rough:
                tokens.update(self._windows(words))
            for given in map(self.of_token.__getitem__, tokens):
                if given:
                    found.update(given)
        return found

    def _windows(self, words: list[str]):
        """Neighbouring chunks that together look like a wanted word."""
        prefixes, rough_of = self.prefixes, self.rough_of
        for first in [k for k, w in enumerate(words) if len(w) <= _CHUNK and rough_of[w] in prefixes]:
            joined = rough_of[words[first]]
            for last in range(first + 1, len(words)):
                if len(words[last]) > _CHUNK:
                    break
                chunk = rough_of[words[last]]
                joined += chunk[1:] if chunk[:1] == joined[-1] else chunk
                if joined not in prefixes:
                    break
                if joined in self.rough:
                    yield " ".join(words[first : last + 1])

    def text(self, text: str) -> str:
        """The restored text itself, by the best reading of each token."""
        lower = _SPACED.sub(lambda m: self.decode(" ".join(m[0].split()))[0], text.lower())
        return " ".join((self.decode(c) or [c])[0] if (c := _core(t)) and (_SIGNS.search(c) or _DOUBLED.search(c)) else t for t in lower.split())


@dataclass
class ToxicityModel:
    chars: np.ndarray
    bias: float
    weights: dict[str, float]

    def score(self, words: set[str]) -> float:
        return 1.0 / (1.0 + math.exp(-max(-700.0, self.bias + sum(self.weights.get(w, 0.0) for w in sorted(words)))))


def _fit(toxic: np.ndarray, row: np.ndarray, word: np.ndarray, size: int, ridge: float) -> np.ndarray:
    """Newton steps for a ridge logistic regression; ``word`` stands in ``row``, the last weight is the bias.

    Each step is solved by conjugate gradients over the pairs alone, so no matrix of rows by words is made.
    """
    n = len(toxic)
    row, word = np.concatenate([row, np.arange(n)]), np.concatenate([word, np.full(n, size)])
    w, penalty = np.zeros(size + 1), np.full(size + 1, ridge)
    penalty[size] = 1e-3

    def by_row(v):
        return np.bincount(row, weights=v[word], minlength=n)

    def by_word(v):
        return np.bincount(word, weights=v[row], minlength=size + 1)

    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(by_row(w), -30, 30)))
        spread = p * (1 - p)
        scale = by_word(spread) + penalty
        left = by_word(toxic - p) - penalty * w
        step, along, worth = np.zeros(size + 1), left / scale, left @ (left / scale)
        for _ in range(4 * (size + 1)):
            if worth < 1e-20:
                break
            image = by_word(spread * by_row(along)) + penalty * along
            rate = worth / (along @ image)
            step, left = step + rate * along, left - rate * image
            worth, before = left @ (left / scale), worth
            along = left / scale + worth / before * along
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, ridge: float = 0.05) -> ToxicityModel:
    """Character model from all of ``docs``; word weights from at most ``max_rows`` labelled documents.

    Labels come only from rows whose ``crc32(doc_id) mod 3`` is not 1; the sample is the first
    ``max_rows`` by a hash of the id. Null ids or labels are no labels; a repeated id is toxic if one of
    its rows is. With no label at all, every score is 0.5. Every word counts that stands in three toxic rows
    and is commoner there by a gain of six nats.
    """
    spark = docs.sparkSession
    chars = char_model(char_counts(docs))
    marked = labels.filter("doc_id is not null and toxic is not null").filter(remainder(F.col("doc_id"), 3) != 1)
    sample = marked.groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").alias("_toxic")).orderBy(F.xxhash64("_id"), "_id").limit(max_rows)
    shared = spark.sparkContext.broadcast(chars)

    def run(batches):
        restorer = Restorer(shared.value)
        for batch in batches:
            words = [sorted(restorer.words(t.as_py() or "")) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.list_(pa.string()))], ["toxic", "words"])

    # At most max_rows ids: the bound holds for any table.
    joined = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("_id"))
    rows = joined.select(F.col("_toxic").cast("long").alias("toxic"), "text").repartition(spark.sparkContext.defaultParallelism)
    rows = rows.mapInArrow(run, "toxic long, words array<string>").withColumn("row", F.monotonically_increasing_id())
    rows = written(spark, rows, "toxic-words")
    totals = rows.groupBy().agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("pos")).first()
    if not totals["n"]:
        return ToxicityModel(chars, 0.0, {})
    n, pos = totals["n"], totals["pos"]
    by_word = rows.select("toxic", F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n"), F.sum("toxic").alias("pos"))

    def part(count, expected):
        return F.when(count > 0, count * F.log(count / expected)).otherwise(0.0)

    c, k = F.col("n"), F.col("pos")
    share = pos / n
    gain = part(k, c * share) + part(c - k, c * (1 - share))
    picked = by_word.filter((k >= 3) & (k > c * share)).withColumn("gain", gain).filter("gain >= 6").select("word")
    pairs = rows.select("row", F.explode("words").alias("word")).join(picked, "word").select("row", "word").toArrow()
    # At most max_rows rows.
    marks = rows.select("row", "toxic").orderBy("row").toArrow()
    ids, toxic = (marks.column(i).to_numpy() for i in (0, 1))
    words, word = np.unique(np.array(pairs.column("word").to_pylist(), object).astype(str), return_inverse=True)
    row = np.searchsorted(ids, pairs.column("row").to_numpy())
    order = np.lexsort((word, row))
    weights = _fit(toxic.astype(float), row[order], word[order], len(words), ridge)
    return ToxicityModel(chars, float(weights[-1]), {str(w): float(x) for w, x in zip(words, weights, strict=False)})


def score(docs: DataFrame, model: ToxicityModel, threshold: float = 0.7) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on); a map over rows.

    A null or empty text has the score of a text without any known word. Columns of the same names are
    replaced; all others stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.drop("score", "predicted")

    def run(batches):
        model = shared.value
        restorer = Restorer(model.chars, set(model.weights))
        for batch in batches:
            scores = [model.score(restorer.words(t.as_py() or "")) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, "score"])
        del restorer
        free_memory()

    schema = StructType([*kept.schema.fields, StructField("score", DoubleType())])
    return kept.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
