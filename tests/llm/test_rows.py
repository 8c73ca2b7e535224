"""Operators that map rows or train models: coding, scoring, extraction, URLs."""

from __future__ import annotations

import hashlib
import html
import itertools
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from creditweave.llm import bpe, html_text, id_coder, suffix_tree, toxicity, urls
from creditweave.llm.common import remainder

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    coder = Tokenizer.from_file(PATH)
    coder.no_padding()
    coder.no_truncation()
    return coder


def test_bpe_digests(docs, corpus, library):
    want = []
    for i, t in corpus:
        ids = library.encode(t or "", add_special_tokens=False).ids
        plain = library.decode(ids, skip_special_tokens=False)
        want.append((str(i), len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(plain.encode()).hexdigest()))
    got = [(str(r[0]), *r[1:]) for r in bpe.encode_digests(docs, PATH).collect()]
    assert sorted(got) == sorted(want)


def test_bpe_on_odd_texts(library):
    rng, coder = random.Random(6), bpe.bpe(PATH)
    parts = [*"aab bcde 's'll \n\t\u3000\xa0é漢🙂\x1c\x85$$##12a", "<|endoftext|>", "the", "aaaa", "    ", "zzz"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert coder.encode(text) == ids and coder.decode(ids) == text
    long = " ".join(rng.choices(["word", "another,", "x\n\ny", "  "], k=400_000))
    assert coder.encode(long) == library.encode(long, add_special_tokens=False).ids


def test_bpe_ids_as_a_column(docs, corpus, library):
    rows = bpe.encode_ids(docs, PATH)
    assert rows.columns == [*docs.columns, "token_ids"]
    assert all(r.token_ids == library.encode(r.text or "", add_special_tokens=False).ids for r in rows.collect())


@pytest.mark.parametrize("seed", range(4))
def test_id_blocks_round_trip(seed):
    rng = np.random.default_rng(seed)
    top = [3, 300, 50_257, 131_000][seed]
    blocks = [np.minimum(rng.integers(0, top, n), rng.integers(0, top, n)).astype(np.int32) for n in (0, 1, 2, 700, 4096, 4096)]
    blocks += [np.full(900, top - 1, np.int32), np.tile(np.arange(7, dtype=np.int32), 200)]
    back = id_coder.decode_blocks(id_coder.encode_blocks(blocks), np.array([len(b) for b in blocks]))
    assert all((a == b).all() for a, b in zip(blocks, back, strict=True))


def test_repeated_ids_take_little_room():
    block = np.tile(np.arange(500, 540, dtype=np.int32), 100)
    assert len(id_coder.encode_blocks([block])[0]) < len(block) * 2 / 10


def test_words_that_keep_coming_are_encoded_once():
    encoder, asked = id_coder._Encoder(PATH, 200), []
    library = encoder.coder

    class Counted:
        model = property(lambda self: self)

        def tokenize(self, text):
            asked.append(text)
            return library.model.tokenize(text)

        def encode(self, text, **how):
            asked.append(text)
            return library.encode(text, **how)

        def encode_batch_fast(self, texts, **how):
            asked.extend(texts)
            return library.encode_batch_fast(texts, **how)

    encoder.coder = Counted()
    for k in range(60):
        text = " ".join(f"rare{'abcdefghij'[k % 10]}{'klmnopqrst'[n % 10]}{'uvwxyzabcd'[k // 10]}{n} oftenseen{' .,;'[n % 4]}" for n in range(30))
        ids, lengths = encoder.encode([text, ""], 0)
        assert ids.tolist() == [*library.encode(text, add_special_tokens=False).ids, 0, 0] and lengths.tolist() == [len(ids) - 1, 1]
    assert sum("oftenseen" in a for a in asked) == 1


def test_chunks_are_those_of_the_library(library):
    rng = np.random.default_rng(5)
    parts = [" ", "  ", "\n", " \n", "\t", "\u2003", "\u3000", "a", "foo", "Bar", "\u00e9", "e\u0301", "'s", "'", "'ll", "1", "23", ".", ",", "!?", "$$", "%", "\u2026"]
    parts += ["\u4e2d", "\u044f", "\U0001f600", "<|endoftext|>", "<|", "\x85", "\x1c", "\u200b", "\u00aa", "\u00d7", "\u00f7", "\u01c5", "_", "-", "\u2019", "\ufeff", "\u0663"]
    texts = ["".join(rng.choice(parts, rng.integers(0, 12))) for _ in range(3000)]
    for encoder in (id_coder._Encoder(PATH), id_coder._Encoder(PATH, 50)):
        ids, lengths = encoder.encode(texts, 0)
        for text, got in zip(texts, np.split(ids, np.cumsum(lengths)[:-1]), strict=True):
            assert got.tolist() == [*library.encode(text, add_special_tokens=False).ids, 0], repr(text)


def test_carries_go_through_full_words():
    # Likely ids and unlikely ones in turn move the range coder's low end over all its places.
    rng = np.random.default_rng(9)
    blocks = [np.where(rng.random(1024) < share, 7, rng.integers(0, 1 << 17, 1024)).astype(np.int32) for share in np.linspace(0, 1, 300)]
    back = id_coder.decode_blocks(id_coder.encode_blocks(blocks), np.array([1024] * 300))
    assert all((a == b).all() for a, b in zip(blocks, back, strict=True))


def test_unforeseen_ids_of_one_magnitude_cost_their_bits():
    ids = np.random.default_rng(1).integers(16_380, 32_764, 4096).astype(np.int32)  # 14 bits each
    payloads = id_coder.encode_blocks([ids])
    assert len(payloads[0]) * 8 < 14.2 * len(ids)


def test_joined_crc():
    parts = [b"hello", b"", b"x" * 70_000, b"\x00\x00"]
    assert id_coder.joined_crc([(zlib.crc32(p), len(p)) for p in parts]) == zlib.crc32(b"".join(parts))


def test_id_files(spark, docs, corpus, library, tmp_path):
    rows = [r for r in corpus if r[0] is not None]
    rows = sorted(dict(rows).items())
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, part int, kind string").repartition(4)
    path = str(tmp_path / "ids")
    id_coder.write_ids(frame, path, PATH)
    want, every, at = [], [], 0
    for i, t in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
        every += ids
    assert sorted(map(tuple, id_coder.read_checksums(spark, path).collect())) == want
    blocks = sorted(id_coder.read_ids(spark, path).collect())
    assert [n for b in blocks for n in b.ids] == every
    # Null ids and repeated rows: every row has its own place.
    other = id_coder.ids_round_trip(docs, PATH).collect()
    assert len(other) == len(corpus) and sum(r.n_tokens for r in other) == max(r.start + r.n_tokens for r in other)


def test_damaged_block_is_noticed(spark, tmp_path):
    path, bad = str(tmp_path / "ids"), str(tmp_path / "bad")
    id_coder.write_ids(spark.createDataFrame([(1, "some words to code " * 50)], "doc_id long, text string"), path, PATH)
    rows = spark.read.parquet(path)
    rows.withColumn("crc", F.col("crc") + 1).write.parquet(bad)
    with pytest.raises(Exception, match="damaged"):
        id_coder.read_checksums(spark, bad).collect()


def brute_base(corpus, modulus, left_out):
    words = [(i, (t or "").encode().lower().split() + [b""]) for i, t in corpus]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % modulus == left_out for i, _ in corpus]
    counts = Counter(w for (_, ws), h in zip(words, held, strict=True) if not h for w in ws)
    n, v = sum(counts.values()), len(counts)
    return sorted(
        (str(i), h, len(ws), sum(counts[w] > 0 for w in ws), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), 6))
        for (i, ws), h in zip(words, held, strict=True)
    )


def test_suffix_tree_base(docs, corpus):
    got = suffix_tree.score(docs, remainder(F.col("doc_id"), 7) != 2).collect()
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == brute_base(corpus, 7, 2)
    assert all(r.score <= 0 for r in got)


def test_suffix_tree_learns_contexts(spark):
    rng = random.Random(8)
    chain = {"a": "b", "b": "c", "c": "d", "d": "a"}
    rows = []
    for k in range(400):
        words = [rng.choice("abcd")]
        for _ in range(30):
            words.append(chain[words[-1]] if rng.random() < 0.9 else rng.choice("abcd"))
        rows.append((k, " ".join(words)))
    got = suffix_tree.score(spark.createDataFrame(rows, "doc_id long, text string"), remainder(F.col("doc_id"), 7) != 2).filter("held_out").collect()
    gain = sum(r.score - r.base_score for r in got) / sum(r.n_tokens for r in got)
    assert gain > 0.3


def brute_tree(texts, depth):
    """The tree by dictionaries of word sequences: a function from words to the log10 probability of a whole text."""
    rows = [[*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), t or "")), None] for t in texts]
    counts = Counter(tuple(r[k : k + n]) for r in rows for n in range(1, depth + 2) for k in range(len(r) - n + 1))
    n_all, n_types = sum(map(len, rows)), len({w for r in rows for w in r})
    states = {}

    def prob(words):
        """Of the last word after those before it."""
        p = (counts[words[-1:]] + 1) / (n_all + n_types + 1)
        for n in range(1, len(words)):
            if (found := states.get(words[-1 - n : -1])) is not None:
                p = found[1].get(words[-1], p * found[0])
        return p

    for n in range(1, depth + 1):
        followers = {}
        for s, c in counts.items():
            if len(s) == n + 1 and c >= suffix_tree.ENTRY_LEAST and counts[s[:-1]] >= suffix_tree.CONTEXT_LEAST:
                followers.setdefault(s[:-1], []).append((s, c))
        found = {}
        for context, grams in followers.items():
            total = counts[context]
            chosen = [(s, c, (c - suffix_tree.DISCOUNT) / total, prob(s)) for s, c in grams]
            chosen = [g for g in chosen if max(g[2] / g[3], g[3] / g[2]) >= suffix_tree.RATIO]
            left, below = 1 - sum(g[2] for g in chosen), 1 - sum(g[3] for g in chosen)
            if not chosen or left <= 1e-9 or below <= 1e-9:
                continue
            gain = sum(c * math.log(own / parent) for _, c, own, parent in chosen) + (total - sum(g[1] for g in chosen)) * math.log(left / below)
            if gain > 0.5 * (len(chosen) + 1) * math.log(total):
                found[context] = (left / below, {s[-1]: own for s, _, own, _ in chosen})
        states.update(found)

    def text_score(text):
        row = [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")), None]
        return sum(math.log10(prob(tuple(row[max(0, k - depth) : k + 1]))) for k in range(len(row)))

    return text_score, states, prob, {w for r in rows for w in r}


@pytest.fixture(scope="module")
def chained():
    """Texts in which words follow from up to four words before, with rare words, a hot word, nulls and blanks."""
    rng = random.Random(9)
    rows = []
    for k in range(900):
        words = rng.choices("pqrs", k=4)
        for _ in range(rng.randint(0, 40)):
            code = sum(map(ord, "".join(words[-4 if k % 3 else -2 :])))
            words.append("pqrs"[code % 4] if rng.random() < 0.8 else rng.choice(["The", "z", f"x{rng.randrange(300)}", "p"]))
        rows.append((k, "  ".join(words)))
    return [*rows, (1000, None), (1001, ""), (1002, " \n"), (None, rows[0][1]), rows[5], rows[5], (1003, "p q r " * 40_000)]


@pytest.mark.parametrize("max_local", [suffix_tree.MAX_LOCAL, 100, 0])
def test_suffix_tree_against_brute_force(spark, chained, max_local):
    """Scores equal those of dictionaries, whether tables are held in tasks, joined, or some of each."""
    text_score, states, _, _ = brute_tree([t for i, t in chained if zlib.crc32(str(i if i is not None else "").encode()) % 7 != 2], 4)
    assert {len(s) for s in states} == {1, 2, 3, 4}
    docs = spark.createDataFrame(chained, "doc_id long, text string").repartition(4)
    got = suffix_tree.score(docs, remainder(F.col("doc_id"), 7) != 2, max_local=max_local).collect()
    want = sorted((str(i), text_score(t)) for i, t in chained)
    assert [g[0] for g in sorted((str(r.doc_id), r.score) for r in got)] == [w[0] for w in want]
    assert all(abs(g[1] - w[1]) < 1e-6 * max(1.0, abs(w[1])) for g, w in zip(sorted((str(r.doc_id), r.score) for r in got), want, strict=True))
    base = brute_base(chained, 7, 2)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == base


def test_suffix_tree_sends_no_token_rows(spark, chained, monkeypatch):
    """With tables of more than ``max_local`` rows too, tasks hand on counts and sums by row, not a row for each token."""
    sent, frame = spark.sparkContext.accumulator(0), type(spark.range(1))
    original = frame.mapInArrow

    def counted(self, func, schema, *other):
        def run(batches):
            for batch in func(batches):
                sent.add(batch.num_rows)
                yield batch

        return original(self, run, schema, *other)

    monkeypatch.setattr(frame, "mapInArrow", counted)
    docs = spark.createDataFrame(chained, "doc_id long, text string").repartition(4)
    got = suffix_tree.score(docs, remainder(F.col("doc_id"), 7) != 2, max_local=100).collect()
    assert 0 < sent.value < sum(r.n_tokens for r in got) / 4


def test_suffix_tree_states_are_distributions(chained):
    """In every retained state the probabilities of all words, the unknown one among them, add up to one."""
    _, states, prob, words = brute_tree([t for _, t in chained], 4)
    for context in list(states)[::7]:
        assert abs(sum(prob((*context, w)) for w in words) + prob((*context, "unknown")) - 1) < 1e-9


def test_suffix_tree_grows_with_the_input(spark, chained):
    """Twice the text under other words gives twice the states: what a state needs does not rise."""
    texts = spark.createDataFrame(chained, "doc_id long, text string").select("text")
    other = texts.select(F.translate("text", "pqrsz", "abcde").alias("text"))

    def size(frame):
        return sum(level.states.count() for level in suffix_tree.train(frame, suffix_tree.word_counts(frame)).levels)

    assert size(texts.unionByName(other)) >= 1.9 * size(texts)


def test_restoring_disguised_words():
    rng = random.Random(10)
    words = "this that with other idiot stupid worthless moron trash word there being thing".split()
    counts = Counter()
    for w in rng.choices(words, k=20_000):
        code = [0, 0, 0, *(ord(c) - 96 for c in w), 0]
        for k in range(len(code) - 3):
            counts[((code[k] * 28 + code[k + 1]) * 28 + code[k + 2]) * 28 + code[k + 3]] += 1

    class Table:
        def toPandas(self):
            import pandas as pd

            return pd.DataFrame(sorted(counts.items()), columns=["gram", "n"])

    restorer = toxicity.Restorer(toxicity.char_model(Table()))
    for text, word in [
        ("you 1d10t!", "idiot"), ("such a m0r0n", "moron"), ("stuuupid thing", "stupid"), ("i d i o t here", "idiot"),
        ("w.o.r.t.h.l.e.s.s", "worthless"), ("tr@sh", "trash"), ("$tup1d", "stupid"), ("worthless###", "worthless"), ("idiot", "idiot"),
    ]:
        assert word in restorer.words(text), text
    wanted = toxicity.Restorer(restorer.chars, {"idiot", "stupid", "moron"})
    for text, word in [
        ("you i  d\ti\n\no t here", "idiot"), ("id iot", "idiot"), ("what a stu  pid thing", "stupid"), ("m0 r0 n", "moron"),
        ("1d i 0t", "idiot"), ("st\nup\nid", "stupid"), ("mo ro o on", "moron"),
    ]:
        assert wanted.words(text) == {word}, text
    assert wanted.words("in the id of it all is not mo and or on top it is id or") == set()
    assert restorer.words("") == set() and restorer.words("this that") == {"this", "that"}
    assert restorer.text("th1s m0r0n") == "this moron"


@pytest.fixture(scope="module")
def toxic_corpus():
    rng = random.Random(11)
    plain = ["".join(rng.choices("abdeinorst", k=rng.randint(2, 7))) for _ in range(300)]
    rows = []
    for k in range(600):
        words, toxic = rng.choices(plain, k=rng.randint(5, 60)), int(k % 6 == 0)
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["idiot", "moron", "scum", "1diot", "mor0n", "i d i o t"]))
        rows.append((k, " ".join(words), toxic))
    return rows


def test_toxicity_fit_against_dense_newton():
    rng = np.random.default_rng(4)
    x = (rng.random((300, 12)) < 0.2).astype(float)
    y = (rng.random(300) < 1 / (1 + np.exp(2 - 3 * x[:, 0] - 2 * x[:, 1]))).astype(float)
    row, word = np.nonzero(x)
    got = toxicity._fit(y, row, word, 12, 0.05)
    full, penalty, w = np.column_stack([x, np.ones(300)]), np.array([0.05] * 12 + [1e-3]), np.zeros(13)
    for _ in range(50):
        p = 1 / (1 + np.exp(-full @ w))
        w += np.linalg.solve((full * (p * (1 - p))[:, None]).T @ full + np.diag(penalty), full.T @ (y - p) - penalty * w)
    assert np.abs(got - w).max() < 1e-6


def test_toxicity_without_a_limit_of_words(spark):
    """Four hundred toxic words, each in few rows, all count; a long text and repeated rows are scored alike."""
    rng = random.Random(5)
    letters = "bcdfghjkmnprstvw"
    bad = ["".join(p) + "uk" for p in itertools.islice(itertools.permutations(letters, 3), 0, 3200, 8)]
    rows = [(k, " ".join([rng.choice(["one", "two", "six"]) for _ in range(9)] + rng.sample(bad, 30) * (k % 5 == 0)), int(k % 5 == 0)) for k in range(3000)]
    extra = [(5000, "one " * 400_000 + " ".join(bad[::14])), (5001, "six " + bad[3]), (5001, "six " + bad[3])]
    docs = spark.createDataFrame([r[:2] for r in rows] + extra, "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame([(k, y) for k, _, y in rows], "doc_id long, toxic int"))
    assert set(bad) <= set(model.weights) and len(model.weights) < len(bad) + 5
    got = toxicity.score(docs.filter("doc_id >= 5000"), model).collect()
    assert len(got) == 3 and len({r.score for r in got if r.doc_id == 5001}) == 1
    assert [r.predicted for r in got if r.doc_id == 5000] == [1]


def test_toxicity(spark, toxic_corpus):
    docs = spark.createDataFrame([(k, t, "en", 9.0) for k, t, _ in toxic_corpus] + [(None, None, "x", 1.0), (900, "", "x", 1.0)], "doc_id long, text string, lang string, score double")
    labels = spark.createDataFrame([(k, y) for k, _, y in toxic_corpus] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(toxic_corpus) + 2 and all(0 <= r.score <= 1 for r in got)
    truth = {k: y for k, _, y in toxic_corpus}
    held = [r for r in got if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.98 * len(held)
    empty = toxicity.train(docs, labels.limit(0))
    assert {r.score for r in toxicity.score(docs, empty).collect()} == {0.5}
    assert toxicity.score(docs.limit(0), model).collect() == []


def test_pages(spark):
    rng = random.Random(12)

    def words(n):
        return " ".join("".join(rng.choices("abdeinorst", k=5)) for _ in range(n)).capitalize() + "."

    rows, want = [], {}
    for k in range(80):
        parts = [words(rng.randint(1, 60)) for _ in range(rng.randint(1, 6))]
        inner = "".join(f"<p><b>{html.escape(p)} &amp;&nbsp;x<br>" for p in parts)
        page = (
            f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t='</p><p>no</p>';</script></head><body><nav><ul><li><a href='/a'>{words(2)}</a></ul></nav>"
            f"<!-- <p>comment</p> --><div class='ad'>{words(6)}</div><article><h1>Head {k}</h1>{inner}</article><section class='comments'><p>{words(9)}</p></section><footer>{words(4)}</footer></body></html>"
        )
        rows.append((k, f"http://x/{k}", page))
        want[k] = "\n".join([f"Head {k}", *(f"{p} & x" for p in parts)])
    odd = [(100, None, None), (101, "u", ""), (None, "u", "<p"), (102, "u", "no markup at all"), (103, "u", "<div><article><p>Open <b>end")]
    pages = spark.createDataFrame([(*r, "t") for r in rows + odd], "page_id long, url string, html string, text string")
    got = {r.page_id: r for r in html_text.extract(pages, html_text.train(pages)).collect()}
    assert len(got) == len(rows) + len(odd) and all(r.n_chars == len(r.text) for r in got.values())
    assert sum(got[k].text == want[k] for k in want) == len(want)
    assert got[100].text == got[101].text == "" and got[103].text == "Open end"


def test_field_on_new_pages():
    model = html_text.fit(html_text.written_pages(200), steps=120)
    right = total = 0
    for found, labels in html_text.written_pages(60, seed=77):
        decoded = model.decode(found)
        right += sum(a == b for a, b in zip(decoded, labels, strict=True))
        total += len(labels)
    assert right >= 0.97 * total and model.decode([]) == []


RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"))


def test_urls(spark):
    cases = {
        "http://A.Example.org/es/x?y": ("a.example.org", "/es/x", "example.org/es/", "block"),
        "https://example.org/en/12#t": ("example.org", "/en/12", "example.org/en/1", "block"),
        "https://notexample.org/es/": ("notexample.org", "/es/", "org/", "allow"),
        "x://news.com/fr/": ("news.com", "/fr/", "com/fr/", "allow"),
        "http://www.casino-win.example.com/en/3": ("www.casino-win.example.com", "/en/3", None, "block"),
        "http://www.history.example.net/en/3": ("www.history.example.net", "/en/3", None, "allow"),
        "http://org": ("org", "", None, None), "no scheme/x": ("", "", None, None), "http://é.COM?q=/fr/": ("é.com", "", None, None),
        "a://b://c/d": ("b:", "//c/d", None, None), "http://x/a\nb?c": ("x", "/a\nb", None, None), "": ("", "", None, None), None: ("", "", None, None),
    }
    pages = spark.createDataFrame([(k, u, "h") for k, u in enumerate(cases)] + [(None, None, "h")], "page_id long, url string, host string")
    got = {r.page_id: r for r in urls.judge(pages, RULES, urls.labelled_urls(spark)).collect()}
    assert len(got) == len(cases) + 1
    for k, (host, path, rule, verdict) in enumerate(cases.values()):
        r = got[k]
        assert (r.host, r.path, r.rule) == (host, path, rule) and verdict in (None, r.verdict) and r.verdict in ("allow", "block")


def test_empty_tables(spark, none):
    assert bpe.encode_digests(none, PATH).collect() == [] and bpe.encode_ids(none, PATH).collect() == []
    assert id_coder.ids_round_trip(none, PATH).collect() == []
    assert suffix_tree.score(none, remainder(F.col("doc_id"), 7) != 2).collect() == []
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert html_text.extract(pages, html_text.train(pages)).collect() == []
    assert urls.judge(pages, RULES, urls.labelled_urls(spark)).collect() == []


def test_patterns_see_white_space_alike():
    assert all((re.fullmatch(r"\s", chr(c)) is not None) == (chr(c) in bpe_space()) or chr(c) in "\x1c\x1d\x1e\x1f" for c in range(0x3100))


def bpe_space():
    from creditweave.llm.common import UNICODE_SPACE

    # The range in the class stands for all of U+2000 to U+200A.
    return set(UNICODE_SPACE) - {"-"} | {chr(c) for c in range(0x2000, 0x200B)}


def block_texts(page):
    return [b.text for b in html_text.blocks(page)]


@pytest.mark.parametrize(
    ("page", "texts"),
    [
        ("<p>One <a title=don't href=x>two</a> three</p><p>it's four</p><p>five</p>", ["One two three", "it's four", "five"]),
        ('<p title="a > b <i>">q</p><p class=a">w</p><img alt=\'it"s\'/>z<br/>y', ["q", "w", "z y"]),
        ('<p>a <a title="open>text</a><p class="x">next</p>', ["a text", "next"]),
        ("<p>3 < 5 and a<b or c</p><p>x</p>", ["3 < 5 and a<b or c", "x"]),
        ("<p>k</p><!-- never ended <p>x</p>", ["k"]),
        ("<p>k</p><script>x <p>y</p>", ["k"]),
        ("<p>k</p><SCRIPT>x</Script >l<svg><p>m</p>", ["k", "l", "m"]),
        ("<svg><p>a</p></svg><title>t</title>b<textarea>c</textarea>", ["b"]),
        ("a <b", ["a <b"]), ("<", ["<"]), ("", []), ("<p", ["<p"]), ("<!DOCTYPE html><?x?>t", ["t"]), ("x</nothing>y", ["x", "y"]),
    ],
)
def test_markup_of_any_kind_loses_no_text(page, texts):
    assert block_texts(page) == texts


@pytest.mark.parametrize("piece", ["<a ", "<svg>", '<a t="', "<a t='x \"<", "<!", "</", '<p class="x', "<div>", "<div>x", "<a b=c ", "</p>", "<script", "<a x=", "<!--", "&", "<p>'"])
def test_time_goes_with_the_length_of_a_page(piece):
    start = time.perf_counter()
    html_text.blocks(piece * 100_000)
    html_text.blocks(piece * 100_000 + ">")
    assert time.perf_counter() - start < 10


def test_viterbi_against_enumeration():
    rng = random.Random(5)
    for _ in range(60):
        found = [html_text.Block("x" * rng.randint(1, 300), frozenset(rng.sample(["t:a", "t:b", "t:c"], 2))) for _ in range(rng.randint(1, 7))]
        model = html_text.Field({f: rng.uniform(-2, 2) for b in found for f in html_text.features(b)}, (rng.random(), rng.random()), tuple(tuple(rng.uniform(-2, 2) for _ in range(2)) for _ in range(2)))

        def score(labels, found=found, model=model):
            unary = sum(sum(model.weights[f] for f in html_text.features(b)) for b, y in zip(found, labels, strict=True) if y)
            return model.start[labels[0]] + unary + sum(model.turn[a][b] for a, b in itertools.pairwise(labels))

        best = max(itertools.product((0, 1), repeat=len(found)), key=score)
        assert model.decode(found) == list(best)


def test_features_of_a_whole_block():
    long = "word " * 300
    assert "w:comments" not in html_text.features(html_text.Block(long + "comments", frozenset()))
    assert "w:cookies" in html_text.features(html_text.Block("word " * 60 + "cookies", frozenset()))
    assert "w:comments" in html_text.features(html_text.Block((long + "comments ") + "comments and comments " * 3, frozenset()))


def test_url_model_is_as_wide_as_its_labelled_table(spark):
    """Buckets that do not vary get no weight; leaving them out changes no score."""
    labelled = urls.labelled_urls(spark).filter("path = '/es/7'")
    rows = urls.with_features(labelled, (3, 4), 1 << 18)
    model = urls.train(labelled, (3, 4), 1 << 18)
    assert model.stages[-1].numFeatures < 1 << 14
    whole = LogisticRegression(labelCol="blocked", regParam=0.01, maxIter=50).fit(rows)
    scores = [[vector[1] for (vector,) in m.transform(rows).orderBy("host").select("probability").collect()] for m in (model, whole)]
    assert max(abs(a - b) for a, b in zip(*scores, strict=True)) < 1e-9
