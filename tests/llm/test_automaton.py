"""The suffix automaton of tokens, words encoded in step and alone, and counts of character four-grams."""

import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from creditweave.llm import bpe, toxicity
from creditweave.llm.suffix_automaton import SuffixAutomaton

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("seed", range(30))
def test_all_tokens_that_end_at_a_place(seed):
    rng = random.Random(seed)
    letters = b"abc"[: rng.randint(1, 3)]
    words = {bytes(rng.choices(letters, k=rng.randint(1, 6))) for _ in range(rng.randint(1, 25))}
    tokens = {w: n for n, w in enumerate(sorted(words | {bytes([c]) for c in letters}))}
    automaton = SuffixAutomaton(tokens)
    texts = [bytes(rng.choices(letters, k=40)) for _ in range(5)]
    state = matched = np.zeros(len(texts), np.int32)
    walks = [list(automaton.walk(t)) for t in texts]
    for end in range(1, 41):
        state, matched = automaton.step(state, matched, np.array([t[end - 1] for t in texts]))
        first = automaton.first(state, matched)
        assert [w[end - 1] for w in walks] == first.tolist()
        for text, ending in zip(texts, first.tolist(), strict=True):
            found = []
            while ending:
                found.append(int(automaton.token[ending]))
                ending = int(automaton.above[ending])
            assert found == [tokens[text[k:end]] for k in range(end) if text[k:end] in tokens]


def test_a_byte_in_no_token_starts_anew():
    automaton = SuffixAutomaton({b"a": 0, b"ab": 1, b"b": 2})
    state = matched = np.zeros(1, np.int32)
    seen = []
    for byte in b"axab":
        state, matched = automaton.step(state, matched, np.array([byte]))
        seen.append(int(automaton.token[automaton.first(state, matched)[0]]))
    assert seen == [0, -1, 0, 1]
    with pytest.raises(ValueError, match="no token"):
        list(automaton.walk(b"ax"))


def test_words_in_step_and_alone():
    rng, coder = random.Random(4), bpe.bpe(PATH)
    words = ["".join(rng.choices("aeinrst é漢0", k=rng.randint(1, 200))).encode() for _ in range(300)]
    words += [words[0], b"a", b"aaaa" * 60]
    ids, bounds = coder.encode_words(words)
    alone = [coder.encode_long(w) for w in words]
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)] == alone
    joined, ends = coder._encode(words)
    assert [joined[a:b].tolist() for a, b in zip(ends, ends[1:], strict=False)] == alone
    assert [len(x) for x in coder._encode([b"x" * 500])] == [len(coder.encode_long(b"x" * 500)), 2]
    assert [x.tolist() for x in coder.encode_words([])] == [[], [0]]


def test_what_is_kept_may_be_emptied_at_any_time(monkeypatch):
    texts = ["one two <|endoftext|> three", "", "two three, four's <|endoftext|>", "one  two\n\n" * 50]
    coder = bpe.bpe(PATH)
    want = list(coder.encode_all(texts))
    for most, lot in ((3, 1 << 21), (400_000, 5), (1, 1)):
        monkeypatch.setattr(bpe, "_MOST", most)
        monkeypatch.setattr(bpe, "_LOT", lot)
        assert list(coder.encode_all(texts)) == want and len(list(bpe._digests(coder, texts))) == len(texts)


def test_character_four_grams(spark):
    texts = ["ab  abc", "", None, "x", "Äb9c-d", " lead", "trail ", "\n\n", "ab"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    want = Counter()
    for text in texts:
        word = []
        for c in f" {text or ''} ":
            low = c.lower()
            word.append(ord(low) - 96 if "a" <= low <= "z" else 27 if c.isalpha() else 0)
        padded = [k for s in word for k in ([0] * 3 if s == 0 else [s])]
        for k in range(len(padded) - 3):
            want[sum(s * 28 ** (3 - i) for i, s in enumerate(padded[k : k + 4]))] += 1
    want.pop(0, None)
    assert {r.gram: r.n for r in toxicity.char_counts(frame).collect()} == dict(want)
