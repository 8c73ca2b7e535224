"""Near duplicates, repeated strings, leaks and top-k search against brute force."""

from __future__ import annotations

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditweave.llm import decontaminate, graph, jaccard, suffix_dedup, topk

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", (text or "").translate(_LOWER)) if w]
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def brute_components(sets):
    """Smallest name reachable by links, for a dict of name to set."""
    label = {k: k for k in sets}
    changed = True
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def test_near_duplicates(docs, corpus):
    sets = {i: shingles(t) for i, t in corpus if i is not None}
    # A null id takes part under a name of its own, larger here than all ids so that it names no component.
    want = brute_components(sets | {10_000 + k: shingles(t) for k, (i, t) in enumerate(corpus) if i is None})
    got = jaccard.near_duplicates(docs).collect()
    assert len(got) == len(corpus)
    for row in got:
        if row.doc_id is not None:
            assert (row.n_shingles, row.component_id) == (len(sets[row.doc_id]), want[row.doc_id])
    by_null = sorted((r.component_id or 0) for r in got if r.doc_id is None)
    assert by_null == sorted(0 if want[10_000 + k] >= 10_000 else want[10_000 + k] for k, (i, _) in enumerate(corpus) if i is None)


def test_near_duplicate_chains_over_groups(spark, monkeypatch):
    """More near copies than a group takes, in a chain whose ends share less than 0.8."""
    rng = random.Random(4)
    words = [f"w{k}" for k in range(120)]
    rows = []
    for k in range(200):
        rows.append((k, " ".join(words)))
        words[rng.randrange(120)] = f"n{k}"
    rows += [(1000 + k, " ".join(f"u{k}x{j}" for j in range(50)) + " " + " ".join(f"c{j}" for j in range(12))) for k in range(40)]
    got = {r.doc_id: r.component_id for r in jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_components({i: shingles(t) for i, t in rows})


def test_a_passage_of_many_documents_is_met_few_times(spark, monkeypatch):
    """Documents that share half of their text ask each other by few of its shingles, and links across groups are found."""
    rng = random.Random(8)
    passage = [f"p{k}" for k in range(60)]
    rows = [(k, " ".join([*passage, *(f"own{k}x{j}" for j in range(60))])) for k in range(60)]
    for k in range(20):
        words = rows[k][1].split()
        words[rng.randrange(10)] = f"n{k}"
        rows.append((1000 + k, " ".join(words)))
    tables, real = {}, jaccard.written
    monkeypatch.setattr(jaccard, "FREQUENT", 2.0)  # nothing is frequent, as in a small part of a large input
    monkeypatch.setattr(jaccard, "GROUP", 2)
    monkeypatch.setattr(jaccard, "written", lambda spark, frame, label: tables.setdefault(label, real(spark, frame, label)))
    got = {r.doc_id: r.component_id for r in jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_components({i: shingles(t) for i, t in rows}) and got[1003] == 3
    assert 0 < tables["token-matrix"].count() < tables["placed-tokens"].count() / 3


def test_large_groups_ask_each_other_once(spark, monkeypatch):
    """Many texts that are alike but mostly not linked: a row for two groups, not for every member and token of them."""
    rng = random.Random(9)
    passage = [f"p{k}" for k in range(100)]
    rows = [(k, " ".join([*passage, *(f"own{k}x{j}" for j in range(20))])) for k in range(64)]
    for k in range(16):
        words = rows[k][1].split()
        words[rng.randrange(100)] = f"n{k}"
        rows.append((1000 + k, " ".join(words)))
    tables, real = {}, jaccard.written
    monkeypatch.setattr(jaccard, "FREQUENT", 2.0)  # nothing is frequent, as in a small part of a large input
    monkeypatch.setattr(jaccard, "GROUP", 8)
    monkeypatch.setattr(jaccard, "written", lambda spark, frame, label: tables.setdefault(label, real(spark, frame, label)))
    got = {r.doc_id: r.component_id for r in jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_components({i: shingles(t) for i, t in rows}) and got[1003] == 3
    groups, matrix = tables["token-groups"].count(), tables["token-matrix"]
    assert 0 < tables["asked"].count() <= groups * (groups - 1) / 2
    assert 0 < matrix.count() == matrix.select("name", "group").distinct().count()


def test_ids_shared_by_texts_are_one_document(spark):
    rows = [(1, "a b c d e f"), (1, "p q r s t u"), (2, "a b c d e f"), (3, "p q r s t u"), (4, "z z z z z z")]
    got = {(r.doc_id, r.component_id) for r in jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (4, 4)}


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(5, 2), (2, 9), (7, 8)], [(k, k + 1) for k in range(60)], [(0, k) for k in range(50)]])
@pytest.mark.parametrize("limit", [500_000, 0], ids=["one-task", "stars"])
def test_components(spark, edges, limit, monkeypatch):
    monkeypatch.setattr(graph, "ONE_TASK_EDGES", limit)
    nodes = {n for e in edges for n in e}
    label = {n: n for n in nodes}
    for _ in nodes:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = graph.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.label for r in got} == label and len(got) == len(nodes)


def brute_dedup(rows):
    """Result of each (id, text), judged in order of the ids."""
    seen, out = set(), {}
    for i, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - 99):
            window = data[s : s + 100]
            if window in seen:
                gone[s : s + 100] = b"\x01" * 100
            seen.add(window)
        kept = bytes(c for c, g in zip(data, gone, strict=True) if not g)
        out[i] = (len(data), sum(gone), len(re.findall(b"\x01+", gone)), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("shard", [16_384, 4], ids=["sorted", "by-window"])
def test_suffix_dedup(docs, corpus, shard, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SHARD", shard)
    nulls = sorted((t for i, t in corpus if i is None), key=lambda t: -len(t))
    got = suffix_dedup.deduplicated(docs).collect()
    assert len(got) == len(corpus)
    # Null ids come first, in an order made from their texts: one of the two orders holds.
    results = []
    for order in (nulls, nulls[::-1]):
        want = brute_dedup([(f"null {t}", t) for t in order] + sorted({(i, t) for i, t in corpus if i is not None}, key=lambda r: r[0]))
        results.append(all(want[f"null {r.text}" if r.doc_id is None else r.doc_id] == (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got))
    assert any(results)
    assert all(len(r.kept.encode()) <= r.n_bytes - r.n_removed and r.lang == "en" for r in got)


@pytest.mark.parametrize("shard", [16_384, 4], ids=["sorted", "by-window"])
@pytest.mark.parametrize("tasks", [1, 4])
def test_suffix_dedup_of_repeated_rows(spark, shard, tasks, monkeypatch):
    """Rows that repeat id and text, of which no other id holds a part, keep what one of them keeps."""
    monkeypatch.setattr(suffix_dedup, "SHARD", shard)
    rng = random.Random(8)
    words = ["".join(rng.choices("abdeinorst", k=6)) for _ in range(400)]
    alone, inside, without, shared = (" ".join(rng.choices(words, k=60)) for _ in range(4))
    rows = [(1, alone), (2, f"{inside} and {inside}"), (None, without), (3, f"x {shared}"), (4, f"y {shared} z")]
    rows += [(10 + k, f"{k} {shared[:300]} {k * 7} {inside}") for k in range(6)]
    want = brute_dedup(sorted(rows, key=lambda r: (r[0] is not None, r[0])))
    many = [r for r in rows for _ in range(5)]
    frame = spark.createDataFrame(many, "doc_id long, text string").repartition(tasks)
    got = suffix_dedup.deduplicated(frame).collect()
    assert len(got) == len(many)
    assert {(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == {(i, *v) for i, v in want.items()}
    assert want[1][1] == want[None][1] == 0 and want[2][1] == len(inside)


def test_suffix_dedup_across_blocks(monkeypatch):
    rng = np.random.default_rng(2)
    data = rng.integers(97, 107, 9000).astype(np.uint8)
    whole = suffix_dedup.anchors(data)
    monkeypatch.setattr(suffix_dedup, "_BLOCK", 1000)
    assert all((a == b).all() for a, b in zip(whole, suffix_dedup.anchors(data), strict=True))
    gaps = np.diff(whole[0])
    assert gaps.max() <= 100 - 32 + 1  # so every 100-byte string holds an anchor


@pytest.mark.parametrize("limit", [64 << 20, 0], ids=["broadcast", "shuffled"])
def test_leaks(spark, limit, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", limit)
    rng = random.Random(5)
    vocabulary = [f"v{k}" for k in range(3000)]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.choice([8, 10, 12, 13, 20, 40])))) for k in range(12)] + [(12, None), (13, "")]
    rows = []
    for k in range(60):
        text = rng.choices(vocabulary, k=rng.randint(0, 60))
        if k % 2:
            passage = items[rng.randrange(12)][1].split()
            passage = passage[rng.randint(0, 3) :]
            for _ in range(k % 4):
                passage[rng.randrange(len(passage))] = "other"
            text[len(text) // 2 :] = [w.upper() for w in passage]
        rows.append((k, " \n".join(text)))
    rows += [(None, items[5][1]), (90, None), (91, ""), rows[1]]
    docs = spark.createDataFrame([(i, t, "w", 1) for i, t in rows], "doc_id long, text string, words string, seed int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = {r[:2] for r in ruled_leaks(rows, items)}
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, bench).collect()}
    assert got == want and len(want) > 10
    bad = {i for i, _ in want}
    clean = decontaminate.without_leaks(docs, bench)
    assert clean.columns == docs.columns
    assert sorted(map(str, (r.doc_id for r in clean.collect()))) == sorted(str(i) for i, _ in rows if i not in bad)


def ruled_leaks(rows, items):
    """Leaks by the rule alone, every alignment looked at: ``doc_id, item_id, best_window, matched_words``."""
    out = {}
    for i, text in rows:
        d = (text or "").lower().split()
        for item, passage in items:
            q = (passage or "").lower().split()
            if not q:  # nothing that could be leaked
                continue
            width = min(13, len(q))
            needed = 11 if len(q) >= 13 else -(-len(q) * 8 // 10)
            for off in range(-len(q) + 1, len(d)):
                equal = [0 <= off + k < len(d) and d[off + k] == w for k, w in enumerate(q)]
                best = max(sum(equal[s : s + width]) for s in range(len(q) - width + 1))
                if best >= needed:
                    was = out.get((i, item), (0, 0))
                    out[i, item] = max(best, was[0]), max(sum(equal), was[1])
    return {(*k, *v) for k, v in out.items()}


@pytest.mark.parametrize("limit", [64 << 20, 0], ids=["broadcast", "shuffled"])
def test_leaks_of_long_items(spark, limit, monkeypatch):
    """Items of thousands of words: their words are in the item table once, not in every seed."""
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", limit)
    rng = random.Random(12)
    items = [(k, " ".join(f"w{rng.randrange(10**6)}" for _ in range(5000))) for k in range(3)]
    passage = items[1][1].split()[3000:3040]
    passage[5] = passage[20] = "other"
    rows = [(1, "a b " + " ".join(passage)), (2, items[2][1]), (3, "c d e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("_id", "_hash", "text_hash", "item", "given")})
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.best_window, r.matched_words) for r in decontaminate.leaks(docs, bench).collect()}
    assert got == {(1, 1, 13, 38), (2, 2, 13, 5000)}
    clean = decontaminate.without_leaks(docs, bench)
    assert clean.columns == docs.columns and [r.doc_id for r in clean.collect()] == [3]


def regular_words(n):
    """Two words of ``2 ** n`` letters that polynomial sums modulo ``2 ** 64`` do not tell apart."""
    first = "a"
    for _ in range(n):
        first += first.translate(str.maketrans("ab", "ba"))
    return first, first.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [5, 7, 8, 10, 12])
def test_regular_long_words_are_told_apart(spark, n):
    one, other = regular_words(n)
    rows = [(1, f"p q r s {one}"), (2, f"p q r s {other}"), (3, f"P q r s {one.upper()}")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (1, 1), 2: (1, 2), 3: (1, 1)}


def test_columns_of_any_name_stay(spark):
    names = ["key", "tag", "spans", "kept", "n_removed", "row", "given", "a.b"]
    long = "once upon a time " * 20
    docs = spark.createDataFrame([(1, long, *names), (2, None, *names)], ", ".join(["doc_id long", "text string", *[f"`{n}` string" for n in names]]))
    got = suffix_dedup.deduplicated(docs)
    assert got.columns == ["doc_id", "text", "key", "tag", "spans", "row", "given", "a.b", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    row = got.filter("doc_id = 1").first()
    assert (row.key, row.tag, row.spans, row["a.b"]) == ("key", "tag", "spans", "a.b") and row.n_bytes == len(long)


def test_seeds_hit_every_alignment_of_the_rule():
    for size in range(1, 14):
        shapes, missing = decontaminate.shapes_of(size), 2 if size >= 10 else 1 if size >= 5 else 0
        for out in itertools.combinations(range(size), missing):
            assert any(not {at + k for k in shape} & set(out) for shape in shapes for at in range(size - shape[-1]))


@pytest.mark.parametrize("limit", [64 << 20, 0], ids=["broadcast", "shuffled"])
def test_leaks_by_the_rule_alone(spark, limit, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", limit)
    rng = random.Random(6)
    vocabulary = [f"v{k}" for k in range(2000)]
    items = [(k, " ".join(rng.choices(vocabulary, k=n))) for k, n in enumerate([*range(1, 14), 16, 20, 45])]
    rows = []
    for item, passage in items:
        for changed in range(5):
            for _ in range(3):
                words = passage.split()
                for at in rng.sample(range(len(words)), min(changed, len(words))):
                    words[at] = "other"
                cut = words[rng.choice([0, 0, 1, 2]) :]
                rows.append((len(rows), " ".join(rng.choices(vocabulary, k=rng.choice([0, 0, 7])) + cut)))
    fifth = ["other" if k % 5 == 2 else w for k, w in enumerate(items[-1][1].split())]
    rows.append((len(rows), " ".join(fifth)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = ruled_leaks(rows, items)
    got = {(r.doc_id, r.item_id, r.best_window, r.matched_words) for r in decontaminate.leaks(docs, bench).collect()}
    assert got == want and {r[1] for r in want} == {i for i, _ in items}


@pytest.mark.parametrize("limit", [64 << 20, 0], ids=["broadcast", "shuffled"])
def test_leaks_of_items_without_an_id_of_their_own(spark, limit, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", limit)
    rng = random.Random(9)
    passages = [" ".join(rng.choices([f"v{k}" for k in range(500)], k=20)) for _ in range(4)]
    # Items that share an id begin with the same words, so both are hit along one alignment; one is leaked.
    ends = [" ".join(p.split()[:8]) + " " + " ".join(f"u{k}x{j}" for j in range(12)) for k, p in enumerate(passages)]
    items = [(None, passages[0]), (None, ends[0]), (7, passages[1]), (7, ends[1]), (8, ends[2]), (8, passages[2]), (None, passages[3])]
    docs = spark.createDataFrame([*enumerate(passages), (None, passages[0])], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.leaks(docs, bench).collect()
    want = {(0, None), (None, None), (1, 7), (2, 8), (3, None)}
    assert len(got) == len(want) and {(r.doc_id, r.item_id) for r in got} == want
    assert {(r.best_window, r.matched_words) for r in got} == {(13, 20)}


def test_leaks_stay_in_the_jvm(docs, spark):
    bench = spark.createDataFrame([(1, "a b c d e f g h i j k l m n")], "item_id long, text string")
    plan = decontaminate.leaks(docs, bench)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("blocks", [(8192, 1024), (7, 3)])
def test_top_k(spark, blocks, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", blocks[0])
    monkeypatch.setattr(topk, "BLOCK_QUERIES", blocks[1])
    rng = np.random.default_rng(3)
    vectors = [(k, [float(np.float32(x)) for x in rng.normal(0, 0.2, 16)]) for k in range(150)]
    vectors += [(200 + k, vectors[10][1]) for k in range(40)] + [(40, vectors[11][1])]
    odd = [(300, None), (301, [0.1, None] * 8), (302, [float("nan")] * 16), (303, [float("inf")] * 16), (None, vectors[0][1]), (304, [1.0, 2.0]), (305, [])]
    frame = spark.createDataFrame([(i, v, "x", 3) for i, v in vectors + odd], "vec_id long, embedding array<float>, uid string, rank int").repartition(3)
    got = topk.top_k(frame, F.col("vec_id") % 20 == 0, k=20).collect()
    x = np.floor(64 * np.array([v for _, v in vectors])).astype(int)
    want = []
    for k, (i, _) in enumerate(vectors):
        if i % 20 == 0:
            scored = sorted((-int(x[j] @ x[k]), other) for j, (other, _) in enumerate(vectors) if j != k)[:20]
            want += [(i, n + 1, other, -s) for n, (s, other) in enumerate(scored)]
    assert sorted(map(tuple, got)) == sorted(want)


def test_empty_tables(spark, none):
    assert jaccard.near_duplicates(none).collect() == []
    assert suffix_dedup.deduplicated(none).collect() == []
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.leaks(none, bench).collect() == []
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0).collect() == []
