"""Conversations: chat formatting and the prefix trie, against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from creditweave.llm import chat_format, prefix_trie
from creditweave.llm.chat_format import TEMPLATE, ChatTemplate, Role
from tests.plans import physical

TURNS = "conv_id long, turn long, role string, text string, segments string, path long, depth string, words int"
ODD = ["\\", "\\\\a", "</turn>", "</turn>\n", "### User: ", "\\### Assistant: </turn> ok", "</tu", "rn>", "a\\b\\", "### Role: x</role> y", "", "\n", "é🙂 漢", "\\g\\a"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def made_turns(seed=3, n=60):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        size = rng.choice([1, 2, 2, 3, 4, 7])
        for k in range(size):
            role = rng.choice(["user", "assistant"]) if rng.random() < 0.3 else ["user", "assistant"][k % 2]
            text = rng.choice(["hello there", "same  words\tagain", "x", *ODD])
            rows.append((c * 3 - 30, k, rng.choice([role, role, role, "system", "tool", None]) if rng.random() < 0.2 else role, None if rng.random() < 0.1 else text))
    rows += [(999, None, "user", "null turn"), (999, 1, "user", "same turn b"), (999, 1, "user", "same turn a"), (None, 0, "user", "no id"), (None, 1, None, None)]
    rows += [rows[0], rows[0], (1000, 5, "user", "long " * 50_000)]
    return rows


@pytest.fixture(scope="module")
def rows():
    return made_turns()


@pytest.fixture(scope="module")
def turns(spark, rows):
    return spark.createDataFrame([(*r, "s", 5, "d", 1) for r in rows], TURNS).repartition(6)


def conversations(rows):
    """Conversation to its turns, in order, as pairs of role and text."""
    by_id = {}
    for c, turn, role, text in rows:
        by_id.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [r[2:] for r in sorted(said)] for c, said in by_id.items()}


def test_formatted_and_read_back(turns, rows):
    want = conversations(rows)
    done = chat_format.format_chats(turns)
    got = {r.conv_id: r for r in done.withColumns({"read": chat_format.read_turns(F.col("formatted")), "under": chat_format.read_loss(F.col("segments"))}).collect()}
    assert set(got) == set(want)
    for c, said in want.items():
        row = got[c]
        assert [(t.role, t.text) for t in row["read"]] == said
        assert row.under == "".join(text for role, text in said if role == "assistant")
        assert "".join(s.text for s in row.segments) == row.formatted
        assert row.formatted.count("</turn>") == len(said)
        headers = [TEMPLATE.other, *[r.header for r in TEMPLATE.roles]]
        assert sum(row.formatted.count(h) for h in headers) == len(said)
    for r in chat_format.digests(done).collect():
        said = want[r.conv_id]
        assert (r.n_turns, r.turns_sha256) == (len(said), sha("".join(f"{role}\n{text}\n" for role, text in said)))
        loss = "".join(text for role, text in said if role == "assistant")
        assert (r.loss_chars, r.loss_sha256, r.formatted_chars) == (len(loss), sha(loss), len(got[r.conv_id].formatted))


def test_plain_conversation_as_written(spark):
    said = spark.createDataFrame([(1, 0, "system", "be <kind>"), (1, 1, "user", "a\\b"), (1, 2, "assistant", "</turn>")], "conv_id long, turn int, role string, text string")
    row = chat_format.format_chats(said).first()
    assert row.formatted == "### System: be <kind></turn>\n### User: a\\ab</turn>\n### Assistant: \\g</turn>\n"
    assert [s.loss for s in row.segments] == [False] * 7 + [True, False] and row.error is None


@pytest.mark.parametrize(
    ("roles", "error"),
    [
        (["user", "assistant"], None), (["system", "user", "assistant", "user", "assistant"], None),
        (["assistant"], "turn 1: assistant after start"), (["user", "user", "assistant"], "turn 2: user after user"),
        (["user", "assistant", "system"], "turn 3: system after assistant"), (["user", "assistant", "user"], "ends after user"),
        (["user", "tool", "assistant"], "turn 2: tool after user"), (["", "user", "assistant"], "turn 1:  after start"), (["user", "", "user", "assistant"], "turn 2:  after user"),
    ],
)
def test_turn_order(spark, roles, error):
    said = spark.createDataFrame([(1, k, r, "x") for k, r in enumerate(roles)], "conv_id long, turn int, role string, text string")
    assert chat_format.format_chats(said).first().error == error


def test_template_of_ones_own(spark):
    template = ChatTemplate((Role("user", "<|u|>", ("",)), Role("tool", "<|t|>", ("user", "tool"), loss=True)), ("tool",), "<|o|>", "<|:|>", "<|e|>", gap="", escape="^")
    said = spark.createDataFrame([(1, 0, "user", "^<|u|><|"), (1, 1, "tool", "<|e|>|>"), (1, 2, "tool", "<|o|>^"), (1, 3, "bot", "<|:|>")], "conv_id long, turn int, role string, text string")
    done = chat_format.format_chats(said, template)
    row = done.select("error", chat_format.read_turns(F.col("formatted"), template).alias("read"), chat_format.read_loss(F.col("segments"), template).alias("loss")).first()
    assert [(t.role, t.text) for t in row["read"]] == [("user", "^<|u|><|"), ("tool", "<|e|>|>"), ("tool", "<|o|>^"), ("bot", "<|:|>")]
    assert row.loss == "<|e|>|><|o|>^" and row.error == "turn 4: bot after tool"


def test_templates_that_could_not_be_read_back():
    user = (Role("user", "<u>", ("",)),)
    for other, end, close in (("<o>", "</o>", "a<"), ("<o>", "</o>", "<u>"), ("x<o>x", "<o>", "</t>"), ("<\\>", "</o>", "</t>"), ("", "</o>", "</t>")):
        with pytest.raises(ValueError, match="control string"):
            ChatTemplate(user, ("user",), other, end, close)


def test_format_is_native_and_takes_an_empty_table(spark, turns):
    done = chat_format.digests(chat_format.format_chats(turns))
    plan = physical(done)
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange hashpartitioning") == 1
    assert chat_format.digests(chat_format.format_chats(turns.limit(0))).count() == 0


def brute_trie(by_id):
    """All nodes of the trie of conversation id to sequence, each as a row of the result."""
    members = {}
    for c, said in by_id.items():
        for d in range(len(said) + 1):
            members.setdefault(tuple(said[:d]), []).append(c)
    rows = []
    for path, ids in members.items():
        below = [p for p in members if p[: len(path)] == path]
        children = {p[: len(path) + 1] for p in below if len(p) > len(path)}
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below)]
        saved = sum((len(members[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) for p in below if p)
        ends = sha(",".join(map(str, sorted(c for c in ids if len(by_id[c]) == len(path)))))
        rows.append((min(ids), len(path), min(members[path[:-1]]) if path else None, len(ids), len(children), len(leaves), saved, ends))
    return sorted(rows, key=repr)


def found(trie):
    columns = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted((tuple(r[c] for c in columns) for r in trie.collect()), key=repr)


def test_trie(turns, rows):
    by_id = {c: said for c, said in conversations(rows).items() if c is not None}
    ordered = prefix_trie.ordered_turns(turns)
    assert found(prefix_trie.prefix_trie(prefix_trie.rooted(ordered))) == brute_trie(by_id)


def test_trie_of_rebuilt_conversations(turns, rows):
    by_id = {c: said for c, said in conversations(rows).items() if c is not None}
    whole = {}
    for c, said in by_id.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        whole[c] = by_id.get(base, [])[:h] + said[h:]
    assert any(not said for said in whole.values())
    assert found(prefix_trie.prefix_trie(prefix_trie.rebuilt(turns))) == brute_trie(whole)


def test_trie_of_nothing(turns):
    assert prefix_trie.prefix_trie(prefix_trie.rebuilt(turns.limit(0))).count() == 0


@pytest.mark.parametrize(("conversations_", "rows_"), [(4096, 1 << 18), (3, 1 << 18), (1, 5), (7, 1), (2, 4)])
def test_shards_of_any_size_agree(monkeypatch, conversations_, rows_):
    """Shards that end between conversations or in the middle of one give the same nodes."""
    monkeypatch.setattr(prefix_trie, "SHARD_CONVERSATIONS", conversations_)
    monkeypatch.setattr(prefix_trie, "SHARD_ROWS", rows_)
    rng = random.Random(8)
    by_id, flat = {}, []
    for c in sorted(rng.sample(range(-50, 1000), 40)):
        by_id[c] = [rng.randrange(2) for _ in range(rng.randrange(8))]
        at = at2 = 0
        flat.append((c, 0, 0, 0, 0, 0, 0, not by_id[c]))
        for d, turn in enumerate(by_id[c], 1):
            gain, gain2 = hash((d, turn)), hash((turn, d, 1))
            flat.append((c, d, at ^ gain, at2 ^ gain2, at, at2, turn + 1, d == len(by_id[c])))
            at, at2 = at ^ gain, at2 ^ gain2
    names = list(prefix_trie._PATH)
    batches = [pa.RecordBatch.from_arrays([pa.array([r[k] for r in flat[n : n + 11]]) for k in range(8)], names) for n in range(0, len(flat), 11)]
    nodes = {}
    for batch in prefix_trie._node_parts(iter(batches)):
        for r in batch.to_pylist():
            node = nodes.setdefault((r["depth"], r["path"], r["path2"]), [r["words"], 0, r["conv_id"], []])
            node[1] += r["n_convs"]
            node[2] = min(node[2], r["conv_id"])
            node[3] += np.frombuffer(r["ends"] or b"", np.int64).tolist()
            assert r["ends"] is None or r["first_end"] == np.frombuffer(r["ends"], np.int64)[0]
    want = {}
    for c, said in by_id.items():
        for d in range(len(said) + 1):
            node = want.setdefault(tuple(said[:d]), [0, c, []])
            node[0] += 1
            node[2] += [c] * (d == len(said))
    assert sorted((n, c, ends) for _, n, c, ends in nodes.values()) == sorted((n, c, ends) for n, c, ends in want.values())


def test_end_digests_over_many_lists():
    lists = [((1, 2, 3), [5, 7]), ((1, 2, 3), [9]), ((1, 2, 4), [-3]), ((2, 0, 0), [1]), ((2, 0, 0), [2]), ((2, 0, 0), [30])]
    batches = [pa.RecordBatch.from_pylist([{"depth": n[0], "path": n[1], "path2": n[2], "ends": np.array(ids, np.int64).tobytes()} for n, ids in lists[k : k + 2]]) for k in (0, 2, 4)]
    got = {(r["depth"], r["path"], r["path2"]): r["ends_sha256"] for b in prefix_trie._end_digests(iter(batches)) for r in b.to_pylist()}
    assert got == {(1, 2, 3): sha("5,7,9"), (1, 2, 4): sha("-3"), (2, 0, 0): sha("1,2,30")}
