"""Prefix trie of conversations by vertical bitmaps.

A shard is a run of conversations in the order of their ids. For each (position, turn) it holds a bitset
of the conversations that have this turn there. Depth-first, the bitset of a node is intersected with the
postings of the next position: what is left are its children, the popcount their number of conversations,
and the conversations whose last position is the node's are its end list. The same node comes out of many
shards; the shards' parts are merged by the name of the path.

A path is named by two 64-bit exclusive-ors over its turns, each turn mixed with its position: the name of
a child follows from its parent's, and a shard can begin in the middle of a long conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditweave.llm.common import written

#: A shard takes so many conversations and rows at most; a longer conversation goes on in the next one.
SHARD_CONVERSATIONS, SHARD_ROWS = 4096, 1 << 18

_PATH = ("conv_id", "depth", "path", "path2", "before", "before2", "words", "last")
_PART = "depth long, path long, path2 long, before long, before2 long, words long, n_convs long, conv_id long, first_end long, ends binary"
_NODE = ["depth", "path", "path2"]


def turn_keys(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, key, key2, words``: turns by 120 bits of the SHA-256 of role and text, without the text.

    A null role or text is the empty one. ``words`` counts ``[^\\x20\\x09-\\x0D]+`` in the text.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    sha = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    half = lambda at: F.conv(F.substring(sha, at, 15), 16, 10).cast("long")
    return turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), half(1).alias("key"), half(16).alias("key2"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    )


def paths(turns: DataFrame) -> DataFrame:
    """Rows ``conv_id, position, key, key2, words`` as rows of paths, each with the name of the path before it.

    Depths count a conversation's rows by ``position`` from 0; its first row, with nulls, is the root.
    """
    by_conv = Window.partitionBy("conv_id").orderBy("position")
    rows = turns.withColumn("depth", F.row_number().over(by_conv).cast("long") - 1)
    mixed = {"mix": F.xxhash64("depth", "key", "key2"), "mix2": F.xxhash64("key2", "depth", "key", F.lit("second"))}
    rows = rows.withColumns({name: F.when(F.col("depth") == 0, F.lit(0).cast("long")).otherwise(value) for name, value in mixed.items()})
    up_to = by_conv.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns({"path": F.bit_xor("mix").over(up_to), "path2": F.bit_xor("mix2").over(up_to), "last": F.lead("depth").over(by_conv).isNull()})
    before = [F.col(path).bitwiseXOR(F.col(mix)).alias(name) for path, mix, name in (("path", "mix", "before"), ("path2", "mix2", "before2"))]
    return rows.select("conv_id", *_NODE, *before, F.coalesce("words", F.lit(0).cast("long")).alias("words"), "last")


def _bits(bitset: int) -> Iterator[int]:
    while bitset:
        low = bitset & -bitset
        yield low.bit_length() - 1
        bitset ^= low


def shard_nodes(rows: np.ndarray) -> Iterator[tuple]:
    """The nodes of one shard as rows of ``_PART``, depth-first.

    ``rows`` (columns of ``_PATH``) are sorted by conversation and depth. Where a conversation begins below
    the root, its row names the path before it; conversations that enter by the same one share a bitset.
    """
    ids, conv = np.unique(rows[:, 0], return_inverse=True)
    ids, conv = ids.tolist(), conv.tolist()
    postings: dict[tuple[int, int, int], int] = {}
    ends: dict[int, int] = {}
    turn: dict[tuple[int, int], tuple] = {}
    entered: dict[tuple[int, int, int], int] = {}
    seen = -1
    for c, (_, depth, path, path2, before, before2, words, last) in zip(conv, rows.tolist(), strict=True):
        # The turn itself: what the path gains at this position.
        gain, gain2, bit = path ^ before, path2 ^ before2, 1 << c
        at = (depth, gain, gain2)
        postings[at] = postings.get(at, 0) | bit
        turn[c, depth] = (gain, gain2, words)
        if last:
            ends[depth] = ends.get(depth, 0) | bit
        if c != seen:
            start = (depth, before, before2)
            entered[start] = entered.get(start, 0) | bit
            seen = c

    stack = [(depth - 1, path, path2, bitset) for (depth, path, path2), bitset in entered.items()]
    while stack:
        above, before, before2, open_set = stack.pop()
        depth = above + 1
        # Members that have a turn here: each turn found takes all that share it out of the set.
        while open_set:
            c = (open_set & -open_set).bit_length() - 1
            here = turn.get((c, depth))
            if here is None:
                open_set &= open_set - 1
                continue
            gain, gain2, words = here
            child = open_set & postings[depth, gain, gain2]
            open_set ^= child
            ended = child & ends.get(depth, 0)
            path, path2 = before ^ gain, before2 ^ gain2
            ending = [ids[k] for k in _bits(ended)]
            first_end, listed = (ending[0], np.array(ending, np.int64).tobytes()) if ending else (None, None)
            yield depth, path, path2, before, before2, words, child.bit_count(), ids[c], first_end, listed
            if child != ended:
                stack.append((depth, path, path2, child ^ ended))


def _node_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cuts a sorted partition into shards and lists their nodes."""
    schema = pa.schema([(n, pa.binary() if t == "binary" else pa.int64()) for n, t in (c.split() for c in _PART.split(", "))])

    def listed(rows: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*shard_nodes(rows), strict=True), schema, strict=True)], schema=schema)

    held: list[np.ndarray] = []
    n_rows, n_convs, last_conv = 0, 0, None
    for batch in batches:
        rows = np.column_stack([c.cast(pa.int64()).to_numpy(zero_copy_only=False) for c in batch.columns])
        while len(rows):
            # Rows up to the place where the shard has its number of conversations or of rows.
            new = np.flatnonzero(np.diff(rows[:, 0], prepend=rows[0, 0] if last_conv is None else last_conv))
            if last_conv is None:
                new = np.concatenate([[0], new])
            room = SHARD_CONVERSATIONS - n_convs
            cut = min(int(new[room]) if len(new) > room else len(rows), SHARD_ROWS - n_rows, len(rows))
            if cut:
                held.append(rows[:cut])
                n_rows, n_convs, last_conv = n_rows + cut, n_convs + int((new < cut).sum()), rows[cut - 1, 0]
            if cut < len(rows) or n_rows == SHARD_ROWS:
                yield listed(np.concatenate(held))
                held, n_rows, n_convs, last_conv = [], 0, 0, None
            rows = rows[cut:]
    if held:
        yield listed(np.concatenate(held))


def _end_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's ids in decimal, from lists that come in order; no list is held whole."""
    names, digests, at, digest = [], [], None, None

    def flush() -> pa.RecordBatch:
        columns = [pa.array(list(c), pa.int64()) for c in zip(*names, strict=True)] if names else [pa.array([], pa.int64())] * 3
        return pa.RecordBatch.from_arrays([*columns, pa.array(digests, pa.string())], [*_NODE, "ends_sha256"])

    for batch in batches:
        *keys, lists = (c.to_pylist() for c in (batch.column(n) for n in (*_NODE, "ends")))
        for *name, ends in zip(*keys, lists, strict=True):
            text = ",".join(map(str, np.frombuffer(ends, np.int64).tolist())).encode()
            if name == at:
                digest.update(b"," + text)
                continue
            if at is not None:
                names.append(at)
                digests.append(digest.hexdigest())
            at, digest = name, hashlib.sha256(text)
        yield flush()
        names, digests = [], []
    if at is not None:
        names.append(at)
        digests.append(digest.hexdigest())
    yield flush()


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row for each node of the trie of ``turns`` (``conv_id, position, key, key2, words``).

    ``conv_id`` (the smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens`` and ``ends_sha256``; the last is over the members that end at the node.
    ``position`` orders the rows of a conversation without ties; its first row, with null ``position`` and
    ``key``, stands for the root and is there once (see :func:`rooted`). An empty table has no root and
    gives no rows; other columns are left out.
    """
    spark = turns.sparkSession
    rows = written(spark, paths(turns), "trie-paths")
    spread = rows.repartitionByRange("conv_id", "depth").sortWithinPartitions("conv_id", "depth")
    parts = written(spark, spread.select(*_PATH).mapInArrow(_node_parts, _PART), "trie-parts")

    nodes = parts.groupBy(*_NODE).agg(
        F.min("before").alias("before"), F.min("before2").alias("before2"), F.min("words").alias("words"),
        F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"),
    )
    above = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("before").alias("path"), F.col("before2").alias("path2"))
    nodes = nodes.join(above.agg(F.count("*").alias("n_children")), _NODE, "left").fillna(0, ["n_children"])
    nodes = written(spark, nodes, "trie-nodes")

    # A node's smallest member owns it. Its owner's path leads through all nodes above, so each of them
    # gets from a path what the path's conversation owns from there downward.
    owned = nodes.select("conv_id", "depth", (F.col("n_children") == 0).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    downward = Window.partitionBy("conv_id").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    shares = rows.select("conv_id", *_NODE).join(owned, ["conv_id", "depth"], "left").fillna(0, ["leaf", "saved"])
    shares = shares.select(*_NODE, F.sum("leaf").over(downward).alias("leaf"), F.sum("saved").over(downward).alias("saved"))
    sums = shares.groupBy(*_NODE).agg(F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))

    # Lists of one node follow each other by their first id; a node's lists all come to one task, piece by piece.
    ends = parts.filter("first_end is not null").repartition(*_NODE).sortWithinPartitions(*_NODE, "first_end")
    digests = ends.select(*_NODE, "ends").mapInArrow(_end_digests, "depth long, path long, path2 long, ends_sha256 string")

    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("path").alias("before"), F.col("path2").alias("before2"), F.col("conv_id").alias("parent_conv_id"))
    found = nodes.join(sums, _NODE).join(digests, _NODE, "left").join(parents, ["depth", "before", "before2"], "left")
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


def ordered_turns(turns: DataFrame) -> DataFrame:
    """``turn_keys`` with ``at``, the place of a turn in its conversation from 1; rows without a ``conv_id`` are left out.

    Turns are ordered by ``turn`` (null first), then role, then key; repeated rows stay.
    """
    by_turn = Window.partitionBy("conv_id").orderBy("turn", "role", "key", "key2")
    keys = turn_keys(turns).filter("conv_id is not null")
    return keys.select("conv_id", F.row_number().over(by_turn).cast("long").alias("at"), "key", "key2", "words")


def _rows(turns: DataFrame, part: int) -> DataFrame:
    position = F.struct(F.lit(part).alias("part"), "at").alias("position")
    return turns.select("conv_id", position, "key", "key2", "words")


def rooted(ordered: DataFrame, *rows: DataFrame) -> DataFrame:
    """Rows for :func:`prefix_trie`: a root for each conversation of :func:`ordered_turns`, and ``rows`` (by default its own turns)."""
    null = F.lit(None)
    roots = ordered.filter("at = 1").select("conv_id", *[null.alias(c) for c in ("position", "key", "key2", "words")])
    for more in rows or (_rows(ordered, 1),):
        roots = roots.unionByName(more)
    return roots


def rebuilt(turns: DataFrame, group: int = 20, longest: int = 4) -> DataFrame:
    """Conversations with the beginning of another one, as rows for :func:`prefix_trie`.

    Conversation ``c`` gets the first ``h`` turns of ``c - c % group`` in place of its own first ``h``, where
    ``h = crc32(c as text) % longest``; all of them where that one has fewer, none where it does not exist.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % longest
    own = written(turns.sparkSession, ordered_turns(turns), "trie-turns")
    heads = own.filter((F.col("conv_id") % group == 0) & (F.col("at") < longest)).withColumnRenamed("conv_id", "base")
    named = own.filter("at = 1").select("conv_id", (F.col("conv_id") - F.col("conv_id") % group).alias("base"))
    lent = named.join(heads, "base").filter(F.col("at") <= h)
    return rooted(own, _rows(lent, 0), _rows(own.filter(F.col("at") > h), 1))
