"""Near-duplicate join on word shingles by a token-group matrix.

Equal shingle sets are one node, named by a 64-bit hash of the set. A global token order (rare first, tokens in many documents last) gives
every set a prefix of which any partner's prefix holds a tenth of the set, so nodes whose prefixes meet
others in fewer tokens are done.
The others are partitioned into small groups of similar sets; each group stores its members' tokens and
their union. Links inside a group are counted from its token matrix. Two groups meet only where enough
prefix tokens of their members meet and they are not connected yet: the overlap of a member's tokens with
the other group's union bounds every overlap inside, and only groups that the bound lets qualify are opened.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditweave.llm.common import Memo, free_memory, written
from creditweave.llm.graph import components
from creditweave.llm.shingles import batch_words, mix, shingle_set

#: Members of a group at most.
GROUP = 64
#: A token is frequent in a part of the input when this share of its documents hold it.
FREQUENT = 0.0005
_NULL_KEY = -(1 << 62)


def doc_key(doc_id: Column, text: Column) -> Column:
    """The id of a document; one made from the text where it is null."""
    made = F.lit(_NULL_KEY) - F.pmod(F.xxhash64(F.coalesce(text, F.lit(""))), F.lit(1 << 61))
    return F.coalesce(doc_id.cast("long"), made)


def _sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    for hashes, bounds in batch_words(column):
        for begin, end in bounds:
            yield shingle_set(hashes[begin:end], size)


def _needed(n):
    """Least overlap with any partner of a set of ``n`` shingles, as 100 * common >= 80 * union."""
    return (8 * n + 9) // 10


def _meetings(n):
    """Prefix tokens that a set of ``n`` shares with any partner of its size or above.

    If two sets share a tokens, the prefixes of their sizes less a plus m tokens share m of them.
    """
    return np.maximum(1, n // 10)


def frequent_tokens(docs: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens that many documents hold, with their counts, sorted by token.

    A part of the input names a token only if ``FREQUENT`` of its documents hold it, and the table keeps
    those in a fifth of that share of all documents. So it has at most 5 / FREQUENT times the mean set
    size entries, whatever the number of documents. It only orders tokens; results do not depend on it.
    """

    def run(batches):
        least, total, tokens, counts = 0, 0, np.zeros(0, np.uint64), np.zeros(0, np.int64)
        pending: list[np.ndarray] = []
        seen = 0
        for batch in batches:
            for found in _sets(batch.column(0), size):
                pending.append(found)
                seen += 1
                total += len(found)
                if total > 1_000_000:
                    tokens, counts = _merged(tokens, counts, pending)
                    pending, total = [], 0
                    least = max(1, int(seen * FREQUENT / 8))
                    tokens, counts = tokens[counts > least], counts[counts > least]
        tokens, counts = _merged(tokens, counts, pending)
        keep = counts >= max(2, seen * FREQUENT)
        yield pa.RecordBatch.from_arrays([pa.array(tokens[keep].view(np.int64)), pa.array(counts[keep]), pa.array(np.full(keep.sum(), seen))], ["token", "n", "seen"])
        free_memory()

    found = docs.select("text").mapInArrow(run, "token long, n long, seen long").groupBy("token").agg(F.sum("n").alias("n"))
    rows = found.filter(F.col("n") >= FREQUENT / 5 * docs.count()).toPandas()
    tokens = rows["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], rows["n"].to_numpy(np.int64)[order]


def _merged(tokens, counts, sets):
    all_tokens = np.concatenate([tokens, *sets])
    weight = np.concatenate([counts, np.ones(len(all_tokens) - len(tokens), np.int64)])
    order = np.argsort(all_tokens, kind="stable")
    all_tokens, weight = all_tokens[order], weight[order]
    first = np.flatnonzero(np.concatenate([[True], all_tokens[1:] != all_tokens[:-1]])) if len(all_tokens) else np.zeros(0, np.int64)
    return all_tokens[first], np.add.reduceat(weight, first) if len(first) else weight


def _prefix(tokens: np.ndarray, frequent: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The first tokens of a set in the global order: rare ones by hash, then frequent ones by count."""
    n = len(tokens)
    if not n:
        return tokens
    length = n - _needed(n) + int(_meetings(n))
    weight = np.zeros(n, np.int64)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
        weight = np.where(frequent[at] == tokens, counts[at], 0)
    return tokens[np.lexsort((tokens, weight))[:length]]


def _node(tokens: np.ndarray) -> int:
    return int(mix(tokens, 2).sum(dtype=np.uint64).view(np.int64)) if len(tokens) else 0


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id, key, n, node, prefix`` of every document; ``node`` names its whole set.

    A task gives the prefix of a set once, with the first of its copies that it meets.
    """
    frequent, counts = frequent_tokens(docs, size)
    shared = docs.sparkSession.sparkContext.broadcast((frequent, counts))

    def run(batches):
        frequent, counts = shared.value
        seen = Memo(lambda node: True, 200_000)
        for batch in batches:
            n, node, prefix = [], [], []
            for tokens in _sets(batch.column(2), size):
                n.append(len(tokens))
                node.append(_node(tokens))
                known = node[-1] in seen
                seen[node[-1]] = True
                prefix.append([] if known else _prefix(tokens, frequent, counts).view(np.int64))
            arrays = [pa.array(n, pa.int64()), pa.array(node, pa.int64()), pa.array(prefix, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], ["doc_id", "key", "n", "node", "prefix"])
        free_memory()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), doc_key(F.col("doc_id"), F.col("text")).alias("key"), "text")
    return rows.mapInArrow(run, "doc_id long, key long, n long, node long, prefix array<long>")


def shared_tokens(prefixes: DataFrame) -> DataFrame:
    """The distinct ``token, node`` whose token occurs in two nodes or more, by one shuffle and a scan of sorted rows."""

    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            token, node = (batch.column(c).to_numpy() for c in (0, 1))
            shared = np.zeros(len(token), bool)
            if held is not None:
                token, node, shared = np.append(held[0], token), np.append(held[1], node), np.append(held[2], shared)
            new = np.concatenate([[True], (token[1:] != token[:-1]) | (node[1:] != node[:-1])])
            token, node, shared = token[new], node[new], shared[new]
            same = token[1:] == token[:-1]
            shared[1:] |= same
            shared[:-1] |= same
            # The last row waits for what follows; it keeps in mind that its token was shared.
            held = token[-1:], node[-1:], shared[-1:]
            keep = shared[:-1]
            yield pa.RecordBatch.from_arrays([pa.array(token[:-1][keep]), pa.array(node[:-1][keep])], ["token", "node"])
        if held is not None and held[2][0]:
            yield pa.RecordBatch.from_arrays([pa.array(held[0]), pa.array(held[1])], ["token", "node"])

    rows = prefixes.select("token", "node").repartition("token").sortWithinPartitions("token", "node")
    return rows.mapInArrow(run, "token long, node long")


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Common tokens of every two of a few sets: product of the 0/1 token matrix, in slices of tokens."""
    n = len(sets)
    tokens = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    names, column, count = np.unique(tokens, return_inverse=True, return_counts=True)
    common = np.zeros((n, n), np.int64)
    shared = np.cumsum(count > 1) - 1
    keep = count[column] > 1
    owner, column = owner[keep], shared[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for begin in range(0, int(column[-1]) + 1 if len(column) else 0, 1 << 15):
        a, b = np.searchsorted(column, [begin, begin + (1 << 15)])
        matrix = np.zeros((n, min(1 << 15, int(column[-1]) + 1 - begin)), np.float32)
        matrix[owner[a:b], column[a:b] - begin] = 1
        common += np.rint(matrix @ matrix.T).astype(np.int64)
    return common


def _roots(sets: list[np.ndarray]) -> np.ndarray:
    """The first member that each member is connected to by links."""
    size = np.array([len(s) for s in sets])
    common = _overlaps(sets)
    linked = 100 * common >= 80 * (size[:, None] + size[None, :] - common)
    root = np.arange(len(sets))
    while True:
        least = np.where(linked, root[None, :], len(sets)).min(axis=1)
        least = np.minimum(root, least)
        if (least == root).all():
            return root
        root = least


_GROUP = "group long, nodes array<long>, roots array<long>, lengths array<int>, tokens binary, union binary"


def grouped(sets: DataFrame) -> DataFrame:
    """Groups of at most ``GROUP`` sets with the same least token, each with members, links and token union.

    ``sets`` are ``node, home, n, tokens``. A home with more members than a group takes is split in order
    of size; a group then also compares the last member of the one before it, so chains go on.
    """

    def run(batches):
        home, members, last = None, [], None

        def close():
            sets = [m[1] for m in members]
            extra = [last] if last is not None else []
            roots = _roots([m[1] for m in extra] + sets) if len(sets) + len(extra) > 1 else np.zeros(1, np.int64)
            names = [m[0] for m in extra + members]
            # A single set is its own union.
            union = np.unique(np.concatenate(sets)) if len(sets) > 1 else np.zeros(0, np.uint64)
            skip = len(extra)
            return {
                "group": int(mix(np.array([members[0][0]], np.int64).view(np.uint64) ^ mix(np.array([home], np.int64).view(np.uint64), 4)).view(np.int64)[0]),
                "nodes": names[skip:], "roots": [names[r] for r in roots[skip:]],
                "lengths": [len(s) for s in sets], "tokens": np.concatenate(sets).tobytes(), "union": union.tobytes(),
            }

        for batch in batches:
            rows = []
            for node, at, tokens in zip(batch.column("node").to_pylist(), batch.column("home").to_pylist(), batch.column("tokens"), strict=True):
                if members and (at != home or len(members) >= GROUP):
                    rows.append(close())
                    last = members[-1] if at == home else None
                    members = []
                elif at != home:
                    last = None
                home = at
                members.append((node, np.frombuffer(tokens.as_buffer(), np.uint64).copy()))
            if rows:
                yield _table(rows)
        if members:
            yield _table([close()])

    parts = sets.repartitionByRange("home", "n", "node").sortWithinPartitions("home", "n", "node")
    return parts.mapInArrow(run, _GROUP)


def _table(rows: list[dict]) -> pa.RecordBatch:
    long, lists = pa.int64(), pa.list_(pa.int64())
    return pa.RecordBatch.from_pylist(rows, pa.schema([("group", long), ("nodes", lists), ("roots", lists), ("lengths", pa.list_(pa.int32())), ("tokens", pa.binary()), ("union", pa.binary())]))


def _opened(asked: DataFrame) -> DataFrame:
    """Links ``a, b`` between the members of two groups, where the union bound lets an asking member qualify.

    Members that links of their group join already are one: one link is given between two such sets of members.
    """

    def run(batches):
        for batch in batches:
            a, b = [], []
            for row in zip(*(batch.column(c) for c in ("from_roots", "from_lengths", "from_tokens", "roots", "lengths", "tokens", "union")), strict=True):
                from_roots, roots = (np.array(row[k].as_py(), np.int64) for k in (0, 3))
                every, there, union = _members(row[2], row[1]), _members(row[5], row[4]), _numbers(row[6])
                bound = union if len(union) else there[0]
                open_ = [k for k, q in enumerate(every) if _common(q, bound) >= _needed(len(q))]
                if not open_:
                    continue
                at, to = np.nonzero(_links([every[k] for k in open_], there))
                found = np.unique(np.column_stack([from_roots[open_][at], roots[to]]), axis=0)
                a.append(found[:, 0])
                b.append(found[:, 1])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, np.int64), *x])) for x in (a, b)], ["a", "b"])
        free_memory()

    return asked.mapInArrow(run, "a long, b long")


def _numbers(value: pa.Scalar) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), np.uint64)


def _members(tokens: pa.Scalar, lengths: pa.Scalar) -> list[np.ndarray]:
    return np.split(_numbers(tokens), np.cumsum(lengths.as_py())[:-1])


def _links(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Whether each set on the left links with each one on the right."""
    if len(left) == 1:
        common = np.array([[_common(left[0], r) for r in right]])
    else:
        common = _overlaps(left + right)[: len(left), len(left) :]
    total = np.array([len(s) for s in left])[:, None] + np.array([len(s) for s in right])[None, :]
    return 100 * common >= 80 * (total - common)


def _common(a: np.ndarray, b: np.ndarray) -> int:
    if not len(a) or not len(b):
        return 0
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int((b[at] == a).sum())


def _tokens(texts: DataFrame, size: int) -> DataFrame:
    """``node, home, n, tokens`` of texts; home is the least token under its own hash. Sets without tokens are left out."""

    def run(batches):
        for batch in batches:
            sets = [t for t in _sets(batch.column(0), size) if len(t)]
            home = [int(mix(s, 9).min().view(np.int64)) for s in sets]
            arrays = [pa.array(map(_node, sets), pa.int64()), pa.array(home, pa.int64()), pa.array(map(len, sets), pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["node", "home", "n", "tokens"])
        free_memory()

    return texts.select("text").mapInArrow(run, "node long, home long, n long, tokens binary")


def _least_meetings(n: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(n / 10)).cast("long")


def _across(meeting: DataFrame, groups: DataFrame, homes: DataFrame, first: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between groups whose members are not connected yet, where enough of their prefix tokens meet.

    Groups meet, not their members, in the tokens that few hold; tokens that the same groups hold, as those of
    a passage, count as one. Of two groups the one with fewer tokens asks the other. So a large group of near
    copies meets itself once for every two groups, however many members and tokens these have.
    """
    spark = meeting.sparkSession
    needs = sets.groupBy("node").agg(_least_meetings(F.ceil(F.min("n") * 8 / 10)).alias("needs"))
    placed = written(spark, meeting.join(homes.select("node", "group").distinct(), "node").join(first, "node").join(needs, "node"), "placed-tokens")
    token = Window.partitionBy("token")
    split = placed.withColumns({"holders": F.count("*").over(token), "smallest": F.min("label").over(token), "largest": F.max("label").over(token)})
    apart = split.filter("smallest < largest").select("token", "node", "group", "label", "needs", "holders")

    # A partner shares as many of these tokens as a node needs, so the least held of those is not among its last ones.
    # Dealt by group, the nodes of one are together, and what they keep is summed up where it is.
    last = Window.partitionBy("group", "node").orderBy(F.desc("holders"), F.desc("token"))
    kept = apart.repartition("group").withColumn("place", F.row_number().over(last)).filter("place >= needs")
    kept = written(spark, kept.groupBy("token", "group").agg(F.min("label").alias("low"), F.max("label").alias("high")), "kept-tokens")
    # Tokens of the same groups are one, as most of a passage are; a clash of names only asks more.
    names = {"name": F.xxhash64(F.sum(F.xxhash64("group").cast("decimal(38,0)")).over(token)), "smallest": F.min("low").over(token), "largest": F.max("high").over(token), "holders": F.count("*").over(token)}
    named = kept.withColumns(names).filter("smallest < largest and holders > 1")
    matrix = named.groupBy("name", "group").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    size = groups.select("group", F.array_min("lengths").alias("least"), F.array_max("lengths").alias("most"), F.struct(F.length("tokens").alias("bytes"), "group").alias("rank"))
    matrix = written(spark, matrix.join(size, "group"), "token-matrix")
    x, y = matrix.alias("x"), matrix.alias("y")
    # Two groups that are one component have nothing to ask, and sets that link are of similar size.
    apart = (F.col("x.low") != F.col("y.high")) | (F.col("x.high") != F.col("y.low"))
    alike = (100 * F.col("x.most") >= 80 * F.col("y.least")) & (100 * F.col("y.most") >= 80 * F.col("x.least"))
    met = x.join(y, (F.col("x.name") == F.col("y.name")) & (F.col("x.rank") < F.col("y.rank")) & apart & alike)
    asked = written(spark, met.select(F.col("x.group").alias("from"), F.col("y.group").alias("group")).distinct(), "asked")
    # Few pairs are left when the tokens join them.
    asking = groups.select(F.col("group").alias("from"), *(F.col(c).alias(f"from_{c}") for c in ("roots", "lengths", "tokens")))
    return _opened(asked.join(asking, "from").join(groups, "group"))


def near_duplicates(docs: DataFrame, size: int = 5) -> DataFrame:
    """``doc_id, key, n_shingles, component_id, component_key`` for every row of ``docs``.

    Two documents link when 100 * common >= 80 * union of their sets of distinct ``size``-word shingles;
    the component is the smallest id that links reach, the own id included. Null, empty or blank texts
    have no shingles and stay alone. A null id counts as a document of its own text (``key``) and is
    never named as a component: one whose members are all null is null. ``component_key`` is the smallest
    key of the component, so it is never null. Rows that share an id count as one document. Other columns
    are left out.
    """
    spark = docs.sparkSession
    signed = written(spark, signatures(docs, size), "signatures")
    filled = signed.filter("n > 0")
    meeting = written(spark, shared_tokens(filled.select("node", F.explode("prefix").alias("token"))), "shared-tokens")

    # A partner has at least 0.8 of the shingles, and the two meet in as many tokens as the smaller one asks for.
    met = meeting.groupBy("node").agg(F.count("*").alias("met"))
    in_play = filled.groupBy("node").agg(F.min("key").alias("key"), F.min("n").alias("n")).join(met, "node")
    in_play = in_play.filter(F.col("met") >= _least_meetings(F.ceil(F.col("n") * 8 / 10))).select("key")
    texts = docs.select(doc_key(F.col("doc_id"), F.col("text")).alias("key"), "text").join(in_play, "key", "left_semi")
    sets = written(spark, _tokens(texts, size), "token-sets")
    groups = written(spark, grouped(sets), "token-groups")
    homes = groups.select("group", F.explode(F.arrays_zip("nodes", "roots")).alias("m")).select("group", F.col("m.nodes").alias("node"), F.col("m.roots").alias("root"))
    first = written(spark, components(homes.select(F.col("node").alias("a"), F.col("root").alias("b"))), "first-links")
    more = _across(meeting, groups, homes, first, sets)

    # One id, other texts: the id joins their sets.
    several = filled.groupBy("key").agg(F.min("node").alias("b"), F.max("node").alias("last")).filter("b <> last").select("key", "b")
    shared_ids = filled.select("key", F.col("node").alias("a")).join(several, "key").select("a", "b")
    edges = first.select(F.col("node").alias("a"), F.col("label").alias("b")).unionAll(more).unionAll(shared_ids)
    labels = written(spark, components(edges), "labels")
    named = signed.select("doc_id", "key", F.col("n").alias("n_shingles"), "node").join(labels, "node", "left")
    named = written(spark, named.withColumn("label", F.coalesce("label", "node")), "labelled")
    least = named.filter("n_shingles > 0").groupBy("label").agg(F.min("key").alias("component_key"), F.min("doc_id").alias("component_id"), F.count("*").alias("n"))
    # Only components of several documents need the join; the others name themselves.
    least = written(spark, least.filter("n > 1").drop("n"), "components")
    done = named.join(least, "label", "left")
    return done.select(
        "doc_id", "key", "n_shingles",
        F.when(F.col("component_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("component_key", "key").alias("component_key"),
    )
