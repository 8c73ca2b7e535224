"""Benchmark decontamination by spaced-seed hashing, with DataFrame functions only.

A seed hashes the words of a window at the positions a fixed mask names and ignores the others, so
replaced words at ignored positions do not hide a copied passage. Hashes of the test items meet those
of the training texts; around each hit the item is laid along the text and equal words are counted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditweave.llm.common import packed

#: Words that are compared at once, and how many of them must be equal (0.8 of them).
WINDOW, EQUAL = 13, 11
SPAN = 10
#: Word positions that a seed hashes, counted from its first word. Wherever two words are replaced, one of
#: ``LONG`` fits beside them somewhere in ``WINDOW`` words, and one of ``MIDDLE`` in ``SPAN`` words.
LONG = ((0, 1, 2, 4, 6, 7), (0, 2, 5, 6, 7, 8))
MIDDLE = ((0, 1, 3, 4, 5), (0, 1, 3, 6, 7), (0, 1, 4, 6, 7))
#: ``MIDDLE`` at every place in ``SPAN`` words; ``1`` marks the positions that are hashed.
MASKS = tuple("".join("01"[k - at in shape] for k in range(SPAN)) for shape in MIDDLE for at in range(SPAN - shape[-1]))
#: Bytes up to which the seeds, and the items, are broadcast; beyond that both sides shuffle. A seed row of
#: numbers takes about ``ROW_BYTES`` in a hash table, an item so many and 8 for each word.
BROADCAST_BYTES, ROW_BYTES = 64 << 20, 100


def word_hashes(text: Column) -> Column:
    """64-bit hashes of the lower-cased words of a text; none for a null or empty text."""
    bare = F.btrim(F.lower(F.coalesce(text, F.lit(""))), F.lit(" \t\n\x0b\x0c\r"))
    words = F.transform(F.split(bare, r"[\x20\x09-\x0D]+"), lambda w: F.xxhash64(w))
    return F.when(bare == "", F.array().cast("array<bigint>")).otherwise(words)


def shapes_of(size: int) -> tuple[tuple[int, ...], ...]:
    """Seed shapes of an item of ``size`` words: every alignment with enough equal words is hit by one of them."""
    if size >= WINDOW:
        return LONG
    if size >= SPAN:
        return MIDDLE
    if size < 5:  # all words must be equal
        return (tuple(range(size)),)
    # One word may differ: of three thirds, two stay whole.
    third = -(-size // 3)
    kept = ([k for k in range(size) if k // third != out] for out in range(3))
    return tuple(tuple(k - part[0] for k in part) for part in kept)


def _seed_rows(table: DataFrame, sizes: Sequence[int], of_items: bool) -> DataFrame:
    """``table`` (with ``words``) with one row per seed: ``seed``, and ``at``, the place of its first word.

    ``sizes`` are the numbers of words, ``WINDOW`` at most, for which seeds are wanted; an item has only
    those of its own size. The windows are exploded as positions, and the hashes are plain expressions on
    the rows, so the whole step stays in generated code; the words ride along by reference.
    """
    size, shapes = F.size("words"), {}
    for n in sizes:
        for shape in shapes_of(n):
            shapes.setdefault(shape, []).append(n)
    least = min((shape[-1] for shape in shapes), default=0)
    windows = table.withColumn("at", F.explode(F.when(size > least, F.sequence(F.lit(0), size - 1 - least))))
    seeds = []
    for shape, owners in shapes.items():
        fits = F.col("at") + shape[-1] < size
        if of_items:
            fits = fits & F.least(size, F.lit(WINDOW)).isin(owners)
        name = F.lit(",".join(map(str, shape)))
        seeds.append(F.when(fits, F.xxhash64(name, *(F.get("words", F.col("at") + k) for k in shape))))
    seeded = windows.withColumn("seed", F.explode(F.array(*seeds) if seeds else F.array().cast("array<bigint>")))
    return seeded.filter(F.col("seed").isNotNull())


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, text_hash, item_id, best_window, matched_words`` for each leaked pair of text and item.

    A pair is leaked when, along one alignment, some ``WINDOW`` consecutive words of
    the item (all, if it has fewer) hold at least ``EQUAL`` equal ones (0.8 of them, if fewer). A seed hits
    every such alignment.
    ``best_window`` is the largest such count, ``matched_words`` the equal words along the whole item.
    ``text_hash`` tells apart texts with the same or a null ``doc_id``; repeated rows give one. Items
    that share an id, or have a null one, are compared each for itself and give one row for the id. Null or
    empty texts and items have no seeds and never match. Other columns are left out.
    """
    items = benchmark.select("item_id", word_hashes(F.col("text")).alias("words")).filter(F.size("words") > 0)
    # Tells apart items that share an id, or have none.
    items = items.withColumn("item_hash", F.xxhash64("words")).distinct()
    sizes = sorted(r[0] for r in items.select(F.least(F.size("words"), F.lit(WINDOW))).distinct().collect())
    # Items with equal words at a place give one seed row each; the pairs below are kept apart by item_id.
    # Seeds carry no words; those of the items come back to the alignments that were hit.
    seeds = _seed_rows(items, sizes, True).select("seed", F.col("at").alias("item_at"), "item_id", "item_hash", F.size("words").alias("size")).distinct()
    texts = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), word_hashes(F.col("text")).alias("words"))
    start = (F.col("at") - F.col("item_at")).alias("start")
    if seeds.count() * ROW_BYTES <= BROADCAST_BYTES:
        hits = _seed_rows(texts, sizes, False).join(F.broadcast(seeds), "seed").select("doc_id", "text_hash", "item_id", "item_hash", "size", start, "words")
    else:
        # The texts' words stay behind too.
        met = _seed_rows(texts, sizes, False).select("doc_id", "text_hash", "at", "seed").join(seeds, "seed")
        met = met.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "item_id", "item_hash", "size", start).distinct()
        same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
        hits = texts.join(met, same)
    # The part of the text that lies along the item; no whole text leaves the stage of the join, and each
    # alignment is looked at once.
    size, skipped = F.col("size"), F.greatest(-F.col("start"), F.lit(0))
    beside = F.slice("words", F.greatest(F.col("start"), F.lit(0)) + 1, size - skipped)
    hits = hits.select("doc_id", "text_hash", "item_id", "item_hash", "start", beside.alias("beside"))
    hits = hits.groupBy("doc_id", "text_hash", "item_id", "item_hash", "start").agg(F.first("beside").alias("beside"))
    whole = items.select(F.col("item_id").alias("_item"), F.col("item_hash").alias("_item_hash"), F.col("words").alias("item"))
    taken = whole.agg(F.coalesce(F.sum(F.size("item").cast("long") * 8 + ROW_BYTES), F.lit(0)).alias("bytes")).first()["bytes"]
    same_item = F.col("item_id").eqNullSafe(F.col("_item")) & (F.col("item_hash") == F.col("_item_hash"))
    hits = hits.join(F.broadcast(whole) if taken <= BROADCAST_BYTES else whole, same_item)
    size = F.size("item")
    hits = hits.withColumns({"size": size, "skipped": skipped})
    aligned = F.transform("item", lambda w, i: F.coalesce((F.get("beside", i - F.col("skipped")) == w).cast("int"), F.lit(0)))
    hits = hits.withColumn("equal", aligned)
    width = F.least(F.lit(WINDOW), F.col("size"))
    sums = F.transform(F.sequence(F.lit(1), F.col("size") - width + 1), lambda k: F.aggregate(F.slice("equal", k, width), F.lit(0), lambda a, b: a + b))
    hits = hits.select(
        "doc_id", "text_hash", "item_id", "size", F.array_max(sums).alias("best_window"),
        F.aggregate("equal", F.lit(0), lambda a, b: a + b).alias("matched_words"),
    )
    needed = F.when(F.col("size") >= WINDOW, EQUAL).otherwise(F.ceil(F.col("size") * 0.8))
    found = hits.filter(F.col("best_window") >= needed)
    return found.groupBy("doc_id", "text_hash", "item_id").agg(F.max("best_window").alias("best_window"), F.max("matched_words").alias("matched_words"))


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text leaks no item; all columns stay, whatever their names, so do null and empty texts."""
    bad = leaks(docs.select("doc_id", "text"), benchmark).select("doc_id", "text_hash").distinct()
    keyed = docs.select(packed(docs, "given"), F.col("doc_id").alias("given_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("given_hash"))
    same = F.col("given_id").eqNullSafe(F.col("doc_id")) & (F.col("given_hash") == F.col("text_hash"))
    return keyed.join(bad, same, "left_anti").select("given.*")
