"""Benchmark passages in documents, found by spaced seeds.

A mask names the word positions that must agree; the others are ignored.  The
words under a mask are hashed at every position of benchmark items and
documents, and equal hashes put a document and an item on a diagonal.  On it
the words are compared one by one, and the pair counts as a leak if some window
has enough equal words.

A window has 13 words, or all words of an item that has fewer, and two of 13 may
differ, in proportion rounded down: one of 7 to 12, none of fewer.  The masks
below hit every window of 13 words with at most two substitutions, wherever
those are.  A shorter item has its first and its second half as masks, one of
which a single substitution leaves alone; without tolerance its only mask is
the whole of it.  So nothing within the tolerance is lost.

Only SQL functions are used.  Words are letters and digits, in lower case; in
scripts written without spaces each character is a word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.llm.common import broadcast_if_small, row_key, written

MASKS = ((0, 1, 2, 4, 6, 7), (0, 1, 3, 6, 7, 8))
WINDOW, SUBSTITUTIONS = 13, 2


#: Items of fewer words are not looked for.
LEAST = 5

#: Scripts written without spaces: Thai to Tibetan, Burmese, Khmer, kana and ideographs; none begins before the first.
UNSPACED = r"[\u0E00-\u0FFF\u1000-\u109F\u1780-\u17FF\u19E0-\u19FF\u3005-\u3007\u3021-\u3029\u3038-\u30FF\u31F0-\u31FF\u3400-\u4DBF\u4E00-\u9FFF\uA9E0-\uA9FF\uAA60-\uAA7F\uF900-\uFAFF\uFF66-\uFF9F\x{1AFF0}-\x{1B16F}\x{20000}-\x{3FFFF}]"


def words(text: str = "text") -> Column:
    """Hashes of the words of a text, in order."""
    low = F.lower(F.coalesce(F.col(text), F.lit("")))
    spaced = F.when(low.rlike(r"[\u0E00-\x{10FFFF}]"), F.regexp_replace(low, f"({UNSPACED})(\\p{{M}}*+)", " $1$2 ")).otherwise(low)
    split = F.split(spaced, r"[^\p{L}\p{M}\p{N}]+")
    return F.transform(F.filter(split, lambda w: w != ""), lambda w: F.xxhash64(w))


def tolerated(window: int | Column) -> int | Column:
    """How many words of a window may differ."""
    if isinstance(window, int):
        return window * SUBSTITUTIONS // WINDOW
    return F.floor(window * SUBSTITUTIONS / WINDOW).cast("int")


def masks(n: int) -> list[tuple[int, ...]]:
    """The masks of an item of ``n`` words."""
    if n >= WINDOW:
        return list(MASKS)
    half = n // 2
    return [tuple(range(half)), tuple(range(half, n))] if tolerated(n) else [tuple(range(n))]


def seeds(df: DataFrame, lengths: list[int], own: bool, *keys: str) -> DataFrame:
    """keys, pos and seed for each place of each mask in the array ``words``.

    ``lengths`` are those of the items, ``WINDOW`` for all from there on.  If ``own``, a row is given the masks of its own
    length, else those of every length that it is not too short for.
    """
    shapes = [(n, mask) for n in lengths for mask in masks(n)]
    span = 1 + max((max(mask) for _, mask in shapes), default=0)
    n = F.size("words")
    long_enough = n >= (min(lengths) if lengths else WINDOW)
    shifted = [F.sequence(F.lit(0), n - 1).alias("pos")]
    shifted += [(F.slice("words", 1 + i, n) if i else F.col("words")).alias(f"w{i}") for i in range(span)]
    # Told by a case and not by a filter, which would be moved below the words and find them a second time.
    zipped = F.when(long_enough, F.arrays_zip(*shifted))
    places = df.select(*keys, n.alias("n"), F.inline(zipped).alias("pos", *[f"w{i}" for i in range(span)]))
    hashes = []
    for length, mask in shapes:
        fits = F.col("n") == length if own and length < WINDOW else F.col("n") >= length
        seed = F.xxhash64(F.lit(length), F.lit(mask[0]), F.lit(mask[-1]), *[F.col(f"w{i}") for i in mask])
        hashes.append(F.when(fits & F.col(f"w{max(mask)}").isNotNull(), seed))
    found = F.explode(F.array(*hashes) if hashes else F.array().cast("array<bigint>")).alias("seed")
    return places.select(*keys, "pos", found).filter(F.col("seed").isNotNull())


def leaks(docs: DataFrame, benchmark: DataFrame, least: int = LEAST) -> DataFrame:
    """Pairs of a document (doc_id, text) and a benchmark passage (item_id, text) that it holds.

    Returns doc_id, item_id (the smallest of the items with that text), matched (equal words in the best window),
    doc_word and item_word (where that window starts, from 0) and n_items (items with that text).  A window is 13
    words, of which 11 must be equal, or a whole item of 7 to 12 words, all but one equal, or of fewer, all equal.  Items of
    fewer than ``least`` words, being no passages, match nothing, nor do texts without words.  Of equally good windows the
    one earliest in the item counts, then the latest in the document.  Texts may be of any length.  Documents with equal
    doc_id and text, and those with a null doc_id, give a row each time they occur.  Empty tables give no rows.
    """
    found = _keyed_leaks(docs, benchmark, least).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    return found.select("doc_id", "item_id", "matched", "doc_word", "item_word", "n_items")


def _keyed_leaks(docs: DataFrame, benchmark: DataFrame, least: int) -> DataFrame:
    """Columns of ``leaks``, key columns and copies, one row for documents that are copies of one another."""
    items = benchmark.select("item_id", words().alias("words"))
    items = items.groupBy("words").agg(F.min("item_id").alias("item_id"), F.count("*").alias("n_items"))
    items = items.filter(F.size("words") >= max(1, least)).withColumn("w", F.least(F.size("words"), F.lit(WINDOW)))
    items = written(items.withColumn("item", F.monotonically_increasing_id()), "items")
    lengths = sorted(r.w for r in items.select("w").distinct().collect())  # 13 at most
    keys = ["key_id", "key_hash"]
    lookup = written(seeds(items, lengths, True, "item").withColumnRenamed("pos", "item_pos").distinct(), "item-seeds")
    keyed = docs.select(*row_key(), "doc_id", "text")
    places = seeds(keyed.select(*keys, words().alias("words")), lengths, False, *keys)
    diagonals = places.join(broadcast_if_small(lookup), "seed").select(*keys, "item", (F.col("pos") - F.col("item_pos")).alias("shift"))
    hits = written(diagonals.distinct(), "hits")
    # Only documents with a hit are read again, once for each time they occur.
    hit_docs = broadcast_if_small(written(hits.select(*keys).distinct(), "hit-docs"))
    again = keyed.join(hit_docs, keys, "left_semi").select(*keys, "doc_id", words().alias("doc_words"))
    again = again.groupBy(*keys, "doc_id").agg(F.first("doc_words").alias("doc_words"), F.count("*").alias("copies"))
    again = written(again, "hit-words")
    lined = hits.join(again, keys).join(broadcast_if_small(items), "item")
    lined = lined.withColumn("start", F.greatest(F.lit(0), -F.col("shift")))
    lined = lined.withColumn("n", F.least(F.size("words"), F.size("doc_words") - F.col("shift")) - F.col("start"))
    lined = lined.filter(F.col("n") >= F.col("w"))
    equal = F.zip_with(
        F.slice("words", F.col("start") + 1, F.col("n")),
        F.slice("doc_words", F.col("start") + F.col("shift") + 1, F.col("n")),
        lambda a, b: F.when(a == b, 1).otherwise(0),
    )
    counts = F.transform(
        F.sequence(F.lit(0), F.col("n") - F.col("w")),
        lambda i: F.struct(
            F.aggregate(F.slice("equal", i + 1, F.col("w")), F.lit(0), lambda a, b: a + b).alias("matched"), (-i).alias("at")
        ),
    )
    best = F.max(F.struct("window.matched", (F.col("window.at") - F.col("start")).alias("item_at"), F.col("shift"))).alias("best")
    return (
        lined.withColumn("equal", equal)
        .withColumn("window", F.array_max(counts))
        .filter(F.col("window.matched") >= F.col("w") - tolerated(F.col("w")))
        .groupBy(*keys, "doc_id", "item_id", "n_items", "copies")
        .agg(best)
        .select(
            *keys,
            "doc_id",
            "copies",
            "item_id",
            F.col("best.matched").cast("bigint").alias("matched"),
            (F.col("best.shift") - F.col("best.item_at")).cast("bigint").alias("doc_word"),
            (-F.col("best.item_at")).cast("bigint").alias("item_word"),
            "n_items",
        )
    )


def clean(docs: DataFrame, benchmark: DataFrame, least: int = LEAST) -> DataFrame:
    """Documents without a leak, with all their columns; null or repeated doc_ids are told apart by their texts."""
    found = _keyed_leaks(docs.select("doc_id", "text"), benchmark, least)
    bad = written(found.select(F.col("key_id").alias("bad_id"), F.col("key_hash").alias("bad_hash")).distinct(), "leaky-docs")
    key_id, key_hash = row_key()
    return docs.join(broadcast_if_small(bad), (key_id == F.col("bad_id")) & (key_hash == F.col("bad_hash")), "left_anti")
