"""Near-duplicate join of documents by PartEnum signatures.

A document is the set of its word n-grams, as 64-bit hashes.  Sizes are divided
into bands such that similar sets lie in one band or in neighbouring ones; for
each band and the one above, a set gives signatures.  Within a band similar sets
differ in at most k elements.  The hash domain is cut into first-level parts, and
those into second-level ones; k differences leave some first-level part with at
most one, so leaving out each of its second-level parts in turn gives some
subset on which the sets agree: similar sets always share a signature.

A signature without elements says little, and is given only by a set that has
so many empty places that all places of agreement could be empty.  First-level
parts beyond the least number, as many as are likely to have an empty place in
the smallest sets, make that rare.

Sets with a common signature are compared through pivots: members of a signature
are checked against its hub, the set that meets most others, connected ones are
merged, and only those that are still apart are checked again, against more
pivots each round, hubs first.  Sizes and sketches, which bound the difference
from below, spare most comparisons; sets too large for a short sketch have a
longer one besides, read only for pairs that pass the short one.  Elements are
computed for the sets of the pairs left.  Equal sets are one node from the start.  So
groups of copies cost in proportion to their size, and every pair that could
link two components is checked.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.llm.common import broadcast_if_small, kept, row_key, short_batches, written
from marlstone.llm.components import components, moved
from marlstone.sources.scratch import scratch_table

PIVOTS = (8, 64, 1024)  # members a signature's others are checked against in each round; the last number repeats
SKETCH = 1024  # bits of a sketch
WORDS = 200_000  # whose hashes a worker process remembers; more cost memory that the next operators lack, and no less time
SMALL = 24  # bands up to this size leave one of three second-level parts out, others one of two


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


_WORDS = kept(_WordHashes())


def _mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, n: int) -> np.ndarray:
    """Sorted hashes of the distinct n-grams of a text's words; of the whole sequence if there are fewer words."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    n = min(n, len(words))
    out = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[i : len(hashes) - n + 1 + i]
    return np.unique(_mix(out))


class Bands:
    """Size bands and signatures for a similarity of ``percent`` out of 100."""

    def __init__(self, percent: int):
        self.percent = percent
        self.tops: list[int] = []  # the largest size of each band

    def band(self, size: int) -> int:
        while not self.tops or self.tops[-1] < size:
            self.tops.append(((self.tops[-1] if self.tops else 0) + 1) * 100 // self.percent)
        return int(np.searchsorted(self.tops, size))

    @lru_cache(maxsize=4096)  # noqa: B019
    def scheme(self, band: int) -> tuple:
        """Spare agreements, edges of the second-level parts, and for each subset its parts and its own number."""
        while len(self.tops) <= band:
            self.band(self.tops[-1] + 1 if self.tops else 1)
        k = 2 * self.tops[band] * (100 - self.percent) // (100 + self.percent)
        if not k:
            return ()
        n2 = 3 if self.tops[band] <= SMALL else 2
        least = k // 2 + 1
        spare = self._spare(least, n2, self.tops[band - 2] + 1 if band > 1 else 1)
        n1 = least + spare
        edges = np.array([(i << 64) // (n1 * n2) for i in range(1, n1 * n2)], np.uint64)
        subsets = np.array(list(combinations(range(n2), n2 - 1)))
        parts = (np.arange(n1)[:, None, None] * n2 + subsets[None]).reshape(-1, n2 - 1)
        names = _mix(np.uint64(band << 32) + np.arange(len(parts), dtype=np.uint64))
        return spare, edges, parts, names, len(subsets)

    @staticmethod
    def _spare(least: int, n2: int, smallest: int) -> int:
        """First-level parts of which some subset is likely to be empty in a set of the ``smallest`` size."""
        spare = 1
        for _ in range(8):
            n1 = least + spare
            empty = n1 * n2 * math.exp(-smallest * (n2 - 1) / (n1 * n2))
            spare = 1 + min(least // 3, math.ceil(empty + math.sqrt(empty)))
        return spare

    def signatures(self, found: np.ndarray) -> np.ndarray:
        size = len(found)
        if not size:
            return np.empty(0, np.uint64)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mix(found + np.uint64(1)), dtype=np.uint64)])
        out = []
        for band in (self.band(size), self.band(size) + 1):
            scheme = self.scheme(band)
            if not scheme:
                continue
            spare, edges, parts, names, per_part = scheme
            cuts = np.concatenate([[0], np.searchsorted(found, edges), [size]])
            count, total = np.diff(cuts)[parts].sum(axis=1), np.diff(sums[cuts])[parts].sum(axis=1, dtype=np.uint64)
            empty = count == 0
            made = _mix(total ^ names)
            if empty.any() and empty.reshape(-1, per_part).any(axis=1).sum() <= spare:
                made = made[~empty]
            out.append(made)
        return np.concatenate(out) if out else np.empty(0, np.uint64)


def _node(found: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(found.tobytes(), digest_size=8).digest(), "little", signed=True)


def _sketches(found: np.ndarray) -> list[np.ndarray | None]:
    """Parities of the elements dealt to places; two sets differ in at least as many elements as parities.

    The first sketch has ``SKETCH`` places.  Larger sets have a second one of at least as many places as elements, the
    next power of two, and a third one of half as many if that is not the first; others have None.
    """
    places = SKETCH
    while places < len(found):
        places *= 2
    levels = [np.bincount((found % np.uint64(places)).astype(np.int64), minlength=places).astype(np.uint8) & 1]
    while len(levels[-1]) > SKETCH:
        half = len(levels[-1]) // 2
        levels.append(levels[-1][:half] ^ levels[-1][half:])
    packed = [np.packbits(x).view(np.int64) for x in levels]
    return [packed[-1], packed[0] if len(packed) > 1 else None, packed[1] if len(packed) > 2 else None]


SETS = (
    "key_id long, key_hash long, doc_id long, n_shingles long, node long, "
    "sketch array<long>, fine array<long>, half array<long>, signatures array<long>"
)


def _sets(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """Size, node (a digest of the set) and signatures of each document; a task gives those of a set once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, seen = Bands(percent), set()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sizes, nodes, sketches, signatures = [], [], ([], [], []), []
                for text in part.column(3):
                    found = shingles(text.as_py(), n)
                    node = _node(found)
                    new = node not in seen
                    if new:
                        if len(seen) >= 500_000:
                            seen.clear()
                        seen.add(node)
                    sizes.append(len(found))
                    nodes.append(node)
                    for column, sketch in zip(sketches, _sketches(found), strict=True):
                        column.append(sketch)
                    signatures.append(bands.signatures(found).view(np.int64) if new else None)
                longs = pa.list_(pa.int64())
                added = [pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64())]
                added += [pa.array(column, longs) for column in (*sketches, signatures)]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], *added], [c.split()[0] for c in SETS.split(", ")])

    return docs.select(*row_key(), "doc_id", "text").mapInArrow(run, SETS)


def _checked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are similar; ``sets`` has the elements of their nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(c).to_pylist() for c in (2, 3))
            keep = []
            for x, y in zip(a, b, strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    for end in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("node").alias(end), F.col("elements").alias(f"{end}_elements")), end)
    return pairs.select("a", "b", "a_elements", "b_elements").mapInArrow(run, "a long, b long")


def _elements(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """node and elements of the sets in ``wanted`` (node, key columns), read from the documents again."""
    keys = ["key_id", "key_hash"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [shingles(t.as_py(), n).tobytes() for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.binary())], ["node", "elements"])

    texts = docs.select(*row_key(), "text").join(broadcast_if_small(wanted), keys).select("node", "text")
    return texts.mapInArrow(run, "node long, elements binary")


def _ends(nodes: DataFrame, end: str) -> DataFrame:
    """Size and sketch of the sets at one end of a pair."""
    return nodes.select(F.col("node").alias(end), F.col("size").alias(f"{end}_size"), F.col("sketch").alias(f"{end}_sketch"))


def _may_link(percent: int) -> Column:
    """False for pairs whose sizes or sketches already differ too much."""
    least, most = F.least("a_size", "b_size"), F.greatest("a_size", "b_size")
    places = (F.bit_count(F.col("a_sketch")[i].bitwiseXOR(F.col("b_sketch")[i])) for i in range(SKETCH // 64))
    differ = reduce(Column.__add__, places)
    return (100 * least >= percent * most) & ((100 + percent) * differ <= (100 - percent) * (least + most))


def _finely(pairs: DataFrame, fine: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) without those whose longer sketches differ too much; ``fine`` has those of the sets with one."""
    for end in ("a", "b"):
        at = fine.select(F.col("node").alias(end), *(F.col(c).alias(f"{end}_{c}") for c in ("size", "fine", "half")))
        pairs = pairs.join(at, end, "left")
    # Similar sets have sketches of one length, or one is twice as long and has a half of the other's length.
    a = F.when(F.size("a_fine") > F.size("b_fine"), F.col("a_half")).otherwise(F.col("a_fine"))
    b = F.when(F.size("b_fine") > F.size("a_fine"), F.col("b_half")).otherwise(F.col("b_fine"))
    parities = F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)
    fits = (100 + percent) * parities <= (100 - percent) * (F.col("a_size") + F.col("b_size"))
    return pairs.filter(F.coalesce(fits, F.lit(True))).select("a", "b")


def groups(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """Components of similar documents, one row for every row of ``docs`` (doc_id, text).

    Words are separated by ASCII white space, A to Z count as a to z, and documents link when the Jaccard similarity
    of their sets of n-grams is at least ``percent`` hundredths; a text of fewer words is one n-gram.  Returns doc_id,
    n_shingles, component_id (the smallest doc_id that can be reached) and comp, key_id, key_hash, which tell
    components and rows apart where doc_ids repeat or are null.  Documents without words, and null texts, link with
    nothing.  Further columns are not read; an empty table gives no rows.
    """
    keys = ["key_id", "key_hash"]
    with short_batches(docs.sparkSession), scratch_table(_sets(docs, n, percent), "signatures") as made:  # wide, and gone after this block
        exploded = made.select(F.explode("signatures").alias("signature"), "node")
        in_order = Window.partitionBy("signature").orderBy("node")
        members = (
            exploded.select("*", F.first("node").over(in_order).alias("pivot"), F.lag("node").over(in_order).alias("before"))
            .filter((F.col("node") != F.col("pivot")) & (F.col("node") != F.col("before")))
            .drop("before")
        )
        members = written(members, "members")  # of signatures that several sets share; the smallest node is the pivot
        sets = written(made.drop("signatures"), "sets")
    shared = members.select("signature", "node").unionByName(members.select("signature", F.col("pivot").alias("node")).distinct())
    crowd = shared.groupBy("signature").agg(F.count("*").alias("crowd"))
    degrees = shared.join(crowd, "signature").groupBy("node").agg(F.sum("crowd").alias("degree"))
    first = [F.first(c).alias(c) for c in ("sketch", "fine", "half")]
    sizes = sets.groupBy("node").agg(F.first("n_shingles").alias("size"), *first, F.min(F.struct(*keys)).alias("key"))
    nodes = written(sizes.join(degrees, "node"), "nodes")
    fine = nodes.filter(F.col("fine").isNotNull()).select("node", "size", "fine", "half")
    unique = sets.groupBy(*keys).count().filter("count > 1").isEmpty()

    def linked(pairs: DataFrame) -> DataFrame:
        pairs = written(_finely(pairs, fine, percent), "pairs")
        ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))
        wanted = written(nodes.select("node", "key.*").join(ends.distinct(), "node", "left_semi"), "wanted")
        elements = _elements(docs, wanted, n)
        elements = elements if unique else elements.dropDuplicates(["node"])
        with short_batches(docs.sparkSession), scratch_table(elements, "elements") as elements:
            return written(_checked(pairs, elements, percent), "links")

    # First each set is checked against one hub only, which joins most groups of copies.
    hub = F.max(F.struct("degree", "node"))
    hubs = shared.join(nodes.select("node", "degree"), "node").groupBy("signature").agg(hub.alias("hub"))
    pairs = shared.join(hubs, "signature").select("hub.degree", F.col("hub.node").alias("a"), F.col("node").alias("b")).filter("a <> b").distinct()
    pairs = pairs.join(_ends(nodes, "a"), "a").join(_ends(nodes, "b"), "b").filter(_may_link(percent))
    pairs = pairs.groupBy("b").agg(F.max(F.struct("degree", "a")).alias("hub")).select("hub.a", "b")
    rest = shared
    labels, done = None, 0
    while True:
        labels = _merged(labels, linked(pairs))
        rest = _apart(rest, labels)
        if rest.isEmpty():
            break
        n_pivots = PIVOTS[min(done, len(PIVOTS) - 1)]
        done += 1
        hubs_first = Window.partitionBy("signature").orderBy(F.col("degree").desc(), "node")
        ranked = rest.join(nodes.select("node", "degree"), "node").withColumn("rank", F.row_number().over(hubs_first))
        ranked = written(ranked.drop("degree").join(nodes.select("node", "size", "sketch"), "node"), "ranked")
        a, b = (ranked.select("signature", *(F.col(c).alias(end if c == "node" else f"{end}_{c}") for c in ranked.columns if c != "signature")) for end in "ab")
        a = a.filter(F.col("a_rank") <= n_pivots).withColumnRenamed("signature", "a_signature")
        apart = (F.col("a_signature") == F.col("signature")) & (F.col("a_rank") < F.col("b_rank")) & (F.col("a_comp") != F.col("b_comp"))
        pairs = a.join(b, apart & _may_link(percent)).select("a", "b").distinct()
        rest = ranked.filter(F.col("rank") > n_pivots).select("signature", "node")
    comp = F.when(F.col("n_shingles") > 0, F.coalesce("comp", "node"))
    placed = sets.drop("sketch", "fine", "half").join(labels, "node", "left").withColumn("comp", comp)
    placed = written(placed, "placed")
    smallest = placed.filter(F.col("comp").isNotNull()).groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    return placed.join(smallest, "comp", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("comp").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        "comp",
        "key_id",
        "key_hash",
    )


def _merged(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Labels after some more links."""
    if labels is None:
        return components(links)
    more = components(moved(links, labels)).select(F.col("node").alias("comp"), F.col("comp").alias("up"))
    old = labels.join(more, "comp", "left").select("node", F.coalesce("up", "comp").alias("comp"))
    new = more.join(labels.select(F.col("node").alias("comp")), "comp", "left_anti")
    return written(old.unionByName(new.select(F.col("comp").alias("node"), F.col("up").alias("comp"))), "labels")


def _apart(rest: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of signatures whose members are not all in one component."""
    placed = rest.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    mixed = placed.groupBy("signature").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low <> high")
    return written(placed.join(mixed.select("signature"), "signature").select("signature", "node", "comp"), "apart")


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component, that with the smallest doc_id, with all its columns; others stay."""
    placed = groups(docs, n, percent)
    keys = ["key_id", "key_hash"]
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "key_hash")
    best = placed.filter(F.col("comp").isNotNull()).groupBy("comp").agg(F.min(order).alias("best"))
    beaten = placed.join(best, "comp").filter((F.col("key_hash") != F.col("best.key_hash")) | ~F.col("doc_id").eqNullSafe(F.col("best.doc_id")))
    beaten = broadcast_if_small(written(beaten.select(*keys).distinct(), "beaten"))
    twice = placed.filter(F.col("comp").isNotNull()).groupBy(*keys).count().filter("count > 1").select(*keys)
    twice = broadcast_if_small(written(twice, "twice"))
    left = docs.withColumns(dict(zip(keys, row_key(), strict=True))).join(beaten, keys, "left_anti")
    once = left.join(twice, keys, "left_anti").unionByName(left.join(twice, keys, "left_semi").dropDuplicates(keys))
    return once.select(*docs.columns)
