"""Near-duplicate groups of documents by SetSketch registers.

A document is the set of its word n-grams.  A register is the minimum of one hash
over that set, seen as an exponential variable and truncated to a whole power of
a base close to 1: sketches of unions are maxima of registers, and registers of
similar sets are likely to be equal.

Bands of registers put similar sets into a common bucket.  Whether two sets of
known sizes may be similar is then told by the numbers of registers in which the
first is greater, the second is greater, or neither: of these the likelihood of
every similarity follows, and a pair is set aside only where the required one is
far less likely than the best.  All others are verified on their full sets.

Equal sets are one node from the start.  Each node is first compared with one hub,
the set of a bucket that meets most others, and linked nodes are merged.  Only buckets
that still hold several components go on, and their members are compared with
more pivots each round, until every pair of a bucket is compared or joined.  There,
sizes and parities, which bound the difference of two sets from below, spare the
estimate for most pairs of a crowd that is nearly but not quite similar.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.llm.common import broadcast_if_small, row_key, short_batches, written
from marlstone.llm.components import components, merge_labels
from marlstone.llm.part_enum import shingles
from marlstone.sources.scratch import scratch_table

REGISTERS = 256
BASE, RATE, TOP = 1.001, 20, 65535  # of a register; the largest value
COARSE = 100  # powers of the base in one step of a stored register
ROWS, DEALS = 6, 2  # registers of a band; how often the registers are dealt to bands
NATS = 20  # how much less likely the required similarity must be for a pair to be set aside
PIVOTS = (8, 64, 512)  # of a bucket in each round after the first; the last number repeats
PLACES = 1024  # of the parities
CHUNK = 2048  # elements at a time

_SEEDS = np.random.default_rng(20210101)
_XOR = _SEEDS.integers(0, 1 << 32, (REGISTERS, 1), np.uint32)
_ODD = _SEEDS.integers(0, 1 << 32, (REGISTERS, 1), np.uint32) | np.uint32(1)
_DEALT = np.concatenate([_SEEDS.permutation(REGISTERS)[: REGISTERS // ROWS * ROWS].reshape(-1, ROWS) for _ in range(DEALS)])
_WEIGHTS = _SEEDS.integers(0, 1 << 63, _DEALT.shape, np.uint64) * np.uint64(2) + np.uint64(1)


def registers(elements: np.ndarray) -> np.ndarray:
    """Registers of a set of 64-bit hashes; ``np.maximum`` of two sketches is that of the union."""
    least = np.full(REGISTERS, 0xFFFFFFFF, np.uint32)
    short = (elements >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(short), CHUNK):
        np.minimum(least, ((short[i : i + CHUNK] ^ _XOR) * _ODD).min(axis=1), out=least)
    if not len(short):
        return np.zeros(REGISTERS, np.uint16)
    exponential = -np.log1p(-(least + 0.5) / 2**32) / RATE
    return np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)), 0, TOP).astype(np.uint16)


def coarse(found: np.ndarray) -> np.ndarray:
    """The same sketch with the base to the power ``COARSE``, one byte a register."""
    return np.minimum((np.maximum(found, 1) - 1) // COARSE + 1, 255).astype(np.uint8)


def bands(found: np.ndarray) -> np.ndarray:
    """One hash a band."""
    mixed = (found[_DEALT].astype(np.uint64) + np.uint64(1)) * _WEIGHTS
    total = mixed.sum(axis=1, dtype=np.uint64) + np.arange(len(_DEALT), dtype=np.uint64)
    total = (total ^ (total >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return total ^ (total >> np.uint64(29))


def _log_likelihood(j, greater, less, equal, u, v, base):
    def chance(x):
        return -np.log1p(-np.clip(x, 0, 1) * (base - 1) / base) / np.log(base)

    first, second = chance(u - v * j), chance(v - u * j)
    parts = ((greater, first), (less, second), (equal, 1 - first - second))
    return sum(np.where(n > 0, n * np.log(np.maximum(p, 1e-12)), 0.0) for n, p in parts)


def estimate(a: np.ndarray, b: np.ndarray, a_size: np.ndarray, b_size: np.ndarray, base: float, percent: int):
    """The likeliest similarity of each pair of sketches, and how much less likely, in nats, ``percent`` is.

    Sketches are rows of registers; the second result is 0 where the likeliest similarity is at least ``percent``.
    """
    greater, less = (a > b).sum(1), (a < b).sum(1)
    counts = greater, less, a.shape[1] - greater - less
    u = a_size / (a_size + b_size)
    v = 1 - u
    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    golden = (5**0.5 - 1) / 2
    for _ in range(24):  # the likelihood has one peak
        x, y = high - golden * (high - low), low + golden * (high - low)
        left = _log_likelihood(x, *counts, u, v, base) > _log_likelihood(y, *counts, u, v, base)
        low, high = np.where(left, low, x), np.where(left, y, high)
    best = (low + high) / 2
    behind = _log_likelihood(best, *counts, u, v, base) - _log_likelihood(percent / 100, *counts, u, v, base)
    return best, np.where(best < percent / 100, behind, 0.0)


def parities(elements: np.ndarray) -> np.ndarray:
    """Parities of the numbers of elements dealt to places; two sets differ in at least as many elements as parities."""
    dealt = np.bincount((elements % np.uint64(PLACES)).astype(np.int64), minlength=PLACES)
    return np.packbits((dealt & 1).astype(np.uint8)).view(np.int64)


def _may_link(percent: int) -> Column:
    """False for pairs whose sizes or parities already differ too much to be similar."""
    least, most = F.least("a_size", "size"), F.greatest("a_size", "size")
    words = (F.bit_count(F.col("a_parities")[i].bitwiseXOR(F.col("parities")[i])) for i in range(PLACES // 64))
    differ = reduce(Column.__add__, words)
    return (100 * least >= percent * most) & ((100 + percent) * differ <= (100 - percent) * (least + most))


SETS = (
    "key_id long, key_hash long, doc_id long, n_shingles long, node binary, "
    "registers binary, parities array<long>, bands array<long>"
)


def _sets(docs: DataFrame, n: int) -> DataFrame:
    """Size and node, a 128-bit digest of the set, of each document; a task gives a set's sketch once."""
    names = [c.split(" ")[0] for c in SETS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                made = []
                for text in part.column(3):
                    found = shingles(text.as_py(), n)
                    node = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
                    row = [len(found), node, None, None, None]
                    if len(found) and node not in seen:
                        if len(seen) >= 500_000:
                            seen.clear()
                        seen.add(node)
                        sketch = registers(found)
                        row[2:] = coarse(sketch).tobytes(), parities(found), bands(sketch).view(np.int64)
                    made.append(row)
                kinds = (pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()))
                added = [pa.array(c, k) for c, k in zip(zip(*made, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], *added], names)

    return docs.select(*row_key(), F.col("doc_id").cast("long"), "text").mapInArrow(run, SETS)


def _likely(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes and registers leave open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                first, second = (np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint8).reshape(-1, REGISTERS) for c in (3, 5))
                sizes = (part.column(c).to_numpy().astype(float) for c in (2, 4))
                _, behind = estimate(first, second, *sizes, BASE**COARSE, percent)
                yield part.select([0, 1]).filter(pa.array(behind <= NATS))

    for end in ("a", "b"):
        at = nodes.select(F.col("id").alias(end), F.col("size").alias(f"{end}_size"), F.col("registers").alias(f"{end}_registers"))
        pairs = pairs.join(at, end)
        if end == "a":
            sizes = nodes.select(F.col("id").alias("b"), F.col("size").alias("other"))
            fits = 100 * F.least("a_size", "other") >= percent * F.greatest("a_size", "other")
            pairs = pairs.join(sizes, "b").filter(fits).drop("other")
    return pairs.select("a", "b", "a_size", "a_registers", "b_size", "b_registers").mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets, read from the documents again, are similar."""

    def elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [shingles(t.as_py(), n).tobytes() for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.binary())], ["id", "elements"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.frombuffer(s.as_py(), np.uint64) for s in (x, y))
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    ends = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    wanted = broadcast_if_small(written(nodes.select("id", "key.*").join(ends, "id", "left_semi"), "wanted"))
    texts = docs.select(*row_key(), "text").join(wanted, ["key_id", "key_hash"]).select("id", "text")
    found = texts.mapInArrow(elements, "id long, elements binary").dropDuplicates(["id"])
    with short_batches(docs.sparkSession), scratch_table(found, "elements") as sets:
        for end in ("b", "a"):
            pairs = pairs.join(sets.select(F.col("id").alias(end), F.col("elements").alias(f"{end}_elements")), end)
        found = pairs.select("a", "b", "a_elements", "b_elements").mapInArrow(compare, "a long, b long")
        return written(found, "links")


def _mixed(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of buckets whose members are not all in one component."""
    placed = members.join(labels.withColumnRenamed("node", "id"), "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    ends = placed.groupBy("bucket").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low <> high")
    return written(placed.join(ends.select("bucket"), "bucket").select("bucket", "id", "degree", "comp"), "mixed")


def sketch_groups(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """Components of similar documents, one row for every row of ``docs`` (doc_id, text).

    Words are separated by ASCII white space, A to Z count as a to z, and documents link when the Jaccard similarity of
    their sets of n-grams is at least ``percent`` hundredths; a text of fewer words is one n-gram.  Returns doc_id,
    n_shingles, component_id (the smallest doc_id that can be reached) and kept, true where they are equal.  Null
    texts and texts without words link with nothing.  A null doc_id counts only where a component has no other.  Rows
    that share a doc_id are rows of their own.  Further columns are not read; an empty table gives no rows.

    A pair at 0.8 shares no band with a chance of about 1e-9, and is set aside with one of about 1e-9.
    """
    with short_batches(docs.sparkSession), scratch_table(_sets(docs, n), "sketches") as made:  # wide, and gone after this block
        sets = written(made.select("doc_id", "n_shingles", "node"), "sets")
        first = [F.first(c, ignorenulls=True).alias(c) for c in ("registers", "parities", "bands")]
        key = F.min(F.struct("key_id", "key_hash")).alias("key")
        nodes = made.filter(F.col("bands").isNotNull()).groupBy("node").agg(F.min("n_shingles").alias("size"), key, *first)
        with scratch_table(nodes.withColumn("id", F.monotonically_increasing_id()), "banded") as banded:
            nodes = written(banded.drop("bands"), "nodes")
            dealt = banded.select(F.explode("bands").alias("bucket"), "id").repartition("bucket")
            crowds = dealt.groupBy("bucket").agg(F.count("*").alias("crowd")).filter("crowd > 1")
            members = written(dealt.join(crowds, "bucket"), "members")
    degrees = members.groupBy("id").agg(F.sum("crowd").alias("degree"))
    members = written(members.drop("crowd").join(degrees, "id"), "ranked")
    hubs = members.groupBy("bucket").agg(F.max(F.struct("degree", "id")).alias("hub"))
    met = members.join(hubs, "bucket").filter("id <> hub.id").groupBy(F.col("hub.id").alias("a"), F.col("id").alias("b"))
    best = F.max(F.struct("n", "a")).alias("best")
    pairs = met.agg(F.count("*").alias("n")).groupBy("b").agg(best).select("best.a", "b")
    rest, labels, done = members, None, 0
    while True:
        likely = written(_likely(pairs, nodes, percent), "likely")
        labels = merge_labels(labels, _verified(likely, docs, nodes, n, percent))
        rest = _mixed(rest, labels)
        if rest.isEmpty():
            break
        n_pivots, done = PIVOTS[min(done, len(PIVOTS) - 1)], done + 1
        hubs_first = Window.partitionBy("bucket").orderBy(F.col("degree").desc(), "id")
        ranked = rest.withColumn("rank", F.row_number().over(hubs_first)).join(nodes.select("id", "size", "parities"), "id")
        ranked = written(ranked, "ranked")
        ends = ranked.filter(F.col("rank") <= n_pivots)
        ends = ends.select("bucket", *(F.col(c).alias(f"a_{c}") for c in ranked.columns if c != "bucket"))
        apart = (F.col("a_rank") < F.col("rank")) & (F.col("a_comp") != F.col("comp"))
        found = ends.join(ranked, "bucket").filter(apart & _may_link(percent))
        pairs = found.select(F.col("a_id").alias("a"), F.col("id").alias("b")).distinct()
        rest = ranked.filter(F.col("rank") > n_pivots).select("bucket", "id", "degree")
    known = sets.filter("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("least"))
    named = known.join(nodes.select("node", "id"), "node").join(labels.withColumnRenamed("node", "id"), "id", "left")
    named = written(named.select("node", F.coalesce("comp", "id").alias("comp"), "least"), "named")
    least = named.groupBy("comp").agg(F.min("least").alias("component_id"))
    ids = named.join(least, "comp").select("node", F.col("component_id").alias("found"))
    component = F.when(F.col("n_shingles") > 0, F.col("found")).otherwise(F.col("doc_id"))
    placed = sets.join(ids, "node", "left").select("doc_id", "n_shingles", component.alias("component_id"))
    return placed.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
