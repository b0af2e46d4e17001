"""Exact top-k inner products over a bit-sliced index.

Vectors are indexed in blocks of rows.  A block holds, for each component, its
integer's upper bits as bitmaps over the rows, one a slice.  A query adds the
slices weighted by its components with bitmap arithmetic (full adders on whole
bitmaps, a negative weight adds complements), which gives the slices of every
row's score but for the bits left out.  From the most significant slice
downward the k-th largest sum is found; rows whose sum is close enough to it for
the left-out bits to matter are the boundary rows, and only theirs are computed
exactly.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.llm.common import partitions, written

LOW_BITS = 2  # left out of the slices, added for boundary rows


def quantised(vectors: DataFrame) -> DataFrame:
    """vec_id and q = floor(1024 * component), of vectors whose components are all finite numbers."""

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))

    wide = F.col("embedding").cast("array<double>")
    return (
        vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
        .select(F.col("vec_id").cast("bigint").alias("vec_id"), wide.alias("x"))
        .filter(F.forall("x", finite))
        .select("vec_id", F.transform("x", lambda x: F.floor(x * 1024).cast("bigint")).alias("q"))
    )


class Block:
    """Slices of some rows; rows are in order of their ids."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.values = ids[order], values[order]
        n, d = self.values.shape
        self.low = int(self.values.min()) if self.values.size else 0
        upper = (self.values - self.low).astype(np.uint64) >> np.uint64(LOW_BITS)
        self.bits = int(upper.max()).bit_length() if upper.size else 0
        words = -(-n // 64)
        self.slices = np.zeros((d, self.bits, words), np.uint64)
        padded = np.zeros((words * 64, d), np.uint64)
        padded[:n] = upper
        for b in range(self.bits):
            plane = ((padded >> np.uint64(b)) & np.uint64(1)).astype(np.uint8)
            self.slices[:, b] = np.packbits(np.ascontiguousarray(plane.T), axis=1, bitorder="little").view(np.uint64)
        self.rows = np.packbits(np.arange(words * 64) < n, bitorder="little").view(np.uint64)

    def sums(self, query: np.ndarray) -> list[np.ndarray]:
        """Slices, least first, of the sum of |weight| * upper bits, complemented where the weight is negative."""
        addends: list[list[np.ndarray]] = []
        signs = np.where(query < 0, np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0))[:, None, None]
        slices, weights = self.slices ^ signs, np.abs(query)
        for t in range(int(weights.max()).bit_length() if len(weights) else 0):
            chosen = slices[(weights >> t) & 1 == 1]
            for b in range(self.bits if len(chosen) else 0):
                while len(addends) <= t + b:
                    addends.append([])
                addends[t + b].append(chosen[:, b])
        out, carried = [], []
        while addends or carried:
            here = np.concatenate([*(addends.pop(0) if addends else []), *carried] or [np.zeros((0, len(self.rows)), np.uint64)])
            carried = []
            while len(here) > 2:
                n = len(here) // 3
                a, b, c = here[:n], here[n : 2 * n], here[2 * n : 3 * n]
                half = a ^ b
                carried.append((a & b) | (half & c))
                here = np.concatenate([half ^ c, here[3 * n :]])
            if len(here) == 2:
                carried.append((here[0] & here[1])[None])
                here = (here[0] ^ here[1])[None]
            out.append(here[0] if len(here) else np.zeros(len(self.rows), np.uint64))
        return out

    def top(self, own_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows but those with ``own_id``; ties go to smaller ids."""
        rows = self.rows.copy()
        first, last = np.searchsorted(self.ids, [own_id, own_id + 1])
        for i in range(first, last):
            rows[i // 64] &= ~(np.uint64(1) << np.uint64(i % 64))
        planes = self.sums(query)
        close, above, bound = rows, 0, 0
        if int(np.bitwise_count(rows).sum()) > k:
            for p in range(len(planes) - 1, -1, -1):
                with_bit = close & planes[p]
                n = int(np.bitwise_count(with_bit).sum())
                if above + n >= k:
                    close, bound = with_bit, bound | 1 << p
                else:
                    close, above = close & ~planes[p], above + n
        spread = ((1 << LOW_BITS) - 1) * int(np.abs(query).sum())  # what the left-out bits can change
        bound = max(0, bound - (spread >> LOW_BITS))
        over, close = np.zeros_like(rows), rows
        for p in range(len(planes) - 1, -1, -1):
            if bound >> p & 1:
                close = close & planes[p]
            else:
                over, close = over | (close & planes[p]), close & ~planes[p]
        chosen = np.flatnonzero(np.unpackbits((over | close).view(np.uint8), bitorder="little"))
        scores = self.values[chosen] @ query
        best = np.lexsort((self.ids[chosen], -scores))[:k]
        return self.ids[chosen][best], scores[best]


BLOCKS = "dim int, block string, n int, ids binary, vals binary"


def packed(values: np.ndarray) -> bytes:
    """The values as the narrowest integers that hold them; stored blocks are read, dealt out and sent to Python whole."""
    for kind in (np.int16, np.int32):
        bounds = np.iinfo(kind)
        if values.size and bounds.min <= values.min() and values.max() <= bounds.max:
            return values.astype(kind).tobytes()
    return values.tobytes()


def unpacked(vals: bytes, n: int, dim: int) -> np.ndarray:
    kind = np.dtype(f"i{len(vals) // (n * dim)}") if n * dim else np.int64
    return np.frombuffer(vals, kind).reshape(n, dim).astype(np.int64)


def blocks(vectors: DataFrame, rows: int) -> DataFrame:
    """Vectors (vec_id, q) packed into blocks of at most ``rows`` rows of one length; nothing is shuffled."""

    def pack(dim: int, held: list) -> dict:
        ids = np.array([i for i, _ in held], np.int64)
        values = np.array([v for _, v in held], np.int64).reshape(len(held), dim)
        return {"dim": dim, "block": uuid.uuid4().hex, "n": len(held), "ids": ids.tobytes(), "vals": packed(values)}

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list] = {}
        for part in parts:
            for i, v in zip(part["vec_id"], part["q"], strict=True):
                held.setdefault(len(v), []).append((i, v))
                if len(held[len(v)]) == rows:
                    yield pd.DataFrame([pack(len(v), held.pop(len(v)))])
        if held:
            yield pd.DataFrame([pack(dim, x) for dim, x in held.items()])

    return vectors.mapInPandas(run, BLOCKS)


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, *, rows: int = 8192, query_rows: int = 64) -> DataFrame:
    """The k best rows of ``vectors`` for each of ``queries`` (both vec_id, embedding), but for rows with its vec_id.

    Returns query_id, rank (from 1), vec_id and score, the inner product of the quantised components; ties go to the
    smaller vec_id.  Vectors that are null or hold null or non-finite components, and those without vec_id, take no
    part; vectors of different lengths are not compared.  Of several queries with one vec_id the least vector counts;
    of the vectors, each row does.  Further columns are not read; empty tables give no rows.
    """
    spark = vectors.sparkSession
    usable = quantised(vectors)
    asked = quantised(queries).groupBy("vec_id").agg(F.min("q").alias("q"))
    n_blocks = -(-vectors.count() // rows)
    index = written(blocks(usable.coalesce(max(1, n_blocks)), rows), "slices")
    groups = max(1, min(partitions(spark), 4 * index.count()))
    # Every block of queries meets every block of rows once: only row blocks are dealt out, each task reads the stored
    # queries in turn, and neither side is collected by the driver for a broadcast.
    index = index.repartition(groups, "block")
    batches = written(blocks(asked, query_rows), "queries").coalesce(1)
    batches = batches.select(
        F.col("dim").alias("q_dim"), F.col("n").alias("q_n"), F.col("ids").alias("q_ids"), F.col("vals").alias("q_vals")
    )

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, name = None, None
        for part in parts:
            for r in part.itertuples():
                if r.block != name:
                    held, name = Block(np.frombuffer(r.ids, np.int64), unpacked(r.vals, r.n, r.dim)), r.block
                found = []
                for own, query in zip(np.frombuffer(r.q_ids, np.int64), unpacked(r.q_vals, r.q_n, r.dim), strict=True):
                    ids, scores = held.top(int(own), query, k)
                    found.append(pd.DataFrame({"query_id": own, "vec_id": ids, "score": scores}))
                yield pd.concat(found)

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        index.join(batches.hint("shuffle_replicate_nl"), F.col("dim") == F.col("q_dim"))
        .mapInPandas(run, "query_id long, vec_id long, score long")
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
