"""Merkle manifest of a table, as a tree of SHA-256 states that can be resumed.

A node is the SHA-256 digest of its children's digests, written as lowercase hex.
Such a digest fills exactly one block of SHA-256, so the state of the hash before
each child is eight words.  A parent keeps those states.  To fold a replaced child
into the root, the state before its slot is resumed with the replacement and the
siblings to its right; nothing to its left is read again.

Rows form one tree for each value of a group column, and the roots of these trees
form another.  A tree is stored in pages, rows that each hold some levels of nodes
and states above at most ``page`` children, so any task handles one page of rows
at a time, however many rows share a group.  Positions come from a range
partitioning and the counts of its parts.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.llm.common import partitions, written

PAGE = 4096  # children below a page, at most

DIGEST, STEP = 32, "struct<state: binary, left: binary, right: binary>"
PLACED = "tree string, position long, total long, digest binary"
PAGES = "tree string, page long, total long, levels int, nodes binary, states binary, digest binary"
PATHS = f"tree string, position long, steps array<{STEP}>"


def _primes(n: int) -> list[int]:
    found: list[int] = []
    at = 2
    while len(found) < n:
        if all(at % p for p in found):
            found.append(at)
        at += 1
    return found


def _fraction(prime: int, power: int) -> int:
    """32 bits of the fractional part of a prime's root."""
    scaled, root = prime << (32 * power), math.isqrt(prime << 64)
    if power == 3:
        root = round(scaled ** (1 / 3))
        while root**3 > scaled:
            root -= 1
        while (root + 1) ** 3 <= scaled:
            root += 1
    return root & 0xFFFFFFFF


_ROUND = np.array([_fraction(p, 3) for p in _primes(64)], np.uint32)
START = np.array([_fraction(p, 2) for p in _primes(8)], np.uint32)


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x >> np.uint32(n)) | (x << np.uint32(32 - n))


def absorb(states: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """SHA-256 states (8, n) after one more block (16, n) each, all as unsigned 32-bit words."""
    w = [*blocks]
    for i in range(16, 64):
        a, b = w[i - 15], w[i - 2]
        low = _turn(a, 7) ^ _turn(a, 18) ^ (a >> np.uint32(3))
        high = _turn(b, 17) ^ _turn(b, 19) ^ (b >> np.uint32(10))
        w.append(w[i - 16] + low + w[i - 7] + high)
    a, b, c, d, e, f, g, h = states
    for i in range(64):
        t = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + (g ^ (e & (f ^ g))) + _ROUND[i] + w[i]
        u = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) ^ (c & (a ^ b)))
        a, b, c, d, e, f, g, h = t + u, a, b, c, d + t, e, f, g
    return states + np.stack([a, b, c, d, e, f, g, h])


def as_blocks(digests: np.ndarray) -> np.ndarray:
    """Digests (n, 32 bytes) as hex text, one block each."""
    text = np.ascontiguousarray(digests).tobytes().hex().encode()
    return np.frombuffer(text, ">u4").reshape(len(digests), 16).T.astype(np.uint32)


def finish(states: np.ndarray, n_blocks: np.ndarray) -> np.ndarray:
    """Digests (n, 32 bytes) of messages of so many whole blocks."""
    last = np.zeros((16, states.shape[1]), np.uint32)
    last[0] = 0x80000000
    last[15] = np.asarray(n_blocks, np.uint32) * np.uint32(512)
    return np.ascontiguousarray(absorb(states, last).T.astype(">u4")).view(np.uint8).reshape(-1, DIGEST)


def _packed(states: np.ndarray) -> bytes:
    return np.ascontiguousarray(states.T).astype(">u4").tobytes()


def _states(data: np.ndarray) -> np.ndarray:
    """States (8, n) from rows of 32 bytes."""
    return np.ascontiguousarray(data).view(">u4").T.astype(np.uint32)


def _bytes(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(-1, DIGEST)


def grow(nodes: np.ndarray, fan: int) -> tuple[np.ndarray, np.ndarray]:
    """The states before each of the ``nodes`` in its parent, and the parents."""
    n_runs = -(-len(nodes) // fan)
    state = np.repeat(START[:, None], n_runs, 1)
    before = np.empty((8, len(nodes)), np.uint32)
    for slot in range(min(fan, len(nodes))):
        part = as_blocks(nodes[slot::fan])
        n = part.shape[1]
        before[:, slot::fan] = state[:, :n]
        state[:, :n] = absorb(state[:, :n], part)
    sizes = np.full(n_runs, fan)
    sizes[-1] = len(nodes) - fan * (n_runs - 1)
    return before, finish(state, sizes)


@dataclass
class Page:
    """Some levels of a tree above at most ``page`` children: nodes of each level and the states before them."""

    fan: int
    nodes: list[np.ndarray] = field(default_factory=list)
    states: list[np.ndarray] = field(default_factory=list)  # (n, 32 bytes)
    top: np.ndarray | None = None

    @classmethod
    def build(cls, children: np.ndarray, levels: int, fan: int) -> Page:
        made, at = cls(fan), children
        for _ in range(levels):
            before, above = grow(at, fan)
            made.nodes.append(at)
            made.states.append(_bytes(_packed(before)))
            at = above
        made.top = at[0]
        return made

    @classmethod
    def read(cls, n: int, levels: int, nodes: bytes, states: bytes, fan: int) -> Page:
        made, all_nodes, all_states, at = cls(fan), _bytes(nodes), _bytes(states), 0
        for _ in range(levels):
            made.nodes.append(all_nodes[at : at + n])
            made.states.append(all_states[at : at + n])
            at, n = at + n, -(-n // fan)
        return made

    def fold(self, positions: np.ndarray, digests: np.ndarray) -> np.ndarray:
        """What the top becomes if the child at a position had the digest given; each pair on its own.

        Pairs that meet in the same node with the same digest go on as one.
        """
        at, found = positions, digests
        back = np.arange(len(at))
        for nodes, states in zip(self.nodes, self.states, strict=True):
            pairs = np.concatenate([at.astype(">i8")[:, None].view(np.uint8), found], 1)
            _, first, same = np.unique(pairs, axis=0, return_index=True, return_inverse=True)
            at, found, back = at[first], found[first], same.ravel()[back]
            state = absorb(_states(states[at]), as_blocks(found))
            run, slot = at // self.fan, at % self.fan
            size = np.minimum(self.fan, len(nodes) - run * self.fan)
            for j in range(1, self.fan):
                right = np.flatnonzero((slot < j) & (j < size))
                if len(right):
                    state[:, right] = absorb(state[:, right], as_blocks(nodes[run[right] * self.fan + j]))
            at, found = run, finish(state, size)
        return found[back]

    def siblings(self, positions: np.ndarray) -> list[list[bytes]]:
        """For each position, level by level, the hex digests of the other children of its parent."""
        out, at = [[] for _ in positions], positions
        for nodes in self.nodes:
            text, low = nodes.tobytes().hex().encode(), at // self.fan * self.fan
            for row, i, start in zip(out, at.tolist(), low.tolist(), strict=True):
                row.append(text[64 * start : 64 * i] + text[64 * (i + 1) : 64 * min(start + self.fan, len(nodes))])
            at = at // self.fan
        return out

    def steps(self, position: int) -> list[dict[str, bytes]]:
        """The way from one child to the top: the state before it and its siblings, level by level."""
        out, at = [], position
        for nodes, states in zip(self.nodes, self.states, strict=True):
            low = at // self.fan * self.fan
            left, right = nodes[low:at], nodes[at + 1 : low + self.fan]
            out.append({"state": states[at].tobytes(), "left": left.tobytes(), "right": right.tobytes()})
            at //= self.fan
        return out


def climb(steps: list[dict[str, bytes]], digests: np.ndarray) -> np.ndarray:
    """Fold digests, each on its own, along one way."""
    for step in steps:
        right = _bytes(step["right"])
        state = absorb(np.repeat(_states(_bytes(step["state"])), len(digests), 1), as_blocks(digests))
        for sibling in right:
            state = absorb(state, np.repeat(as_blocks(sibling[None]), len(digests), 1))
        digests = finish(state, np.full(len(digests), len(_bytes(step["left"])) + 1 + len(right)))
    return digests


def leaf(columns: list[str], changed: dict[str, Column] | None = None) -> Column:
    """Digest of a row: each value as its UTF-8 byte count, a colon and the text, or ``-`` for null."""
    parts = []
    for name in columns:
        value = (changed or {}).get(name, F.col(name)).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _place(rows: DataFrame, order: list) -> DataFrame:
    """Rows with their position within their tree and the size of the tree.

    Rows are sorted once, by range; parts are as even as rows are, since the last sort key is a row number.
    """
    spark = rows.sparkSession
    keys = ["tree", *order, "row"]
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "merkle-rows")
    dealt = rows.repartitionByRange(partitions(spark), *keys).sortWithinPartitions(*keys).drop("row")
    dealt = written(dealt.withColumn("at", F.monotonically_increasing_id()), "merkle-sorted")
    dealt = dealt.withColumn("part", F.shiftright("at", 33))
    parts = dealt.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(
        "tree", "part", "first",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"),
        F.sum("n").over(Window.partitionBy("tree")).alias("total"),
    )
    placed = dealt.join(starts, ["tree", "part"])
    return placed.withColumn("position", F.col("start") + F.col("at") - F.col("first")).drop("at", "part", "first", "start")


def _height(fan: int, page: int) -> int:
    """Levels of a whole page."""
    height = 1
    while fan ** (height + 1) <= page:
        height += 1
    return height


def _depth(total: int, fan: int) -> int:
    depth = 0
    while total > 1:
        total, depth = -(-total // fan), depth + 1
    return depth


def _pages(nodes: DataFrame, fan: int, height: int) -> DataFrame:
    """One row for each page above ``nodes`` (tree, position, total, digest)."""

    def build(group: pa.Table) -> pa.Table:
        group = group.combine_chunks().sort_by("position")
        total, page = group.column("total")[0].as_py(), group.column("position")[0].as_py() // fan**height
        children = _bytes(b"".join(group.column("digest").to_pylist()))
        levels = min(height, _depth(total, fan))
        made = Page.build(children, levels, fan)
        row = {
            "tree": group.column("tree")[0].as_py(), "page": page, "total": total, "levels": levels,
            "nodes": b"".join(x.tobytes() for x in made.nodes), "states": b"".join(x.tobytes() for x in made.states),
            "digest": made.top.tobytes(),
        }
        return pa.Table.from_pylist([row], pa.schema(_fields(PAGES)))

    page = F.floor(F.col("position") / fan**height).alias("page")
    return nodes.select("tree", "position", "total", "digest").groupBy("tree", page).applyInArrow(build, PAGES)


def _fields(schema: str) -> list[tuple[str, pa.DataType]]:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return [(name, kinds[kind]) for name, kind in (c.split(" ") for c in schema.split(", "))]


def _tree(nodes: DataFrame, fan: int, height: int) -> tuple[list[DataFrame], DataFrame]:
    """Pages round by round, from the leaves up, and the tree and digest of each root."""
    rounds, tops = [], None
    while True:
        pages = written(_pages(nodes, fan, height), "merkle-pages")
        rounds.append(pages)
        n_pages = F.ceil(F.col("total") / fan**height)
        done = pages.filter(n_pages == 1).select("tree", "digest")
        tops = done if tops is None else tops.unionByName(done)
        nodes = pages.filter(n_pages > 1).select("tree", F.col("page").alias("position"), n_pages.alias("total"), "digest")
        if nodes.isEmpty():
            return rounds, tops


def _ways(pages: DataFrame, above: DataFrame, fan: int, height: int) -> DataFrame:
    """For each child of ``pages`` the way to the root; ``above`` has the ways of the pages that have one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                low = row["page"] * fan**height
                n = min(fan**height, row["total"] - low)
                page = Page.read(n, row["levels"], row["nodes"], row["states"], fan)
                for start in range(0, n, 1024):
                    at = range(start, min(n, start + 1024))
                    steps = [page.steps(i) + (row["steps"] or []) for i in at]
                    yield pa.RecordBatch.from_pydict(
                        {"tree": [row["tree"]] * len(at), "position": [low + i for i in at], "steps": steps},
                        pa.schema([("tree", pa.string()), ("position", pa.int64()), ("steps", pa.list_(pa.struct([(c, pa.binary()) for c in ("state", "left", "right")])))]),
                    )

    with_ways = pages.join(above.withColumnRenamed("position", "page"), ["tree", "page"], "left")
    return with_ways.select("tree", "page", "total", "levels", "nodes", "states", "steps").mapInArrow(run, PATHS)


@dataclass
class Manifest:
    """A stored tree: leaves with their places, pages by round, and for each lowest page the way to the root."""

    leaves: DataFrame  # tree, position, total, digest, offered and the key columns
    pages: list[DataFrame]  # of the groups' trees, from the leaves up
    upper: list[DataFrame]  # of the tree above the groups
    ways: DataFrame  # tree, page, steps, subroot, root of the lowest pages
    fan: int
    height: int


def manifest(
    docs: DataFrame,
    columns: list[str],
    *,
    group: str,
    key: str,
    changed: dict[str, Column] | None = None,
    fan: int = 2,
    page: int = PAGE,
) -> Manifest:
    """Build the tree of ``docs`` and store it.

    A leaf is the digest of ``columns``.  In the tree of a group leaves ascend by ``key``, null first; rows that share
    a key follow by digest, so the root does not depend on the order of the input.  Groups ascend as text by bytes,
    null first.  While several nodes remain, every ``fan`` consecutive ones become one; the last run may be shorter.
    ``changed`` gives expressions for columns of rows that someone offers in place of the stored ones.  Columns not
    named are not read.  An empty table has no leaf and no root.
    """
    height = _height(fan, page)
    tree = F.coalesce(F.concat(F.octet_length(F.col(group).cast("string")).cast("string"), F.lit(":"), F.col(group).cast("string")), F.lit("-"))
    rows = docs.select(
        F.col(key).alias("key"), F.col(group).cast("string").alias("group"), tree.alias("tree"),
        leaf(columns).alias("digest"), (leaf(columns, changed) if changed else F.lit(None).cast("binary")).alias("offered"),
    )
    leaves = written(_place(rows, [F.col("key").asc_nulls_first(), "digest"]), "merkle-leaves")
    pages, tops = _tree(leaves, fan, height)
    groups = leaves.filter("position = 0").select("tree", "group")
    subroots = groups.join(tops, "tree").select(F.lit("").alias("tree"), "group", F.col("tree").alias("below"), "digest")
    subroots = written(_place(subroots, [F.col("group").asc_nulls_first()]), "merkle-subroots")
    upper, root = _tree(subroots, fan, height)

    above = leaves.sparkSession.createDataFrame([], PATHS)
    for round_pages in reversed(upper):
        above = _ways(round_pages, above, fan, height)
    roots = root.select(F.col("tree"), F.col("digest").alias("root"))
    known = subroots.join(above, ["tree", "position"], "left").join(roots, "tree")
    above = written(known.select(F.col("below").alias("tree"), "steps", F.col("digest").alias("subroot"), "root"), "merkle-ways")
    ends = above.select("tree", "subroot", "root")
    above = above.select("tree", F.lit(0).cast("long").alias("position"), "steps")
    for depth in range(len(pages) - 1, 0, -1):
        lower = above.join(pages[depth].select("tree"), "tree", "left_anti")  # of trees that end further down
        above = written(_ways(pages[depth], above, fan, height).unionByName(lower), "merkle-ways")
    ways = above.withColumnRenamed("position", "page").join(ends, "tree")
    return Manifest(leaves, pages, upper, ways, fan, height)


PROOFS = "key long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def prove(tree: Manifest) -> DataFrame:
    """For each leaf its proof's digest, and whether the row offered in its place leads to the root.

    Returns key, leaf, subroot, root, proof_sha256 (of the siblings' digests from the leaf up, left to right),
    folded_root and verified; an offered digest that is null stands for the leaf itself.
    """
    fan, height = tree.fan, tree.height

    def run(rows: pa.Table, page: pa.Table) -> pa.Table:
        rows, page = rows.combine_chunks(), page.to_pylist()[0]
        at = rows.column("position").to_numpy() - page["page"] * fan**height
        own = _bytes(b"".join(rows.column("digest").to_pylist()))
        offered = [o or d for o, d in zip(rows.column("offered").to_pylist(), rows.column("digest").to_pylist(), strict=True)]
        found = Page.read(min(fan**height, page["total"] - page["page"] * fan**height), page["levels"], page["nodes"], page["states"], fan)
        tops, back = np.unique(found.fold(at, _bytes(b"".join(offered))), axis=0, return_inverse=True)
        folded = climb(page["steps"] or [], tops)[back.ravel()]
        above = b"".join((s["left"] + s["right"]).hex().encode() for s in page["steps"] or [])
        proofs = [hashlib.sha256(b"".join(x) + above).hexdigest() for x in found.siblings(at)]
        root, n = page["root"], len(own)
        return pa.table({
            "key": rows.column("key"), "leaf": [x.tobytes().hex() for x in own], "subroot": [page["subroot"].hex()] * n,
            "root": [root.hex()] * n, "proof_sha256": proofs, "folded_root": [x.tobytes().hex() for x in folded],
            "verified": [x.tobytes() == root for x in folded],
        })

    page = F.floor(F.col("position") / fan**height).alias("page")
    rows = tree.leaves.select("tree", page, "position", F.col("key").cast("long").alias("key"), "digest", "offered")
    pages = tree.pages[0].drop("digest").join(tree.ways, ["tree", "page"])
    return rows.groupBy("tree", "page").cogroup(pages.groupBy("tree", "page")).applyInArrow(run, PROOFS)
