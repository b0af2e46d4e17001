"""Spelling variants, SetSketch groups and Merkle manifests against SQL, brute force and odd rows."""

import hashlib
import random
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("tokenizers")

from marlstone.llm import merkle, set_sketch  # noqa: E402
from marlstone.llm.common import ship  # noqa: E402
from marlstone.llm.part_enum import shingles  # noqa: E402
from marlstone.llm.spelling import near_pairs, spelling_variants, variants  # noqa: E402
from tests.llm.test_operators import documents  # noqa: E402


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


# Spelling variants.


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def test_near_pairs_equal_brute_force(spark):
    rng = random.Random(5)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 9))) for _ in range(400)}
    long = "x" * 300
    words |= {long, long + "y", long[1:], "q" * 64, "q" * 65, "q" * 66, "é" * 70, "é" * 69 + "e"}
    frame = spark.createDataFrame([(w, i + 1) for i, w in enumerate(sorted(words))], "word string, n long").repartition(5)
    found = {(r.word, r.near) for r in near_pairs(frame).collect()}
    assert found == {(a, b) for p in combinations(sorted(words), 2) if one_edit(*p) for a, b in (p, p[::-1])}
    assert found == {(r.word, r.near) for r in near_pairs(frame, symbols=8).collect()}


def test_forms_and_roots(spark):
    counts = {"library": 5000, "libary": 500, "libar": 40, "liba": 3, "libry": 20, "fibrary": 501, "other": 9, "othe": 1, "otheq": 9}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = {r.word: r for r in variants(frame).collect()}
    assert {w: (r.form, r.root) for w, r in found.items()} == {
        "library": (None, "library"), "libary": ("library", "library"), "libar": ("libary", "library"), "liba": ("libar", "library"),
        "libry": ("libary", "library"), "fibrary": (None, "fibrary"), "other": (None, "other"), "othe": (None, "othe"), "otheq": (None, "otheq"),
    }
    assert (found["othe"].n_near, found["liba"].form_n, found["library"].n_near) == (2, 40, 2)
    assert variants(frame.limit(0)).count() == 0


def test_spelling_of_odd_documents(spark):
    texts = [None, "", "12 34", "Straße straße STRASSE", "wordword " * 3 + "wordwort", "étude", "z" * 40000, "z" * 40000, "ÀÉàé×÷ÿ x"]
    docs = documents(spark, texts, [1, 2, 3, None, 5, 5, None, 8, 9])
    found = {r.word: (r.n, r.n_near) for r in spelling_variants(docs, least_letters=1, least_n=1).collect()}
    assert found == {
        "straße": (2, 0), "strasse": (1, 0), "wordword": (3, 1), "wordwort": (1, 1), "e": (1, 1), "tude": (1, 0),
        "z" * 40000: (2, 0), "ÀÉàé×÷ÿ": (1, 0), "x": (1, 1),
    }
    words = [f"{a}{b}tional" for a in "abcdef" for b in "ghijkl"]
    docs = documents(spark, [" ".join(words)] * 12 + [None], [*range(12), 3])
    total = Counter()
    for i in range(12):
        for w in words:
            h = zlib.crc32(f"{i}:{w}".encode())
            total[w if h % 3 else w[: h % len(w)] + w[h % len(w) + 1 :]] += 1
    found = {r.word: r.n for r in spelling_variants(docs, damage=3).collect()}
    assert found == {w: n for w, n in total.items() if len(w) >= 7 and n >= 2}


# SetSketch.


def test_registers_estimate_and_merge():
    rng = np.random.default_rng(3)
    for similarity, size in ((0.5, 200), (0.8, 1000), (0.9, 6000)):
        shared = round(2 * size * similarity / (1 + similarity))
        pool = rng.integers(0, 1 << 64, 2 * size - shared, np.uint64)
        a, b = np.unique(pool[:size]), np.unique(pool[size - shared :])
        x, y = set_sketch.registers(a), set_sketch.registers(b)
        assert (np.maximum(x, y) == set_sketch.registers(np.unique(pool))).all()
        for one, other, base in ((x, y, set_sketch.BASE), (set_sketch.coarse(x), set_sketch.coarse(y), set_sketch.BASE**set_sketch.COARSE)):
            best, behind = set_sketch.estimate(one[None], other[None], np.array([len(a)]), np.array([len(b)]), base, 80)
            assert abs(best[0] - similarity) < 0.1 and (behind[0] <= set_sketch.NATS or similarity < 0.7)
        differ = len(np.setxor1d(a, b))
        parities = np.bitwise_count((set_sketch.parities(a) ^ set_sketch.parities(b)).view(np.uint64)).sum()
        assert parities <= differ


def jaccard_groups(rows, n, percent):
    sets = [set(shingles(t, n).tolist()) for _, t in rows]
    least = list(range(len(rows)))

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        common = len(sets[i] & sets[j])
        if sets[i] and 100 * common >= percent * len(sets[i] | sets[j]):
            least[max(root(i), root(j))] = min(root(i), root(j))
    members = {}
    for i in range(len(rows)):
        members.setdefault(root(i), []).append(rows[i][0])
    smallest = {r: min((m for m in ids if m is not None), default=None) for r, ids in members.items()}
    return sorted((str(rows[i][0]), len(sets[i]), str(smallest[root(i)]), rows[i][0] == smallest[root(i)]) for i in range(len(rows)))


def test_sketch_groups_equal_brute_force(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    bases = [[word() for _ in range(rng.choice((3, 12, 60, 400)))] for _ in range(20)]
    texts = [None, "", " \t", "one", "ONE", "one two", "One  Two", "x " * 20000]
    for base in bases:
        for _ in range(12):
            copy = list(base)
            for _ in range(rng.choice((0, 1, 2, len(copy) // 10, len(copy) // 6))):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    ids = [*range(len(texts))]
    ids[9], ids[30], ids[31] = None, 7, 7
    rows = list(zip(ids, texts, strict=True))
    found = set_sketch.sketch_groups(documents(spark, texts, ids), n=2, percent=80).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in found) == jaccard_groups(rows, 2, 80)
    assert set_sketch.sketch_groups(documents(spark, [], []), n=2).count() == 0


# Merkle manifests.


def test_states_are_those_of_sha256():
    rng = np.random.default_rng(1)
    nodes = rng.integers(0, 256, (23, 32)).astype(np.uint8)
    for fan in (2, 3, 5):
        before, above = merkle.grow(nodes, fan)
        assert before.shape == (8, 23)
        for run, digest in enumerate(above):
            text = nodes[run * fan : (run + 1) * fan].tobytes().hex().encode()
            assert hashlib.sha256(text).digest() == digest.tobytes()


def tree_root(leaves, fan):
    while len(leaves) > 1:
        leaves = [hashlib.sha256("".join(leaves[i : i + fan]).encode()).hexdigest() for i in range(0, len(leaves), fan)]
    return leaves[0]


@pytest.mark.parametrize("fan, page", [(2, 4096), (2, 4), (3, 9), (5, 5)])
def test_manifest_of_odd_rows(spark, fan, page):
    rows = [(i, f"text {i}", "en") for i in range(29)] + [(5, None, None), (None, "", None), (None, "é" * 30000, "en"), (7, "a", "fr"), (7, "a", "fr"), (1, "x", "")]
    docs = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "doc_id long, text string, lang string, tree string, leaf string").repartition(4)
    changed = {"text": F.when(F.col("doc_id") % 4 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))}
    made = merkle.manifest(docs, ["doc_id", "text"], group="lang", key="doc_id", changed=changed, fan=fan, page=page)
    found = merkle.prove(made).collect()
    coded = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    digest = lambda i, t: hashlib.sha256((coded(i) + coded(t)).encode()).hexdigest()
    groups = {}
    for i, text, lang in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, digest(*r[:2]))):
        groups.setdefault(lang, []).append(digest(i, text))
    roots = [tree_root(groups[g], fan) for g in sorted(groups, key=lambda g: (g is not None, g or ""))]
    assert {r.root for r in found} == {tree_root(roots, fan)} and {r.subroot for r in found} == set(roots)
    assert Counter(r.leaf for r in found) == Counter(d for g in groups.values() for d in g)
    assert [r.verified for r in found] == [r.key is None or r.key % 4 != 0 or r.subroot != roots[2] for r in found]
    assert all(r.verified == (r.folded_root == r.root) for r in found)


def test_manifest_of_nothing_and_of_one_row(spark):
    docs = spark.createDataFrame([(1, "a", None)], "doc_id long, text string, lang string")
    alone = merkle.prove(merkle.manifest(docs, ["doc_id"], group="lang", key="doc_id")).collect()
    assert [(r.root, r.subroot, r.folded_root) for r in alone] == [(alone[0].leaf,) * 3]
    assert alone[0].proof_sha256 == hashlib.sha256(b"").hexdigest() and alone[0].verified
    assert merkle.prove(merkle.manifest(docs.limit(0), ["doc_id"], group="lang", key="doc_id")).count() == 0


def test_cut_lies_between_the_labels():
    from marlstone.llm.toxicity import _cut

    rng = np.random.default_rng(2)
    for low, high in ((-8.0, 11.0), (5.0, 12.0), (-300.0, -250.0)):
        scores = np.concatenate([rng.normal(low, 1, 200), rng.normal(high, 1, 200)])
        cut = _cut(scores, np.repeat([0, 1], 200), 0.1)
        assert low + 2 < cut < high - 1
