"""Spelling variants: words one edit apart, found over a reduced alphabet.

Letters are hashed to a few symbols, so a word becomes a reduced word.  The full
one-edit neighbourhood of each reduced word is generated: every symbol replaced,
left out or inserted, at every place.  With few symbols that is a short list, and
words one edit apart have reduced words that meet in it.  Neighbours are joined
with the reduced vocabulary and the pairs found are verified on the words
themselves.

An edit leaves one half of a word as it is.  So each neighbour is joined together
with a hash of the original letters of the half that its edit does not touch, and
the many words that share a reduced word do not all meet.  Reduced words, halves
and neighbours are polynomial hashes, so the neighbourhood of a word takes room in
proportion to its length; a collision costs a comparison and nothing else.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.llm.common import written

SYMBOLS = 3
RUN = re.compile("[A-Za-zÀ-ÿ]+")
HELD = 200_000  # distinct words a task counts before it passes them on
CELLS = 1_000_000  # numbers in a matrix of neighbours
CARRIED = 64  # letters of a word up to which its keys carry it; longer words are looked up for the pairs that meet

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)


def _mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    return np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, base, np.uint64), dtype=np.uint64)])


def reduce_letters(codes: np.ndarray, symbols: int) -> np.ndarray:
    """A symbol from 1 to ``symbols`` for each code point."""
    return _mix(codes) % np.uint64(symbols) + np.uint64(1)


def _sums(codes: np.ndarray, powers: np.ndarray) -> np.ndarray:
    """Hashes of all prefixes, from the empty one on."""
    out = np.zeros((codes.shape[0], codes.shape[1] + 1), np.uint64)
    np.cumsum(codes * powers[: codes.shape[1]], axis=1, dtype=np.uint64, out=out[:, 1:])
    return out


class Reduced:
    """Words of one length, given as code points, and the keys by which they meet.

    A key stands for a reduced word, the length ``m`` of the shorter word of a pair, and a half: the first ``m // 2``
    letters or the last ``m - m // 2``.
    """

    def __init__(self, codes: np.ndarray, symbols: int):
        self.n, self.length = codes.shape
        self.symbols = symbols
        self._power, self._inverse = _powers(_BASE, self.length + 1), _powers(_INVERSE, self.length + 1)
        self._letters = reduce_letters(codes, symbols)
        self._reduced, self._own = _sums(self._letters, self._power), _sums(codes, self._power)

    def _half(self, m: int, first: bool) -> np.ndarray:
        if first:
            return _mix(self._own[:, m // 2] + np.uint64(2 * m))
        start = self.length - (m - m // 2)
        rest = (self._own[:, -1] - self._own[:, start]) * self._inverse[start]
        return _mix(rest + np.uint64(2 * m + 1))

    def keys(self) -> np.ndarray:
        """Four keys a word, under which neighbours look for it."""
        whole = self._reduced[:, -1]
        found = [_mix(whole ^ self._half(m, first)) for m in (self.length, self.length - 1) for first in (True, False)]
        return np.stack(found, 1)

    def neighbours(self) -> np.ndarray:
        """Keys of the one-edit neighbourhood, one row a word; some recur within a row."""
        at, end = self._power, np.arange(self.length + 1)
        low, whole = self._reduced, self._reduced[:, -1:]
        symbols = np.arange(1, self.symbols + 1, dtype=np.uint64)
        replaced = whole[:, :, None] + (symbols - self._letters[:, :, None]) * at[: self.length, None]
        left_out = low[:, :-1] + (whole - low[:, 1:]) * np.uint64(_INVERSE)
        inserted = (low + (whole - low) * np.uint64(_BASE))[:, :, None] + symbols * at[: self.length + 1, None]
        out = []
        for made, m in ((replaced, self.length), (left_out[:, :, None], self.length - 1), (inserted, self.length)):
            behind = (end[: made.shape[1]] >= m // 2)[None, :, None]  # the edit is in the second half
            half = np.where(behind, self._half(m, True)[:, None, None], self._half(m, False)[:, None, None])
            out.append(_mix(made ^ half).reshape(self.n, -1))
        return np.concatenate(out, 1)


KEYS = "key long, id long, word string"


def _keyed(words: DataFrame, symbols: int, neighbours: bool) -> DataFrame:
    """The keys of each word (id, word), its own or those of its neighbourhood, with the word if it is short."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = pa.compute.utf8_length(batch.column(1)).to_numpy()
            for length in np.unique(lengths):
                part = np.flatnonzero(lengths == length)
                step = max(1, CELLS // (int(length + 1) * (2 * symbols + 1)))
                for i in range(0, len(part), step):
                    chosen = batch.take(pa.array(part[i : i + step]))
                    text = "".join(chosen.column(1).to_pylist())
                    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64).reshape(chosen.num_rows, -1)
                    made = Reduced(codes, symbols)
                    found = np.sort(made.neighbours() if neighbours else made.keys(), axis=1)
                    new = np.ones(found.shape, bool)
                    new[:, 1:] = found[:, 1:] != found[:, :-1]
                    owner = pa.array(np.repeat(np.arange(chosen.num_rows), new.sum(1)))
                    carried = chosen.column(1).take(owner) if length <= CARRIED else pa.nulls(len(owner), pa.string())
                    made = [pa.array(found[new].view(np.int64)), chosen.column(0).take(owner), carried]
                    yield pa.RecordBatch.from_arrays(made, ["key", "id", "word"])

    return words.select("id", "word").mapInArrow(run, KEYS)


def count_words(docs: DataFrame, damage: int | None = None) -> DataFrame:
    """word and n: maximal runs of Latin letters of all whole texts, A to Z in lower case, counted.

    With ``damage`` a run loses a letter in documents where the CRC-32 of ``<doc_id>:<run>`` is a multiple of it: the
    one at the place that the CRC gives modulo the run's length.  A null doc_id stands there as nothing.  Null and
    empty texts have no words; the empty word that is left of a single letter is not counted.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            out = [pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())]
            total.clear()
            return pa.RecordBatch.from_arrays(out, ["word", "n"])

        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    found = Counter(RUN.findall(text.encode().lower().decode())) if text else {}
                    if damage:
                        start = zlib.crc32(b"%s:" % (b"" if doc_id is None else b"%d" % doc_id))
                        hit = [(w, h) for w in found if not (h := zlib.crc32(w.encode(), start)) % damage]
                        for word, h in hit:
                            place, n = h % len(word), found.pop(word)
                            total[word[:place] + word[place + 1 :]] += n
                    total.update(found)
                    if len(total) >= HELD:
                        yield flush()
        if total:
            yield flush()

    counted = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "word string, n long")
    return counted.filter("word <> ''").groupBy("word").agg(F.sum("n").alias("n"))


def near_pairs(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """word, n, near, near_n: all ordered pairs of distinct words (word, n) that differ by exactly one code point."""
    numbered = written(words.select(F.monotonically_increasing_id().alias("id"), "word", "n"), "words")
    mine = _keyed(numbered, symbols, neighbours=True).withColumnsRenamed({"id": "a", "word": "a_word"})
    theirs = _keyed(numbered, symbols, neighbours=False).withColumnsRenamed({"id": "b", "word": "b_word"})
    fits = F.coalesce(F.levenshtein("a_word", "b_word", 1) == 1, F.col("a") != F.col("b"))
    pairs = mine.join(theirs, (mine["key"] == theirs["key"]) & fits).select("a", "b").distinct()
    ends = numbered.select(F.col("id").alias("b"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    found = pairs.join(ends, "b").join(numbered.withColumnRenamed("id", "a"), "a")
    return found.filter(F.levenshtein("word", "near", 1) == 1).select("word", "n", "near", "near_n")


def variants(words: DataFrame, *, ratio: int = 10, symbols: int = SYMBOLS) -> DataFrame:
    """word, form, root, n, n_near, form_n for distinct ``words`` (word, n).

    ``form`` is the near word of largest n, of several the smallest in code-point order, if that n is at least
    ``ratio`` times the word's own, else null, and ``form_n`` its n.  ``root`` is the end of the way from the word
    along the forms.  ``n_near`` counts the near words.  ``ratio`` must be 2 or more, so that ways end.
    """
    if ratio < 2:
        raise ValueError("ratio must be at least 2")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    near = near_pairs(words, symbols).groupBy("word").agg(F.count("*").alias("n_near"), best)
    enough: Column = -F.col("best.less") >= ratio * F.col("n")
    forms = words.select("word", "n").join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n"),
    )
    forms = written(forms, "forms")
    # Each step multiplies n by 2 or more, and n is below 2**63: 63 steps at most, which six doublings cover.
    ways = forms.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    for _ in range(6):
        further = ways.select(F.col("word").alias("root"), F.col("root").alias("further"))
        ways = written(ways.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "ways")
    return forms.join(ways, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(
    docs: DataFrame, *, damage: int | None = None, least_letters: int = 7, least_n: int = 2, ratio: int = 10, symbols: int = SYMBOLS
) -> DataFrame:
    """Variants among the words of ``docs`` (doc_id, text); see ``count_words`` and ``variants``.

    Words are those of at least ``least_letters`` code points that occur ``least_n`` times.  Repeated rows count each
    time, further columns are not read, and an empty table has no words.
    """
    known = (F.char_length("word") >= least_letters) & (F.col("n") >= least_n)
    words = written(count_words(docs, damage).filter(known), "vocabulary")
    return variants(words, ratio=ratio, symbols=symbols)
