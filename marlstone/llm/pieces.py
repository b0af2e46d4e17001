"""Encoding texts piece by piece, each distinct piece once.

A byte-level tokenizer cuts a text before every space that stands between two
other characters, and around every line break that does.  The parts can be
encoded alone, and most of them recur, so their ids are kept.  Texts with other
white space next to such a place are cut only where it is safe.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

EncodeMany = Callable[[Sequence[str]], Iterable[bytes]]

_SAFE_SPACE = re.compile(r"(?<=\S) (?=\S)")


def by_size(batch: pa.RecordBatch, column: str, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most ``size`` bytes in a column of text, or a single row with more."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(ends):
        before = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
        yield batch.slice(at, end - at)
        at = end


class PieceEncoder:
    """Ids of texts as little-endian bytes; remembers between ``limit`` and twice as many pieces.

    When ``limit`` new ones are known, they become the older ones; those of them that come again are taken over, and
    the rest is forgotten at the next turn.

    A piece is known by a key: itself where it follows a space, a line break and itself where it follows that.  Texts
    are read as if a line break stood in front, whose id is taken off again.  Arrow cuts the texts, tells the pieces
    apart and puts the ids together, so that Python looks at each distinct piece of a call once.
    """

    def __init__(self, encode_many: EncodeMany, limit: int = 500_000):
        self._encode_many = encode_many
        self._limit = limit
        self._known: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._newline = next(iter(encode_many(["\n"])))

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text; a null is an empty one."""
        if len(self._known) > self._limit:
            self._known, self._older = {}, self._known
        texts = texts.cast(pa.large_string()).fill_null("")
        newline, nothing = (pa.scalar(x, pa.large_string()) for x in ("\n", ""))
        cut = pc.split_pattern(pc.binary_join_element_wise(newline, pc.replace_substring(texts, "\n", " \n"), nothing), " ")
        pieces = cut.flatten().dictionary_encode()
        keys = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = [*map(self._known.get, keys)]
        if None in ids:
            self._learn([k for k, i in zip(keys, ids) if i is None])
            ids = [*map(self._known.get, keys)]
        joined = pa.array(ids, pa.large_binary()).take(pieces.indices)
        ends = cut.offsets.to_numpy()
        _, places, data = joined.buffers()
        view, skip = memoryview(data or b""), len(self._newline)
        out = [bytes(view[a + skip : b]) for a, b in pairwise(np.frombuffer(places, np.int64)[ends].tolist())]
        if joined.null_count:
            unknown = np.flatnonzero(joined.is_null().to_numpy(zero_copy_only=False))
            for i in set((np.searchsorted(ends, unknown, "right") - 1).tolist()):
                out[i] = self._encode_safely(texts[i].as_py())
        return out

    def _encode_safely(self, text: str) -> bytes:
        """Ids of a text that white space keeps from being cut at every space and line break."""
        if not text:
            return b""
        head, *rest = _SAFE_SPACE.split(text)
        begin = next(iter(self._encode_many([head])))  # not kept: behind a line break it may have other ids
        self._learn([k for k in {*rest} if k not in self._known], safe=True)
        return begin + b"".join(map(self._known.__getitem__, rest))

    def _learn(self, new: list[str], safe: bool = False) -> None:
        """Encode distinct pieces by key, but for those that are empty or have white space at an end."""
        known, older = self._known, self._older
        if older:
            known.update((k, ids) for k, ids in zip(new, map(older.get, new), strict=True) if ids is not None)
            new = [k for k in new if k not in known]
        after_space = [k for k in new if k[:1] != "\n"]
        if len(after_space) < len(new):
            found = self._encode_new([k[1:] for k in new if k[:1] == "\n"], "", safe)
            known.update((f"\n{p}", self._newline + ids) for p, ids in found.items())
        known.update(self._encode_new(after_space, " ", safe))

    def _encode_new(self, pieces: list[str], prefix: str, safe: bool) -> dict[str, bytes]:
        if not safe:
            pieces = [p for p in pieces if p and p.strip() == p]
        # A Latin word and the punctuation behind it are encoded apart.
        ended = [p for p in pieces if p[-1] in ".,;:!?"]
        cores = {p: core for p in ended if (core := p.rstrip(".,;:!?")).isalpha() and max(core) < "\u0250"}
        alone = [p for p in pieces if p not in cores] if cores else pieces
        found = dict(zip(alone, self._encode_many([prefix + p for p in alone]), strict=True))
        known = self._known if prefix else {}
        words = [w for w in {*cores.values()} if w not in found and w not in known]
        found.update(zip(words, self._encode_many([prefix + w for w in words]), strict=True))
        ends = [*{p[len(core) :] for p, core in cores.items()}]
        tails = dict(zip(ends, self._encode_many(ends), strict=True))
        found.update((p, (found.get(core) or known[core]) + tails[p[len(core) :]]) for p, core in cores.items())
        return found
