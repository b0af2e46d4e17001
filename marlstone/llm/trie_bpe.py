"""Byte-level BPE by a traversal of the trie of distinct words.

The last token of a word's encoding is a state of the word's prefix: it is the
one token t that ends the prefix such that the prefix before t is encoded on its
own with a last token that stays apart from t.  So all words below a trie node
share the states on the way to it.  Words are visited in sorted order, which is
the depth-first order of their trie; only the path to the current word is held,
and each state of a shared prefix is computed once.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from marlstone.llm.common import forget, kept
from marlstone.llm.pieces import PieceEncoder

#: Fixed value: the split of byte-level BPE before its merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

NEVER = 1 << 60


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in vocabulary files: itself if printable, else one from 256 up."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in printable)
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class TrieBpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        raw = {i: bytes(letters[c] for c in token) for token, i in vocab.items() if token not in specials}
        self.bytes_of = [raw.get(i, b"") for i in range(max([*vocab.values(), *specials.values()]) + 1)]
        for token, i in specials.items():
            self.bytes_of[i] = token.encode()
        self.specials = specials
        self._special = regex.compile("|".join(regex.escape(s) for s in sorted(specials, key=len, reverse=True)) or r"(?!)")
        self._words = regex.compile(PATTERN)
        self._rank: dict[tuple[int, int], int] = {}
        self._parts: dict[int, tuple[int, int, int]] = {}  # left, right, rank of the merge that makes a token
        for rank, pair in enumerate(merges):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b, whole = vocab[left], vocab[right], vocab[left + right]
            self._rank[a, b] = rank
            self._parts.setdefault(whole, (a, b, rank))
        self._apart: dict[tuple[int, int], bool] = {}
        own = {i for i, b in raw.items() if len(b) == 1}
        for whole, (a, b, _) in self._parts.items():  # in merge order, parts come first
            if a in own and b in own and self._seam(a, b) == (a, b):
                own.add(whole)
        self._own = {raw[i]: i for i in own}  # tokens whose text is encoded as that token alone
        self._longest = max(map(len, self._own))
        self._known: dict[str, bytes] = {}

    def _seam(self, a: int, b: int) -> tuple[int, int] | None:
        """Who meets at the seam of a and b when a merge across it comes first; None if none does.

        Both tokens are built up by their merges in order of rank; a merge across the seam wins if it comes before
        the next merge on either side.
        """
        left, right = [(a, NEVER)], [(b, NEVER)]  # along the seam, with the rank of the merge that ends each
        while (p := self._parts.get(left[-1][0])) is not None:
            left.append((p[1], p[2]))
        while (p := self._parts.get(right[-1][0])) is not None:
            right.append((p[0], p[2]))
        while True:
            (x, until_x), (y, until_y) = left[-1], right[-1]
            across = self._rank.get((x, y), NEVER)
            if across < until_x and across <= until_y and across < NEVER:
                return x, y
            if until_x == NEVER and until_y == NEVER:
                return None
            (left if until_x <= until_y else right).pop()

    def _stay_apart(self, a: int, b: int) -> bool:
        found = self._apart.get((a, b))
        if found is None:
            if len(self._apart) >= 2_000_000:
                self._apart.clear()
            found = self._apart[a, b] = self._seam(a, b) is None
        return found

    def encode_words(self, words: Sequence[bytes]) -> dict[bytes, list[int]]:
        """Ids of distinct words, by one depth-first walk over their trie."""
        out: dict[bytes, list[int]] = {}
        own, longest, size = self._own, self._longest, self.bytes_of
        last, before = [-1], b""  # last[i]: last token of the first i bytes on the path
        for word in sorted(words):
            n, shared = len(word), 0
            top = min(n, len(before))
            while shared < top and word[shared] == before[shared]:
                shared += 1
            del last[shared + 1 :]
            for i in range(shared + 1, n + 1):
                for start in range(max(0, i - longest), i):
                    token = own.get(word[start:i])
                    if token is not None and (not start or self._stay_apart(last[start], token)):
                        last.append(token)
                        break
                else:
                    raise ValueError(f"no encoding of {word!r}")
            ids, i = [], n
            while i:
                ids.append(last[i])
                i -= len(size[last[i]])
            ids.reverse()
            out[word] = ids
            before = word
        return out

    def encode_pieces(self, texts: Sequence[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers; the words of all texts make one trie."""
        if len(self._known) > 300_000:
            self._known.clear()
        split = [self._split(t) for t in texts]
        new = {w for words in split for w in words if w not in self._known and w not in self.specials}
        ids = self.encode_words([w.encode() for w in new])
        known = self._known
        known.update((w, array("I", ids[w.encode()]).tobytes()) for w in new)
        for s, i in self.specials.items():
            known[s] = np.array([i], "<u4").tobytes()
        return [b"".join([known[w] for w in words]) for words in split]

    def _split(self, text: str) -> list[str]:
        out, at = [], 0
        for m in self._special.finditer(text):
            out += [*self._words.findall(text[at : m.start()]), m[0]]
            at = m.end()
        return out + self._words.findall(text[at:])

    def decode(self, ids: bytes) -> str:
        """Text of ids given as little-endian 32-bit integers; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


_CODECS: dict[str, tuple[TrieBpe, PieceEncoder]] = kept({})


def codec(path: str) -> tuple[TrieBpe, PieceEncoder]:
    """One codec a worker process."""
    if path not in _CODECS:
        forget(but=_CODECS)
        bpe = TrieBpe(path)
        _CODECS[path] = bpe, PieceEncoder(bpe.encode_pieces)
    return _CODECS[path]


def encode_decode(docs: DataFrame, tokenizer: str, *, keep_ids: bool = False) -> DataFrame:
    """Encode every whole text and decode the ids again.

    Returns doc_id, n_tokens, ids_sha256 (of the ids as little-endian unsigned 32-bit integers), decoded_sha256 and,
    with ``keep_ids``, ids and decoded.  One row for every input row, in no order: null texts count as empty, null and
    repeated doc_ids are kept, further columns are ignored, an empty table gives no rows.
    """
    more = ", ids array<int>, decoded string" if keep_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, encoder = codec(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, 32):
                part = batch.slice(at, 32)
                ids = encoder.encode(part.column(1))
                texts = [bpe.decode(x) for x in ids]
                columns = {
                    "doc_id": part.column(0),
                    "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
                    "ids_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                    "decoded_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string()),
                }
                if keep_ids:
                    columns["ids"] = pa.array([np.frombuffer(x, "<i4") for x in ids], pa.list_(pa.int32()))
                    columns["decoded"] = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_pydict(columns)

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + more
    )
