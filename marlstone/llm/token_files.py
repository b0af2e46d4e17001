"""Token ids as Arrow stream files of equal-length sequences and masks.

A shard is one file holding an Arrow stream.  Its schema is

    ids   fixed_size_list<uint16 or uint32>[length]
    mask  fixed_size_list<bool>[length]     true: a token, false: padding

and every batch but the last holds the same number of sequences.  Documents
follow one another without gaps, so only the end of a shard is padded.  Nothing
is compressed: a reader maps the file and gets every sequence as a view on it.
Beside it, a second stream tells where each document begins (doc_id, offset in
the shard, n_tokens).

Shards are made by range partitioning on doc_id, so they are encoded once and
without knowing what stands before them; the counts that the tasks return give
each shard its place.  A task writes to names of its own and returns them, so a
repeated or lost attempt leaves files that nothing refers to.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.ipc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm.common import forget, kept, new_path, open_folder, partitions, unique_name, written
from marlstone.llm.pieces import PieceEncoder, by_size

MANIFEST = "first_id long, first_row long, ids_file string, docs_file string, n_docs long, n_ids long"
DOCS = pa.schema([("doc_id", pa.int64()), ("offset", pa.int64()), ("n_tokens", pa.int64())])

#: Letters below U+0250, behind a space or not.
_LATIN_WORD = re.compile(" ?[A-Za-z\u00AA\u00B5\u00BA\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F]+").fullmatch

_ENCODERS: dict[tuple, PieceEncoder] = kept({})


def library_encoder(path: str, dtype: str) -> PieceEncoder:
    """The tokenizers library behind a memory of pieces, one per worker process."""
    if (path, dtype) not in _ENCODERS:
        forget(but=_ENCODERS)
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the cores
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        table = np.arange(tokenizer.get_vocab_size(), dtype=dtype)
        as_bytes = [i.tobytes() for i in table]  # ids of the vocabulary as they are written
        model, letters = tokenizer.model, _byte_letters()
        whole_words = _keeps_words_whole(path)

        def by_model(words: list[str]) -> list[bytes]:
            """Latin words, each one piece for the model; giving them directly spares the rest of the library's way."""
            if not words:
                return []
            lines = "\n".join(words).encode().decode("latin-1")
            for byte, letter in letters:
                lines = lines.replace(byte, letter)
            made = map(model.tokenize, lines.split("\n"))
            return [as_bytes[found[0].id] if len(found) == 1 else b"".join([as_bytes[t.id] for t in found]) for found in made]

        def by_library(texts: list[str]) -> list[bytes]:
            made = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            return [b"".join([as_bytes[i] for i in found.ids]) for found in made]

        def encode_many(texts: Sequence[str]) -> list[bytes]:
            words = [*filter(_LATIN_WORD, texts)] if whole_words else []
            if len(words) == len(texts):
                return by_model(words)
            others = [t for t in texts if not _LATIN_WORD(t)] if words else texts
            made = dict(zip(words, by_model(words), strict=True)) | dict(zip(others, by_library(others), strict=True))
            return [made[t] for t in texts]

        _ENCODERS[path, dtype] = PieceEncoder(encode_many, limit=350_000)  # a call with megabytes of text may pass it by a third
    return _ENCODERS[path, dtype]


def _byte_letters() -> list[tuple[str, str]]:
    """Bytes and the letters that stand for them in a byte-level vocabulary, but for line breaks and bytes that stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return [(chr(b), chr(256 + i)) for i, b in enumerate(others) if b != ord("\n")]


def _keeps_words_whole(path: str) -> bool:
    """Does the tokenizer hand letters with a space in front to its model in one piece, unchanged?"""
    with open(path, encoding="utf-8") as file:
        made = json.load(file)
    split = made.get("pre_tokenizer") or {}
    plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
    added = any(t["content"].strip().isalpha() for t in made.get("added_tokens", ()))
    return bool(plain and not made.get("normalizer") and not added)


class ShardWriter:
    """Appends documents to one shard; holds at most one batch of sequences."""

    def __init__(self, folder: str, length: int, rows: int, dtype: str, end_id: int):
        self._fs, base = open_folder(folder)
        self._fs.create_dir(base, recursive=True)
        name = unique_name("shard")
        self.ids_file, self.docs_file = f"{name}.ids.arrows", f"{name}.docs.arrows"
        self._length, self._rows, self._dtype = length, rows, np.dtype(dtype)
        self._end = np.array([end_id], self._dtype).tobytes()
        kind = pa.from_numpy_dtype(self._dtype)
        self._schema = pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])
        self._out = self._fs.open_output_stream(f"{base}/{self.ids_file}")
        self._docs_out = self._fs.open_output_stream(f"{base}/{self.docs_file}")
        self._ids = pa.ipc.new_stream(self._out, self._schema)
        self._docs = pa.ipc.new_stream(self._docs_out, DOCS)
        self._buffer, self._places = bytearray(), []
        self.n_ids = self.n_docs = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        ids += self._end
        n = len(ids) // self._dtype.itemsize
        self._places.append((doc_id, self.n_ids, n))
        self.n_ids, self.n_docs = self.n_ids + n, self.n_docs + 1
        self._buffer += ids
        full = self._length * self._rows * self._dtype.itemsize
        at = 0
        while len(self._buffer) - at >= full:
            self._batch(bytes(self._buffer[at : at + full]))
            at += full
        if at:
            del self._buffer[:at]
        if len(self._places) >= 50_000:
            self._index()

    def _batch(self, data: bytes) -> None:
        ids = np.frombuffer(data, self._dtype)
        real = len(ids)
        ids = np.pad(ids, (0, -real % self._length))
        columns = [
            pa.FixedSizeListArray.from_arrays(pa.array(x), self._length) for x in (ids, np.arange(len(ids)) < real)
        ]
        self._ids.write_batch(pa.record_batch(columns, schema=self._schema))

    def _index(self) -> None:
        self._docs.write_batch(pa.RecordBatch.from_pylist([dict(zip(DOCS.names, p, strict=True)) for p in self._places], DOCS))
        self._places = []

    def close(self) -> None:
        if self._buffer:
            self._batch(bytes(self._buffer))
        if self._places:
            self._index()
        for x in (self._ids, self._docs, self._out, self._docs_out):
            x.close()


class SequenceFile:
    """Random access to a shard; on a local or mounted file every answer is a view on the mapped file."""

    def __init__(self, folder: str, name: str):
        fs, base = open_folder(folder)
        local = isinstance(fs, pa.fs.LocalFileSystem)
        source = pa.memory_map(f"{base}/{name}") if local else fs.open_input_file(f"{base}/{name}")
        self._batches = list(pa.ipc.open_stream(source))
        self._rows = self._batches[0].num_rows if self._batches else 1

    def __len__(self) -> int:
        return sum(b.num_rows for b in self._batches)

    def _column(self, i: int, name: str) -> pa.Array:
        if not 0 <= i < len(self):
            raise IndexError(i)
        return self._batches[i // self._rows].column(name)[i % self._rows].values

    def ids(self, i: int) -> np.ndarray:
        return self._column(i, "ids").to_numpy(zero_copy_only=True)

    def mask(self, i: int) -> pa.Array:
        return self._column(i, "mask")


def write_shards(
    docs: DataFrame,
    tokenizer: str,
    folder: str,
    *,
    end_id: int = 2,
    length: int = 2048,
    rows: int = 32,
    dtype: str = "uint16",
) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into shards under ``folder``; returns the manifest, one row a shard.

    Texts are encoded whole; a null or empty one is just its end id.  A null doc_id comes first and stays null.
    Rows that share a doc_id follow in input order.  Columns other than the two are not read.  An empty table gives
    no shard.  ``dtype`` must hold every id; ``length`` and ``rows`` set the size of sequences and batches.
    """
    spark = docs.sparkSession

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, writer, first = library_encoder(tokenizer, dtype), None, None
        for batch in batches:
            for part in by_size(batch, "text"):
                doc_ids = part.column(0).to_pylist()
                if writer is None:
                    writer = ShardWriter(folder, length, rows, dtype, end_id)
                    first = (doc_ids[0], part.column(2)[0].as_py())
                for doc_id, ids in zip(doc_ids, encoder.encode(part.column(1)), strict=True):
                    writer.add(doc_id, ids)
        if writer is not None:
            writer.close()
            row = [*first, writer.ids_file, writer.docs_file, writer.n_docs, writer.n_ids]
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], pa.string() if isinstance(v, str) else pa.int64()) for v in row],
                ["first_id", "first_row", "ids_file", "docs_file", "n_docs", "n_ids"],
            )

    ordered = (
        docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
        .repartitionByRange(partitions(spark), "doc_id", "row")
        .sortWithinPartitions("doc_id", "row")
    )
    return written(ordered.mapInArrow(encode, MANIFEST), "shards")


def read_shards(manifest: DataFrame, folder: str) -> DataFrame:
    """Documents as the shards hold them: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before; the CRC is that of the ids as little-endian unsigned 32-bit
    integers.  The driver sees one manifest row a shard, no documents.
    """
    spark = manifest.sparkSession
    places, start = [], 0
    for r in sorted(manifest.collect(), key=lambda r: (r.first_id is not None, r.first_id or 0, r.first_row)):
        places.append((r.ids_file, r.docs_file, start))
        start += r.n_ids
    shards = spark.createDataFrame(places, "ids_file string, docs_file string, start long")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_folder(folder)
        for batch in batches:
            for shard in batch.to_pylist():
                with fs.open_input_stream(f"{base}/{shard['ids_file']}") as a, fs.open_input_stream(f"{base}/{shard['docs_file']}") as b:
                    ids = _IdReader(pa.ipc.open_stream(a))
                    for places in pa.ipc.open_stream(b):
                        sizes = places.column("n_tokens").to_pylist()
                        sums = [ids.checksum(n) for n in sizes]
                        starts = pa.compute.add(places.column("offset"), shard["start"])
                        yield pa.RecordBatch.from_arrays(
                            [places.column("doc_id"), starts, places.column("n_tokens"), pa.array(sums, pa.int64())],
                            ["doc_id", "start", "n_tokens", "ids_crc32"],
                        )

    return shards.repartition(max(1, min(len(places), partitions(spark)))).mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


class _IdReader:
    """Takes runs of tokens from a stream of sequences, one batch in memory at a time."""

    def __init__(self, stream: pa.ipc.RecordBatchStreamReader):
        self._stream = iter(stream)
        self._left = np.empty(0, np.uint32)

    def checksum(self, n: int) -> int:
        crc = 0
        while n:
            if not len(self._left):
                batch = next(self._stream)
                ids, mask = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("ids", "mask"))
                self._left = ids[mask].astype("<u4")
            part, self._left = self._left[:n], self._left[n:]
            crc = zlib.crc32(part, crc)
            n -= len(part)
        return crc


def token_files(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Write ``docs`` to a new shared folder and return what the files hold."""
    folder = new_path(docs.sparkSession, "tokens")
    return read_shards(write_shards(docs, tokenizer, folder, **options), folder)
