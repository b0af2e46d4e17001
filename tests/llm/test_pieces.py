"""Encoding piece by piece, against the tokenizers library."""

import random

import numpy as np
import pyarrow as pa
import pytest

tokenizers = pytest.importorskip("tokenizers")
pytest.importorskip("public_tokenizers")

from marlstone.llm.catalog import vocabulary  # noqa: E402
from marlstone.llm.pieces import PieceEncoder, by_size  # noqa: E402
from marlstone.llm.token_files import library_encoder  # noqa: E402
from marlstone.llm.trie_bpe import TrieBpe  # noqa: E402

PARTS = [
    "a", "b", "the", "that", "été", "ÀÉß", "Ł", "ǅ", "ɐ", "日本", "🙂", " ", " ", " ", "  ", "\n", "\n\n", "\t", "\r", "\x1c", "\x85",
    "\xa0", " ", "'s", "'", "<|endoftext|>", "<|", "1", "42", ".", ",", "!?", "...", "-", "\x00", "́", "ª", "Ġ", "Ċ", "a" * 40,
]


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(vocabulary())


@pytest.fixture(params=["library", "trie"])
def encoder(request):
    """An encoder that remembers few pieces, and the type of its ids."""
    kept = library_encoder(vocabulary(), "uint32")._encode_many if request.param == "library" else TrieBpe(vocabulary()).encode_pieces
    return PieceEncoder(kept, limit=100)


def ids_of(found):
    return [np.frombuffer(ids, "<u4").tolist() for ids in found]


def test_pieces_agree_with_library(encoder, library):
    rng = random.Random(5)
    for _ in range(150):
        texts = [None, *("".join(rng.choices(PARTS, k=rng.randint(0, 30))) for _ in range(rng.randint(0, 20))), None, ""]
        expected = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert ids_of(encoder.encode(pa.array(texts, pa.string()))) == expected
        assert ids_of(encoder.encode(pa.array(texts, pa.string()).slice(1))) == expected[1:]
    assert encoder.encode(pa.array([], pa.string())) == []


def test_ids_of_white_space_at_the_beginning_are_not_taken_behind_a_line_break(encoder, library):
    for text in ("\xa0", "b\n\xa0", "\xa0x y", "b\n\xa0x y"):
        assert ids_of(encoder.encode(pa.array([text]))) == [library.encode(text, add_special_tokens=False).ids]


def test_a_piece_that_recurs_is_looked_up_once_a_call(encoder):
    """A word costs Python nothing where it comes again in a call."""

    class Counted(dict):
        looks = 0

        def get(self, key, default=None):
            self.looks += 1
            return super().get(key, default)

    texts = pa.array(["one two\nthree two one, two"] * 500)
    expected = encoder.encode(texts)
    encoder._known = known = Counted(encoder._known)
    assert encoder.encode(texts) == expected
    assert 0 < known.looks <= 10


def test_parts_of_a_batch_are_bounded_by_their_bytes():
    texts = ["x" * 5, None, "é" * 10, "", "z" * 3, "z" * 7]
    batch = pa.record_batch({"doc_id": range(6), "text": texts})
    parts = [*by_size(batch, "text", 10)]
    assert [p.num_rows for p in parts] == [2, 1, 3]
    assert pa.Table.from_batches(parts) == pa.Table.from_batches([batch])
    assert [p.num_rows for p in by_size(batch.slice(2), "text", 10)] == [1, 3]
    assert [*by_size(batch.slice(0, 0), "text", 10)] == []
