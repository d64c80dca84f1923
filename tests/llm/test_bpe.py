import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken

from ebbline.llm import bpe
from ebbline.llm.queries import QUERIES

from .conftest import SF

PATH = P.path("byte_bpe_multi_50k.tiktoken")
ODD = [None, "", " ", "a" * 5000, "=" * 700, " " * 90, "ab" * 900, "don't  stop\n\n x", "漢字🙂é́", "<|endoftext|>"]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


@pytest.mark.parametrize("steps", [0, 50, 100_000])
def test_pieces_equal_the_library(library, steps):
    encoder = bpe.PieceEncoder(bpe.read_ranks(PATH), P.PATTERN)
    encoder.transducer.max_steps = steps
    rng = random.Random(5)
    texts = ["".join(rng.choice("abcdehinorst é漢🙂\n'12%-_") for _ in range(rng.randint(0, 50))) for _ in range(3000)]
    for text in [t or "" for t in ODD] + texts:
        assert encoder.encode(text) == library.encode_ordinary(text)
    assert len(encoder.transducer.steps) <= steps


def test_bounded_lookahead():
    """Tokens come out before the text ends."""
    machine = bpe.Transducer(bpe.read_ranks(PATH))
    state, emitted = 0, []
    for byte in b" antidisestablishmentarianism":
        state, tokens = machine._step(state, byte)
        emitted += tokens
    assert len(emitted) >= 2


def test_decoder_takes_any_portions():
    data = "aé漢🙂z".encode() + b"\xff\xe2\x82" + "ß".encode() + b"\xf0\x9f"
    for size in range(1, 6):
        machine = bpe.Utf8Machine()
        parts = [machine.feed(data[i : i + size]) for i in range(0, len(data), size)] + [machine.feed(b"", last=True)]
        assert "".join(parts) == data.decode("utf-8", "replace")
        assert all(len(p) <= size + 3 for p in parts)


def test_round_trip_of_documents(documents, library):
    docs = documents(list(enumerate(ODD)) + [(1, ""), (3, "a" * 5000)])
    encoded = bpe.encode(docs, PATH, P.PATTERN)
    assert sorted((r.doc_id, r.ids) for r in encoded.collect()) == sorted(
        (r.doc_id, library.encode_ordinary(r.text or "")) for r in docs.collect()
    )
    decoded = bpe.decode(encoded, PATH)
    assert sorted(map(tuple, decoded.collect())) == sorted((r.doc_id, r.text or "") for r in docs.collect())
    assert bpe.encode(docs.limit(0), PATH, P.PATTERN).count() == 0


def test_query_equals_the_library(spark, texts, library):
    texts = dict(texts)
    for r in QUERIES["op2_bpe"](spark, SF).collect():
        ids = library.encode_ordinary(texts.pop(r.doc_id))
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode_bytes(ids)).hexdigest()
    assert not texts
