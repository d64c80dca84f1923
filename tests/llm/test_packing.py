import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from ebbline.llm import packing
from ebbline.llm.queries import QUERIES

from .conftest import SF

FILES = P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILES[0])


def _ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids + [1]


def _holds(rows, texts, library, capacity):
    """Every id of every document lies in one piece, every sequence is gapless and within its capacity."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == {i for i, _ in texts}
    expected = defaultdict(list)
    for i, t in texts:
        expected[i].append(_ids(library, t))
    for i, own in by_doc.items():
        assert sum(r.length for r in own) == sum(map(len, expected[i]))
        ids = expected[i][0]
        for r in own:
            part = np.array(ids[r.start : r.start + r.length], "<u4")
            assert (len(part), r.doc_tokens) == (r.length, len(ids))
            assert zlib.crc32(part.tobytes()) == r.ids_crc32
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert 0 < at <= capacity
    return len(by_sequence)


def test_query(spark, texts, library):
    rows = QUERIES["op4_packing"](spark, SF).collect()
    n = _holds(rows, texts.items(), library, 2048)
    tokens = sum(r.length for r in rows)
    assert n <= -(-tokens // 2048) * 1.02 + 1


def test_odd_rows(documents, library):
    rows = [(0, None), (1, ""), (2, "x"), (2, "x"), (3, "a b " * 900), (4, "<|endoftext|> z"), (5, "é" * 3000)]
    docs = documents(rows).withColumns({c: F.lit("clash") for c in ("start", "size", "rank", "offset", "_part")})
    cut = packing.pieces(docs, *FILES, capacity=64)
    assert _holds(packing.pack(cut, 64, 1).collect(), rows, library, 64) > 1
    assert packing.pack(packing.pieces(documents([]), *FILES)).count() == 0


def test_pieces_with_ids(documents, library):
    rows = packing.pieces(documents({7: "Of the thing. " * 40}), *FILES, capacity=50, with_ids=True).collect()
    assert sum((r.ids for r in sorted(rows, key=lambda r: r.start)), []) == _ids(library, "Of the thing. " * 40)


def _unpacked(ids):
    return np.frombuffer(bytes(ids), "<u4").tolist()


def _filled(rows):
    """``{sequence_id: ids}``, each piece put at its offset."""
    out = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert len(out[r.sequence_id]) == r.offset
        out[r.sequence_id] += _unpacked(r.ids)
    return out


@pytest.mark.parametrize("form", ["with_ids", "held"])
def test_sequences_hold_the_tokens(documents, library, form):
    rows = [(0, None), (1, ""), (2, "x"), (2, "x"), (3, "a b " * 900), (4, "<|endoftext|> z"), (5, "é" * 3000), (None, "y")]
    packed = packing.pack(packing.pieces(documents(rows), *FILES, capacity=64, **{form: True}), 64, 1)
    stored = packing.write_sequences(packed)
    filled = _filled(stored.collect())
    assert all(0 < len(ids) <= 64 for ids in filled.values())
    expected = sorted(sum((_ids(library, t) for _, t in rows), []))
    assert sorted(sum(filled.values(), [])) == expected
    for r in stored.collect():
        whole = _ids(library, dict(rows)[r.doc_id])
        assert _unpacked(r.ids) == whole[r.start : r.start + len(r.ids) // 4] and r.doc_tokens == len(whole)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    digests = packing.digests(stored)
    assert digests.columns == packing.pack(packing.pieces(documents(rows), *FILES)).columns
    assert sorted(map(tuple, digests.select(names).collect()), key=str) == sorted(map(tuple, packed.select(names).collect()), key=str)
    empty = packing.pack(packing.pieces(documents([]), *FILES, **{form: True}))
    assert packing.digests(packing.write_sequences(empty)).count() == 0


def test_wide_ids():
    for ids in ([], [0, 1], [65535], [65536, 3], [2**31 - 1]):
        ids = np.array(ids, "<u4")
        assert packing.expanded(packing.compressed(ids), len(ids)).tolist() == ids.tolist()


def test_pipeline_ends_in_tokens(spark, documents, library):
    rows = [(i, f"Of the thing {i}. " * 400) for i in range(5)]
    got = corpus_pipeline.pack(spark, documents(rows), SF).collect()
    by_doc = defaultdict(list)
    for r in sorted(got, key=lambda r: r.start):
        by_doc[r.doc_id] += _unpacked(r.ids)
    assert by_doc == {i: _ids(library, t) for i, t in rows}


def test_knapsack_is_best():
    rng = np.random.default_rng(3)
    for _ in range(20):
        sizes = np.unique(rng.integers(1, 12, 4))
        prices = rng.random(len(sizes))
        value, pattern = packing.best_pattern(prices, sizes, 12)
        grid = np.array(np.meshgrid(*[range(13)] * len(sizes))).reshape(len(sizes), -1)
        feasible = grid[:, sizes @ grid <= 12]
        assert value == pytest.approx((prices @ feasible).max())
        assert prices @ pattern == pytest.approx(value) and sizes @ pattern <= 12


def test_inverse():
    rng = np.random.default_rng(6)
    for n in (1, 2, 30):
        matrix = rng.integers(-3, 4, (n, n)) + 9 * np.eye(n)[rng.permutation(n)]
        assert np.allclose(packing.inverted(matrix) @ matrix, np.eye(n), atol=1e-8)


def test_plan_is_near_the_bound():
    rng = np.random.default_rng(4)
    histogram = {int(s): int(n) for s, n in enumerate(rng.integers(0, 3000, 257)) if s and n}
    runs, sequences = packing.plan(histogram, 256)
    bound = sum(s * n for s, n in histogram.items()) / 256
    assert bound <= sequences <= bound * 1.02 + 1
    assert packing.plan({}, 256) == ([], 0)


def test_hot_class(documents, library):
    rows = [(i, "word word") for i in range(3000)] + [(9000 + i, "w " * i) for i in range(60)]
    packed = packing.pack(packing.pieces(documents(rows), *FILES, capacity=64), 64, 4).collect()
    _holds(packed, rows, library, 64)
