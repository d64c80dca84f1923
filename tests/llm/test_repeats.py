import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbline.llm import repeats
from ebbline.llm.queries import QUERIES

from .conftest import SF


def brute_force(rows, length=100):
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` from a table of every window."""
    texts = {i: (t or "").encode() for i, t in rows if i is not None}
    first = {}
    for i in sorted(texts):
        for at in range(len(texts[i]) - length + 1):
            first.setdefault(texts[i][at : at + length], (i, at))
    out = []
    for i, t in rows:
        data = (t or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for at in range(len(data) - length + 1) if i is not None else ():
            if first[data[at : at + length]] != (i, at):
                gone[at : at + length] = True
        kept = bytes(b for b, g in zip(data, gone, strict=False) if not g)
        spans = int((gone[:-1] & ~np.append(False, gone[:-2])).sum()) if data else 0
        out.append((i, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def _got(df):
    return sorted((tuple(r[:5]) for r in df.collect()), key=repr)


def test_query(spark, texts):
    assert _got(QUERIES["op3_repeats"](spark, SF)) == brute_force(texts.items())


def _random(rng, n):
    return "".join(rng.choice("abcdefgh é") for _ in range(n))


def _rows(rng):
    passages = [_random(rng, n) for n in (99, 100, 101, 140, 400, 60)]
    rows = [(i, _random(rng, rng.randrange(200)) + rng.choice(passages) + _random(rng, rng.randrange(150)) + rng.choice(passages)) for i in range(60)]
    rows += [(100, "a" * 500), (101, "b" + "a" * 300), (102, "ab" * 400), (103, "x" + "ab" * 90), (104, "%&" * 49), (105, "%&" * 50 + "z" + "%&" * 50)]
    rows += [(110, rows[3][1]), (111, rows[3][1] + "!"), (112, rows[3][1][:150] + "#" + rows[3][1][151:])]
    rows += [(120, None), (121, ""), (122, "short"), (None, rows[3][1]), (130, rows[5][1]), (130, rows[5][1])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_odd_rows(documents, monkeypatch, seed):
    monkeypatch.setattr(repeats, "CHUNK", 333)
    rows = _rows(random.Random(seed))
    docs = documents(rows).withColumns({c: F.lit("clash") for c in ("core", "span", "at", "ats", "n_bytes")})
    assert _got(repeats.digests(docs)) == brute_force(rows)
    assert repeats.digests(documents([])).count() == 0


def test_common_passage_with_other_surroundings(documents):
    """One core, as many spans as documents: only windows that really recur go."""
    rng = random.Random(4)
    line = _random(rng, 90)
    rows = [(i, _random(rng, 120) + line + _random(rng, 5) * 20) for i in range(120)]
    rows += [(500 + i, _random(rng, 120) + line + " and the same tail" + _random(rng, 50)) for i in range(40)]
    assert _got(repeats.digests(documents(rows))) == brute_force(rows)


def test_texts_without_repeats(documents):
    passage = "é" * 40 + "the same sentence in both of the documents, of some length " * 2
    rows = [(1, "one " + passage), (2, "two " + passage + " end"), (3, None), (4, "x"), (None, "two " + passage)]
    docs = documents(rows).withColumn("extra", F.lit(7))
    got = repeats.without_repeats(docs)
    assert got.columns == docs.columns
    texts = {r.doc_id: r.text for r in got.collect() if r.extra == 7 and r.source == "s"}
    assert texts == {1: "one " + passage, 2: "twoend", 3: None, 4: "x", None: "two " + passage} | {2: texts[2]}
    assert texts[2].startswith("two") and texts[2].endswith("end") and len(texts[2]) <= 9


def test_sampling_depends_on_the_window_only():
    rng = np.random.default_rng(5)
    data = rng.integers(97, 100, 4000).astype(np.uint8)
    whole = repeats.places(data, 100)
    for i in range(0, 3900, 97):
        assert repeats.places(data[i : i + 100].copy(), 100)[0] + i == whole[i]
    assert len(set(whole)) < len(whole) / 25


def test_clashing_names(documents):
    text = "".join(hashlib.sha256(bytes([i])).hexdigest() for i in range(3))
    df = documents([(1, text), (2, text)]).withColumnsRenamed({"lang": "_ats", "source": "_ATS_"})
    got = {r.doc_id: (r.text, r._ats) for r in repeats.without_repeats(df).collect()}
    assert got[1] == (text, "en") and got[2][0] == ""
