from collections import defaultdict

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from ebbline.llm import language, quality
from ebbline.session import settle

from .conftest import SF
from .test_neardup import brute_force as components
from .test_repeats import brute_force as cuts

NAMES = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november oscar papa".split()


def _stage(name, spark, docs):
    return dict(corpus_pipeline.STAGES)[name](spark, docs, SF)


@pytest.fixture(scope="module")
def stages(spark):
    """The rows after each stage."""
    rows, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for _, f in corpus_pipeline.STAGES:
        rows = settle(f(spark, rows, SF))
        out.append(rows)
    return out


def test_stages_equal_brute_force(spark, sample, stages):
    good, known, single, cut, packed = (s.collect() for s in stages)
    assert all(s.columns == sample.columns for s in stages[:4])
    verdicts = quality.judge(sample, quality.train(sample, spark.read.parquet(f"{SF}/labels.parquet"))).collect()
    assert {r.doc_id for r in good} == {r.doc_id for r in verdicts if r.kept} != set()
    rejected = language.identify(stages[0], language.train(stages[0])).where("rejected").collect()
    assert {r.doc_id for r in known} == {r.doc_id for r in good} - {r.doc_id for r in rejected}
    kept = {i for i, _, _, k in components([(r.doc_id, r.text) for r in known]) if k}
    assert {r.doc_id for r in single} == kept and len(single) == len(kept) < len(known)
    removed = {i: gone for i, _, gone, _, _ in cuts([(r.doc_id, r.text) for r in single])}
    assert {r.doc_id for r in cut} == kept
    before = {r.doc_id: r.text for r in single}
    for r in cut:
        assert len(before[r.doc_id].encode()) - len(r.text.encode()) - removed[r.doc_id] in range(0, 16)
        assert r.n_chars == len(r.text) and (r.text == before[r.doc_id]) == (not removed[r.doc_id])
    library, lengths = Tokenizer.from_file(P.path("byte_bpe_50k.json")), defaultdict(int)
    for r in packed:
        lengths[r.doc_id] += r.length
    assert lengths == {r.doc_id: len(library.encode(r.text, add_special_tokens=False).ids) + 1 for r in cut}


def test_run(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    columns = ["doc_id", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, stages[-1].select(columns).collect()))


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_odd_rows(spark, documents, name):
    text = " ".join(f"{a}{b}" for a in ("river", "mill", "stone", "field", "bridge") for b in NAMES)  # 80 words
    rows = [(0, None), (1, ""), (2, text), (2, text), (3, text), (None, text), (None, None), (4, text + " more"), (5, "x")]
    rows = [(i if i is None else i + 9000, t) for i, t in rows]  # no labels there
    docs = documents(rows).withColumns({"score": F.lit(1), "rank": F.lit("r"), "kept": F.lit(None).cast("boolean")})
    got = _stage(name, spark, docs).collect()
    ids = {r.doc_id for r in got}
    if name == "packing":
        assert ids == {9000, 9001, 9002, 9003, 9004, 9005, None}
    else:
        assert {9002, None} <= ids and _stage(name, spark, docs).columns == docs.columns
    if name == "MinHash near-dedup":
        assert sorted((r.doc_id for r in got), key=str) == [9000, 9001, 9002, 9005, None, None]
    assert _stage(name, spark, docs.limit(0)).count() == 0
