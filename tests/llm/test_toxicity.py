import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbline.llm import toxicity
from ebbline.llm.queries import QUERIES

from .conftest import SF

CLEAN = "the river runs along a quiet field where birds sing and children walk home {}"
TOXIC = "you are a blargish snorf and a blargoon {}"
NAMES = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november oscar papa".split()


@pytest.fixture(scope="module")
def trained(documents, spark):
    rows = [(i, CLEAN.format(NAMES[i % 16])) for i in range(60)] + [(100 + i, TOXIC.format(NAMES[i % 16])) for i in range(30)]
    labels = spark.createDataFrame([(i, 1, int(i >= 100)) for i, _ in rows] + [(7, 1, 0), (None, 1, 1), (5000, 0, 1)], "doc_id long, quality int, toxic int")
    more = [(200, None), (201, ""), (202, "..."), (203, "a blargish day"), (204, "A BLARGISH snorf"), (205, "the quiet river " * 9000)]
    docs = documents(rows + more + [(203, "a blargish day")]).withColumn("score", F.lit("clash")).withColumn("terms", F.lit(1))
    return toxicity.train(docs, labels)


def test_odd_rows(trained):
    counted, chosen, index = trained
    assert "blargish" in chosen and "^blar" in chosen and "the" not in chosen
    got = {r.doc_id: r for r in toxicity.score(counted, index).collect()}
    assert len(got) == 96
    assert got[200].score == got[201].score == got[202].score == got[205].score < 0.5
    assert got[204].score > 0.9 and got[203].predicted == 1 and got[203].neighbours
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    assert all((r.predicted == 1) == (r.doc_id >= 100) for r in got.values() if r.doc_id < 200)


def test_neighbours_are_exact():
    """The pruned search equals scoring every example."""
    rng = np.random.default_rng(2)

    class Row:
        def __init__(self, i):
            self.doc_id, self.toxic, self.words = i, int(rng.random() < 0.4), int(rng.integers(5, 400))
            n = rng.integers(1, 7)
            self.terms = sorted(rng.choice(40, n, replace=False).tolist())
            self.counts = rng.integers(1, 5, n).tolist()

    rows = [Row(i) for i in range(500)]
    index = toxicity.build(rows, 1 + rng.random(40), {0: 1.0, 1: 1.0})
    by_id = {r.doc_id: r for r in rows}
    table = np.zeros((len(index.ids), 41))
    for i, d in enumerate(index.ids):
        r = by_id[d]
        numbers, weights = index.vector(r.terms, r.counts, r.words)
        table[i, numbers] = weights
    visited = 0
    for _ in range(200):
        q = Row(-1)
        numbers, weights = index.vector(q.terms, q.counts, q.words)
        places, similar = index.nearest(numbers, weights, 10)
        scores = table[:, numbers] @ weights
        best = np.lexsort((np.arange(len(scores)), -scores.round(12)))[:10]
        assert places.tolist() == best.tolist()
        assert similar == pytest.approx(scores[best])
        visited += ((weights @ index.largest[numbers]) > similar[-1]).sum()
    assert visited < 200 * index.largest.shape[1]


def test_no_labels(documents, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    counted, chosen, index = toxicity.train(documents({1: "x", 2: None}), none)
    assert chosen == [] and index is None
    assert [r.score for r in toxicity.score(counted, index).collect()] == [0.0, 0.0]
    one = spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int")
    assert toxicity.train(documents({1: "x"}), one)[2] is None
    assert toxicity.score(toxicity.train(documents([]), one)[0], None).count() == 0


def test_query(spark, sample):
    got = {r.doc_id: r for r in QUERIES["op6_toxicity"](spark, SF).collect()}
    ids = [r.doc_id for r in sample.select("doc_id").collect()]
    assert set(got) == set(ids)
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in ids)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = QUERIES["op6_toxicity"](spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    rows = got.collect()
    hits = sum(r.toxic and r.predicted for r in rows)
    assert hits >= 0.9 * sum(r.toxic for r in rows) and hits >= 0.95 * sum(r.predicted for r in rows)
