import itertools
import re
from collections import Counter

import numpy as np
import pytest

from ebbline.llm import quality
from ebbline.llm.queries import QUERIES

from .conftest import SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _base(text):
    """The counting rules, straight from their definition."""
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


ODD = [None, "", "\n\n", "a", "a b c", "x y x y x y x y", "a b c\na b c\n\na b c", "é é   z\x0bq", "# * <>| " * 30]


def test_counts_equal_the_definition(documents, texts):
    rows = list(enumerate([*ODD, *list(texts.values())[:60], "w " * 30000])) + [(1, ""), (1, "other")]
    got = quality.judge(documents(rows).withColumnRenamed("lang", "n_words"), None).collect()
    assert sorted((r.doc_id, *r[1:6]) for r in got) == sorted((i, *_base(t)) for i, t in rows)
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed)
    assert quality.judge(documents([]), None).count() == 0


def test_no_labels(documents, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.train(documents({0: "a b"}), none) is None
    nulls = spark.createDataFrame([(0, None, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert quality.train(documents({0: "a b"}), nulls) is None


def test_viterbi_is_best():
    rng = np.random.default_rng(1)
    for n in range(1, 8):
        score, change = rng.normal(size=(n, 2)), rng.normal(size=(2, 2))

        def total(states, score=score, change=change):
            return sum(score[i, s] for i, s in enumerate(states)) + sum(change[a, b] for a, b in itertools.pairwise(states))

        got = quality.viterbi(score, change)
        assert total(got) == pytest.approx(max(map(total, itertools.product((0, 1), repeat=n))))


def test_marks_lines(documents, spark):
    """A field trained on documents tells the lines of a mixed one apart."""
    good = "The river runs past the old mill and the children walk along it to school."
    bad = "| HOME | LOGIN | ### | $$$ | *** | HOME | LOGIN |"
    docs = documents([(i, "\n".join([good + f" {i}"] * 4)) for i in range(40)] + [(100 + i, "\n".join([bad + f" {i}"] * 4)) for i in range(40)])
    labels = spark.createDataFrame([(i, int(i < 100), 0) for i in [*range(40), *range(100, 140)]], "doc_id long, quality int, toxic int")
    field = quality.train(docs, labels)
    mixed = documents({1: "\n".join([good, good + " x", good + " y", bad, bad + " z"])})
    row = quality.judge(mixed, field, with_lines=True).collect()[0]
    assert row.boilerplate == [0, 0, 0, 1, 1] and 0.6 < row.content_share < 0.8


def test_query(spark, texts):
    got = {r.doc_id: r for r in QUERIES["op10_quality"](spark, SF).collect()}
    assert set(got) == set(texts)
    for i, r in got.items():
        assert tuple(r[1:6]) == _base(texts[i])
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    sound = [r for r in labels if not got[r.doc_id].base_failed]
    right = sum(got[r.doc_id].kept == bool(r.quality) for r in sound)
    assert right >= 0.97 * len(sound)
