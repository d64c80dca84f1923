import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbline.llm import graph, neardup, ngram_join
from ebbline.llm.queries import QUERIES

from .conftest import SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def _set(text, size):
    words = WORD.findall((text or "").translate(FOLD))
    if not words:
        return set()
    size = min(size, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute_force(rows, size=5, percent=80):
    """``{(doc_id, text): (n_shingles, component_id, kept)}`` by comparing all pairs."""
    sets = [_set(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            same = rows[i][0] == rows[j][0] and a and b
            if same or a and b and 100 * (k := len(a & b)) >= percent * (len(a) + len(b) - k):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted((r[0], len(s), least[find(i)], r[0] == least[find(i)]) for i, (r, s) in enumerate(zip(rows, sets, strict=True)))


def _got(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect())


def _words(rng, n):
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def _family(rng, first, n, words=120, edits=6):
    base = _words(rng, words)
    out = []
    for i in range(n):
        own = list(base)
        for _ in range(rng.randrange(edits)):
            own[rng.randrange(words)] = f"x{rng.randrange(9999)}"
        out.append((first + i, " ".join(own)))
    return out


def test_query(spark, sample):
    rows = [(r.doc_id, r.text) for r in sample.collect()]
    assert _got(QUERIES["op9_neardup"](spark, SF)) == brute_force(rows, 2)


def test_odd_rows(documents):
    rng = random.Random(1)
    long = " ".join(_words(rng, 30000))
    rows = [(0, None), (1, ""), (2, " \n\t"), (3, "One"), (4, "oNE"), (5, "one two"), (6, "One\x0btwo"), (7, "É"), (8, "é"),
            (9, long), (10, long + " end"), (11, "a b c d e"), (11, "a b c d e"), (11, "quite another text than that"), (12, "a b c d e f")]
    docs = documents(rows).withColumns({c: F.lit("clash") for c in ("rep", "region", "component", "f", "bucket")})
    assert _got(neardup.near_duplicates(docs)) == brute_force(rows)
    assert neardup.near_duplicates(documents([])).count() == 0


@pytest.mark.parametrize("edits", [6, 14])
def test_large_regions(documents, edits):
    """A region far above the block size, with edits that keep some pairs below the threshold."""
    rng = random.Random(7)
    rows = _family(rng, 0, 150, edits=edits) + _family(rng, 1000, 40, edits=3) + [(2000 + i, " ".join(_words(rng, 60))) for i in range(30)]
    rng.shuffle(rows)
    assert _got(neardup.near_duplicates(documents(rows), 2, 80, block=16)) == brute_force(rows, 2)


def test_regions_of_repeated_rows(documents):
    """A region of less ids than a block but more rows: each row twice, and ids with many texts."""
    rng = random.Random(11)
    rows = _family(rng, 0, 14, edits=9) * 2
    rows += [(500 + i, t) for i in range(3) for _, t in _family(random.Random(12), 0, 9, edits=12)]
    docs = documents(rows).orderBy("doc_id", "text")
    assert _got(neardup.near_duplicates(docs, 2, 80, block=16)) == brute_force(rows, 2)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_pairs_across_a_cut(documents, seed):
    """Pairs that only one link joins, in a region at the block size with every row twice."""
    rng = random.Random(seed)
    base, n = _words(rng, 60), 16
    rows = []
    for i in range(n):  # a chain: neighbours differ in few words, others in more
        base = list(base)
        for k in range(3):
            base[(3 * i + k) % 60] = f"y{i}{k}"
        rows.append((rng.randrange(10**6), " ".join(base)))
    rows = rows * 2
    assert len({c for _, _, c, _ in brute_force(rows, 1)}) < n
    assert _got(neardup.near_duplicates(documents(rows), 1, 80, block=n)) == brute_force(rows, 1)


def test_pages_of_a_template(documents, monkeypatch):
    """Pages with 55 of 100 words in common chain into one region; pairs that only share those are not compared."""
    rng, asked, confirm = random.Random(17), [], ngram_join._confirm
    monkeypatch.setattr(ngram_join, "_confirm", lambda pairs, *rest: asked.append(pairs.count()) or confirm(pairs, *rest))
    shared = _words(rng, 55)
    rows = [(i, " ".join(shared + _words(rng, 45))) for i in range(300)]
    rows += [(1000 + i, t + " again") for i, t in rows[:20]] + [(2000 + i, t.rsplit(" ", 5)[0]) for i, t in rows[10:40]]
    rng.shuffle(rows)
    assert _got(neardup.near_duplicates(documents(rows), 2, 80, block=16)) == brute_force(rows, 2)
    assert asked and sum(asked) < len(rows)


def test_links_on_full_sets():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, rng.integers(20, 50))).astype(np.uint64) for _ in range(30)]
    near = neardup.linked(sets, 50)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            k = len(np.intersect1d(a, b))
            assert near[i, j] == (100 * k >= 50 * (len(a) + len(b) - k))
    assert (neardup.linked(sets[:4], 50, sets[4:]) == near[:4, 4:]).all()


def test_components(spark):
    chain = [(i, i + 1) for i in range(100)] + [(200, 300), (300, 250), (7, 7), (None, 4)]
    got = dict(map(tuple, graph.components(spark.createDataFrame(chain, "a long, b long")).collect()))
    assert got == {i: 0 for i in range(101)} | {200: 200, 250: 200, 300: 200}
