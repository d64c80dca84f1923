import random
import re

import duckdb
import numpy as np
import pytest

from ebbline.llm import ngram_join
from ebbline.llm.queries import QUERIES, SQL

from .conftest import SF


def shingles(text, size):
    fold = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", fold)
    size = min(size, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


def brute_force(rows, size, percent):
    """Every pair compared; rows of one id are one document."""
    sets = [(i, shingles(t, size)) for i, t in rows]
    least = {i: i for i, _ in rows if i is not None}

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for i, a in sets:
        for j, b in sets:
            if i is not None and j is not None and i < j and a and b and 100 * len(a & b) >= percent * len(a | b):
                low, high = sorted((root(i), root(j)))
                least[high] = low
    return [(i, len(s), None if i is None else root(i) if s else i) for i, s in sets]


def _sorted(rows):
    return sorted(map(tuple, rows), key=repr)


def _check(df, rows, size=3, percent=90):
    got = ngram_join.jaccard_components(df, size, percent)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert _sorted(got.collect()) == _sorted(brute_force(rows, size, percent))


def edited(rng, words, n, vocabulary):
    out = list(words)
    for _ in range(n):
        at = rng.randrange(len(out))
        what = rng.random()
        if what < 0.6:
            out[at] = rng.choice(vocabulary)
        elif what < 0.8:
            del out[at]
        else:
            out.insert(at, rng.choice(vocabulary))
    return out


def families(seed=5, copies=60):
    """Groups of near-copies around the threshold, templates, short texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, i = [], 0
    for length in (20, 45, 130, 300):
        base = [rng.choice(vocabulary) for _ in range(length)]
        for _ in range(copies):
            i += rng.randrange(1, 4)
            rows.append((i, " ".join(edited(rng, base, rng.randrange(0, 1 + length // 25), vocabulary))))
    template = [rng.choice(vocabulary) for _ in range(60)]
    for _ in range(40):
        i += 1
        rows.append((i, " ".join(template + [rng.choice(vocabulary) for _ in range(30)])))
    for k in range(12):
        i += 1
        rows.append((i, " ".join(rng.choice("abc") for _ in range(k % 5))))
    rng.shuffle(rows)
    return rows


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    df = QUERIES["op13_ngram_join"](spark, SF)
    assert _sorted(df.collect()) == _sorted(con.execute(SQL["op13_ngram_join"]).fetchall())


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80), (2, 60)])
def test_equals_all_pairs(spark, documents, size, percent):
    rows = families()
    _check(documents(rows), rows, size, percent)


def test_blocks_and_tiles(spark, documents, monkeypatch):
    """Posting lists cut into many blocks, groups into many tiles: no pair is lost."""
    monkeypatch.setattr(ngram_join, "TILE", 3)
    whole = ngram_join.candidates
    monkeypatch.setattr(ngram_join, "candidates", lambda kernels, percent: whole(kernels, percent, block=2))
    rows = families(9, 30)
    _check(documents(rows).repartition(7), rows)


def test_odd_rows(spark, documents):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "One"), (5, "one"), (6, "one two"), (7, "ONE\ttwo"), (8, "É a b"), (9, "é a b")]
    long_ = " ".join(f"x{i % 977} y{i}" for i in range(20_000))
    rows += [(20, long_), (21, long_ + " more"), (None, "one two"), (None, None)]
    rows += [(30, "p q r s"), (30, "p q r s"), (31, "k l m n"), (31, "one two"), (32, "K L m n")]
    df = documents(rows)
    _check(df, rows)
    clash = df.withColumnsRenamed({"lang": "f", "source": "tokens", "n_chars": "rep"})
    _check(clash, rows)
    assert ngram_join.jaccard_components(df.limit(0)).count() == 0
    _check(documents([(7, None)]), [(7, None)])


def test_a_chosen_level_keeps_the_bound():
    """A set and a similar one share at least the lower level of shingles in their prefixes, whatever the counts."""
    rng = np.random.default_rng(3)
    for _ in range(300):
        n, lacking = int(rng.integers(2, 120)), rng.integers(0, 12)
        a = rng.permutation(1000)[:n]
        b = np.unique(np.append(rng.permutation(a)[: max(1, n - lacking)], rng.integers(1000, 2000, rng.integers(0, 6))))
        shared = len(np.intersect1d(a, b))
        if 100 * shared < 90 * (len(a) + len(b) - shared):
            continue
        counts = np.sort(rng.integers(1, 50, 2000))  # the order of all shingles is their number
        prefixes = []
        for x in (np.sort(a), b):
            lone = counts[x] == 1
            common = set(np.intersect1d(a, b))
            lone &= np.array([v not in common for v in x])
            x = np.append(x[lone], x[~lone])
            chosen, length = ngram_join.level(counts[x[lone.sum() :]], len(x), 90)
            prefixes.append((chosen, set(x[lone.sum() :][:length].tolist())))
        (l, p), (m, q) = prefixes
        assert len(p & q) >= min(l, m)


def test_a_run_cut_by_batches():
    import pyarrow as pa

    def met(*batches):
        out = {}
        for columns in ngram_join._met(pa.RecordBatch.from_pydict({"token": t, "f": f}) for t, f in batches):
            for i, n in zip(columns["f"], columns["hits"], strict=True):
                out[int(i)] = out.get(int(i), 0) + int(n)
        return out

    one = met(([1, 2, 2, 3, 4, 5, 5, 9], [10, 11, 12, 13, 14, 15, 16, 17]))
    assert one == {10: 1, 11: 1, 12: 1, 15: 1, 16: 1, 17: 1}  # the ends of a partition count
    assert met(([1, 2], [10, 11]), ([2], [12]), ([3, 4], [13, 14]), ([5, 5], [15, 16]), ([9], [17])) == one


@pytest.mark.parametrize("seed", [1, 2])
def test_components_given(spark, seed):
    """Sets that share all but shingles of their own, some joined before: the edges join what is linked."""
    rng = random.Random(seed)
    cores = [rng.sample(range(k * 1000, k * 1000 + 300), 80) for k in range(4)]
    sets = {f: set(rng.choice(cores)) | {-100 * f - i for i in range(1, rng.choice([2, 9, 11, 13, 24]))} for f in range(70)}
    comps = {f: rng.choice([f, f, f, f // 9 * 9, 7]) for f in sets}
    rows = [(f, 5000 + f, len(x), sorted(x), comps[f]) for f, x in sets.items()]
    df = spark.createDataFrame(rows, "f long, rep long, n long, tokens array<long>, comp long")
    edges = [(a - 5000, b - 5000) for a, b in map(tuple, ngram_join.joining(df, 80).collect())]
    near = [(a, b) for a, x in sets.items() for b, y in sets.items() if a < b and 100 * len(x & y) >= 80 * len(x | y)]
    assert set(edges) <= set(near) | {(b, a) for a, b in near}

    def joined(pairs):
        least = dict(comps)
        while True:
            before = dict(least)
            for a, b in pairs:
                low = min(least[a], least[b])
                least = {f: low if c in (least[a], least[b]) else c for f, c in least.items()}
            if before == least:
                return least

    assert joined(edges) == joined(near)
