import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from ebbline.llm import language
from ebbline.llm.queries import QUERIES

from .conftest import SF


def _trigrams(text):
    """``(second before, before, letter)`` of every position, from the definition."""
    out, word = [], ["", ""]
    for c in [*text.lower(), " "]:
        if c.isalpha():
            out.append((word[-2], word[-1], c))
            word.append(c)
        elif len(word) > 2:
            out.append((word[-2], word[-1], ""))
            word = ["", ""]
    return out


class Plain:
    """Interpolated Kneser-Ney with dictionaries."""

    def __init__(self, counts, alphabet):
        self.orders = [counts]
        for _ in range(2):
            above = self.orders[-1]
            self.orders.append(Counter(k[1:] for k in above))
        self.alphabet = alphabet
        self.discounts = []
        for c in self.orders:
            once, twice = (sum(v == k for v in c.values()) for k in (1, 2))
            self.discounts.append(min(once / (once + 2 * twice), 0.95) if once else 0.5)
        self.totals = []
        for c in self.orders:
            t = defaultdict(lambda: [0, 0])
            for k, v in c.items():
                t[k[:-1]][0] += v
                t[k[:-1]][1] += 1
            self.totals.append(t)

    def p(self, key, order=0):
        if order == 3:
            return 1 / (self.alphabet + 1)
        total, types = self.totals[order].get(key[:-1], (0, 0))
        below = self.p(key[1:], order + 1)
        if not total:
            return below
        d = self.discounts[order]
        return max(self.orders[order].get(key, 0) - d, 0) / total + d * types / total * below


TEXTS = {
    "aa": "The thin thing then, tin ten hen. Nine!",
    "bb": "Le lion et la lionne élèvent l'éléphant; voilà tout",
}


def _models():
    langs, keys, counts = [], [], []
    for lang, text in TEXTS.items():
        key, n = np.unique(language.grams(language.letters([text])[0]), return_counts=True)
        langs += [lang] * len(key)
        keys.append(key)
        counts.append(n)
    return language.build(np.array(langs, object), np.concatenate(keys), np.concatenate(counts))


def test_equals_the_definition():
    models = _models()
    alphabet = {c for t in TEXTS.values() for k in _trigrams(t) for c in k[2:]}
    plain = {lang: Plain(Counter(_trigrams(t)), len(alphabet)) for lang, t in TEXTS.items()}
    samples = [*TEXTS.values(), "Then the élan; zebra xyz lit", "nnnn q", "İstanbul"]
    h, n = models.cross_entropy(samples)
    for i, text in enumerate(samples):
        keys = _trigrams(text)
        assert n[i] == len(keys)
        for k, lang in enumerate(models.langs):
            assert h[i, k] == pytest.approx(-sum(math.log(plain[lang].p(x)) for x in keys) / len(keys), rel=1e-4)


def test_probabilities_sum_to_one():
    alphabet = {c for t in TEXTS.values() for k in _trigrams(t) for c in k[2:]}
    plain = Plain(Counter(_trigrams(TEXTS["aa"])), len(alphabet))
    for a, b in [("", ""), ("t", "h"), ("q", "q")]:
        assert sum(plain.p((a, b, c)) for c in alphabet) + plain.p((a, b, "no")) == pytest.approx(1)


def test_long_texts_and_chunks(monkeypatch):
    texts = ["".join(TEXTS.values()) * 40, "", "x", TEXTS["aa"]]
    whole, n = _models().cross_entropy(texts)
    monkeypatch.setattr(language, "CHUNK", 37)
    parts, m = _models().cross_entropy(texts)
    assert np.allclose(whole, parts, rtol=1e-5) and (n == m).all()


def test_counts_of_a_large_alphabet():
    text = "".join(chr(0x4E00 + i * 7 % 400) for i in range(3000))
    key, n = language.counted(language.grams(language.letters([text, "abc abc"])[0]))
    expected = Counter(_trigrams(text)) + Counter(_trigrams("abc abc"))
    assert sorted(n.tolist()) == sorted(expected.values())


def test_odd_rows(documents):
    rows = [(0, None), (1, ""), (2, "123 --- %%"), (3, "The thin thing"), (3, "The thin thing"), (None, "then"), (4, "the " * 50000)]
    docs = documents(rows).withColumnRenamed("source", "score")
    models = language.train(documents({i: TEXTS["aa"] for i in range(9)}, "aa").union(documents({20: TEXTS["bb"]}, "bb")))
    got = {r.doc_id: r for r in language.identify(docs, models).collect()}
    assert [got[i].lang_pred for i in (0, 1, 2, 3, None)] == ["und", "und", "und", "aa", "aa"]
    assert [got[i].rejected for i in (0, 1, 2, 3)] == [True, True, True, False]
    assert got[0].score == 0 and all(0 <= r.score <= 1 for r in got.values())
    assert language.train(documents([(0, None)])) is None
    assert [r.lang_pred for r in language.identify(docs, None).collect()] == ["und"] * len(rows)
    assert language.identify(documents([]), models).count() == 0


def test_pruned_models(documents):
    docs = documents({i: TEXTS["aa"] for i in range(5)}, "aa").union(documents({9: TEXTS["bb"]}, "bb"))
    models = language.train(docs, max_grams=25)
    assert len(models.keys[0]) <= 50 and models.cross_entropy(["the"])[0].shape == (1, len(models.langs))


def test_models_that_stay_tables(documents, monkeypatch):
    """No size of the models changes a result, and a small language beside large ones keeps all of its trigrams."""
    docs = documents({i: TEXTS["aa"] for i in range(5)}, "aa").union(documents({9: TEXTS["bb"], 10: "漢字仮名交じり文"}, "bb"))
    docs = docs.union(documents({11: "жук шёл"}, "cc"))
    held, tables = language.train(docs), language.train(docs, max_grams=25)
    assert len(held.keys[0]) > 50 and tables.langs == held.langs == ["aa", "bb", "cc"]
    odd = [None, "", "123", "zebra шёл 字", "nnnn q", "İstanbul"]
    samples = [t or "" for t in odd] + list(TEXTS.values())
    (h, n), (g, m) = held.cross_entropy(samples), tables.cross_entropy(samples)
    assert np.allclose(h, g, rtol=1e-5) and (n == m).all()
    assert np.allclose(held.usual, tables.usual, rtol=1e-5) and np.allclose(held.spread, tables.spread, rtol=1e-4)
    monkeypatch.setattr(language, "CHUNK", 40)
    asked = docs.union(documents([(20 + i, t) for i, t in enumerate(odd)] + [(20, None), (None, "the")]))
    rows = [sorted(language.identify(asked, x).collect(), key=str) for x in (held, tables)]
    for a, b in zip(*rows, strict=True):
        assert (a.doc_id, a.lang_pred, a.rejected) == (b.doc_id, b.lang_pred, b.rejected)
        assert a.score == pytest.approx(b.score, rel=1e-4) and (a.cross_entropy is None) == (b.cross_entropy is None)
        assert (a.cross_entropy or 0) == pytest.approx(b.cross_entropy or 0, rel=1e-5)
    assert {r.doc_id: r.lang_pred for r in rows[1]}[11] == "cc"
    kept = [sorted(language.keep_known(asked, x).collect(), key=str) for x in (held, tables)]
    assert kept[0] == kept[1] and 0 < len(kept[0]) < asked.count()
    clash = asked.withColumnsRenamed({"lang": "_chunk", "source": "_CHUNK_"})
    assert sorted(map(tuple, language.keep_known(clash, tables).collect()), key=str) == sorted(map(tuple, kept[1]), key=str)


def test_an_id_with_many_rows_is_one_sample(documents):
    docs = documents([(1, TEXTS["aa"] + str(i)) for i in range(40)] + [(2, TEXTS["aa"])], "aa")
    assert language.train(docs, sample=5) is not None


def test_rejects_what_was_not_learned(documents, sample):
    """Junk among what is learned does not let other languages and gibberish in."""
    rng = np.random.default_rng(5)

    def gibberish(n):
        return " ".join("".join(rng.choice(list("bcdfghjklmnpqrstvwxzaeiou"), rng.integers(2, 10))) for _ in range(n))

    rows = sample.orderBy("doc_id").collect()
    texts = {lang: [r.text.split() for r in rows if r.lang == lang and r.text] for lang in ("en", "de", "es", "fr")}
    learned = [(i, " ".join(w)) for i, w in enumerate(texts["en"])] + [(900, gibberish(400)), (901, gibberish(400).upper())]
    models = language.train(documents(learned))
    sizes = (50, 100, 200, 500)
    cut = {lang: [" ".join(w[:n]) for w in own for n in sizes if len(w) >= n] for lang, own in texts.items()}
    planted = cut["de"] + cut["es"] + cut["fr"] + [gibberish(n) for n in sizes for _ in range(5)]
    got = language.identify(documents(list(enumerate([*planted, *cut["en"]]))), models).collect()
    rejected = {r.doc_id for r in got if r.rejected}
    assert set(range(len(planted))) <= rejected
    assert len(rejected) - len(planted) <= 0.01 * len(cut["en"])


def test_query(spark, sample):
    got = {r.doc_id: r for r in QUERIES["op8_language"](spark, SF).collect()}
    import zlib

    right = []
    for r in sample.collect():
        held = zlib.crc32(str(r.doc_id).encode()) % 4 == 2
        assert got[r.doc_id].held_out == held
        right += [got[r.doc_id].lang_pred == r.lang] * held
    assert sum(right) >= 0.97 * len(right)
    assert sum(r.rejected for r in got.values()) <= 2


def test_calibrated_on_every_document(spark, documents, monkeypatch):
    """Thresholds are those of all training documents, and exact, however few values are looked at together."""
    rng = np.random.default_rng(4)
    words = TEXTS["aa"].lower().split()
    rows = [(i, " ".join(rng.choice(words, rng.integers(3, 12)))) for i in range(4300)]
    models = language.train(documents(rows, "aa"))
    h, n = models.cross_entropy([t for _, t in rows])
    assert models.usual[0] == pytest.approx(np.median(h[:, 0]), rel=1e-9)
    excess = np.sort((h[:, 0] - np.median(h[:, 0])) * np.sqrt(n))
    assert models.spread[0] == pytest.approx(language.SLACK * max(excess[int(language.USUAL * 4299)], 1.0), rel=1e-9)
    monkeypatch.setattr(language, "FEW", 3)
    monkeypatch.setattr(language, "BINS", 5)
    values = [(t, float(x)) for t in (0, 2) for x in rng.integers(0, 40, 60) / 7]
    table = spark.createDataFrame(values, "truth int, value double")
    got = language.order_statistics(table, {0: [0, 29, 30, 59], 2: [7]})
    assert got == {(t, i): sorted(v for o, v in values if o == t)[i] for t, i in [(0, 0), (0, 29), (0, 30), (0, 59), (2, 7)]}
