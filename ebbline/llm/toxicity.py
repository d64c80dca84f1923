"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Terms are words and the five-character windows of a word between its boundaries (so a stem of four letters counts).
Those that a bounded labelled sample shows to go with toxic documents, beyond what chance gives, span the vector
space: a likelihood ratio above the Bonferroni bound.  A term counts by its rate among the words of the whole text; the rest of the text is one
more dimension, of equal weight in all, so that a chance hit in a long text stays near the clean ones.  Document
frequencies come from all documents.  The examples' index keeps, by term, the postings in blocks of similar examples with the
largest weight of each block; a query visits blocks by falling bound and stops once the bound is below its k-th
similarity, which gives the exact neighbours.  They vote with squared similarity; a prior keeps weak evidence weak,
and a logistic fit on the examples (each without itself) calibrates the votes.

Null texts are empty texts.  Texts without any of the terms, empty ones included, get the share that examples
without terms have; without labelled rows everything scores 0.  Equal texts get equal scores.  Of ``docs`` only
``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.llm.batches import map_columns
from ebbline.session import settle

TOXIC_DOCS, CLEAN_DOCS = 4000, 8000  # bounds of the labelled sample, those with the lowest hashes of doc_id
MAX_TERMS = 2000  # of the vector space, the most telling ones
MIN_DOCS = 3  # toxic documents a term must be in
WINDOW = 5
NEIGHBOURS = 10
BLOCK = 64
RATE = 100  # a term's frequency is taken for so many words
REST = 1.5  # weight of the rest of the text
PRIOR = 0.5  # weight of the share of toxic rows among the votes
MAX_WORDS = 300_000  # remembered by a worker

_words = re.compile(r"[^\W\d_]+").findall


def terms(word: str) -> list[str]:
    """The word and the windows of ``^word$``."""
    edged = f"^{word}$"
    return [word, *{edged[i : i + WINDOW] for i in range(len(edged) - WINDOW + 1)} - {word}]


def text_words(text: str | None) -> Counter:
    return Counter(_words((text or "").lower()))


def labelled(labels: DataFrame, toxic: int = TOXIC_DOCS, clean: int = CLEAN_DOCS) -> DataFrame:
    """``(doc_id, toxic)``: at most so many of each label."""
    rows = labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    parts = [
        rows.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
        for label, bound in ((1, toxic), (0, clean))
    ]
    return parts[0].unionByName(parts[1])


def telling_terms(docs: DataFrame, sample: DataFrame, bound: int = MAX_TERMS) -> list[str]:
    """Terms that go with toxic documents of the sample, the most telling first."""

    def work(batches):
        counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
        docs_of = Counter()
        for batch in batches:
            for text, toxic in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                docs_of[toxic] += 1
                counts[toxic].update({t for w in set(text_words(text)) for t in terms(w)})
        names = [*counts[1], *(t for t in counts[0] if t not in counts[1]), ""]
        per = [[*(counts[k][t] for t in names[:-1]), docs_of[k]] for k in (1, 0)]
        yield {"term": names, "toxic": per[0], "clean": per[1]}

    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", "toxic")
    counted = map_columns(rows, work, "term string, toxic long, clean long")
    counted = settle(counted.groupBy("term").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b")))
    totals = counted.where("term = ''").first()
    if totals is None or not totals.a or not totals.b:
        return []
    n, m = totals.a, totals.b
    tested = counted.where((F.col("a") >= MIN_DOCS) & (F.col("term") != ""))
    share = (F.col("a") + F.col("b")) / (n + m)
    ratio = F.lit(0.0)
    for seen, size in (("a", n), ("b", m)):
        for part, expected in ((F.col(seen), size * share), (size - F.col(seen), size * (1 - share))):
            ratio = ratio + F.when((part > 0) & (expected > 0), 2 * part * F.log(part / expected)).otherwise(0)
    least = 2 * np.log(max(tested.count(), 2))
    telling = tested.withColumn("ratio", ratio).where((F.col("ratio") > least) & (F.col("a") / n > 3 * F.col("b") / m))
    return [r.term for r in telling.orderBy(F.desc("ratio"), "term").limit(bound).collect()]


class WordTerms(dict):
    """Word: the numbers of its terms among the chosen ones."""

    def __init__(self, chosen: list[str]):
        self.number = {t: i for i, t in enumerate(chosen)}

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= MAX_WORDS:
            self.clear()
        found = self[word] = tuple(self.number[t] for t in terms(word) if t in self.number)
        return found


def term_counts(docs: DataFrame, chosen: list[str]) -> DataFrame:
    """``(doc_id, terms, counts, words)``: how often each document has each chosen term, by number."""

    def work(batches):
        lookup = WordTerms(chosen)
        for batch in batches:
            numbers, counts, sizes = [], [], []
            for text in batch.column(1).to_pylist():
                own: Counter = Counter()
                words = text_words(text)
                sizes.append(sum(words.values()))
                for word, n in words.items():
                    for t in lookup[word]:
                        own[t] += n
                numbers.append(sorted(own))
                counts.append([own[t] for t in numbers[-1]])
            yield {"doc_id": batch.column(0), "terms": numbers, "counts": counts, "words": sizes}

    schema = "doc_id long, terms array<int>, counts array<int>, words long"
    return map_columns(docs.select("doc_id", "text"), work, schema)


@dataclass
class Index:
    """Examples by block of similar ones: the block's terms, its dense weights, and the largest weight by term."""

    idf: np.ndarray
    ids: np.ndarray
    toxic: np.ndarray
    weight: np.ndarray  # rows that an example stands for
    blocks: list[tuple[np.ndarray, np.ndarray]]
    largest: np.ndarray  # (term, block)
    share: float  # of toxic rows
    bare: float  # of toxic rows among those without terms
    slope: float = 1.0
    shift: float = 0.0

    def vector(self, numbers, counts, words) -> tuple[np.ndarray, np.ndarray]:
        """Dimensions and weights; the last dimension is the rest of the text."""
        weights = np.log1p(RATE * np.asarray(counts, float) / words) * self.idf[np.asarray(numbers, int)]
        numbers, weights = np.append(np.asarray(numbers, int), len(self.idf)), np.append(weights, REST)
        return numbers, weights / np.sqrt((weights**2).sum())

    def nearest(self, numbers: np.ndarray, weights: np.ndarray, k: int, but: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Places and similarities of the ``k`` nearest examples (ties: the earlier place) other than ``but``."""
        bounds = weights @ self.largest[numbers]
        places, found, least = np.zeros(0, int), np.zeros(0), -1.0
        for b in np.argsort(-bounds, kind="stable"):
            if bounds[b] <= 0 or len(found) == k and bounds[b] < least - 1e-9:
                break
            own, dense = self.blocks[b]
            at = np.minimum(np.searchsorted(own, numbers), len(own) - 1)
            has = own[at] == numbers
            scores = dense[:, at[has]] @ weights[has]
            here = np.arange(b * BLOCK, b * BLOCK + len(scores))
            good = (scores > 0) & (here != but)
            places, found = np.append(places, here[good]), np.append(found, scores[good])
            order = np.lexsort((places, -found.round(12)))[:k]
            places, found = places[order], found[order]
            least = found[-1] if len(found) else -1.0
        return places, found

    def votes(self, places: np.ndarray, similar: np.ndarray) -> float:
        power = similar**2 * self.weight[places]
        return float((power @ self.toxic[places] + PRIOR * self.share) / (power.sum() + PRIOR))

    def score(self, votes: float) -> float:
        return float(1 / (1 + np.exp(-self.slope * logit(votes) - self.shift)))


def logit(p):
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def build(examples: list, idf: np.ndarray, weights: dict[int, float]) -> Index:
    """``examples``: rows with ``doc_id, toxic, terms, counts, words``; ``weights``: by label, rows an example stands for."""
    bare = [weights[r.toxic] * np.array([r.toxic, 1]) for r in examples if not r.terms]
    total = sum(weights[r.toxic] for r in examples)
    share = sum(weights[1] for r in examples if r.toxic) / total
    hits, rows = np.sum(bare, axis=0) if bare else (0, 0)
    index = Index(idf, *[np.zeros(0)] * 3, [], np.zeros((len(idf) + 1, 0)), share, (hits + share) / (rows + 1))
    told = [(r, *index.vector(r.terms, r.counts, r.words)) for r in examples if r.terms]
    if not told:
        return index
    told.sort(key=lambda x: (int(x[1][x[2][:-1].argmax()]), -float(x[2][:-1].max()), x[0].doc_id))  # like with like
    index.ids = np.array([r.doc_id for r, _, _ in told])
    index.toxic = np.array([r.toxic for r, _, _ in told], float)
    mean = sum(weights.values()) / 2
    index.weight = np.array([weights[r.toxic] / mean for r, _, _ in told])
    index.largest = np.zeros((len(idf) + 1, -(-len(told) // BLOCK)))
    for b in range(index.largest.shape[1]):
        some = told[b * BLOCK : (b + 1) * BLOCK]
        own = np.unique(np.concatenate([n for _, n, _ in some]))
        dense = np.zeros((len(some), len(own)))
        for i, (_, n, w) in enumerate(some):
            dense[i, np.searchsorted(own, n)] = w
        index.blocks.append((own, dense))
        index.largest[own, b] = dense.max(axis=0)
    votes = np.array([index.votes(*index.nearest(n, w, NEIGHBOURS, i)) for i, (_, n, w) in enumerate(told)])
    index.slope, index.shift = _calibration(logit(votes), index.toxic, index.weight)
    return index


def _calibration(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic fit, drawn towards 1 and 0, by Newton's method."""
    design, at = np.stack([x, np.ones_like(x)], axis=1), np.array([1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-design @ at))
        slope = design.T @ (weight * (y - p)) - (at - [1.0, 0.0])
        curve = (design * (weight * p * (1 - p))[:, None]).T @ design + np.eye(2)
        step = np.linalg.solve(curve, slope)
        at = at + step / max(1.0, np.abs(step).max())
    return float(max(at[0], 0.05)), float(at[1])


def train(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, list[str], Index | None]:
    """Term counts of all documents (written), the terms, and the index of the labelled examples among them."""
    sample = labelled(labels)
    sample = settle(sample)
    chosen = telling_terms(docs, sample)
    counted = settle(term_counts(docs, chosen))
    n = counted.count()
    frequency = counted.select(F.explode("terms").alias("t")).groupBy("t").count().collect()  # MAX_TERMS rows at most
    idf = np.full(len(chosen), np.log(n + 1.0) + 1)
    for t, df in frequency:
        idf[t] = np.log((n + 1) / (df + 1)) + 1
    one = counted.join(F.broadcast(sample), "doc_id").dropDuplicates(["doc_id"])
    examples = sorted(one.collect(), key=lambda r: r.doc_id)  # the sample's bound
    sizes = {r["toxic"]: r["count"] for r in labels.groupBy("toxic").count().collect()}
    drawn = Counter(r.toxic for r in examples)
    if len(drawn) < 2:
        return counted, chosen, None
    weights = {k: max(sizes[k], drawn[k]) / drawn[k] for k in (0, 1)}
    return counted, chosen, build(examples, idf, weights)


def score(counted: DataFrame, index: Index | None) -> DataFrame:
    """``score``, ``predicted`` and the evidence: the nearest examples and their similarities."""

    def work(batches):
        known: dict[tuple, tuple] = {}
        for batch in batches:
            out = []
            for numbers, counts, words in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True):
                if index is None:
                    out.append((0.0, [], []))
                elif not numbers or not index.blocks:
                    out.append((index.bare, [], []))
                else:
                    key = (words, *numbers, *counts)
                    if key not in known:
                        if len(known) >= MAX_WORDS // 10:
                            known.clear()
                        places, similar = index.nearest(*index.vector(numbers, counts, words), NEIGHBOURS)
                        value = index.score(index.votes(places, similar))
                        known[key] = value, index.ids[places].tolist(), similar.tolist()
                    out.append(known[key])
            columns = zip(*out, strict=True) if out else [[]] * 3
            yield {"doc_id": batch.column(0)} | dict(zip(("score", "neighbours", "similarities"), columns, strict=True))

    schema = "doc_id long, score double, neighbours array<long>, similarities array<double>"
    rows = map_columns(counted.select("doc_id", "terms", "counts", "words"), work, schema)
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
