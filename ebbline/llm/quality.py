"""Quality rules: a linear-chain conditional random field marks each line as content or boilerplate.

The field is trained here, on a bounded sample of labelled documents.  Labels speak of documents, not of lines, so
line labels are made first: lines of good documents are content; of a bad document's lines, those that a plain
logistic fit finds likelier bad than good are boilerplate (the worst one in any case).  Then the field is fitted to
these by its exact gradient (forward-backward), and every line of every text is labelled by Viterbi decoding.  The
share of words in content lines decides, after counting rules that need no model.

A null or empty text has no words and fails the counting rules.  Without labelled rows every line is content.
Equal rows get equal verdicts.  Of ``docs`` only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.llm.batches import keep_rows, map_columns

TRAINING_DOCS = 2000  # bound of the labelled sample, those with the lowest hashes of doc_id
CHAIN = 32  # lines of a training sequence; longer documents give several
ROUNDS = 100
MIN_WORDS = 50
MAX_REPEATED = 50  # percent of the words
MIN_CONTENT = 0.5  # share of the words

SPACES = " \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"
_BYTES = bytes(range(256))
_NOT_UPPER = bytes(b for b in _BYTES if not 65 <= b <= 90)
_NOT_LETTER = bytes(b for b in _BYTES if not (65 <= b <= 90 or 97 <= b <= 122 or b >= 128))
_NOT_SYMBOL = bytes(b for b in _BYTES if b not in SYMBOLS)
_NOT_DIGIT = bytes(b for b in _BYTES if not 48 <= b <= 57)

FEATURES = (
    "bias short long upper shouted symbols many_symbols bars bangs digits few_letters "
    "few_distinct hardly_distinct long_words short_words repeated_line no_end"
).split()


def line_features(line: bytes, words: list[bytes], repeated: bool) -> list[float]:
    size, n = len(line), len(words)
    upper, symbols = len(line.translate(None, _NOT_UPPER)), len(line.translate(None, _NOT_SYMBOL))
    digits, letters = len(line.translate(None, _NOT_DIGIT)), len(line.translate(None, _NOT_LETTER))
    distinct, mean = len(set(words)) / n, size / n
    return [
        1.0,
        n < 4,
        n > 40,
        upper / size,
        upper > 0.5 * max(letters, 1),
        symbols > 0.02 * size,
        symbols > 0.08 * size,
        line.count(b"|") > 0.02 * size,
        line.count(b"!") > 0.03 * size,
        digits > 0.1 * size,
        letters < 0.6 * size,
        n > 5 and distinct < 0.6,
        n > 5 and distinct < 0.35,
        mean > 12,
        mean < 3.5,
        repeated,
        line[-1:] not in b".!?:",
    ]


def repeated_words(words: list[bytes]) -> int:
    """Words in three-word windows that the text has twice or more."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    counts, covered, end = Counter(windows), 0, 0
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered += i + 3 - max(i, end)
            end = i + 3
    return covered


def read_text(text: str | None) -> tuple[list[int], list[int], list[list[float]]]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``; the words and the features of each line."""
    text = text or ""
    data = text.encode()
    seen: set[bytes] = set()
    every: list[bytes] = []
    sizes, features, again = [], [], 0
    for line in data.split(b"\n"):
        words = line.split()
        if words:
            repeated = line in seen
            again += repeated
            seen.add(line)
            sizes.append(len(words))
            features.append(line_features(line, words, repeated))
            every += words
    chars = len(text) - sum(map(text.count, SPACES))
    base = [len(every), chars, len(data.translate(None, _NOT_SYMBOL)), again, repeated_words(every)]
    return base, sizes, features


# ---- the field ---------------------------------------------------------------


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 300) -> np.ndarray:
    weights = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-x @ weights))
        weights += 2.0 * (x.T @ (y - p) / len(y) - 1e-4 * weights)
    return weights


def fit(features: list[np.ndarray], bad: list[bool], rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Weights (state, feature) and transitions (from, to); state 1 is boilerplate."""
    x, of = np.concatenate(features), np.repeat(bad, [len(f) for f in features])
    odds = logistic(x, of.astype(float))
    prior = np.log(of.mean() / (1 - of.mean())) if 0 < of.mean() < 1 else 0.0
    labels = []
    for f, b in zip(features, bad, strict=True):
        score = f @ odds - max(prior, 0)
        labels.append(np.array((score > 0) | (score >= score.max()), int) if b else np.zeros(len(f), int))
    chains = [(f[i : i + CHAIN], y[i : i + CHAIN]) for f, y in zip(features, labels, strict=True) for i in range(0, len(f), CHAIN)]
    longest, n, k = max(len(f) for f, _ in chains), len(chains), x.shape[1]
    seen, gold = np.zeros((longest, n, k)), np.zeros((longest, n), int)
    there = np.zeros((longest, n), bool)
    for j, (f, y) in enumerate(chains):
        seen[: len(f), j], gold[: len(f), j], there[: len(f), j] = f, y, True
    pairs = there[1:]
    target = np.array([(seen * (there & (gold == s))[..., None]).sum((0, 1)) for s in (0, 1)])
    moves = np.array([[(pairs & (gold[:-1] == a) & (gold[1:] == b)).sum() for b in (0, 1)] for a in (0, 1)], float)
    weights, change = np.zeros((2, k)), np.zeros((2, 2))
    speed = [np.zeros_like(weights), np.zeros_like(change)]
    for _ in range(rounds):
        score = seen @ weights.T
        ahead, back = np.zeros_like(score), np.zeros_like(score)
        ahead[0] = score[0]
        for t in range(1, longest):
            ahead[t] = score[t] + np.logaddexp.reduce(ahead[t - 1][:, :, None] + change, axis=1)
        for t in range(longest - 2, -1, -1):
            step = np.logaddexp.reduce(change + (score[t + 1] + back[t + 1])[:, None, :], axis=2)
            back[t] = np.where(there[t + 1][:, None], step, 0)
        whole = np.logaddexp.reduce(ahead[0] + back[0], axis=1)
        state = np.exp(ahead + back - whole[:, None]) * there[..., None]
        expected = np.einsum("tns,tnk->sk", state, seen)
        both = ahead[:-1][..., None] + change + (score[1:] + back[1:])[:, :, None, :] - whole[:, None, None]
        passed = (np.exp(np.minimum(both, 0)) * pairs[..., None, None]).sum((0, 1))
        lines = there.sum()
        for i, (value, slope) in enumerate(
            ((weights, (target - expected) / lines - 1e-4 * weights), (change, (moves - passed) / lines - 1e-4 * change))
        ):
            speed[i] = 0.9 * speed[i] + slope
            value += 1.0 * speed[i]
    return weights, change


def viterbi(score: np.ndarray, change: np.ndarray) -> list[int]:
    """The likeliest states of a sequence with these scores (line, state)."""
    (aa, ab), (ba, bb) = change.tolist()
    rows = score.tolist()
    a, b = rows[0]
    back = []
    for next_a, next_b in rows[1:]:
        from_a, from_b = b + ba > a + aa, b + bb > a + ab
        back.append((from_a, from_b))
        a, b = next_a + (b + ba if from_a else a + aa), next_b + (b + bb if from_b else a + ab)
    states = [int(b > a)]
    for choice in reversed(back):
        states.append(int(choice[states[-1]]))
    return states[::-1]


def train(docs: DataFrame, labels: DataFrame, sample: int = TRAINING_DOCS) -> tuple[np.ndarray, np.ndarray] | None:
    """The field, from at most ``sample`` labelled documents; None without any."""
    chosen = (
        labels.where("doc_id is not null and quality is not null")
        .select("doc_id", "quality")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "quality")
        .limit(sample)
    )

    def work(batches):
        for batch in batches:
            read = [read_text(t)[2] for t in batch.column(0).to_pylist()]
            yield {"lines": [[x for line in f for x in map(float, line)] for f in read], "quality": batch.column(1)}

    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = rows.groupBy("doc_id").agg(F.min(F.struct("text", "quality")).alias("r")).select("r.*")  # one row of an id
    read = [r for r in map_columns(rows, work, "lines array<double>, quality int").toLocalIterator() if r.lines]
    if not read:
        return None
    read.sort(key=lambda r: (r.quality, r.lines))
    return fit([np.array(r.lines).reshape(-1, len(FEATURES)) for r in read], [not r.quality for r in read])


def _judged(field: tuple[np.ndarray, np.ndarray] | None, min_content: float):
    names = "n_words word_chars n_symbols n_dup_lines n_repeat_words content_share base_failed kept boilerplate".split()

    def work(batches):
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                base, sizes, features = read_text(text)
                states = [0] * len(sizes)
                if sizes and field:
                    states = viterbi(np.array(features, float) @ field[0].T, field[1])
                share = sum(n for n, s in zip(sizes, states, strict=True) if not s) / max(base[0], 1)
                failed = base[0] < MIN_WORDS or 100 * base[4] > MAX_REPEATED * base[0]
                rows.append((*base, share, failed, not failed and share >= min_content, states))
            columns = zip(*rows, strict=True) if rows else [[] for _ in names]
            yield {"doc_id": batch.column(0)} | dict(zip(names, map(list, columns), strict=True))

    return work


def judge(
    docs: DataFrame,
    field: tuple[np.ndarray, np.ndarray] | None,
    min_content: float = MIN_CONTENT,
    with_lines: bool = False,
) -> DataFrame:
    """Counts, ``content_share``, ``base_failed`` and ``kept`` of every document; ``with_lines`` adds for each line
    with a word whether it is boilerplate."""
    schema = (
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "content_share double, base_failed boolean, kept boolean"
    )
    schema += ", boilerplate array<int>" * with_lines
    return map_columns(docs.select("doc_id", "text"), _judged(field, min_content), schema)


def keep_good(
    docs: DataFrame, field: tuple[np.ndarray, np.ndarray] | None, min_content: float = MIN_CONTENT
) -> DataFrame:
    """The documents that stay, with all their columns."""
    return keep_rows(docs, ["doc_id", "text"], _judged(field, min_content), "kept")
