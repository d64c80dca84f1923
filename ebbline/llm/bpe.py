"""Byte-level BPE as a lazily determinised finite-state transducer, and its streaming decoder.

Merges by rank have two properties that make them a finite-state matter: every byte string has exactly one
encoding, and a token sequence is that encoding if and only if each pair of neighbours is (what the pair spells
encodes to the pair).  So the transducer's hypotheses are token sequences with fitting neighbours, each with a
place in the trie of the vocabulary where its last, unfinished token stands.  A state is the set of hypotheses
still open; a token is emitted once all of them agree on it.  States and their steps are made when a text first
needs them.  Once as many are made as the bound allows, what they do not cover is run on the hypotheses themselves.

Nulls encode as empty texts.  Repeated rows are encoded each for itself, other columns are not read.
"""

from __future__ import annotations

import base64
import contextlib
import gc
import hashlib
import itertools
from collections.abc import Iterable, Iterator

import regex
from pyspark.sql import DataFrame

from ebbline.llm.batches import kept_by_process, map_columns

#: Bounds of the memory a worker keeps.  They do not change results.
MAX_STEPS = 30_000
MAX_FITS = 500_000
MAX_PIECES = 700_000
MAX_PIECE = 32  # characters; longer pieces are not remembered

NONE = -1  # before the first token
END = 1 << 60  # above every rank


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 of the token's bytes and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Transducer:
    """Encodes byte strings by ranks; one instance serves many texts.

    States are numbers; ``steps`` has, by state and byte, the next state and the tokens emitted on the way.
    """

    def __init__(self, ranks: dict[bytes, int], max_steps: int = MAX_STEPS):
        self.ranks = ranks
        self.spelled = {i: t for t, i in ranks.items()}
        self.max_steps = max_steps
        self._trie()
        self.spines: dict[int, tuple[list, list] | None] = {}
        self.numbers: dict[tuple, int] = {}
        self.hypotheses: list[tuple] = []  # of each state: ((tokens since the last agreed one, node), ...)
        self.steps: dict[int, tuple[int, tuple]] = {}
        self.tails: dict[int, tuple] = {}  # tokens emitted if the text ends in a state
        self.fits: dict[int, bool] = {}  # by the left token << 32 | the right one
        self._state((((NONE,), 0),))

    def _trie(self) -> None:
        """``next`` by node and byte, node 0 being the root; ``ends`` has the token that ends at a node."""
        self.next: dict[int, int] = {}
        self.ends: list[int] = [NONE]
        for token, i in self.ranks.items():
            node = 0
            for b in token:
                to = self.next.get(node << 8 | b)
                if to is None:
                    to = self.next[node << 8 | b] = len(self.ends)
                    self.ends.append(NONE)
                node = to
            self.ends[node] = i

    def _state(self, hypotheses: tuple) -> int:
        number = self.numbers.setdefault(hypotheses, len(self.hypotheses))
        if number == len(self.hypotheses):
            self.hypotheses.append(hypotheses)
        return number

    def _spine(self, token: int) -> tuple[list, list] | None:
        """Parts of a token at its left and its right edge, each with the ranks of itself and of the token it
        becomes part of; the token itself comes first.  None if the token is not its own encoding."""
        if token in self.spines:
            return self.spines[token]
        text = self.spelled[token]
        parts, halves = [text[i : i + 1] for i in range(len(text))], {}
        while len(parts) > 1:
            ranks = [self.ranks.get(parts[i] + parts[i + 1], END) for i in range(len(parts) - 1)]
            low = min(ranks)
            if low == END:
                break
            i = ranks.index(low)
            halves[parts[i] + parts[i + 1]] = parts[i], parts[i + 1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        edges: tuple[list, list] | None = None
        if len(parts) == 1:
            edges = ([], [])
            for side in (0, 1):
                part, above = text, END
                while part:
                    rank = self.ranks[part]
                    edges[side].append((part, rank, above))
                    part, above = halves[part][side] if part in halves else b"", rank
        self.spines[token] = edges
        return edges

    def _fit(self, left: int, right: int) -> bool:
        """Whether ``right`` can follow ``left``; after ``NONE``, whether it is its own encoding.

        Two tokens stay apart unless some part at the right edge of the one and some part at the left edge of the
        other merge before either goes into a larger part of its own token.  Of equal ranks the left one goes first.
        """
        known = self.fits.get(left << 32 | right)
        if known is None:
            if len(self.fits) >= MAX_FITS:
                self.fits.clear()
            after = self._spine(right)
            known = after is not None
            if known and left != NONE:
                ranks = self.ranks
                for a, rank_a, above_a in self._spine(left)[1]:
                    for b, rank_b, above_b in after[0]:
                        merge = ranks.get(a + b)
                        if merge is not None:
                            when = max(merge, rank_a, rank_b)
                            if when < above_a and (when < above_b or when == above_b == merge):
                                known = False
            self.fits[left << 32 | right] = known
        return known

    def _step(self, state: int, byte: int) -> tuple[int, tuple]:
        """Make the step from ``state`` over ``byte``."""
        after, step, ends, fits = [], self.next.get, self.ends, self.fits
        first = step(byte)
        for tokens, node in self.hypotheses[state]:
            to = step(node << 8 | byte)
            if to is not None:
                after.append((tokens, to))
            token = ends[node]
            if token >= 0:
                fit = fits.get(tokens[-1] << 32 | token)
                if fit or fit is None and self._fit(tokens[-1], token):
                    after.append(((*tokens, token), first))
        common = after[0][0]
        if len(after) == 1:
            agreed = len(common) - 1
            after = ((common[agreed:], after[0][1]),)
        else:
            agreed = 0
            while len(common) > agreed + 1:
                token = common[agreed + 1]
                for tokens, _ in after:
                    if len(tokens) < agreed + 2 or tokens[agreed + 1] != token:
                        break
                else:
                    agreed += 1
                    continue
                break
            after = tuple([(t[agreed:], node) for t, node in after]) if agreed else tuple(after)
        to = self.numbers.get(after)
        if to is None:
            to = self._state(after)
        made = self.steps[state << 8 | byte] = (to, common[1 : agreed + 1])
        return made

    def _tail(self, state: int) -> tuple:
        for tokens, node in self.hypotheses[state]:
            token = self.ends[node]
            if token != NONE and self._fit(tokens[-1], token):
                tail = self.tails[state] = (*tokens[1:], token)
                return tail
        raise ValueError("the vocabulary lacks single bytes")

    def encode(self, text: bytes) -> tuple[int, ...]:
        """The tokens of one piece; a piece that is itself in the vocabulary is one token."""
        whole = self.ranks.get(text)
        if whole is not None:
            return (whole,)
        if not text:
            return ()
        state, out, steps = 0, [], self.steps
        for byte in text:
            step = steps.get(state << 8 | byte)
            if step is None:
                if len(steps) >= self.max_steps:
                    return tuple(self._search(text))
                step = self._step(state, byte)
            state, tokens = step
            if tokens:
                out += tokens
        out += self.tails.get(state) or self._tail(state)
        return tuple(out)

    def _search(self, text: bytes) -> list[int]:
        """The nondeterministic machine run depth first, longest token first, without making states.

        A place in the text is reached by one hypothesis at most, the encoding of what stands before it.  So none
        is visited twice.
        """
        out, tokens, place, step, ends, fits = [], [], 0, self.next.get, self.ends, self.fits
        levels, last = [tokens], NONE
        while True:
            node = 0
            for i in range(place, len(text)):  # the tokens that start here
                node = step(node << 8 | text[i])
                if node is None:
                    break
                if ends[node] >= 0:
                    tokens.append((ends[node], i + 1))
            while True:
                while not tokens:
                    levels.pop()
                    tokens = levels[-1]
                    out.pop()
                    last = out[-1] if out else NONE
                token, place = tokens.pop()
                fit = fits.get(last << 32 | token)
                if fit or fit is None and self._fit(last, token):
                    break
            out.append(token)
            if place == len(text):
                return out
            last, tokens = token, []
            levels.append(tokens)


class PieceEncoder(dict):
    """Piece: its tokens.  Remembers pieces in two generations, of which the older goes when the newer is full."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.older: dict[str, tuple[int, ...]] = {}
        self.transducer = Transducer(ranks)
        self.pieces = regex.compile(pattern).findall

    def __missing__(self, piece: str) -> tuple[int, ...]:
        tokens = self.older.get(piece) or self.transducer.encode(piece.encode())
        if len(piece) <= MAX_PIECE:
            if len(self) >= MAX_PIECES:
                self.older = dict(self)
                self.clear()
            self[piece] = tokens
        return tokens

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for tokens in map(self.__getitem__, self.pieces(text)):
            out += tokens
        return out


#: By the lead byte: how many bytes follow, and the range of the first of them.
_LEADS = (
    (0x00, 0x7F, 0, 0x80, 0xBF),
    (0xC2, 0xDF, 1, 0x80, 0xBF),
    (0xE0, 0xE0, 2, 0xA0, 0xBF),
    (0xE1, 0xEC, 2, 0x80, 0xBF),
    (0xED, 0xED, 2, 0x80, 0x9F),
    (0xEE, 0xEF, 2, 0x80, 0xBF),
    (0xF0, 0xF0, 3, 0x90, 0xBF),
    (0xF1, 0xF3, 3, 0x80, 0xBF),
    (0xF4, 0xF4, 3, 0x80, 0x8F),
)


class Utf8Machine:
    """Incremental UTF-8: takes bytes in any portions, gives text as soon as characters are complete.

    The state between portions is the unfinished character: its bytes, at most three.  Bytes that cannot become a
    character turn into U+FFFD.
    """

    def __init__(self):
        self.open = b""

    @staticmethod
    def unfinished(data: bytes) -> int:
        """How many bytes at the end begin a character that more bytes could complete."""
        for back in range(1, min(3, len(data)) + 1):
            lead = data[-back]
            if 0x80 <= lead <= 0xBF:
                continue
            for low, high, follow, first, last in _LEADS:
                if low <= lead <= high:
                    fits = back == 1 or first <= data[1 - back] <= last
                    return back if back <= follow and fits else 0
            return 0
        return 0

    def feed(self, data: bytes, last: bool = False) -> str:
        data = self.open + data
        cut = len(data) if last else len(data) - self.unfinished(data)
        self.open = data[cut:]
        return data[:cut].decode("utf-8", "replace")


def decode_stream(ids: Iterable[int], spelled, portion: int = 4096) -> Iterator[str]:
    """Text of a token stream, in portions."""
    machine = Utf8Machine()
    for some in itertools.batched(ids, portion):
        yield machine.feed(b"".join(map(spelled.__getitem__, some)))
    yield machine.feed(b"", last=True)


def _encoder(path: str, pattern: str) -> PieceEncoder:
    return kept_by_process(("bpe", path, pattern), lambda: PieceEncoder(read_ranks(path), pattern))


@contextlib.contextmanager
def uncollected():
    """Without cyclic collection: the tables hold no cycles, and walking them is slow.  Back on for the worker's next task."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()


def encode(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, ids)`` for every row: the tokens of the whole text."""

    def work(batches):
        with uncollected():
            encoder = _encoder(path, pattern)
            for batch in batches:
                yield {key: batch.column(0), "ids": [encoder.encode(t or "") for t in batch.column(1).to_pylist()]}

    return map_columns(docs.select(key, text), work, f"{key} long, ids array<int>")


def decode(encoded: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """``(key, text)`` for every row of ``(key, ids)``; null ids give an empty text."""

    def work(batches):
        spelled = kept_by_process(("spelled", path), lambda: {i: t for t, i in read_ranks(path).items()})
        for batch in batches:
            texts = ["".join(decode_stream(ids or (), spelled)) for ids in batch.column(1).to_pylist()]
            yield {key: batch.column(0), "text": texts}

    return map_columns(encoded.select(key, "ids"), work, f"{key} long, text string")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Digests of the tokens and of the text decoded from them, in one pass; nothing large leaves the worker."""

    def work(batches):
        with uncollected():
            encoder = _encoder(path, pattern)
            spelled = encoder.transducer.spelled
            decimal = {i: str(i) for i in spelled}
            for batch in batches:
                out = {"doc_id": batch.column(0), "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
                for t in batch.column(1).to_pylist():
                    ids = encoder.encode(t or "")
                    decoded = hashlib.sha256()
                    for portion in decode_stream(ids, spelled):
                        decoded.update(portion.encode())
                    out["n_tokens"].append(len(ids))
                    out["ids_sha256"].append(hashlib.sha256(",".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                    out["decoded_sha256"].append(decoded.hexdigest())
                yield out

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_columns(docs.select("doc_id", "text"), work, schema)
