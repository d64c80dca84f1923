"""Language identification by interpolated Kneser-Ney character models.

Per language the trigrams of letters are counted over all training documents (words are padded with boundaries, what
is not a letter is a boundary, upper case is folded).  The lower orders are continuation counts, which follow from
the distinct trigrams.  The models of all languages lie in three sorted key arrays (trigrams, bigrams, single
letters) with a column of log probabilities per language; a lookup is a binary search, a missing key backs off.
A text goes to the language with the lowest cross-entropy per character.  Where there are too many trigrams to hold,
the orders stay tables, whole, and each chunk of texts is joined with the log probabilities of its own trigrams.

Two things are calibrated on all training documents, one row of an id: the sharpness of the score, and per language how
much worse than usual, for its length, a text may be predicted before it is rejected.  The numbers for it stay a table; its
order statistics are exact, found in ever finer counts.

A text that is null or has no letter is ``und`` with score 0, and rejected; so is every text where nothing could be
learned.  Rows without language or id teach nothing.  Of ``docs`` only ``doc_id, text, lang`` are read.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ebbline.llm.batches import free_name, keep_rows, kept_by_process, map_columns
from ebbline.session import settle

MAX_GRAMS = 4_000_000  # rows of models held in memory; larger ones stay tables, with the same results
BINS = 4096  # counts by which an order statistic is narrowed down
FEW = 4096  # values among which it is looked up
GRID = (1.0, 2.0, 5.0, 10.0, 20.0, 50.0)  # of the sharpness
CHUNK = 1_000_000  # characters worked on at once
BITS = 21  # of a code point
SLACK = 1.5  # times the excess that the share USUAL of the texts stays within
USUAL = 0.98  # rounded down, so that the worst of a few texts never counts

LEAST = 1.75  # times the usual cross-entropy; texts below are never rejected

UNKNOWN = "und"


def is_letter() -> np.ndarray:
    return kept_by_process(("letters",), lambda: np.array([chr(i).isalpha() for i in range(0x110000)]))


def letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the letters of all texts, 0 once for each boundary, and the number of the text each belongs to."""
    folded = [t.lower() for t in texts]
    codes = np.frombuffer("\0".join([*folded, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    of = np.repeat(np.arange(len(folded), dtype=np.int32), [len(t) + 1 for t in folded])
    letter = is_letter()[codes]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    return np.where(letter, codes, 0)[keep].astype(np.uint64), of[keep]


def grams(codes: np.ndarray) -> np.ndarray:
    """For each position the two letters before it in its word (0: none) and its own code, as one number."""
    before = np.concatenate([[0], codes[:-1]]).astype(np.uint64)
    second = np.concatenate([[0], before[:-1]]).astype(np.uint64)
    second[before == 0] = 0
    return second << np.uint64(2 * BITS) | before << np.uint64(BITS) | codes


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and their counts; by a dense table where the alphabet is small."""
    low = np.uint64((1 << BITS) - 1)
    alphabet = np.zeros(0x110000, bool)
    alphabet[keys & low] = True
    alphabet[0] = True
    known = np.flatnonzero(alphabet)
    if len(known) > 160:
        return np.unique(keys, return_counts=True)
    place = np.zeros(0x110000, np.int64)
    place[known] = np.arange(len(known))
    n = len(known)
    parts = [place[(keys >> np.uint64(s * BITS)) & low] for s in (2, 1, 0)]
    table = np.bincount((parts[0] * n + parts[1]) * n + parts[2], minlength=n**3)
    there = np.flatnonzero(table)
    code = known.astype(np.uint64)
    a, b, c = there // (n * n), there // n % n, there % n
    found = code[a] << np.uint64(2 * BITS) | code[b] << np.uint64(BITS) | code[c]
    return found, table[there]


def merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, inverse = np.unique(keys, return_inverse=True)
    return distinct, np.bincount(inverse, weights=counts, minlength=len(distinct)).astype(np.int64)


def chunks(texts: list[str]):
    """Slices of about ``CHUNK`` characters, a text never split."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > CHUNK:
            yield slice(start, i)
            start, size = i, 0
        size += len(t)
    if texts:
        yield slice(start, len(texts))


def remainder(doc_id: str = "doc_id", parts: int = 4) -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts


def count_grams(docs: DataFrame) -> DataFrame:
    """``(lang, gram, n)`` over all rows of ``docs``; counts are summed in each task before the shuffle."""

    def work(batches):
        held: dict[str, list] = {}

        def out():
            for lang, parts in held.items():
                keys, counts = merged(*map(np.concatenate, zip(*parts, strict=True)))
                yield {"lang": [lang] * len(keys), "gram": keys.astype(np.int64), "n": counts}
            held.clear()

        for batch in batches:
            texts, langs = (np.array(c.to_pylist(), object) for c in batch.columns)
            for lang in set(langs):
                own = list(texts[langs == lang])
                for some in chunks(own):
                    held.setdefault(lang, []).append(counted(grams(letters(own[some])[0])))
                parts = held.get(lang, ())
                if len(parts) > 1:
                    held[lang] = [merged(*map(np.concatenate, zip(*parts, strict=True)))]
            if sum(len(p[0]) for parts in held.values() for p in parts) > CHUNK:
                yield from out()
        yield from out()

    rows = docs.where("text is not null and lang is not null").select("text", "lang")
    part = map_columns(rows, work, "lang string, gram long, n long")
    return part.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class Models:
    """Sorted keys by order, log probabilities and back-off weights by key and language."""

    langs: list[str]
    keys: tuple[np.ndarray, np.ndarray, np.ndarray]  # trigrams, bigrams, letters
    logs: tuple[np.ndarray, np.ndarray, np.ndarray]
    contexts: tuple[np.ndarray, np.ndarray]  # of trigrams, of bigrams
    backoffs: tuple[np.ndarray, np.ndarray]
    floor: np.ndarray  # log probability of a letter no language has
    sharpness: float = 20.0
    usual: np.ndarray | None = None  # by language: cross-entropy, and its spread for one character
    spread: np.ndarray | None = None

    def log_probability(self, keys: np.ndarray) -> np.ndarray:
        """``(key, language)``: the interpolated log probability of the last letter after the two before."""
        at, hit = find(self.keys[0], keys)
        out = self.logs[0][at]
        if not hit.all():
            rest = keys[~hit]
            out[~hit] = self._backed(rest)
        return out

    def _backed(self, keys: np.ndarray) -> np.ndarray:
        low = np.uint64((1 << BITS) - 1)
        pair, last = keys & np.uint64((1 << 2 * BITS) - 1), keys & low
        at, hit = find(self.keys[2], last)
        out = np.where(hit[:, None], self.logs[2][at], self.floor)
        at, hit = find(self.contexts[1], pair >> np.uint64(BITS))
        out += np.where(hit[:, None], self.backoffs[1][at], 0)
        at, hit = find(self.keys[1], pair)
        out = np.where(hit[:, None], self.logs[1][at], out)
        at, hit = find(self.contexts[0], keys >> np.uint64(BITS))
        return out + np.where(hit[:, None], self.backoffs[0][at], 0)

    def cross_entropy(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``(text, language)`` in nats per character, and the characters counted."""
        sums, sizes = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts))
        for some in chunks(texts):
            codes, of = letters(texts[some])
            n = some.stop - some.start
            # a very long text is taken in parts, whose first positions look at the part before
            keys = grams(codes)
            for i in range(0, len(keys), CHUNK):
                part, whose = self.log_probability(keys[i : i + CHUNK]), of[i : i + CHUNK]
                for k in range(len(self.langs)):
                    sums[some, k] += np.bincount(whose, weights=part[:, k], minlength=n)
            sizes[some] = np.bincount(of, minlength=n)
        return -sums / np.maximum(sizes, 1)[:, None], sizes


@dataclass
class TableModels(Models):
    """Models of any size.  No key is held: the orders are tables ``(lang, key, n)``, trigrams first, and ``facts`` has
    of each language its place, the discounts ``d0, d1, d2`` of the orders, and the total and floor of the last one."""

    orders: tuple[DataFrame, ...] = ()
    facts: DataFrame | None = None

    def holding(self, keys: np.ndarray, logs: np.ndarray) -> Models:
        """With the log probabilities of some trigrams; it can judge texts that have no others."""
        none, empty = np.zeros(0, np.uint64), np.zeros((0, len(self.langs)), np.float32)
        order = np.argsort(keys)
        held = (keys[order], none, none), (logs[order], empty, empty), (none, none), (empty, empty)
        return Models(self.langs, *held, self.floor, self.sharpness, self.usual, self.spread)

    def table_of_logs(self, wanted: DataFrame) -> DataFrame:
        """``(gram, logs)``, by language, for the distinct ``gram`` of ``wanted``."""
        facts, below = F.broadcast(self.facts), None
        for k in (2, 1, 0):
            key, d = F.col("gram").bitwiseAND(F.lit((1 << (3 - k) * BITS) - 1)), F.col(f"d{k}")
            rows = wanted.select(key.alias("key")).distinct().crossJoin(facts).join(self.orders[k], ["lang", "key"], "left")
            if below is None:
                p = F.greatest(F.coalesce(F.col("n") - d, F.lit(0.0)), F.lit(0.0)) / F.col("total") + F.col("floor")
            else:
                context = F.shiftright("key", BITS)
                sums = self.orders[k].groupBy("lang", context.alias("context"))
                sums = sums.agg(F.sum("n").alias("all"), F.count("n").alias("types"))
                rest = F.col("key").bitwiseAND(F.lit((1 << (2 - k) * BITS) - 1))
                rows = rows.withColumns({"context": context, "rest": rest}).join(sums, ["lang", "context"], "left")
                rows = rows.join(below.select("lang", F.col("key").alias("rest"), F.col("p").alias("lower")), ["lang", "rest"])
                own = F.coalesce((F.col("n") - d) / F.col("all"), F.lit(0.0))
                p = own + F.coalesce(d * F.col("types") / F.col("all"), F.lit(1.0)) * F.col("lower")
            below = rows.select("lang", "place", "key", p.alias("p"))
        logs = F.array_sort(F.collect_list(F.struct("place", F.log("p").cast("float").alias("log"))))
        return below.groupBy(F.col("key").alias("gram")).agg(logs["log"].alias("logs"))

    def cross_entropy(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        keys = np.unique(np.concatenate([grams(letters(texts[some])[0]) for some in chunks(texts)]))
        wanted = self.facts.sparkSession.createDataFrame([(int(k),) for k in keys], "gram long")
        return self.holding(*_columns_of(self.table_of_logs(wanted).toArrow(), len(self.langs))).cross_entropy(texts)

    def by_chunk(self, docs: DataFrame, work, schema: T.StructType) -> DataFrame:
        """``work(models, rows)`` on chunks of ``docs``, with models that hold the chunk's trigrams."""
        size = docs.agg(F.sum(F.length("text"))).first()[0] or 0
        # written, since the chunk of a row must not change between its two uses
        chunk = free_name(docs.columns, "_chunk")
        docs = settle(docs.withColumn(chunk, (F.rand(0) * (size // CHUNK + 1)).cast("int")))

        def own(batches):
            for batch in batches:
                parts, texts = np.array(batch.column(0).to_pylist()), np.array(batch.column(1).to_pylist(), object)
                for part in np.unique(parts):
                    some = [t or "" for t in texts[parts == part]]
                    for piece in chunks(some):
                        keys = np.unique(grams(letters(some[piece])[0]))
                        yield {"part": [int(part)] * len(keys), "gram": keys.astype(np.int64)}

        wanted = settle(map_columns(docs.select(chunk, "text"), own, "part int, gram long").distinct())
        logs = wanted.join(self.table_of_logs(wanted.select("gram")), "gram").select("part", "gram", "logs")
        bare = TableModels(
            self.langs, (), (), (), (), self.floor, self.sharpness, self.usual, self.spread
        )  # tables stay with the driver
        arrow = to_arrow_schema(schema)

        def run(rows: pa.Table, held: pa.Table) -> pa.Table:
            models = bare.holding(*_columns_of(held, len(bare.langs)))
            return work(models, rows.drop_columns(chunk)).cast(arrow)

        return docs.groupBy(chunk).cogroup(logs.groupBy("part")).applyInArrow(run, schema)


def _columns_of(logs: pa.Table, langs: int) -> tuple[np.ndarray, np.ndarray]:
    values = logs["logs"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float32)
    return logs["gram"].to_numpy().astype(np.uint64), values.reshape(-1, langs)


def find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
    return at, keys[at] == wanted


def _discount(counts: np.ndarray) -> float:
    once, twice = (counts == 1).sum(), (counts == 2).sum()
    return float(once / (once + 2 * twice)) if once else 0.5


def _level(key: np.ndarray, count: np.ndarray, union: np.ndarray, contexts: np.ndarray, below: np.ndarray):
    """One order of one language: log probabilities at ``union``, log back-off weights at ``contexts``.

    ``below`` has the probability that the next lower order gives to each key of ``union``.
    """
    discount = min(_discount(count), 0.95)
    of = np.searchsorted(contexts, key >> np.uint64(BITS))
    total = np.bincount(of, weights=count, minlength=len(contexts))
    types = np.bincount(of, minlength=len(contexts))
    backoff = np.where(total > 0, discount * types / np.maximum(total, 1), 1.0)
    own = np.zeros(len(union))
    own[np.searchsorted(union, key)] = count - discount
    at = np.searchsorted(contexts, union >> np.uint64(BITS))
    p = np.where(total[at] > 0, own / np.maximum(total[at], 1), 0) + backoff[at] * below
    return p, backoff


def build(langs: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> Models:
    """Models from the trigram counts of every language."""
    names = sorted(set(langs.tolist()))
    low, pair = np.uint64((1 << BITS) - 1), np.uint64((1 << 2 * BITS) - 1)
    shift = np.uint64(BITS)
    tri, bi, uni = np.unique(keys), np.unique(keys & pair), np.unique(keys & low)
    tri_context, bi_context = np.unique(tri >> shift), np.unique(bi >> shift)
    logs, backoffs, floor = ([], [], []), ([], []), []
    for name in names:
        key, count = keys[langs == name], counts[langs == name]
        pairs, pair_count = np.unique(key & pair, return_counts=True)  # continuations: distinct letters before
        single, single_count = np.unique(pairs & low, return_counts=True)
        discount = min(_discount(single_count), 0.95)
        p1 = np.full(len(uni), discount * len(single) / single_count.sum() / (len(uni) + 1))
        floor.append(np.log(p1[0]))
        p1[np.searchsorted(uni, single)] += (single_count - discount) / single_count.sum()
        p2, back2 = _level(pairs, pair_count, bi, bi_context, p1[np.searchsorted(uni, bi & low)])
        p3, back3 = _level(key, count, tri, tri_context, p2[np.searchsorted(bi, tri & pair)])
        for into, p in zip(logs, (p3, p2, p1), strict=True):
            into.append(np.log(p))
        for into, p in zip(backoffs, (back3, back2), strict=True):
            into.append(np.log(p))
    table = [np.array(x, np.float32).T.copy() for x in (*logs, *backoffs)]
    return Models(
        names, (tri, bi, uni), tuple(table[:3]), (tri_context, bi_context), tuple(table[3:]), np.array(floor, np.float32)
    )


def build_tables(table: DataFrame) -> TableModels:
    """The same as ``build``, from ``(lang, gram, n)``; only a row for each language comes to the driver."""
    orders = [table.select("lang", F.col("gram").alias("key"), "n")]
    for k in (2, 1):  # continuations: distinct letters before
        key = F.col("key").bitwiseAND(F.lit((1 << k * BITS) - 1))
        orders.append(settle(orders[-1].groupBy("lang", key.alias("key")).agg(F.count("n").alias("n"))))
    discounts = []
    for level in orders:
        once, twice = (F.count(F.when(F.col("n") == k, 1)).alias(name) for k, name in ((1, "once"), (2, "twice")))
        rows = level.groupBy("lang").agg(once, twice).collect()
        discounts.append({r["lang"]: min(r["once"] / (r["once"] + 2 * r["twice"]) if r["once"] else 0.5, 0.95) for r in rows})
    alphabet = orders[2].select("key").distinct().count()
    sums = {r["lang"]: r for r in orders[2].groupBy("lang").agg(F.sum("n").alias("total"), F.count("n").alias("types")).collect()}
    names = sorted(sums)
    floor = [discounts[2][x] * sums[x]["types"] / sums[x]["total"] / (alphabet + 1) for x in names]
    rows = [(x, i, *(float(d[x]) for d in discounts), sums[x]["total"], floor[i]) for i, x in enumerate(names)]
    columns = "lang string, place int, d0 double, d1 double, d2 double, total long, floor double"
    facts = table.sparkSession.createDataFrame(rows, columns)
    none = np.zeros(0, np.uint64)
    return TableModels(
        names, (none,) * 3, (), (), (), np.log(np.array(floor)).astype(np.float32), orders=tuple(orders), facts=facts
    )


def train(docs: DataFrame, max_grams: int = MAX_GRAMS, sample: int | None = None) -> Models | None:
    """Models of every language in ``docs``; None if there is nothing to learn from.

    Calibrated on all of them, unless ``sample`` names so many ids, those with the lowest hashes.
    """
    table = settle(count_grams(docs))
    if table.count() > max_grams:
        models = build_tables(table)
    else:
        rows = table.toArrow()
        if not rows.num_rows:
            return None
        keys = rows["gram"].to_numpy().astype(np.uint64)
        models = build(np.array(rows["lang"].to_pylist(), object), keys, rows["n"].to_numpy())
    own = docs.where("doc_id is not null and text is not null and lang is not null").select("doc_id", "text", "lang")
    if sample is not None:
        ids = own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).select("doc_id").distinct()
        own = own.join(F.broadcast(ids), "doc_id")
    return calibrate(models, _entropies(own, models))


def _judged(docs: DataFrame, models: Models | None, make, schema: str) -> DataFrame:
    """The columns that ``make(models)`` yields for batches of ``docs``."""
    if not isinstance(models, TableModels):
        return map_columns(docs, make(models), schema)
    struct = T._parse_datatype_string(schema)
    arrow = to_arrow_schema(struct)

    def work(held: Models, rows: pa.Table) -> pa.Table:
        out = next(make(held)(iter([rows])))
        return pa.table([c if isinstance(c, pa.ChunkedArray) else pa.array(c, f.type) for f, c in ((f, out[f.name]) for f in arrow)], schema=arrow)

    return models.by_chunk(docs, work, struct)


def _entropies(docs: DataFrame, models: Models) -> DataFrame:
    """Of one row for each id, that of the least text: ``truth``, the place of its language; its own cross-entropy ``h``;
    its length's root ``n``; and the ``losses`` by sharpness."""

    def make(models):
        def work(batches):
            for batch in batches:
                texts = [t or "" for t in batch.column(1).to_pylist()]
                h, n = models.cross_entropy(texts) if texts else (np.zeros((0, len(models.langs))), np.zeros(0))
                places = {x: i for i, x in enumerate(models.langs)}
                truth = np.array([places.get(x, -1) for x in batch.column(2).to_pylist()], int)
                at = np.arange(len(h)), truth
                losses = np.stack([-np.log(softmax(-k * h)[at] + 1e-12) for k in GRID], axis=1) if len(h) else h
                known = (truth >= 0) & (n > 0)
                out = {"doc_id": batch.column(0), "lang": batch.column(2), "start": [t[:64] for t in texts]}
                out |= {"rest": [zlib.crc32(t.encode("utf-8", "surrogatepass")) for t in texts]}
                yield out | {"truth": np.where(known, truth, -1), "h": h[at], "n": np.sqrt(n), "losses": list(losses)}

        return work

    schema = "doc_id long, lang string, start string, rest long, truth int, h double, n double, losses array<double>"
    rows = _judged(docs.select("doc_id", "text", "lang"), models, make, schema)
    least = F.min_by(F.struct("truth", "h", "n", "losses"), F.struct("start", "rest", "lang"))
    return settle(rows.groupBy("doc_id").agg(least.alias("r")).select("r.*").where("truth >= 0"))


def order_statistics(rows: DataFrame, wanted: dict[int, list[int]]) -> dict[tuple[int, int], float]:
    """The ``i``-th smallest ``value`` (from 0) of each ``truth``, for the ``i`` that ``wanted`` names.

    All are narrowed down together by counts in ``BINS`` bins of the range that holds them, until few values are left.
    """
    found: dict[tuple[int, int], float] = {}
    sides = {(t, i): (None, None, 0) for t, places in wanted.items() for i in places}  # range and the values below it
    while sides:
        spark = rows.sparkSession
        asked = [(t, i, low, high) for (t, i), (low, high, _) in sides.items()]
        ranges = F.broadcast(spark.createDataFrame(asked, "truth int, i long, low double, high double"))
        met = rows.join(ranges, "truth").where("(low is null or value >= low) and (high is null or value <= high)")
        facts = met.groupBy("truth", "i").agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
        facts = {(r["truth"], r["i"]): r for r in facts.collect()}
        few = {x for x, r in facts.items() if r["n"] <= FEW or r["low"] == r["high"]}
        for x in [x for x in few if facts[x]["low"] == facts[x]["high"]]:
            found[x] = facts[x]["low"]
            few.discard(x)
        if few:
            names = F.broadcast(spark.createDataFrame(sorted(few), "truth int, i long"))
            held: dict[tuple[int, int], list[float]] = {}
            for r in met.join(names, ["truth", "i"]).select("truth", "i", "value").toLocalIterator():  # FEW of each
                held.setdefault((r["truth"], r["i"]), []).append(r["value"])
            found |= {x: sorted(v)[x[1] - sides[x][2]] for x, v in held.items()}
        sides = {x: v for x, v in sides.items() if x not in found}
        if not sides:
            break
        asked = [(*x, facts[x]["low"], facts[x]["high"]) for x in sides]
        ranges = F.broadcast(spark.createDataFrame(asked, "truth int, i long, low double, high double"))
        bin_ = F.least(F.floor((F.col("value") - F.col("low")) / (F.col("high") - F.col("low")) * BINS), F.lit(BINS - 1)).alias("bin")
        met = rows.join(ranges, "truth").where("value >= low and value <= high")
        counts = met.groupBy("truth", "i", bin_).agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
        bins: dict[tuple[int, int], list] = {}
        for r in counts.collect():  # BINS for each that is wanted
            bins.setdefault((r["truth"], r["i"]), []).append(r)
        for x, own in bins.items():
            below = sides[x][2]
            for r in sorted(own, key=lambda r: r["bin"]):
                if below + r["n"] > x[1]:
                    sides[x] = r["low"], r["high"], below
                    break
                below += r["n"]
    return found


def calibrate(models: Models, rows: DataFrame) -> Models:
    models.usual, models.spread = np.full(len(models.langs), np.inf), np.zeros(len(models.langs))
    losses = [F.avg(F.col("losses")[i]).alias(f"l{i}") for i in range(len(GRID))]
    total = rows.agg(F.count("*").alias("n"), *losses).first()
    if not total["n"]:
        return models
    models.sharpness = GRID[int(np.argmin([total[f"l{i}"] for i in range(len(GRID))]))]
    sizes = {r["truth"]: r["count"] for r in rows.groupBy("truth").count().collect()}
    middle = {t: sorted({(m - 1) // 2, m // 2}) for t, m in sizes.items()}
    medians = order_statistics(rows.select("truth", F.col("h").alias("value")), middle)
    for t, places in middle.items():
        models.usual[t] = np.mean([medians[t, i] for i in places])
    usual = F.element_at(F.array(*[F.lit(float(u)) for u in models.usual]), F.col("truth") + 1)
    excess = rows.select("truth", ((F.col("h") - usual) * F.col("n")).alias("value"))
    last = {t: [max(min(int(USUAL * (m - 1)), m - 2), 0)] for t, m in sizes.items()}
    for (t, _), highest in order_statistics(excess, last).items():
        models.spread[t] = SLACK * max(highest, 1.0)
    return models


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _identified(models: Models | None):
    def work(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            out = {"doc_id": batch.column(0), "lang_pred": [UNKNOWN] * len(texts), "score": np.zeros(len(texts))}
            out |= {"cross_entropy": [None] * len(texts), "rejected": np.ones(len(texts), bool)}
            if models and texts:
                h, n = models.cross_entropy(texts)
                best, known = h.argmin(axis=1), n > 0
                lowest = h[np.arange(len(h)), best]
                limit = models.usual[best] + models.spread[best] / np.sqrt(np.maximum(n, 1))
                limit = np.maximum(limit, LEAST * models.usual[best])
                score = softmax(-models.sharpness * h).max(axis=1)
                out["lang_pred"] = [models.langs[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
                out["score"] = np.where(known, score, 0.0)
                out["cross_entropy"] = [float(x) if k else None for x, k in zip(lowest, known, strict=True)]
                out["rejected"] = ~known | (lowest > limit)
            out["accepted"] = ~out["rejected"]
            yield out

    return work


def identify(docs: DataFrame, models: Models | None) -> DataFrame:
    """``lang_pred``, ``score``, ``cross_entropy`` (nats per character) and ``rejected`` of every document."""
    schema = "doc_id long, lang_pred string, score double, cross_entropy double, rejected boolean"
    return _judged(docs.select("doc_id", "text"), models, _identified, schema)


def keep_known(docs: DataFrame, models: Models | None) -> DataFrame:
    """The documents that are not rejected, with all their columns."""
    if not isinstance(models, TableModels):
        return keep_rows(docs, ["doc_id", "text"], _identified(models), "accepted")

    def work(held: Models, rows: pa.Table) -> pa.Table:
        (out,) = _identified(held)(iter([rows.select(["doc_id", "text"])]))
        return rows.filter(pa.array(out["accepted"], pa.bool_()))

    return models.by_chunk(docs, work, docs.schema)
