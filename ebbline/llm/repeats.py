"""Removal of byte strings that occur earlier: sampled suffixes, named and compared by recursive induction.

A position is removable if it lies in a string of ``LENGTH`` bytes that also starts earlier (in a document with a
smaller id, or before in the same one).  The README says why not every suffix is sorted.  What is done:

* Sampling.  Of the ``LENGTH`` windows' suffixes only local minima are kept: each window goes to the place in it
  whose first ``SEED`` bytes hash lowest, which depends on the window's bytes alone, so that equal windows go to
  equal places.  A run of windows with one place is a segment; there is about one in 35 bytes.
* Naming.  A segment has two names, hashes of the bytes that all its windows share (``core``) and of all their bytes
  (``span``).  Windows can only be equal if their cores are; segments whose core occurs once are done.
* Induction.  Segments with one span are equal window by window, so all but the first are removable.  Where a core
  has several spans, only the first segment of each goes on: it is cut into blocks of ``WIDTHS[1]`` windows, which
  get names likewise, at last into single windows, whose name is exact.

Each level is an aggregation and a join on names, so a passage in many documents meets in partial sums, never as a
group.  Names that decide are 128 bits (core and span); at the last level both are hashes of the same window.

Texts are taken as UTF-8 bytes, null as empty.  Ids are taken to be unique but for exact repeats, which share one
result; rows without id are left whole.  Of ``docs`` only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.llm.batches import discard, free_name, map_columns, release, written
from ebbline.session import settle, shared_dir

LENGTH = 100  # bytes of a string that counts
SEED = 32  # bytes whose hash places a window
CHUNK = 1 << 20  # window starts worked on at once

_POSITION = np.uint64((1 << 21) - 1)
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F))


def widths(length: int) -> tuple[int, int, int]:
    """Windows in a segment or block, at most, by level."""
    return length - SEED + 1, 8, 1


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _B
    return x ^ (x >> np.uint64(29))


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes at each position, as a number."""
    n = max(len(data) - 7, 0)
    return np.ndarray((n,), np.dtype("<u8"), buffer=data, strides=(1,)) if n else np.zeros(0, np.uint64)


def seeds(data: np.ndarray) -> np.ndarray:
    """The hash of ``SEED`` bytes at each position."""
    h = _mix(_words(data) * _A)
    h = _mix(h[:-8] * _C + h[8:])
    return _mix(h[:-16] * _A + h[16:])


def seeds_at(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """``seeds`` at some positions only."""
    words = _words(data)
    h = [_mix(words[at + i] * _A) for i in (0, 8, 16, 24)]
    h = [_mix(h[0] * _C + h[1]), _mix(h[2] * _C + h[3])]
    return _mix(h[0] * _A + h[1])


def names(data: np.ndarray, start: np.ndarray, size: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """Hashes of the ``size`` bytes at ``start`` (``SEED`` at least) and of ``salt``."""
    out = _mix(salt.astype(np.uint64) * _C + size.astype(np.uint64))
    for i in range(0, int(size.max(initial=0)), SEED):
        out = np.where(i < size, _mix(out * _A + seeds_at(data, start + np.minimum(i, size - SEED))), out)
    return out


def places(data: np.ndarray, length: int) -> np.ndarray:
    """For each window of ``length`` bytes, where in ``data`` the seed with the lowest hash is, the first of equals."""
    h = seeds(data)
    low = (h & ~_POSITION) | np.arange(len(h), dtype=np.uint64)
    wide, have = length - SEED + 1, 1
    while have * 2 <= wide:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    if have < wide:
        low = np.minimum(low[: len(low) - (wide - have)], low[wide - have :])
    return (low & _POSITION).astype(np.int64)


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of a batch and where each begins and ends, as they lie in memory."""
    offsets = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4).astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _named(data, offsets, ids, start, count, place, level, length):
    """Rows of segments: names, document, and start, count and place in one number that sorts by start."""
    wide = widths(length)[level]
    far = place - start  # offset of the first window's start from the place; the others' are smaller
    low = (far - count + 1) // wide * wide
    high = np.minimum(low + wide - 1, length - SEED)
    core = names(data, place - low, length - (high - low), low * 4 + level)
    span = names(data, start, length + count - 1, (far * 128 + count) * 4 + level)
    doc = np.searchsorted(offsets, start, "right") - 1
    packed = (start - offsets[doc]) << 14 | count << 7 | far
    return {"core": core.astype(np.int64), "span": span.astype(np.int64), "doc_id": ids.take(pa.array(doc)), "at": packed}


def segments(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``(core, span, doc_id, at)`` of every segment of every text."""

    def work(batches):
        for batch in batches:
            data, offsets = texts(batch.column(1))
            ends = offsets[1:]
            for lo in range(0, max(len(data) - length + 1, 0), CHUNK):
                part = data[lo : lo + CHUNK + length - 1]
                if len(part) < length:
                    continue
                place = places(part, length)
                first = np.searchsorted(ends, lo, "right")
                last = np.searchsorted(ends, lo + len(place), "left") + 1
                bounds = np.clip(np.append(offsets[first:last], ends[min(last, len(ends)) - 1]), lo, lo + len(place))
                left = np.repeat(ends[first : first + len(bounds) - 1], np.diff(bounds)) - np.arange(lo, lo + len(place))
                valid = np.flatnonzero(left >= length)
                if not len(valid):
                    continue
                to = place[valid]
                new = np.append(True, (np.diff(valid) != 1) | (np.diff(to) != 0))
                at = np.flatnonzero(new)
                count = np.diff(np.append(at, len(valid)))
                yield _named(data, offsets, batch.column(0), valid[at] + lo, count, to[at] + lo, 0, length)

    return map_columns(docs.select("doc_id", "text"), work, "core long, span long, doc_id long, at long")


def blocks(docs: DataFrame, segments_: DataFrame, level: int, length: int = LENGTH) -> DataFrame:
    """The segments ``(doc_id, at)`` cut into the blocks of ``level``, with new names."""
    wide = widths(length)[level]

    def work(batches):
        for batch in batches:
            data, offsets = texts(batch.column(1))
            lists = batch.column(2)
            at = lists.flatten().to_numpy()
            doc = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
            start, count, far = (at >> 14) + offsets[doc], at >> 7 & 127, at & 127
            of = np.repeat(np.arange(len(at)), count)
            step = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
            block = (far[of] - step) // wide
            new = np.flatnonzero(np.append(True, (np.diff(of) != 0) | (np.diff(block) != 0))[: len(of)])
            size = np.diff(np.append(new, len(of)))
            begin = start[of[new]] + step[new]
            yield _named(data, offsets, batch.column(0), begin, size, (start + far)[of[new]], level, length)

    lists = segments_.groupBy("doc_id").agg(F.collect_list("at").alias("ats"))
    rows = docs.select("doc_id", "text").join(lists, "doc_id")
    return map_columns(rows.select("doc_id", "text", "ats"), work, "core long, span long, doc_id long, at long")


def decide(named: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Segments that occur earlier, and those to look into: the first of each span whose core has several."""
    place = F.struct("doc_id", "at")
    spans = settle(named.groupBy("core", "span").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")))
    release(named.sparkSession)
    again = named.join(spans.where("n > 1").select("core", "span", "first"), ["core", "span"])
    again = settle(again.where(place > F.col("first")).select("doc_id", "at"))
    release(named.sparkSession)
    several = spans.groupBy("core").agg(F.count(F.lit(1)).alias("spans")).where("spans > 1").select("core")
    return again, settle(spans.join(several, "core").select("first.doc_id", "first.at"))


def repeated(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``(doc_id, at)``: runs of windows that occur earlier; ``at`` holds the run's start and count."""
    if not 2 * SEED <= length <= SEED + 127:
        raise ValueError(f"length must be from {2 * SEED} to {SEED + 127}")
    docs = docs.where(F.col("doc_id").isNotNull() & (F.octet_length("text") >= length)).select("doc_id", "text")
    named = segments(docs, length)
    twice = settle(named.select("core").groupBy("core").count().where("count > 1").select("core"))
    release(docs.sparkSession)
    rows = named.join(twice, "core")
    for level in (1, 2, 3):
        path = shared_dir(docs.sparkSession, "segments")
        named = written(rows, path)
        release(docs.sparkSession)
        more, open_ = decide(named)
        discard(docs.sparkSession, path)
        again = more if level == 1 else again.unionByName(more)
        rows = blocks(docs, open_, level, length) if level < 3 else None
    return again


def spans(at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the maximal runs of bytes that runs of windows cover."""
    at = np.sort(at)
    start, end = at >> 14, (at >> 14) + (at >> 7 & 127) - 1 + length
    far = np.maximum.accumulate(end)
    new = np.append(True, start[1:] > far[:-1])[: len(start)]
    last = np.append(np.flatnonzero(new)[1:] - 1, len(start) - 1)[: new.sum()]
    return start[new], far[last]


def _known(docs: DataFrame, length: int) -> DataFrame:
    """``docs`` and, as one more column at the end, the runs of windows of each that occur earlier."""
    name = free_name(docs.columns, "_ats")
    lists = repeated(docs, length).groupBy("doc_id").agg(F.collect_list("at").alias(name))
    return docs.join(lists, "doc_id", "left").select(*docs.columns, name)


def _cut(text: str | None, ats: list | None, length: int) -> tuple[bytes, list[bytes], int, int]:
    """The bytes of a text, the parts that stay, how many bytes go and in how many runs."""
    data = (text or "").encode()
    start, end = spans(np.array(ats or [], np.int64), length)
    edges = [0, *np.stack([start, end], axis=1).ravel().tolist(), len(data)]
    parts = [data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)]
    return data, parts, int((end - start).sum()), len(start)


def digests(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Sizes, removed runs, and the digest of the bytes that stay."""

    def work(batches):
        for batch in batches:
            out = {"doc_id": batch.column(0), "n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": []}
            for text, ats in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True):
                data, parts, gone, runs = _cut(text, ats, length)
                digest = hashlib.sha256(b"".join(parts)).hexdigest()
                for name, value in zip(list(out)[1:], (len(data), gone, runs, digest), strict=True):
                    out[name].append(value)
            yield out

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return map_columns(_known(docs.select("doc_id", "text"), length), work, schema)


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with all their columns and the texts without the repeated bytes; a null text stays null.

    A character that a cut goes through is left out with them.
    """
    known = _known(docs, length)
    names_, at = docs.columns, docs.columns.index("text")

    def run(batches):
        for batch in batches:
            texts_ = []
            for text, ats in zip(batch.column(at).to_pylist(), batch.column(len(names_)).to_pylist(), strict=True):
                parts = _cut(text, ats, length)[1]
                texts_.append("".join(p.decode("utf-8", "ignore") for p in parts) if ats else text)
            columns = batch.columns[:-1]
            columns[at] = pa.array(texts_, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names_)

    return known.mapInArrow(run, docs.schema)
