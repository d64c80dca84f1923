"""The shard source against recorded responses: restarts, splits, merges, positions, passing errors."""

import json
import sys
import uuid
from datetime import datetime, timedelta, timezone

import pytest
from pyspark import cloudpickle

from ebbline.config import SourceConfig
from ebbline.sources import kinesis, lines
from ebbline.streaming import jobs

cloudpickle.register_pickle_by_value(sys.modules[__name__])
NOW = datetime.now(timezone.utc)


class Recorded:
    """A client that answers from a file: shards in the order they were made, records with times before now."""

    def __init__(self, options):
        self.path = options["recorded"]
        self.page = int(options.get("page", 3))
        self.asked = []

    @property
    def story(self):
        with open(self.path) as f:
            return json.load(f)

    def list_shards(self, StreamName=None, NextToken=None):
        at = int(NextToken or 0)
        shards = [s["about"] for s in self.story["shards"]]
        out = {"Shards": shards[at : at + 2]}
        return out | ({"NextToken": str(at + 2)} if at + 2 < len(shards) else {})

    def _records(self, shard):
        return next(s["records"] for s in self.story["shards"] if s["about"]["ShardId"] == shard)

    def get_shard_iterator(self, StreamName, ShardId, ShardIteratorType, StartingSequenceNumber=None, Timestamp=None):
        records, at = self._records(ShardId), 0
        if ShardIteratorType == "AFTER_SEQUENCE_NUMBER":
            at = sum(int(r["seq"]) <= int(StartingSequenceNumber) for r in records)
        if ShardIteratorType == "AT_TIMESTAMP":
            at = sum(NOW - timedelta(seconds=r["age"]) < Timestamp for r in records)
        return {"ShardIterator": f"{ShardId} {at} {uuid.uuid4().hex}"}

    def get_records(self, ShardIterator, Limit):
        shard, at, _ = ShardIterator.split()
        at, records = int(at), self._records(shard)
        self.asked.append((shard, at))
        if len(self.asked) in self.story.get("throttled", ()):
            raise type("ProvisionedThroughputExceededException", (Exception,), {})("later")
        if len(self.asked) in self.story.get("expired", ()):
            raise type("ExpiredIteratorException", (Exception,), {})("old")
        own = records[at : at + min(Limit, self.page)]
        closed = "EndingSequenceNumber" in next(s["about"] for s in self.story["shards"] if s["about"]["ShardId"] == shard)["SequenceNumberRange"]
        out = {
            "Records": [
                {
                    "SequenceNumber": r["seq"],
                    "Data": r["data"].encode(),
                    "PartitionKey": r["data"][:1],
                    "ApproximateArrivalTimestamp": NOW - timedelta(seconds=r["age"]),
                }
                for r in own
            ],
            "MillisBehindLatest": 1000 if at + len(own) < len(records) else 0,
        }
        if not (closed and at + len(own) >= len(records)):
            out["NextShardIterator"] = f"{shard} {at + len(own)} x"
        return out


def shard(name, records, parents=(), closed=False):
    about = {"ShardId": name, "SequenceNumberRange": {"StartingSequenceNumber": "0"}}
    about |= dict(zip(("ParentShardId", "AdjacentParentShardId"), parents, strict=False))
    if closed:
        about["SequenceNumberRange"]["EndingSequenceNumber"] = str(int(records[-1]["seq"]) + 5 if records else 5)
    return {"about": about, "records": records}


def records(first, texts, age=1000.0):
    """Sequence numbers far beyond 64 bits, of different lengths."""
    return [{"seq": str(10**first * 7 + i * 10**18), "data": t, "age": age - i / 100} for i, t in enumerate(texts)]


@pytest.fixture
def story(tmp_path):
    path = tmp_path / "recorded.json"

    def tell(*shards, **more):
        path.write_text(json.dumps({"shards": list(shards)} | more))
        return str(path)

    return tell


@pytest.fixture(scope="module")
def source(spark):
    return kinesis.register(spark, Recorded, "recorded_shards")


def _read(spark, source, path, home, **options):
    """What a run over the input that is there adds, in the order it was written, by batch."""
    stream = spark.readStream.format(source).options(stream="events", recorded=path, **options).load()
    rows = stream.selectExpr("shard", "sequence", "cast(data as string) AS text", "arrival")
    jobs.run_available(rows, jobs.append_table(f"{home}/rows"), f"{home}/checkpoint")
    return [r.text for r in spark.read.parquet(f"{home}/rows").orderBy("arrival").collect()]


A, B, C = "a0 a1 a2 a3 a4 a5 a6".split(), "b0 b1".split(), "c0 c1 c2".split()


def test_restarts_neither_lose_nor_repeat(spark, source, story, tmp_path):
    home = str(tmp_path / "run")
    for n, m in ((0, 0), (2, 1), (2, 1), (7, 2)):  # more arrives between the runs, or nothing
        path = story(shard("s-1", records(25, A[:n])), shard("s-2", records(30, B[:m])))
        if n:
            assert sorted(_read(spark, source, path, home)) == sorted(A[:n] + B[:m])


def test_split_and_merge(spark, source, story, tmp_path):
    """Children come after their parents, whatever part of the parents was read before."""
    home = str(tmp_path / "run")
    parent = records(25, A, 5000)
    assert _read(spark, source, story(shard("s-1", parent[:3])), home) == A[:3]
    # split while records are unread, and one child merged with another shard since
    children = [shard("s-2", records(26, B, 4000), ["s-1"], closed=True), shard("s-3", records(26, ["x"], 4000), ["s-1"])]
    merged = shard("s-4", records(27, C, 3000), ["s-2", "s-0"])
    path = story(shard("s-1", parent, closed=True), *children, merged, shard("s-0", [], closed=True))
    assert sorted(_read(spark, source, path, home)) == sorted([*A, *B, "x", *C])
    reader = kinesis.ShardReader({"stream": "events", "recorded": path}, Recorded)
    start = {"shards": {"s-1": parent[2]["seq"]}, "parents": {}}
    (own,) = reader.partitions(start, reader.latestOffset())  # one lineage, in one task
    texts = [t.decode() for batch in reader.read(own) for t in batch["data"].to_pylist()]
    assert texts == [*A[3:], *B, "x", *C]
    # once the parent is read, its children are read side by side
    start["shards"]["s-1"] = reader.latestOffset()["shards"]["s-1"]
    assert len(reader.partitions(start, reader.latestOffset())) == 2


def test_a_batch_ends_where_it_was_planned(story):
    """Records that come after the plan belong to the next batch, also if the batch is run again."""
    options = {"stream": "events", "recorded": story(shard("s-1", records(25, A[:4])))}
    reader = kinesis.ShardReader(options, Recorded)
    start, end = reader.initialOffset(), reader.latestOffset()
    story(shard("s-1", records(25, A)))
    for _ in range(2):
        again = kinesis.ShardReader(options, Recorded)
        texts = [t for p in again.partitions(start, end) for b in again.read(p) for t in b["data"].to_pylist()]
        assert [t.decode() for t in texts] == A[:4]
    (rest,) = reader.partitions(end, reader.latestOffset())
    assert [t.decode() for b in reader.read(rest) for t in b["data"].to_pylist()] == A[4:]


def test_latest_begins_with_what_comes(spark, source, story, tmp_path):
    home = str(tmp_path / "run")
    shards = shard("s-0", records(24, ["old"]), closed=True), shard("s-1", records(25, A[:3]))
    path = story(*shards)
    rows = spark.readStream.format(source).options(stream="events", recorded=path, position="LATEST").load()
    jobs.run_available(rows.selectExpr("cast(data as string) AS text", "arrival"), jobs.append_table(f"{home}/rows"), f"{home}/checkpoint")
    story(shards[0], shard("s-1", records(25, A)), shard("s-2", records(26, B), ["s-0"]))
    assert sorted(_read(spark, source, path, home, position="LATEST")) == sorted(A[3:] + B)


def test_the_driver_looks_at_the_newest_records_only(story):
    busy = records(25, [f"r{i}" for i in range(50)], 0.8)  # the last second
    old = [{"seq": str(i + 1), "data": "old", "age": 9000} for i in range(5000)]
    client = Recorded({"recorded": story(shard("s-1", old + busy)), "page": 1000})
    stream = kinesis.Stream(client, "events")
    assert stream.newest("s-1", "", NOW) == busy[-1]["seq"]
    assert all(at >= 5000 for _, at in client.asked)
    client.asked.clear()
    assert stream.newest("s-1", busy[-1]["seq"], NOW + timedelta(hours=1)) == busy[-1]["seq"]
    assert all(at >= 5000 for _, at in client.asked)


def test_passing_errors(story):
    path = story(shard("s-1", records(25, A)), throttled=[1, 2], expired=[4])
    waits = []
    stream = kinesis.Stream(Recorded({"recorded": path}), "events", waits.append)
    assert [r["Data"].decode() for page in stream.records("s-1", "") for r in page] == A
    assert waits == [0.25, 0.5]
    client = Recorded({"recorded": story(shard("s-1", records(25, A)), throttled=list(range(1, 20)))})
    with pytest.raises(Exception, match="later"):
        list(kinesis.Stream(client, "events", waits.append).records("s-1", ""))


def test_lines_of_the_source_section(spark, story):
    config = SourceConfig(datastreamName="events", awsRegion="here", streamInitialPosition="TRIM_HORIZON")
    got = lines.kinesis_lines(spark, config, Recorded, recorded=story(shard("s-1", records(25, A))))
    assert got.isStreaming and got.columns == ["value", "arrival"]
