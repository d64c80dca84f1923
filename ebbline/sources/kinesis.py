"""A Kinesis source in the Python data source API: no connector is needed on the class path.

Offsets are sequence numbers per shard, so a micro-batch that is run again reads the same records.  The driver only asks
for the shards and for the newest sequence number of each, for which it looks at the shard's last second (more only if
that is empty); executors read the records, a task for each shard.  When a shard was split or merged, and its own
records are not all read, its children are read after it, in the same task.

``open_client`` gets the options and returns a client with the public API's ``list_shards``, ``get_shard_iterator`` and
``get_records``; without it the AWS client library is used, which must then be installed.
"""

from __future__ import annotations

import sys
import time
from collections.abc import Callable, Iterator
from datetime import datetime, timedelta, timezone

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

# executors get this module with the query and need not have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NAME = "kinesis_shards"
SCHEMA = "shard string, sequence string, partition_key string, data binary, arrival timestamp"
ARROW = pa.schema(
    [
        ("shard", pa.string()),
        ("sequence", pa.string()),
        ("partition_key", pa.string()),
        ("data", pa.binary()),
        ("arrival", pa.timestamp("us", tz="UTC")),
    ]
)
# Records of a request, the service's errors that pass, and how often and long to wait for them.
LIMIT = 10_000
PASSING = ("ProvisionedThroughputExceededException", "LimitExceededException", "KMSThrottlingException")
EXPIRED = "ExpiredIteratorException"
ATTEMPTS, WAIT = 8, 0.25
GLANCES = (1, 10)  # seconds before now that are looked at for the newest record

NOTHING = ""  # the offset before the first record of a shard


def aws_client(options: dict[str, str]):
    """A client of the AWS library from the options of the source section, with an assumed role if one is named."""
    import boto3  # not part of this library

    def given(**names):
        return {k: options[o] for k, o in names.items() if options.get(o)}

    keys = given(aws_access_key_id="accesskeyid", aws_secret_access_key="secretkey")
    if options.get("rolearn"):
        sts = boto3.client("sts", **given(region_name="region"), **keys)
        role = sts.assume_role(RoleArn=options["rolearn"], RoleSessionName=options["sessionname"])["Credentials"]
        keys = {
            "aws_access_key_id": role["AccessKeyId"],
            "aws_secret_access_key": role["SecretAccessKey"],
            "aws_session_token": role["SessionToken"],
        }
    return boto3.client("kinesis", **given(region_name="region", endpoint_url="endpoint"), **keys)


def after(sequence: str, other: str) -> bool:
    """Whether a sequence number (or the place before all) comes after another."""
    return int(sequence or -1) > int(other or -1)


class Stream:
    """The shards and records of one stream."""

    def __init__(self, client, name: str, sleep: Callable[[float], None] = time.sleep):
        self.client, self.name, self.sleep = client, name, sleep

    def _ask(self, what: str, **arguments) -> dict:
        for attempt in range(ATTEMPTS):
            try:
                return getattr(self.client, what)(**arguments)
            except Exception as e:
                code = getattr(e, "response", {}).get("Error", {}).get("Code", type(e).__name__)
                if code not in PASSING or attempt == ATTEMPTS - 1:
                    raise
                self.sleep(WAIT * 2**attempt)
        raise AssertionError

    def shards(self) -> list[dict]:
        """``id``, ``parents`` and, once closed, ``end`` of every shard."""
        out, token = [], None
        while True:
            page = self._ask("list_shards", **({"NextToken": token} if token else {"StreamName": self.name}))
            for s in page["Shards"]:
                parents = [s[p] for p in ("ParentShardId", "AdjacentParentShardId") if s.get(p)]
                out.append({"id": s["ShardId"], "parents": parents, "end": s["SequenceNumberRange"].get("EndingSequenceNumber")})
            token = page.get("NextToken")
            if not token:
                return out

    def _iterator(self, shard: str, kind: str, **more) -> str:
        return self._ask("get_shard_iterator", StreamName=self.name, ShardId=shard, ShardIteratorType=kind, **more)["ShardIterator"]

    def _from(self, shard: str, last: str) -> str:
        if not last:
            return self._iterator(shard, "TRIM_HORIZON")
        return self._iterator(shard, "AFTER_SEQUENCE_NUMBER", StartingSequenceNumber=last)

    def records(self, shard: str, last: str, iterator: str | None = None) -> Iterator[list[dict]]:
        """Records after ``last``, request by request, up to the newest one."""
        iterator = iterator or self._from(shard, last)
        while iterator:
            try:
                page = self._ask("get_records", ShardIterator=iterator, Limit=LIMIT)
            except Exception as e:
                if getattr(e, "response", {}).get("Error", {}).get("Code", type(e).__name__) != EXPIRED:
                    raise
                iterator = self._from(shard, last)
                continue
            if page["Records"]:
                last = page["Records"][-1]["SequenceNumber"]
                yield page["Records"]
            elif not page.get("MillisBehindLatest"):
                return
            iterator = page.get("NextShardIterator")

    def newest(self, shard: str, known: str, now: datetime) -> str:
        """The newest sequence number, as cheaply as it can be found."""
        for seconds in GLANCES:
            at = self._iterator(shard, "AT_TIMESTAMP", Timestamp=now - timedelta(seconds=seconds))
            found = known
            for records in self.records(shard, known, at):
                found = max(found, records[-1]["SequenceNumber"], key=lambda s: int(s or -1))
            if found != known:
                return found
        for records in self.records(shard, known):  # a quiet shard: what came since it was last looked at
            known = records[-1]["SequenceNumber"]
        return known


class Lineage(InputPartition):
    """Shards to be read one after the other: ``(shard, last read, end)``."""

    def __init__(self, parts: list[tuple[str, str, str]]):
        super().__init__(None)
        self.parts = parts


def lineages(start: dict[str, str], end: dict[str, str], parents: dict[str, list[str]]) -> list[Lineage]:
    """The shards with records in a batch; those whose parents have some too come after them, in one partition."""
    wanted = {s: (start.get(s, NOTHING), e) for s, e in end.items() if after(e, start.get(s, NOTHING))}
    group = {s: s for s in wanted}

    def root(s: str) -> str:
        while group[s] != s:
            s = group[s]
        return s

    depth: dict[str, int] = {}

    def level(s: str) -> int:
        if s not in depth:
            depth[s] = 1 + max((level(p) for p in parents.get(s, ()) if p in wanted), default=-1)
        return depth[s]

    for s in wanted:
        for p in parents.get(s, ()):
            if p in wanted:
                group[root(s)] = root(p)
    out: dict[str, list[tuple[str, str, str]]] = {}
    for s in sorted(wanted, key=lambda s: (level(s), s)):
        out.setdefault(root(s), []).append((s, *wanted[s]))
    return [Lineage(parts) for _, parts in sorted(out.items())]


class ShardReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str], open_client: Callable[[dict], object]):
        self.options, self.open_client = options, open_client
        self.known: dict[str, str] = {}
        self._stream: Stream | None = None

    def stream(self) -> Stream:
        if self._stream is None:
            self._stream = Stream(self.open_client(self.options), self.options["stream"])
        return self._stream

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_stream": None, "known": {}}  # executors open their own client

    def initialOffset(self) -> dict:
        if self.options.get("position", "TRIM_HORIZON") == "TRIM_HORIZON":
            return {"shards": {}, "parents": {}}
        return self.latestOffset()

    def latestOffset(self) -> dict:
        shards, now = self.stream().shards(), datetime.now(timezone.utc)
        for s in shards:
            self.known[s["id"]] = s["end"] or self.stream().newest(s["id"], self.known.get(s["id"], NOTHING), now)
        # a shard listed after another was looked at may hold newer records: it is read with them
        return {"shards": {s["id"]: self.known[s["id"]] for s in shards}, "parents": {s["id"]: s["parents"] for s in shards}}

    def partitions(self, start: dict, end: dict) -> list[Lineage]:
        return lineages(start["shards"], end["shards"], end["parents"]) or [Lineage([])]

    def read(self, partition: Lineage) -> Iterator[pa.RecordBatch]:
        for shard, last, end in partition.parts:
            for records in self.stream().records(shard, last):
                own = [r for r in records if not after(r["SequenceNumber"], end)]
                if own:
                    yield pa.RecordBatch.from_pydict(
                        {
                            "shard": [shard] * len(own),
                            "sequence": [r["SequenceNumber"] for r in own],
                            "partition_key": [r.get("PartitionKey") for r in own],
                            "data": [r["Data"] for r in own],
                            "arrival": [r["ApproximateArrivalTimestamp"] for r in own],
                        },
                        schema=ARROW,
                    )
                if len(own) < len(records) or own[-1]["SequenceNumber"] == end:
                    break

    def commit(self, end: dict) -> None:
        pass


def register(spark: SparkSession, open_client: Callable[[dict], object] = aws_client, name: str = NAME) -> str:
    """Make the source known to the session; options are ``stream``, ``position`` and the client's."""

    class ShardSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return SCHEMA

        def streamReader(self, schema: StructType) -> ShardReader:
            return ShardReader(dict(self.options), open_client)

    spark.dataSource.register(ShardSource)
    return name
