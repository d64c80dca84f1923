"""Run a job: ``spark-submit submit.py JOB --source ... --checkpoint DIR [--output DIR]``.

Jobs: ``words`` (per window), ``lifetime`` (words since the beginning),
``counters`` (decayed counters per user), ``candidates`` (decayed counters
per media and the list of the best) and ``late`` (events that come after their
window has closed, and how many there were in each batch).

Sources: ``files:DIR``, ``kafka:SERVERS/TOPIC``, or ``config`` for the stream
named in the YAML file given by ``--config``.

``--client module:function`` also writes counters and lists to the key-value
tables that the sink section of that file names.  The function gets the section
and a table's name, on the executors, and returns a client (see
:func:`ebbline.sinks.tables.write_items`).
"""

from __future__ import annotations

import argparse
import importlib
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from ebbline.config import load_config
from ebbline.functions import items
from ebbline.functions.events import allow_events, decode_events
from ebbline.operators.late import LateSplit, seconds
from ebbline.session import prepare
from ebbline.sinks.tables import (
    TopListTable,
    UpsertTable,
    fan_out_writer,
    item_writer,
    to_console,
    to_files,
    write_items,
)
from ebbline.sources.lines import START, decode_base64, kafka_lines, kinesis_lines, replayed_lines
from ebbline.streaming import jobs

# The defaults of window, decay intervals, listed events, list size and trigger.
WINDOW = "5 seconds"
INTERVALS = [5, 10, 15]
ALLOWED = ["view", "like"]
FEATURE, SCORE_INTERVAL, LIST_SIZE = "view", 15, 500
TRIGGER = "5 seconds"


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description="Feature counters and candidate lists on Spark")
    p.add_argument("job", choices=["words", "lifetime", "counters", "candidates", "late"])
    p.add_argument("--source", required=True)
    p.add_argument("--config", help="YAML file with the source and sink sections")
    p.add_argument("--checkpoint", required=True, help="folder every executor can reach")
    p.add_argument("--output", help="folder for results; without it they go to the console")
    p.add_argument("--tokeniser", default="words")
    p.add_argument("--base64", action="store_true")
    p.add_argument("--event-time", default="arrival", choices=["arrival", "payload"])
    p.add_argument("--delay", default="0 seconds")
    p.add_argument("--on-bad-record", default="fail", choices=["fail", "drop"])
    p.add_argument("--ttl-days", type=float, default=jobs.TTL_DAYS)
    p.add_argument("--trigger", default=TRIGGER, help="time between micro-batches, each of which is checkpointed")
    p.add_argument("--partitions", type=int, help="state partitions, by default one per core of the cluster")
    p.add_argument("--files-per-batch", type=int, help="limit for a files source")
    p.add_argument("--client", help="module:function that opens a key-value client")
    p.add_argument("--window", default=WINDOW)
    p.add_argument("--intervals", type=int, nargs="+", default=INTERVALS, help="decay intervals in seconds")
    p.add_argument("--allowed", nargs="+", default=ALLOWED, help="events that are counted")
    p.add_argument("--feature", default=FEATURE, help="event that the list ranks by")
    p.add_argument("--score-interval", type=int, default=SCORE_INTERVAL)
    p.add_argument("--list-size", type=int, default=LIST_SIZE)
    p.add_argument("--list-mode", default="table", choices=["table", *jobs.MODES], help="keep the list by the counter table, or in state")
    p.add_argument("--list-days", type=float, default=jobs.TTL_DAYS, help="ids without events for so long leave the list")
    p.add_argument("--kafka-group", help="consumer group of a Kafka source")
    p.add_argument("--start", default="TRIM_HORIZON", choices=sorted(START), help="where a new Kafka checkpoint starts")
    p.add_argument("--initial", help="counter table of a backfill that a new checkpoint begins with")
    p.add_argument("--ttl-clock", default="processing", choices=["processing", "event"], help="what state expires by")
    p.add_argument("--once", action="store_true", help="stop at the end of the input; only event time expires state")
    return p.parse_args(argv)


def source_lines(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    kind, _, where = args.source.partition(":")
    if kind == "files":
        lines = replayed_lines(spark, where, args.files_per_batch)
    elif kind == "kafka":
        servers, _, topic = where.partition("/")
        lines = kafka_lines(spark, servers=servers, topic=topic, position=args.start, group=args.kafka_group)
    elif kind == "config":
        lines = kinesis_lines(spark, load_config(args.config, args.job == "candidates").source)
    else:
        raise ValueError(f"unknown source {args.source!r}")
    return decode_base64(lines) if args.base64 else lines


def build(spark: SparkSession, args: argparse.Namespace) -> DataStreamWriter:
    lines = source_lines(spark, args)
    by_event = args.ttl_clock == "event"
    ttl = None if args.once or by_event else jobs.ttl_millis(args.ttl_days)
    event_ttl = int(args.ttl_days * 86_400) if by_event else None
    if args.job in ("words", "lifetime"):
        stream = jobs.word_windows(lines, args.window, args.delay, args.tokeniser, by_event and args.job == "lifetime")
        if args.job == "lifetime":
            stream = jobs.lifetime_totals(stream, ["word"], ttl, event_ttl_s=event_ttl)
        if not args.output:
            return to_console(stream, args.checkpoint)
        if args.job == "words":
            return to_files(stream, args.output, args.checkpoint)
        return _upserted(stream, args, UpsertTable(args.output, ["word"], ["window_end"]).write)

    key = "media_id" if args.job == "candidates" else "user_id"
    events = allow_events(decode_events(lines, on_bad_record=args.on_bad_record), args.allowed)
    if args.job == "late":
        return _late(events, args)
    initial = UpsertTable(args.initial, ["feature_name", "key"], ["window_end"]).read(spark) if args.initial else None
    counters = jobs.event_counters(
        events, key, args.intervals, args.window, args.delay, args.event_time, ttl, initial, event_ttl
    )
    if not args.output:
        return to_console(counters, args.checkpoint)
    if args.job == "candidates" and args.list_mode != "table":
        listed = args.feature, args.score_interval, args.list_size
        lists = jobs.top_lists(counters, items.TOP_VIEWS, *listed, mode=args.list_mode, ttl_ms=ttl)
        return _upserted(lists, args, UpsertTable(f"{args.output}/lists", ["name"], ["updated"]).write)
    table = UpsertTable(f"{args.output}/counters", ["feature_name", "key"], ["window_end"])
    writers = [table.write]
    open_client, sink = _client(args)
    if open_client:
        writers.append(
            item_writer(items.counter_items, table.keys, table.order, partial(open_client, sink, sink.tableName))
        )
    if args.job == "candidates":
        best = TopListTable(
            f"{args.output}/candidates",
            items.TOP_VIEWS,
            args.feature,
            args.score_interval,
            args.list_size,
            counters=table,
            max_age=int(args.list_days * 86_400),
        )
        writers.append(best.write)
        if open_client:
            put = partial(open_client, sink, sink.cgTableName)
            writers.append(lambda rows, batch_id: write_items(items.list_items(best.read(rows.sparkSession)), put))
    return _upserted(counters, args, fan_out_writer(*writers))


def _late(events: DataFrame, args: argparse.Namespace) -> DataStreamWriter:
    """Late events below ``--output``, and the counts of every batch beside them."""
    if not args.output:
        raise ValueError("the job late needs --output")
    split = LateSplit(
        f"{args.output}/batches",
        seconds(args.window),
        jobs.append_table(f"{args.output}/late"),
        delay=seconds(args.delay),
        order=["arrival", "event_ts", "event_name", "user_id", "media_id"],
    )
    return _upserted(events, args, split.write)


def _client(args: argparse.Namespace):
    """The function that opens a client, and the sink section; nothing if no client is asked for."""
    if not args.client:
        return None, None
    if not args.config:
        raise ValueError("--client needs --config, whose sink section names the tables")
    module, _, function = args.client.partition(":")
    return getattr(importlib.import_module(module), function), load_config(args.config, args.job == "candidates").sink


def _upserted(stream: DataFrame, args: argparse.Namespace, write) -> DataStreamWriter:
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", args.checkpoint).outputMode("append")


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = prepare(SparkSession.builder.appName(f"ebbline-{args.job}").getOrCreate())
    writer = build(spark, args)
    trigger = {"availableNow": True} if args.once else {"processingTime": args.trigger}
    jobs.start(writer.trigger(**trigger), spark, args.partitions).awaitTermination()


if __name__ == "__main__":
    main()
