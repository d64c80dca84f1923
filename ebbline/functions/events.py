"""JSON engagement events: decode, police bad records, filter, encode."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbline.schemas import EVENT_COLUMNS, EVENT_JSON

POLICIES = ("fail", "drop", "quarantine")


def _parsed(value: Column) -> Column:
    schema = T.StructType([*EVENT_JSON.fields, T.StructField("_corrupt", T.StringType())])
    return F.from_json(value, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})


def _is_bad(value: Column, parsed: Column) -> Column:
    """Not one JSON object, a field of the wrong type, or an explicit null.

    A flat, complete record is parsed once.  Only where a field is missing and
    the text has a null somewhere are the keys listed, and only where something
    follows a closing brace is the line checked to be a single value.
    """
    missing = [parsed[f.name].isNull() for f in EVENT_JSON]
    keys = F.json_object_keys(value)
    explicit_null = reduce(
        Column.__or__,
        [parsed[f.name].isNull() & F.array_contains(keys, f.name) for f in EVENT_JSON],
    )
    values = F.json_array_length(F.concat(F.lit("["), value, F.lit("]")))
    return F.coalesce(
        parsed.isNull()
        | parsed["_corrupt"].isNotNull()
        | F.when(value.rlike(r"\}\s*\S"), F.coalesce(values, F.lit(0)) != 1).otherwise(F.lit(False))
        | F.when(
            value.contains("null") & reduce(Column.__or__, missing), F.coalesce(explicit_null, F.lit(True))
        ).otherwise(F.lit(False)),
        F.lit(True),
    )


def parse_events(lines: DataFrame, value: str = "value") -> DataFrame:
    """Add ``bad`` and the event columns; missing keys get "" or 0, unknown keys are ignored."""
    kept = [F.col(c) for c in lines.columns if c != value]
    # exploded from an array of one: no filter is pushed below that, which would parse again
    staged = lines.select(*kept, F.col(value).alias("raw"), F.explode(F.array(_parsed(F.col(value)))).alias("_p"))
    p = F.col("_p")
    fields = [
        F.coalesce(
            p[f.name], F.lit(0).cast("bigint") if isinstance(f.dataType, T.LongType) else F.lit("")
        ).alias(name)
        for f, name in zip(EVENT_JSON, EVENT_COLUMNS)
    ]
    return staged.select(
        *kept,
        "raw",
        _is_bad(F.col("raw"), p).alias("bad"),
        *fields,
        F.lit(1).cast("bigint").alias("event_count"),
    )


def decode_events(lines: DataFrame, value: str = "value", on_bad_record: str = "fail") -> DataFrame:
    """Decode one JSON event per line.

    ``fail`` stops the job at the first bad record, ``drop`` skips bad records,
    ``quarantine`` keeps every line with its ``raw`` text and a ``bad`` flag so
    that the caller can route it.
    """
    if on_bad_record not in POLICIES:
        raise ValueError(f"on_bad_record must be one of {POLICIES}, not {on_bad_record!r}")
    parsed = parse_events(lines, value)
    if on_bad_record == "quarantine":
        return parsed
    if on_bad_record == "drop":
        return parsed.where(~F.col("bad")).drop("raw", "bad")
    stop = F.raise_error(F.concat(F.lit("malformed event: "), F.coalesce("raw", F.lit("<null>"))))
    # the guard sits in a filter, so that column pruning cannot drop it
    return parsed.where(F.when(F.col("bad"), stop.cast("boolean")).otherwise(F.lit(True))).drop("raw", "bad")


def allow_events(events: DataFrame, allowed: list[str]) -> DataFrame:
    """Keep the listed event names."""
    return events.where(F.col("event_name").isin(*allowed))


def encode_events(events: DataFrame) -> DataFrame:
    """The inverse of :func:`decode_events`: one JSON line per event, in ``value``."""
    kept = [F.col(c) for c in events.columns if c not in (*EVENT_COLUMNS, "event_count")]
    body = F.struct(*[F.col(c).alias(f.name) for f, c in zip(EVENT_JSON, EVENT_COLUMNS)])
    return events.select(F.to_json(body).alias("value"), *kept)
