"""Job configuration read from YAML: a ``source`` and a ``sink`` section."""

from __future__ import annotations

from dataclasses import MISSING, dataclass, fields

import yaml

POSITIONS = ("TRIM_HORIZON", "LATEST")


@dataclass(frozen=True)
class SourceConfig:
    # The YAML keys and their defaults.
    datastreamName: str
    awsEndpoint: str | None = None
    awsRegion: str | None = None
    awsAccessKeyId: str | None = None
    awsSecretAccessKey: str | None = None
    streamInitialPosition: str = "TRIM_HORIZON"
    kinesaliteTimestampFix: bool = False
    awsAssumeRoleArn: str | None = None

    def __post_init__(self):
        if self.streamInitialPosition not in POSITIONS:
            raise ValueError(f"source.streamInitialPosition must be one of {POSITIONS}")


@dataclass(frozen=True)
class SinkConfig:
    # The YAML keys and their defaults.
    tableName: str
    cgTableName: str | None = None
    awsEndpoint: str | None = None
    awsRegion: str | None = None
    awsAccessKeyId: str | None = None
    awsSecretAccessKey: str | None = None


@dataclass(frozen=True)
class JobConfig:
    source: SourceConfig
    sink: SinkConfig


def _section(cls, name: str, raw: dict):
    known = {f.name for f in fields(cls)}
    needed = {f.name for f in fields(cls) if f.default is MISSING}
    unknown, missing = set(raw) - known, needed - set(raw)
    if unknown or missing:
        raise ValueError(f"{name}: missing {sorted(missing)}, unknown {sorted(unknown)}")
    return cls(**raw)


def parse_config(text: str, candidates: bool = False) -> JobConfig:
    """Parse and check; ``candidates`` jobs also need ``sink.cgTableName``."""
    raw = yaml.safe_load(text) or {}
    config = JobConfig(
        _section(SourceConfig, "source", raw.get("source") or {}),
        _section(SinkConfig, "sink", raw.get("sink") or {}),
    )
    if candidates and not config.sink.cgTableName:
        raise ValueError("sink: missing ['cgTableName']")
    return config


def load_config(path: str, candidates: bool = False) -> JobConfig:
    with open(path, encoding="utf-8") as f:
        return parse_config(f.read(), candidates)
