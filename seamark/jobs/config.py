"""Settings of the jobs, from arguments, environment variables and a flat TOML file, in this order of precedence."""

from __future__ import annotations

import dataclasses
import json
import os
import tomllib
import types
import typing
from collections.abc import Mapping
from dataclasses import dataclass

from seamark.functions.times import GRAINS
from seamark.operators.partitions import PartitionFilter

#: Words that switch a setting off.
OFF = ("", "0", "f", "false", "n", "no", "off")


@dataclass(frozen=True)
class IngestConfig:
    """Files under the input folders to lines in time partitions under ``output_dir``."""

    input_dir: tuple[str, ...]
    output_dir: str = "data"
    partition: str = "day"
    source: str | None = None
    max_rows: int | None = None
    compression_level: int = 5
    max_line_length: int = 65536

    def validate(self) -> None:
        check_common(self)
        if self.max_line_length < 1 or (self.max_rows is not None and self.max_rows < 1):
            raise ValueError("max_line_length and max_rows are 1 or more")


@dataclass(frozen=True)
class DecodeConfig:
    """Lines in time partitions to the typed tables; ``since`` is in hours back from now, ``feed`` is nmea or json."""

    input_dir: tuple[str, ...]
    output_dir: str
    partition: str = "day"
    feed: str = "nmea"
    filter_source: str | None = None
    year: int | None = None
    month: int | None = None
    day: int | None = None
    hour: int | None = None
    minute: int | None = None
    since: int | None = None
    incremental: bool = False
    consolidate_ais: bool = False
    process_timestamps: bool = False
    compression_level: int = 5
    scratch_dir: str | None = None
    eta_year: int | None = None
    h3: bool = True
    namespace: str | None = None
    table_prefix: str | None = None
    dry_run: bool = False

    def validate(self) -> None:
        check_common(self)
        if self.feed not in ("nmea", "json"):
            raise ValueError("feed is nmea or json")
        if self.feed == "json" and (self.consolidate_ais or self.process_timestamps):
            raise ValueError("messages of a JSON feed are whole and carry no times of lines before them")
        fixed = [g for g in GRAINS if getattr(self, g) is not None]
        if self.incremental and fixed:
            raise ValueError(f"an incremental run has its own lower bound, which excludes {fixed[0]}")
        for name, low, high in (("month", 1, 12), ("day", 1, 31), ("hour", 0, 23), ("minute", 0, 59)):
            value = getattr(self, name)
            if value is not None and not low <= value <= high:
                raise ValueError(f"{name} is {low} to {high}")
        self.filter(0).validate(self.partition)

    def filter(self, now_ms: int) -> PartitionFilter:
        """What a run may read; in an incremental run ``since`` is only the first run's lower bound, not a filter."""
        since_ms = None if self.since is None or self.incremental else now_ms - self.since * 3_600_000
        return PartitionFilter(**{g: getattr(self, g) for g in GRAINS}, since_ms=since_ms, source=self.filter_source)


@dataclass(frozen=True)
class ListenConfig:
    """A feed of lines to time partitions under ``output_dir``; ``name`` is the query's, for ever, and batches are ``seconds`` apart."""

    feed: str
    output_dir: str = "data"
    partition: str = "day"
    source: str | None = None
    name: str = "listen"
    seconds: int = 10
    max_line_length: int = 65536
    tcp_host: str | None = None
    tcp_port: int | None = None
    websocket_url: str | None = None
    api_key: str | None = None
    bounding_boxes: str = "[[[-90, -180], [90, 180]]]"
    filter_mmsi: tuple[str, ...] = ()
    filter_message_types: tuple[str, ...] = ()
    kafka_brokers: str | None = None
    kafka_topic: str | None = None
    kafka_auto_offset_reset: str = "latest"
    buffer_dir: str | None = None
    checkpoint_dir: str | None = None
    status_file: str | None = None

    def validate(self) -> None:
        needs = {"tcp": ("tcp_host", "tcp_port"), "websocket": ("websocket_url",), "kafka": ("kafka_brokers", "kafka_topic")}
        if self.feed not in needs:
            raise ValueError(f"feed is one of {', '.join(needs)}")
        missing = [name for name in needs[self.feed] if getattr(self, name) is None]
        if missing:
            raise ValueError(f"a {self.feed} feed needs {' and '.join(missing)}")
        if self.partition not in GRAINS or not self.output_dir:
            raise ValueError(f"output_dir is required and partition is one of {', '.join(GRAINS)}")
        if self.seconds < 1 or self.max_line_length < 1:
            raise ValueError("seconds and max_line_length are 1 or more")
        if self.kafka_auto_offset_reset not in ("earliest", "latest"):
            raise ValueError("kafka_auto_offset_reset is earliest or latest")
        pair = lambda x: isinstance(x, list) and len(x) == 2
        boxes = json.loads(self.bounding_boxes)
        if not isinstance(boxes, list) or not boxes or not all(pair(box) and all(pair(corner) for corner in box) for box in boxes):
            raise ValueError("bounding_boxes are JSON, two corners each")


def check_common(config: IngestConfig | DecodeConfig) -> None:
    if not config.input_dir:
        raise ValueError("input_dir is required")
    if not config.output_dir:
        raise ValueError("output_dir is required")
    if config.partition not in GRAINS:
        raise ValueError(f"partition is one of {', '.join(GRAINS)}")
    if not 1 <= config.compression_level <= 22:
        raise ValueError("compression_level is 1 to 22")


def from_file(path: str) -> dict[str, str]:
    """The settings of a flat TOML file as text; arrays are joined by commas, tables rejected."""
    with open(path, "rb") as file:
        table = tomllib.load(file)
    found = {}
    for key, value in table.items():
        if isinstance(value, dict):
            raise ValueError(f"{path}: {key} is a table, but settings are a flat list")
        if isinstance(value, list):
            if not all(isinstance(v, str) or type(v) is int for v in value):
                raise ValueError(f"{path}: {key} has an element that is neither text nor an integer")
            found[key] = ",".join(map(str, value))
        else:
            found[key] = str(value).lower() if isinstance(value, bool) else str(value)
    return found


def read(kind: object, text: str) -> object:
    """``text`` as a value of a field's type; an empty one is no value where the field may be None."""
    if typing.get_origin(kind) is types.UnionType:
        return read(typing.get_args(kind)[0], text) if text else None
    if kind is bool:
        return text.strip().lower() not in OFF
    if typing.get_origin(kind) is tuple:
        return tuple(part for part in text.split(",") if part)
    return kind(text)


def load(kind: type, given: Mapping[str, object] | None = None, environ: Mapping[str, str] | None = None, file: str | None = None):
    """A valid configuration of the class ``kind``. Variables and the file's keys are field names in capitals."""
    environ = os.environ if environ is None else environ
    path = file or environ.get("CONFIG_FILE")
    texts = {**(from_file(path) if path else {}), **environ}
    hints = typing.get_type_hints(kind)
    names = {f.name for f in dataclasses.fields(kind)}
    given = dict(given or {})
    if unknown := sorted(given.keys() - names):
        raise ValueError(f"unknown settings: {', '.join(unknown)}")
    values = {name: read(hints[name], texts[name.upper()]) for name in names if name not in given and name.upper() in texts}
    try:
        config = kind(**values, **given)
    except TypeError as missing:
        raise ValueError(str(missing)) from missing
    config.validate()
    return config
