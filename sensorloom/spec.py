"""Declarative inputs of the operators: sensors, column names, incident calendar."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

ANALOG = "analog"
DIGITAL = "digital"


@dataclass(frozen=True)
class Sensor:
    name: str
    kind: str
    unit: str = "unknown"
    station: str = "unknown"


@dataclass(frozen=True)
class Delta:
    """A derived signal ``left - right``."""

    name: str
    left: str
    right: str


@dataclass(frozen=True)
class StateBands:
    """Lower bounds, highest first, that turn one sensor into a named state."""

    source: str
    bands: tuple[tuple[float, str], ...]
    default: str

    @property
    def states(self) -> tuple[str, ...]:
        return tuple(name for _, name in self.bands) + (self.default,)


@dataclass(frozen=True)
class SensorSpec:
    sensors: tuple[Sensor, ...]
    bands: StateBands
    deltas: tuple[Delta, ...] = ()
    key_digital: tuple[str, ...] = ()
    aliases: dict[str, str] = field(default_factory=dict, hash=False)
    time_format: str = "yyyy-MM-dd HH:mm:ss"
    time: str = "event_time"
    row_id: str = "raw_index"
    by: tuple[str, ...] = ()
    state: str = "operating_state"
    flag: str = "is_failure_window"
    label: str = "failure_type"
    day: str = "dt"
    bucket: str = "event_minute"
    bucket_unit: str = "minute"

    @property
    def analog(self) -> list[str]:
        return [s.name for s in self.sensors if s.kind == ANALOG]

    @property
    def digital(self) -> list[str]:
        return [s.name for s in self.sensors if s.kind == DIGITAL]

    @property
    def names(self) -> list[str]:
        return [s.name for s in self.sensors]

    @property
    def signals(self) -> list[str]:
        """Continuous signals: analog sensors and deltas."""
        return self.analog + [d.name for d in self.deltas]


_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def unit_seconds(unit: str) -> int:
    return _UNIT_SECONDS[unit]


@dataclass(frozen=True)
class Interval:
    id: int
    start: datetime
    end: datetime
    type: str

    @property
    def severity(self) -> str:
        return severity_of(self.type)


def severity_of(interval_type: str) -> str:
    return "high_stress" if "high" in interval_type else "unknown"


def micros_of(moment: datetime) -> int:
    """Microseconds since the epoch of a zone-less time."""
    delta = moment.replace(tzinfo=timezone.utc) - datetime(1970, 1, 1, tzinfo=timezone.utc)
    return delta // timedelta(microseconds=1)


@dataclass(frozen=True)
class Calendar:
    """A short, configured list of incident intervals, closed on both ends.

    It is compiled into column expressions, so its length is bounded; tables of intervals
    go through ``operators.labels.interval_calendar`` and ``seconds_to_next``.
    """

    intervals: tuple[Interval, ...]

    LIMIT = 200

    def __post_init__(self) -> None:
        if len(self.intervals) > self.LIMIT:
            raise ValueError(f"a literal calendar holds at most {self.LIMIT} intervals")

    @classmethod
    def of(cls, rows: Iterable[tuple[str, str, str]]) -> Calendar:
        made = [
            Interval(i, datetime.fromisoformat(start), datetime.fromisoformat(end), kind)
            for i, (start, end, kind) in enumerate(rows, start=1)
        ]
        return cls(tuple(made))

    @classmethod
    def from_text(cls, text: str) -> Calendar:
        """Parse ``start|end|type;start|end|type``; a malformed part raises."""
        rows = []
        for part in filter(None, (p.strip() for p in text.split(";"))):
            fields = [f.strip() for f in part.split("|")]
            if len(fields) != 3 or not fields[2]:
                raise ValueError(f"expected start|end|type, got {part!r}")
            rows.append(tuple(fields))
        return cls.of(rows)

    def by_start(self) -> list[Interval]:
        return sorted(self.intervals, key=lambda i: (i.start, i.id))
