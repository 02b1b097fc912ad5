"""A commit log for the outputs of a stream: readers see whole batches, whatever happens while one is written.

Every attempt of a batch writes folders of its own.  When all outputs of the batch are there, one small record that names
them is renamed into the log, which is atomic; a repeated batch replaces its record, so readers see the old attempt or the
new one and never a part.  A record adds folders to a day or replaces what the day had.  The state is the records in the
order of their batches.  ``compact`` folds days of many folders into one and the records so far into a snapshot; ``clean``
removes folders that no record names any more.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.streaming.stores import Files

_LOG = "_commits"
_DAY = "_day"
#: Name of the only part of an output that has no days.
ALL = ""

State = dict[str, dict[str, list[str]]]


@dataclass
class Change:
    """What a batch does to one output: day to folders, added to those it has or in their place."""

    output: str
    folders: Mapping[str, Sequence[str]] = field(default_factory=dict)
    replace: bool = False


class Commits:
    def __init__(self, base: str):
        self.base = base.rstrip("/")

    def _log(self, spark: SparkSession) -> Files:
        return Files(spark, f"{self.base}/{_LOG}")

    def _records(self, spark: SparkSession, before: int | None) -> list[tuple[int, bool, dict]]:
        """Latest snapshot and the records after it, by batch."""
        log = self._log(spark)
        for attempt in range(5):
            found = []
            for name in log.names():
                stem, kind = name.split(".")[0], name.split(".")[1:]
                if kind in (["json"], ["snapshot", "json"]) and (before is None or int(stem) < before):
                    found.append((int(stem), len(kind) == 2, name))
            last = max((n for n, whole, _ in found if whole), default=-1)
            wanted = sorted((n, not whole, name) for n, whole, name in found if n > last or (whole and n == last))
            try:
                return [(n, not plain, json.loads(log.read(name))) for n, plain, name in wanted]
            except Exception:
                if attempt == 4:
                    raise  # else a compaction removed a record between listing and reading: list again
        return []

    def state(self, spark: SparkSession, before: int | None = None) -> State:
        """Output to day to folders after all batches, or after those before one."""
        out: State = {}
        for _, whole, record in self._records(spark, before):
            if whole:
                out = record
                continue
            for change in record["changes"]:
                days = out.setdefault(change["output"], {})
                for day, folders in change["folders"].items():
                    days[day] = list(folders) if change["replace"] else [*days.get(day, []), *folders]
        return out

    def write(self, rows: DataFrame, output: str, batch_id: int, day: str | None = None) -> dict[str, list[str]]:
        """Write one output of an attempt, a folder per day; nothing of it counts before ``commit``.

        Each task writes a file per day it has rows of, so large ``rows`` should be rebalanced by day.
        """
        folder = f"{output}/{batch_id:010d}-{uuid.uuid4().hex}"
        if day is None:
            rows.write.parquet(f"{self.base}/{folder}")
            return {ALL: [folder]}
        rows.withColumn(_DAY, F.col(day)).write.partitionBy(_DAY).parquet(f"{self.base}/{folder}")
        names = Files(rows.sparkSession, f"{self.base}/{folder}").names()
        return {n.split("=", 1)[1]: [f"{folder}/{n}"] for n in names if n.startswith(f"{_DAY}=")}

    def commit(self, spark: SparkSession, batch_id: int, changes: Iterable[Change]) -> None:
        record = {"changes": [{"output": c.output, "folders": {d: list(f) for d, f in c.folders.items()}, "replace": c.replace} for c in changes]}
        self._log(spark).put(f"{batch_id:020d}.json", json.dumps(record))

    def folders(self, spark: SparkSession, output: str, days: Iterable[str] | None = None, before: int | None = None) -> list[str]:
        held = self.state(spark, before).get(output, {})
        return [f"{self.base}/{f}" for d in (held if days is None else sorted(set(days) & set(held))) for f in held[d]]

    def read(self, spark: SparkSession, output: str, schema: T.StructType, days: Iterable[str] | None = None, before: int | None = None) -> DataFrame:
        """Rows of an output; with ``days`` nothing of other days is listed or read."""
        found = self.folders(spark, output, days, before)
        return spark.read.schema(schema).parquet(*found) if found else spark.createDataFrame([], schema)

    def compact(self, spark: SparkSession, upto: int, most: int = 16) -> None:
        """Fold the records of batches before ``upto`` into a snapshot, and each day of more than ``most`` folders into one.

        Batches before ``upto`` must be done with.  Folders that are folded stay until ``clean``, for readers at work.
        """
        if upto <= 0:
            return
        held = self.state(spark, upto)
        for output, days in held.items():
            crowded = [d for d, folders in days.items() if len(folders) > most]
            for d in crowded:
                rows = spark.read.parquet(*[f"{self.base}/{f}" for f in days[d]])
                target = f"{output}/{upto - 1:010d}-{uuid.uuid4().hex}"
                rows.write.parquet(f"{self.base}/{target}")
                days[d] = [target]
        log = self._log(spark)
        old = [n for n in log.names() if n.endswith(".json") and int(n.split(".")[0]) < upto]
        name = f"{upto - 1:020d}.snapshot.json"
        log.put(name, json.dumps(held))
        for n in old:
            if n != name:
                log.remove(n)

    def clean(self, spark: SparkSession, older_than_seconds: int = 86_400) -> int:
        """Remove folders that the log does not name and that are older; their number."""
        held = self.state(spark)
        live = {"/".join(f.split("/")[:2]) for days in held.values() for folders in days.values() for f in folders}
        removed = 0
        for output in Files(spark, self.base).names():
            if output == _LOG:
                continue
            files = Files(spark, f"{self.base}/{output}")
            for name in files.names(older_than_seconds):
                if f"{output}/{name}" not in live:
                    files.remove(name)
                    removed += 1
        return removed
