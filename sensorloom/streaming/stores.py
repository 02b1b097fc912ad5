"""Latest-state stores behind ``foreachBatch``."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Sequence
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.streaming.pipeline import latest_per_key

log = logging.getLogger(__name__)


class KeyValueStore(Protocol):
    """Where the newest row per key goes; a batch may be written twice after a failure."""

    def write(self, latest: DataFrame, batch_id: int) -> None: ...


def store_key(prefix: str, *parts: Column) -> Column:
    return F.concat_ws(":", F.lit(prefix), *parts)


class ParquetStore:
    """One folder per batch, replaced when the batch is repeated; reads merge by order.

    Every ``compact_every`` batches the folders so far are folded into a new one, so that
    neither reads nor folders grow with time; keys past their TTL go then.
    """

    def __init__(
        self,
        path: str,
        keys: Sequence[str],
        order: Sequence[str],
        ttl_seconds: int | None = None,
        written_at: str | None = None,
        compact_every: int | None = 100,
    ):
        self.path, self.keys, self.order = path, list(keys), list(order)
        self.ttl_seconds, self.written_at, self.compact_every = ttl_seconds, written_at, compact_every

    def write(self, latest: DataFrame, batch_id: int) -> None:
        latest.write.mode("overwrite").parquet(f"{self.path}/part=b{batch_id}")
        if self.compact_every and batch_id and batch_id % self.compact_every == 0:
            self.compact(latest.sparkSession, batch_id)

    def compact(self, spark: SparkSession, upto: int, now: Column | None = None) -> None:
        """Fold the batches up to ``upto`` and earlier folds into a new folder, then remove them.

        Nothing is overwritten: the new folder is complete before an old one goes, and a stop
        at any point leaves repeats at most, which reads merge away.
        """
        files = Files(spark, self.path)
        old = [n for n in files.names() if n.startswith("part=m") or n.startswith("part=b") and int(n[len("part=b") :]) <= upto]
        if not old:
            return
        rows = spark.read.option("basePath", self.path).parquet(*[f"{self.path}/{n}" for n in old]).drop("part")
        self._alive(latest_per_key(rows, self.keys, self.order), now).write.parquet(f"{self.path}/part=m{upto}-{uuid.uuid4().hex}")
        for name in old:
            files.remove(name)

    def _alive(self, newest: DataFrame, now: Column | None, written_at: str | None = None) -> DataFrame:
        stamp = written_at or self.written_at
        if not self.ttl_seconds or not stamp:
            return newest
        moment = F.current_timestamp() if now is None else now
        return newest.filter(F.unix_timestamp(moment) - F.unix_timestamp(F.col(stamp)) <= self.ttl_seconds)

    def read(self, spark: SparkSession, now: Column | None = None, written_at: str | None = None) -> DataFrame:
        """Newest row per key; with a TTL, keys last written too long ago are left out."""
        rows = spark.read.parquet(self.path).drop("part")
        return self._alive(latest_per_key(rows, self.keys, self.order), now, written_at)


class Files:
    """Files of a folder in whatever file system the session can reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark.sparkContext._jvm
        self.gateway = spark.sparkContext._gateway
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.make = self.jvm.org.apache.hadoop.fs.Path
        self.path = path
        self.fs = self.make(path).getFileSystem(self.conf)

    def exists(self) -> bool:
        return self.fs.exists(self.make(self.path))

    def names(self, older_than_seconds: int | None = None) -> list[str]:
        if not self.exists():
            return []
        found = list(self.fs.listStatus(self.make(self.path)))
        if older_than_seconds is not None:
            latest = self.jvm.java.lang.System.currentTimeMillis() - older_than_seconds * 1000
            found = [f for f in found if f.getModificationTime() <= latest]
        return [f.getPath().getName() for f in found]

    def remove(self, name: str) -> None:
        self.fs.delete(self.make(f"{self.path}/{name}"), True)

    def read(self, name: str) -> str:
        stream = self.fs.open(self.make(f"{self.path}/{name}"))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, name: str, text: str) -> None:
        """Write a file whole: it is written aside and renamed over an earlier one in one step."""
        aside = self.make(f"{self.path}/.{name}-{uuid.uuid4().hex}")
        stream = self.fs.create(aside, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        how = self.jvm.org.apache.hadoop.fs.Options.Rename
        options = self.gateway.new_array(how, 1)
        options[0] = how.OVERWRITE
        target = self.fs.makeQualified(self.make(f"{self.path}/{name}"))
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self.conf)
        context.rename(self.fs.makeQualified(aside), target, options)


def write_degraded(store: KeyValueStore, latest: DataFrame, batch_id: int) -> bool:
    """Write to the cache; a failure is logged and does not stop the stream."""
    try:
        store.write(latest, batch_id)
        return True
    except Exception:
        log.exception("latest-state write failed for batch %s", batch_id)
        return False
