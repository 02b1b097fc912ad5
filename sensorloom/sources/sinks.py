"""Table and extract sinks."""

from __future__ import annotations

import json
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_partitioned(
    df: DataFrame, path: str, partitions: Sequence[str] = (), rebalance: bool = True, whole_table: bool = False
) -> None:
    """Overwrite a Parquet table, touching only the partitions present in ``df``.

    With ``whole_table`` partitions that are not in ``df`` go as well.  Rows are rebalanced by
    partition column first: adaptive execution merges small partitions into few files and
    splits a day that is far larger than the others.
    """
    out = df.hint("rebalance", *partitions) if partitions and rebalance else df
    mode = "static" if whole_table else "dynamic"
    writer = out.write.mode("overwrite").option("partitionOverwriteMode", mode)
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.parquet(path)


def verified_write(
    df: DataFrame,
    path: str,
    partitions: Sequence[str] = (),
    expected_rows: int | None = None,
    label: str = "table",
    conserve: bool = True,
    whole_table: bool = False,
) -> DataFrame:
    """Write and prove that no row was lost; returns (label, expected, written, status).

    The source is evaluated once: rows, and the partitions they belong to, are observed while
    they are written, and the written count reads only the Parquet footers of those
    partitions.  Without ``conserve`` the table only has to be non-empty.
    """
    spark = df.sparkSession
    seen = Observation()
    # a set of partition values is as large as the number of folders the write makes
    key = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in partitions]))
    values = F.collect_set(key) if partitions else F.collect_set(F.lit(""))
    write_partitioned(df.observe(seen, F.count(F.lit(1)).alias("n"), values.alias("parts")), path, partitions, whole_table=whole_table)
    got = _observed(seen)
    expected = expected_rows if expected_rows is not None else got["n"]
    if not conserve and expected_rows is None and not expected:
        raise RuntimeError(f"{label}: no rows written to {path}")
    written = _rows_in(spark, path, partitions, [json.loads(x) for x in got["parts"] if x]) if got["n"] else 0
    if written != expected:
        raise RuntimeError(f"{label}: {expected} rows expected, {written} written to {path}")
    row = [(label, int(expected), int(written), "PASS")]
    return spark.createDataFrame(row, "label string, expected_rows long, written_rows long, status string")


def _observed(seen: Observation) -> dict:
    """What the write has counted; an input that the optimiser knows to be empty leaves nothing to observe."""
    try:
        return seen.get
    except Py4JJavaError:
        return {"n": 0, "parts": []}


def _rows_in(spark: SparkSession, path: str, partitions: Sequence[str], parts: list[dict[str, str]]) -> int:
    """Rows of the table in the partitions ``parts``."""
    rows = spark.read.parquet(path)
    if not partitions:
        return rows.count()
    if len(partitions) == 1:
        name = partitions[0]
        some = [p[name] for p in parts if name in p]
        match = F.col(name).cast("string").isin(some) | (F.col(name).isNull() if len(some) < len(parts) else F.lit(False))
        return rows.where(match).count()
    keys = spark.createDataFrame([tuple(p.get(c) for c in partitions) for p in parts], ", ".join(f"`{c}` string" for c in partitions))
    same = [F.col(f"r.`{c}`").cast("string").eqNullSafe(F.col(f"k.`{c}`")) for c in partitions]
    return rows.alias("r").join(F.broadcast(keys).alias("k"), same, "left_semi").count()


def write_tsv(df: DataFrame, path: str, order: Sequence[str] = (), header: bool = False) -> None:
    """Tab-separated extract; nulls are empty fields.  Ordered across files when asked."""
    out = df.orderBy(*order) if order else df
    out.write.mode("overwrite").option("sep", "\t").option("header", header).csv(path)
