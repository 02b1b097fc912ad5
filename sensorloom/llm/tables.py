"""What the operators share: reading a table, storing an intermediate one, the word pattern, even buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.session import scratch_path

#: A word is a run of characters other than ASCII white space (space, tab, newline, \v, \f, \r).
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written once to the shared scratch folder and read back: lineage ends here, a lost executor loses nothing."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucket_bits(rows: DataFrame) -> int:
    """Bits of a hash by which tasks deal out what they have packed: somewhat more buckets than tasks that get or send them."""
    settled = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(settled, rows.rdd.getNumPartitions(), 1).bit_length()


def word_count(text: Column) -> Column:
    """Words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unused(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have, in any case."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name = f"_{name}"
    return name
