"""Quality by importance resampling.

Two generative models of hashed n-grams are kept as counts per bucket: one of target text (labelled good), one of the
raw corpus.  A document's log importance is the sum over its n-grams of the log ratio of the two, divided by the square
root of their number, so that long and short texts are spread alike.  Adding Gumbel noise to the log importance and
keeping the k largest draws k documents without replacement in proportion to their importance.

k follows from the corpus: it is the number of documents whose importance reaches ``level``, the value that all but
``loss`` of the labelled good documents reach.  ``heat`` scales the noise; at 1 the draw is proportional to importance,
near 0 it is the ranking itself.

N-grams are words and pairs of words in lower case, where runs of letters and digits and runs of other signs are words
of their own.  They are hashed with numpy in Arrow batches; models and histograms that reach the driver have a fixed
number of buckets.  Labels may be taken from a sample of at most ``label_rows`` rows, which is what is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.llm.tables import stored, unused

BUCKET_BITS = 17
BUCKETS = 1 << BUCKET_BITS
LABEL_ROWS = 20_000
PRIOR = 20.0
BATCH_BYTES = 1 << 20
U = np.uint64
_BYTE = np.arange(256)
#: 0 white space, 1 letters, digits and all bytes above 127, 2 other signs.
KIND = np.full(256, 2, np.uint8)
KIND[[32, *range(9, 14)]] = 0
KIND[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
SMALL = np.where((_BYTE >= 65) & (_BYTE <= 90), _BYTE + 32, _BYTE).astype(np.uint64)
SIGN = (SMALL + U(1)) * U(0xD6E8FEB86659FD93)
POWER = np.array([pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(64)], np.uint64)


def _bucket(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(32))) * U(0xD6E8FEB86659FD93)
    h = (h ^ (h >> U(32))) * U(0xD6E8FEB86659FD93)
    return (h >> U(64 - BUCKET_BITS)).astype(np.int64)


def ngrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of the texts, and the text each is from."""
    none = np.zeros(0, np.int64)
    if not texts:
        return none, none
    buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    kind = KIND[buf]
    start = np.flatnonzero((kind != 0) & np.concatenate([[True], kind[1:] != kind[:-1]]))
    if not len(start):
        return none, none
    place = np.arange(len(buf))
    word = np.zeros(len(buf), np.int64)
    word[start[1:]] = 1
    inside = place - start[np.cumsum(word)]
    value = np.where(kind != 0, SIGN[buf] * POWER[inside & 63], U(0))
    words = np.add.reduceat(value, start)
    ends = np.cumsum([len(t) + 1 for t in texts])
    owner = np.searchsorted(ends, start, side="right")
    pair = owner[1:] == owner[:-1]
    # a word twice in a row is one n-gram, whatever the word
    pairs = np.where(words[:-1] == words[1:], U(1), words[:-1] * U(3) + words[1:] * U(0x9E3779B97F4A7C15))[pair]
    return np.concatenate([_bucket(words), _bucket(pairs)]), np.concatenate([owner, owner[1:][pair]])


def _batches(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Stretches of rows of about ``BATCH_BYTES`` of text, with the texts."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + BATCH_BYTES, side="right")))
        part = batch.slice(at, to - at)
        yield part, [t.as_py() or b"" for t in part.column(column)]
        at = to


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts per bucket, of all rows and of the target's, one row per bucket and task."""
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for part, texts in _batches(batch, "text"):
            buckets, owner = ngrams(texts)
            good = part.column("good").to_numpy(zero_copy_only=False).astype(bool)
            raw += np.bincount(buckets, minlength=BUCKETS)
            target += np.bincount(buckets[good[owner]], minlength=BUCKETS)
    some = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(raw[some]), pa.array(target[some])], ["bucket", "raw", "target"])


def log_ratios(expected: np.ndarray, target: np.ndarray, prior: float = PRIOR) -> np.ndarray:
    """Log of the target's counts over those expected from the raw corpus, drawn to 0 where few are expected."""
    return np.log((target + prior) / (expected + prior))


def log_importance(texts: list[bytes], own: np.ndarray, expected: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log importance of each text and its number of n-grams; texts that are part of the target (``own``) are weighed by
    the target without them, so that they compare with all others."""
    buckets, owner = ngrams(texts)
    n = np.bincount(owner, minlength=len(texts))
    value = log_ratios(expected, target)[buckets]
    mine = own[owner]
    if mine.any():
        cell, back, times = np.unique(owner[mine] * BUCKETS + buckets[mine], return_inverse=True, return_counts=True)
        b = cell % BUCKETS
        value[mine] = log_ratios(expected[b], np.maximum(target[b] - times, 0))[back]
    return np.bincount(owner, value, len(texts)) / np.sqrt(np.maximum(n, 1)), n


def labelled(docs: DataFrame, labels: DataFrame, label_rows: int, key: str) -> DataFrame:
    """``docs`` with ``good``: true for labelled good rows of the sample, false for labelled bad ones, else null.

    The sample is the ``label_rows`` labels with the least hashes of their ids, so it is bounded and the same each time;
    an id with several labels is good only if all of them are.
    """
    rows = labels.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.min(((F.coalesce("quality", F.lit(0)) == 1) & (F.coalesce("toxic", F.lit(0)) == 0))).alias("good")
    )
    sample = rows.orderBy(F.xxhash64(key), key).limit(label_rows).select(F.col(key).alias("label_id"), "good")
    return docs.join(F.broadcast(sample), docs[key] == F.col("label_id"), "left").drop("label_id")


def importances(docs: DataFrame, labels: DataFrame, label_rows: int = LABEL_ROWS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Stored table ``doc_id, text_hash, good, importance`` of every row; texts without n-grams have no importance (null).

    Without any labelled good row in the sample the ratio is that of equal models, 0 everywhere.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).cast("binary").alias("text"))
    marked = labelled(rows, labels.withColumnRenamed(key, "doc_id"), label_rows, "doc_id")
    counts = (
        marked.select(F.coalesce("good", F.lit(False)).alias("good"), "text")
        .mapInArrow(_count, "bucket long, raw long, target long")
        .groupBy("bucket")
        .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    )
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    found = counts.toArrow()  # one row per bucket
    at = found["bucket"].to_numpy()
    raw[at], target[at] = found["raw"].to_numpy(), found["target"].to_numpy()
    if not target.any():
        target = raw  # no target is known: both models are the same
    models = docs.sparkSession.sparkContext.broadcast((raw * (target.sum() / max(1, raw.sum())), target))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in _batches(batch, "text"):
                own = part.column("good").fill_null(False).to_numpy(zero_copy_only=False)
                total, n = log_importance(texts, own, *models.value)
                value = pa.array(total, mask=n == 0)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_hash"), part.column("good"), value], schema.names)

    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[key].dataType),
            T.StructField("text_hash", T.LongType()),
            T.StructField("good", T.BooleanType()),
            T.StructField("importance", T.DoubleType()),
        ]
    )
    return stored(marked.select("doc_id", "text_hash", "good", "text").mapInArrow(score, schema), "importance")


def kth_largest(values: DataFrame, column: str, k: int, bins: int = 2000) -> float:
    """The k-th largest value of a column without nulls, exactly, by histograms of ``bins`` bins that close in on it."""
    low, high = values.agg(F.min(column), F.max(column)).first()
    above = 0  # values beyond the bin in hand
    while low < high:
        width = (high - low) / bins
        inside = values.where(F.col(column).between(low, high))
        slot = F.least(F.floor((F.col(column) - low) / width), F.lit(bins - 1)) if width > 0 else F.lit(0)
        rows = sorted(inside.groupBy(slot.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi")).collect(), reverse=True)
        for row in rows:
            if above + row["n"] >= k:
                low, high = row["lo"], row["hi"]
                break
            above += row["n"]
        if len(rows) == 1 and width == 0:
            break
    return low


def resample(
    docs: DataFrame,
    labels: DataFrame,
    loss: float = 0.0005,
    heat: float = 0.01,
    seed: int = 7,
    label_rows: int = LABEL_ROWS,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Per row ``doc_id, text_hash, importance, kept``.

    Rows whose text has no n-gram (null, empty, white space) have no importance and are not kept.  The noise depends on
    id, text and seed alone, so reruns agree and rows that repeat id and text share a fate; at equal keys all go in.  An
    empty table gives an empty one.
    """
    scored = importances(docs, labels, label_rows, key, text)
    draw = (F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string"), F.col("text_hash"))), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(2**52))
    keyed = stored(scored.withColumn("draw", F.col("importance") - heat * F.log(-F.log(draw))), "importance-keys")
    with_value = keyed.where("importance is not null")
    good = with_value.where("good")
    n_good = good.count()
    rank = n_good - int(loss * n_good)
    level = kth_largest(good, "importance", rank) if n_good else float("-inf")
    k = with_value.where(F.col("importance") >= level).count()
    border = kth_largest(with_value, "draw", k) if k else float("inf")
    return keyed.select("doc_id", "text_hash", "importance", (F.coalesce(F.col("draw"), F.lit(float("-inf"))) >= border).alias("kept"))


def kept_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows that the draw leaves out."""
    key, text = options.get("key", "doc_id"), options.get("text", "text")
    left_out = resample(docs, labels, **options).where("not kept").select(F.col("doc_id").alias("out_id"), F.col("text_hash").alias("out_hash")).distinct()
    mark = unused(docs, "text_hash")
    rows = docs.withColumn(mark, F.xxhash64(F.col(text)))
    return rows.join(left_out, rows[key].eqNullSafe(F.col("out_id")) & (rows[mark] == F.col("out_hash")), "left_anti").drop(mark)
