"""Removal of repeated byte strings by a sorted array of sampled suffixes.

A byte goes if a string of ``length`` bytes that covers it starts anywhere else too.  A suffix array over every byte
would be many times the corpus, so only suffixes at anchors enter it: in every string of ``length`` bytes the first of
the least hashed ``GRAM``-byte runs is an anchor, so equal strings have their anchors at equal places, and comparing what
surrounds equal anchors misses none.

* Suffixes (digest of the leading gram, digest of all a string around the anchor can reach) are range-partitioned by
  sampled splitters, sorted inside a bucket by multikey quicksort, and compared with their neighbours; runs that cross
  a bucket's border are joined by the border rows.  A third key scatters runs of equal suffixes over buckets, so a
  passage that a third of all documents share is sorted in many tasks.
* Suffixes whose whole surroundings repeat are settled: all of it goes.
* Suffixes whose gram repeats in other surroundings (the ends of a passage) get their surroundings from the text, once,
  are range-partitioned by gram, and each string through the anchor is compared by rolling digest with the others of its
  gram.  Rows of a gram with more than ``HOT`` of them are cut into pieces first, which get a finer gram from the bytes
  that all strings of a piece share; digests of whole pieces are counted, which combines before the shuffle, and only
  pieces that differ inside are cut again, down to single strings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.llm.tables import stored

GRAM = 32
HALF = 128
HOT = 200
STRETCH = 4 << 20
U = np.uint64
BASE = 0x9E3779B97F4A7C15
BYTES = (np.arange(1, 257, dtype=np.uint64) * U(0xD6E8FEB86659FD93)) ^ (np.arange(1, 257, dtype=np.uint64) << U(40))
HIGH = U(0xFFFFFFFF00000000)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def digests(buf: np.ndarray, width: int, start: np.ndarray | None = None, start_width: int = 1) -> np.ndarray:
    """Polynomial digest of the ``width`` bytes from each place on; ``width`` is a power of two times ``start_width``."""
    h = BYTES[buf] if start is None else start
    w = start_width
    while w < width:
        h = h[:-w] * U(pow(BASE, w, 1 << 64)) + h[w:] if len(h) > w else h[:0]
        w *= 2
    return h


def stretch_digests(buf: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Digest of all bytes from ``low`` to ``high``: a difference of sums of bytes times falling powers, raised to one place."""
    sums = np.full(len(buf) + 1, U(pow(BASE, -1, 1 << 64)))
    sums[0] = 1
    np.multiply.accumulate(sums, out=sums)
    sums[1:] = sums[:-1] * BYTES[buf]
    sums[0] = 0
    np.cumsum(sums, out=sums)
    found = sums[high] - sums[low]
    for k in range(len(buf).bit_length()):
        found[(low >> k & 1).astype(bool)] *= U(pow(BASE, 1 << k, 1 << 64))
    return found


def sliding_least(c: np.ndarray, width: int) -> np.ndarray:
    w = 1
    while 2 * w <= width:
        c = np.minimum(c[:-w], c[w:])
        w *= 2
    rest = width - w
    return np.minimum(c[: len(c) - rest], c[rest:]) if rest else c


def anchors(buf: np.ndarray, first: np.ndarray, last: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Anchors of the strings that start in ``buf[first:last]``, per text.

    Returns for each stretch of strings with one anchor: where the first of them starts, how many follow, how far on
    the anchor is, and the digests of the anchor's gram and of all bytes of the strings.
    """
    gram = digests(buf, GRAM)
    if len(gram) < length - GRAM + 1:
        return (np.zeros(0, np.int64),) * 5
    gram = mixed(gram)
    least = sliding_least((gram & HIGH) | np.arange(len(gram), dtype=np.uint64), length - GRAM + 1)
    step = np.zeros(len(least) + 1, np.int32)
    some = last > first
    np.add.at(step, first[some], 1)
    np.add.at(step, last[some], -1)
    start = np.flatnonzero(np.cumsum(step[:-1]) > 0)
    if not len(start):
        return (np.zeros(0, np.int64),) * 5
    picked = (least[start] & ~HIGH).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (picked[1:] != picked[:-1]) | (start[1:] != start[:-1] + 1)]))
    low, at = start[new], picked[new]
    more = start[np.append(new[1:], len(start)) - 1] - low
    around = mixed(stretch_digests(buf, low, low + more + length))
    around = mixed(around + (at - low).astype(np.uint64) * U(BASE) + more.astype(np.uint64))
    return low, more, at - low, gram[at], around


def suffix_rows(length: int):
    """Arrow batches of ``row_key, text`` to ``row_key, where, gram, around``; long texts in overlapping stretches.

    ``where`` packs the place of the first string, the anchor's distance from it, and how many strings follow.
    """

    def stretches(batch: pa.RecordBatch) -> Iterator[list[tuple[int, memoryview, int]]]:
        """(row, bytes, their place in the text) to look at together; each string lies whole in one of them."""
        held, size = [], 0
        for i, text in enumerate(batch.column(1)):
            data = memoryview(text.as_buffer()) if text.is_valid else memoryview(b"")
            for at in range(0, max(0, len(data) - length + 1), STRETCH):
                part = data[at : at + STRETCH + length - 1]
                held.append((i, part, at))
                size += len(part)
                if size >= STRETCH:
                    yield held
                    held, size = [], 0
        if held:
            yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy()
            for held in stretches(batch):
                buf = np.frombuffer(b"".join(p[1] for p in held), np.uint8)
                sizes = np.array([len(p[1]) for p in held])
                starts = np.cumsum(sizes) - sizes
                low, more, before, gram, around = anchors(buf, starts, starts + sizes - length + 1, length)
                piece = np.searchsorted(starts, low, side="right") - 1
                place = low - starts[piece] + np.array([p[2] for p in held])[piece]
                where = (place << 24) | (before << 12) | more
                owner = keys[np.array([p[0] for p in held])[piece]]
                columns = [owner, where, gram.view(np.int64), around.view(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], SUFFIX.names)

    return run


def unpacked(where: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place of the first string, distance of the anchor, how many strings follow."""
    return where >> 24, (where >> 12) & 0xFFF, where & 0xFFF


def multikey_order(*words: np.ndarray) -> np.ndarray:
    """Order of rows by their words: by the first one, and by the next only where all before are equal."""
    order = np.argsort(words[0], kind="stable")
    ties = np.zeros(len(order), bool)
    same = words[0][order]
    equal = same[1:] == same[:-1]
    for word in words[1:]:
        ties[:] = False
        ties[1:] |= equal
        ties[:-1] |= equal
        at = np.flatnonzero(ties)
        if not len(at):
            break
        # the run number keeps runs apart while the rows in them are put in order
        run = np.cumsum(~np.concatenate([[True], equal])) if len(order) else order
        inner = order[at]
        order[at] = inner[np.lexsort((word[inner], run[at]))]
        sorted_word = word[order]
        equal = equal & (sorted_word[1:] == sorted_word[:-1])
    return order


SUFFIX = T.StructType([T.StructField(c, T.LongType()) for c in ("row_key", "where", "gram", "around")])
FLAGGED = T.StructType([*SUFFIX.fields, *(T.StructField(c, T.BooleanType()) for c in ("gram_twice", "around_twice", "sample", "border", "lead")), T.StructField("bucket", T.IntegerType())])


def compare_neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sort a bucket and flag rows whose gram, and whose surroundings as well, a neighbour shares.

    Rows of grams that occur once are dropped, but for the first and last gram of the bucket (``border``), which may go
    on in the next; ``lead`` marks the first row of each run of equal surroundings, ``sample`` the runs needed on.
    """
    parts = list(batches)
    if not sum(b.num_rows for b in parts):
        return
    table = pa.Table.from_batches(parts)
    gram, around = (table[c].to_numpy() for c in ("gram", "around"))
    order = multikey_order(gram, around)
    gram, around = gram[order], around[order]
    g = gram[1:] == gram[:-1]
    a = g & (around[1:] == around[:-1])
    none = np.zeros(1, bool)
    gram_twice = np.concatenate([none, g]) | np.concatenate([g, none])
    around_twice = np.concatenate([none, a]) | np.concatenate([a, none])
    border = (gram == gram[0]) | (gram == gram[-1])
    # a settled run is needed on for grams that have other surroundings too
    run = np.cumsum(np.concatenate([none, ~g]))
    several = np.bincount(run[1:][g & ~a], minlength=run[-1] + 1) > 0
    lead = ~np.concatenate([none, a])
    sample = around_twice & lead & (several[run] | border)
    keep = np.flatnonzero(gram_twice | border)
    rows = table.take(pa.array(order[keep])).combine_chunks()
    bucket = pa.array(np.full(len(keep), TaskContext.get().partitionId(), np.int32))
    flags = [pa.array(x[keep]) for x in (gram_twice, around_twice, sample, border, lead)]
    out = pa.Table.from_arrays([*rows.columns, *flags, bucket], names=FLAGGED.names)
    yield from out.to_batches(max_chunksize=100_000)


def compared_suffixes(docs: DataFrame, length: int) -> DataFrame:
    """Stored suffixes of grams that occur twice or more, with what repeats: ``gram_twice, around_twice, sample``."""
    suffixes = docs.select("row_key", F.col("text").cast("binary").alias("text")).mapInArrow(suffix_rows(length), SUFFIX)
    salt = F.xxhash64("row_key", "where")
    sorted_in = suffixes.repartitionByRange(F.col("gram"), F.col("around"), salt)
    flagged = stored(sorted_in.mapInArrow(compare_neighbours, FLAGGED), "suffix-flags")
    # what crosses a border is first or last in two buckets; one row per run and bucket tells, and there are no more
    # such grams than borders on either side, and no more such runs than borders
    ends = flagged.where("border and lead")
    grams = ends.groupBy("gram").agg(F.min("bucket").alias("a"), F.max("bucket").alias("b")).where("a < b").select("gram", F.lit(True).alias("g"))
    arounds = ends.groupBy("gram", "around").agg(F.min("bucket").alias("a"), F.max("bucket").alias("b")).where("a < b")
    arounds = arounds.select("gram", "around", F.lit(True).alias("r"))
    told = F.col("gram_twice") & F.col("around_twice") | ~F.col("border")
    crossed = flagged.where(~told).join(F.broadcast(grams), "gram", "left").join(F.broadcast(arounds), ["gram", "around"], "left")
    crossed = crossed.select(
        *SUFFIX.names,
        (F.col("gram_twice") | F.coalesce("g", F.lit(False))).alias("gram_twice"),
        (F.col("around_twice") | F.coalesce("r", F.lit(False))).alias("around_twice"),
        # a run of one row in its bucket stands for itself
        (F.col("sample") | F.coalesce("r", F.lit(False))).alias("sample"),
    ).where("gram_twice")
    names = [*SUFFIX.names, "gram_twice", "around_twice", "sample"]
    return flagged.where(told).select(names).unionByName(crossed)


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed, so that the exchange by key moves half of it."""
    press = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        texts = [press.compress(t.as_buffer() if t.is_valid else b"") for t in batch.column("text")]
        names = batch.schema.names
        yield pa.RecordBatch.from_arrays([pa.array(texts, pa.binary()) if n == "text" else batch.column(n) for n in names], names)


def packed(docs: DataFrame) -> DataFrame:
    frame = docs.withColumn("text", F.col("text").cast("binary"))
    return frame.mapInArrow(pack, frame.schema)


def unpack(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def surroundings(length: int):
    """Rows with packed text and places to ``gram, row_key, place, before, data, hot``: the bytes of all strings of an
    anchor, and the anchor's place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, data, wheres, grams, hots in zip(*(batch.column(c) for c in ("row_key", "text", "where", "gram", "hot")), strict=True):
                text = unpack(data.as_py())
                low, before, more = unpacked(wheres.values.to_numpy())
                parts = [text[a:b] for a, b in zip(low.tolist(), (low + more + length).tolist(), strict=True)]
                columns = [grams.values, pa.array(np.full(len(low), key.as_py())), pa.array(low + before), pa.array(before), pa.array(parts, pa.binary()), hots.values]
                yield pa.RecordBatch.from_arrays(columns, ["gram", "row_key", "place", "before", "data", "hot"])

    return run


def string_digests(data: list[bytes], before: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Digest of each string of ``length`` bytes by how many bytes it has before the anchor, and which of them exist."""
    reach = length - GRAM
    width = reach + length
    table = np.zeros((len(data), width), np.uint8)
    sizes = np.array([len(x) for x in data])
    lead = reach - before
    flat = np.frombuffer(b"".join(data), np.uint8)
    row = np.repeat(np.arange(len(data)), sizes)
    col = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(lead, sizes)
    table[row, col] = flat
    h = BYTES[table]
    # digest of the bytes so far, times base per byte: a string is a difference of two of them
    sums = np.zeros((len(data), width + 1), np.uint64)
    for k in range(width):
        sums[:, k + 1] = sums[:, k] * U(BASE) + h[:, k]
    power = U(pow(BASE, length, 1 << 64))
    start = np.arange(reach + 1)
    found = mixed(sums[:, start + length] - sums[:, start] * power)
    exists = (start >= lead[:, None]) & (start + length <= (lead + sizes)[:, None])
    return found, exists


SPAN = "row_key long, low long, high long"
AROUND = ["row_key", "place", "before", "data"]


def _spans(keys: np.ndarray, place: np.ndarray, hit: np.ndarray, length: int) -> pa.RecordBatch:
    """Runs of hit strings as stretches of bytes; column c of ``hit`` is the string that starts ``reach - c`` before."""
    reach = length - GRAM
    edge = np.diff(np.pad(hit.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, a = np.nonzero(edge == 1)
    _, b = np.nonzero(edge == -1)
    low, high = place[row] - reach + a, place[row] - reach + b - 1 + length
    return pa.RecordBatch.from_arrays([pa.array(keys[row]), pa.array(low), pa.array(high)], ["row_key", "low", "high"])


def compare_surroundings(length: int):
    """Rows of whole grams to the stretches that repeat: strings with equal lead and digest within a gram."""

    def flush(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(rows).combine_chunks()
        gram, keys, place, before = (table[c].to_numpy() for c in ("gram", "row_key", "place", "before"))
        found, exists = string_digests(table["data"].to_pylist(), before, length)
        found = mixed(found + gram.view(np.uint64)[:, None])
        hit = np.zeros(found.shape, bool)
        for c in range(found.shape[1]):
            at = np.flatnonzero(exists[:, c])
            order = at[multikey_order(found[at, c])]
            same = found[order[1:], c] == found[order[:-1], c]
            hit[order[1:][same], c] = True
            hit[order[:-1][same], c] = True
        yield _spans(keys, place, hit, length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            # rows come in the order of grams; keep the last gram back, its rows may go on
            gram = batch.column("gram").to_numpy()
            cut = int(np.searchsorted(gram, gram[-1], side="left")) if len(gram) else 0
            if cut and n + cut >= 4000:
                yield from flush([*held, batch.slice(0, cut)])
                held, n, batch = [], 0, batch.slice(cut)
            held.append(batch)
            n += batch.num_rows
        if n:
            yield from flush(held)

    return run


def finer_pieces(length: int, width: int):
    """Rows of hot grams to pieces, ``gram, whole, row_key, place, before, data``: the strings whose starts lie in one cell
    of ``width`` distances before the anchor.

    All strings of a cell cover its core, so the core's digest is part of the new ``gram``; ``whole`` is the digest of
    all bytes of the piece.
    """
    reach = length - GRAM

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                gram, keys, place, before = (part.column(c).to_numpy() for c in ("gram", "row_key", "place", "before"))
                data = part.column("data").to_pylist()
                sizes = np.array([len(x) for x in data])
                least = before - (sizes - length)
                cells = before // width - least // width + 1
                row = np.repeat(np.arange(len(data)), cells)
                cell = np.arange(len(row)) - np.repeat(np.cumsum(cells) - cells, cells) + (least // width)[row]
                near, far = cell * width, np.minimum(cell * width + width - 1, reach)
                a, b = np.maximum(near, least[row]), np.minimum(far, before[row])
                buf = np.frombuffer(b"".join(data), np.uint8)
                anchor = (np.cumsum(sizes) - sizes + before)[row]
                low, high = anchor - b, anchor - a + length
                core = stretch_digests(buf, anchor - near, anchor - far + length)
                key = mixed(mixed(core + gram.view(np.uint64)[row] * U(BASE)) + cell.astype(np.uint64))
                whole = mixed(mixed(stretch_digests(buf, low, high)) + (a << 16 | b).astype(np.uint64))
                flat = buf.tobytes()
                parts = [flat[x:y] for x, y in zip(low.tolist(), high.tolist(), strict=True)]
                columns = [key.view(np.int64), whole.view(np.int64), keys[row], place[row], b]
                yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in columns), pa.array(parts, pa.binary())], ["gram", "whole", *AROUND])

    return run


def finer(rows: DataFrame, length: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Stretches that repeat in rows of hot grams, and rows of finer grams that are to be compared with each other.

    Rows are cut into pieces of a quarter of the strings and grouped by what all strings of a piece share, until groups are
    small.  A piece that no other shares its gram with is done, and so is one that occurs twice as a whole: all of it goes,
    and one such piece stands for all beside others of its gram.  So only pieces with an end of a repeat in them are cut again.
    """
    spans, cool, width = [], [], length - GRAM + 1
    while width > 1:
        width = -(-width // 4)
        schema = "gram long, whole long, row_key long, place long, before long, data binary"
        pieces = stored(rows.mapInArrow(finer_pieces(length, width), schema), "suffix-pieces", compression="zstd")
        alike = pieces.groupBy("gram", "whole").agg(F.count(F.lit(1)).alias("n"), F.first(F.struct(*AROUND)).alias("one"))
        alike = stored(alike.select("gram", "whole", "n", "one.*"), "suffix-alike", compression="zstd")
        low = F.col("place") - F.col("before")
        twice = pieces.join(alike.where("n > 1").select("gram", "whole"), ["gram", "whole"])
        spans.append(twice.select("row_key", low.alias("low"), (low + F.length("data")).alias("high")))
        several = alike.groupBy("gram").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
        onward = alike.join(several, "gram")
        cool.append(onward.where(F.col("m") <= HOT).select("gram", *AROUND))
        rows = onward.where(F.col("m") > HOT).select("gram", *AROUND)
        if rows.isEmpty():
            break
    return spans, cool


def repeated_spans(docs: DataFrame, length: int) -> DataFrame:
    """``row_key, low, high``: stretches of repeated strings, overlapping as they come; ``docs`` has ``row_key, text``."""
    flagged = compared_suffixes(docs, length)
    low, more = F.shiftright("where", 24), F.col("where").bitwiseAND(F.lit(0xFFF).cast("long"))
    settled = flagged.where("around_twice").select("row_key", low.alias("low"), (low + more + length).alias("high"))
    opened = flagged.where("not around_twice or sample").select("row_key", "where", "gram")
    hot = opened.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT).select("gram", F.lit(True).alias("h"))
    places = (
        opened.join(hot, "gram", "left")
        .groupBy("row_key")
        .agg(F.collect_set(F.struct("where", "gram", F.coalesce("h", F.lit(False)).alias("hot"))).alias("p"))
        .select("row_key", *[F.col(f"p.{c}").alias(c) for c in ("where", "gram", "hot")])
    )
    joined = packed(docs.select("row_key", "text")).join(places, "row_key")
    around = joined.mapInArrow(surroundings(length), "gram long, row_key long, place long, before long, data binary, hot boolean")
    around = stored(around, "suffix-around", compression="zstd")
    spans, rest = finer(around.where("hot").drop("hot"), length)
    cool = reduce(DataFrame.unionByName, rest, around.where("not hot").drop("hot")).repartitionByRange("gram").sortWithinPartitions("gram")
    compared = cool.mapInArrow(compare_surroundings(length), SPAN)
    return reduce(DataFrame.unionByName, spans, settled.unionByName(compared))


def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Remove the stretches from the packed texts and digest what is left."""
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    for batch in batches:
        out = []
        for data, low, high in zip(batch.column("text"), batch.column("low"), batch.column("high"), strict=True):
            text = unpack(data.as_py())
            digest, at, removed, n = hashlib.sha256(), 0, 0, 0
            if low.is_valid and len(low):
                a, b = low.values.to_numpy(), high.values.to_numpy()
                order = np.argsort(a, kind="stable")
                a, b = a[order], np.maximum.accumulate(np.minimum(b[order], len(text)))
                new = np.flatnonzero(np.concatenate([[True], a[1:] > b[:-1]]))
                for lo, hi in zip(a[new].tolist(), b[np.append(new[1:] - 1, len(b) - 1)].tolist(), strict=True):
                    digest.update(text[at:lo])
                    at, removed, n = hi, removed + hi - lo, n + 1
            digest.update(text[at:])
            out.append((len(text), removed, n, digest.hexdigest()))
        columns = list(zip(*out, strict=True)) or [()] * 4
        kinds = [pa.int64()] * 3 + [pa.string()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names)


def without_repeats(docs: DataFrame, length: int = 200, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``.

    Null texts are empty; texts below ``length`` bytes lose nothing; rows that repeat id and text are repeats of each
    other and lose all strings of ``length``; null ids are ids like others; an empty table gives an empty one.
    ``length`` is between 128 and 4,000 bytes.
    """
    if not HALF <= length <= 4000:
        raise ValueError(f"length is between {HALF} and 4000")
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("row_key", F.xxhash64("doc_id", "text"))
    spans = repeated_spans(rows.select("row_key", "text"), length)
    lists = spans.groupBy("row_key").agg(F.collect_set(F.struct("low", "high")).alias("s"))
    lists = lists.select("row_key", F.col("s.low").alias("low"), F.col("s.high").alias("high"))
    joined = packed(rows).join(lists, "row_key", "left").select("doc_id", "text", "low", "high")
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[key].dataType),
            *(T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")),
            T.StructField("kept_sha256", T.StringType()),
        ]
    )
    return joined.mapInArrow(cut_out, schema)
