"""Token ids in ORC files.

Texts are encoded by a given tokenizer, every document ends with an end id, and the ids are written as
``doc_id, n_tokens, tokens`` in ascending ``doc_id``.  ORC brings what a token store needs: integer run-length encoding
of the ids, stripes that tasks read in parallel, row-group indexes, and Bloom filters on the document id, so that a
look-up of one document touches one row group.  Files follow each other in id order, and so do the rows in them.

The Spark side: encoding runs in Arrow batches where the text is scanned; one range exchange puts the ids in order.  The
ranges are cut by (id, checksum), so many rows with one id still spread over tasks.
"""

from __future__ import annotations

import functools
import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Cut before white space that follows a non-space: byte-level pre-tokenizers always start a new piece there.
_PIECE = re.compile(r"\s*\S+|\s+")
#: Python counts these as white space and the tokenizer doesn't; such texts are encoded in one call.
_ODD = re.compile(r"[\x1c-\x1f]")
#: A space after other white space: a text in which a single space is not always a cut.
_RUN = r"[\p{Z}\x09-\x0D\x1C-\x1F\x{85}] |[\x1C-\x1F]"
#: Letters of these two blocks are letters to every Unicode version.
_LATIN = r"[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F]+"
_LETTERS = re.compile(rf" ?{_LATIN}")
#: A line break, if no space follows it, such a run, and a stop or comma: up to three pieces.
_FORM = re.compile(rf"(\n(?! ))?( ?{_LATIN})([.,])?")
#: The sign a byte-level model has for each byte: itself if it prints, else the next free one from 256 on.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_SIGNS = {b: b for b in _PRINTED} | {b: 256 + n for n, b in enumerate(sorted({*range(256)} - {*_PRINTED}))}
_SPACE_SIGN = chr(BYTE_SIGNS[32])
PIECES_KEPT = 500_000
LONG_PIECE = 32
BATCH_BYTES = 12 << 20
ROW_GROUP = 10_000


class Encoder:
    """A tokenizer that remembers pieces.

    For a byte-level tokenizer without normalizer a text is cut where its pre-tokenizer always cuts, and a piece that
    was seen before is not encoded again; the ids are those of the whole text.  Other tokenizers encode whole texts.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.marks = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        byte_level = pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
        self.by_piece = byte_level and not pre.get("add_prefix_space") and not spec.get("normalizer")
        self.seen: dict[str, bytes] = {}

    def pieces(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece, as 32-bit numbers."""
        seen, form, room = self.seen, _FORM.fullmatch, PIECES_KEPT
        out = list(map(seen.get, pieces))
        for i in [i for i, known in enumerate(out) if known is None]:
            piece = pieces[i]
            parts = form(piece)
            if parts is None:
                out[i] = self.piece(piece)
                continue
            line, word, stop = parts.groups()
            ids = seen.get(word)
            if ids is None:
                ids = self.word(word)
                if len(seen) < room and len(word) <= LONG_PIECE:
                    seen[word] = ids
            if line or stop:
                ids = (self.piece(line) if line else b"") + ids + (self.piece(stop) if stop else b"")
                if len(seen) < room and len(piece) <= LONG_PIECE:
                    seen[piece] = ids
            out[i] = ids
        return out

    def word(self, word: str) -> bytes:
        """The ids of a run of Latin letters with at most one space before it: one piece, so only the model looks at it."""
        signs = word.replace(" ", _SPACE_SIGN) if word.isascii() else word.encode().decode("latin-1").translate(BYTE_SIGNS)
        return array("i", [t.id for t in self.tokenizer.model.tokenize(signs)]).tobytes()

    def piece(self, piece: str) -> bytes:
        """The ids of one piece, remembered if it is short.

        A run of Latin letters is one piece to the pre-tokenizer as well; a line break before a word and a stop or comma
        after one are pieces of their own; all else takes the whole way through the tokenizer.
        """
        ids = self.seen.get(piece)
        if ids is not None:
            return ids
        if _LETTERS.fullmatch(piece):
            ids = self.word(piece)
        elif len(parts := _PIECE.findall(piece)) > 1:
            ids = b"".join(map(self.piece, parts))
        elif len(piece) > 1 and piece[0] == "\n" and not piece[1].isspace():
            ids = self.piece("\n") + self.piece(piece[1:])
        elif len(piece) > 1 and piece[-1] in ".," and _LETTERS.fullmatch(piece[-2]):
            ids = self.piece(piece[:-1]) + self.piece(piece[-1])
        else:
            ids = array("i", self.tokenizer.encode(piece, add_special_tokens=False).ids).tobytes()
        if len(piece) <= LONG_PIECE and len(self.seen) < PIECES_KEPT:
            self.seen[piece] = ids
        return ids

    def whole(self, text: str) -> bytes:
        """The ids of a text that Arrow's cut at single spaces does not fit."""
        if not self.by_piece or _ODD.search(text) or any(m in text for m in self.marks):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int32).tobytes()
        return b"".join(self.pieces(_PIECE.findall(text)))

    def batch(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, each with the end id, and how many each text has."""
        n = len(texts)
        texts = pc.fill_null(texts, "")
        if self.by_piece:
            apart = pc.match_substring_regex(texts, _RUN)
            for mark in self.marks:
                apart = pc.or_(apart, pc.match_substring(texts, mark))
            apart = apart.to_numpy(zero_copy_only=False)
        else:
            apart = np.ones(n, bool)
        lists = pc.split_pattern(pc.if_else(pa.array(apart), "", texts), " ")
        widths = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        words = lists.flatten().dictionary_encode()
        distinct = [f" {w}" for w in words.dictionary.to_pandas()]
        heads = np.concatenate([[0], np.cumsum(widths)])[:-1]
        first = self.pieces(lists.flatten().take(pa.array(heads)).to_pylist())
        for i in np.flatnonzero(apart):  # the text was taken out above; its ids stand in for its first piece
            first[i] = self.whole(texts[int(i)].as_py())
        entries = [*self.pieces(distinct), *first, np.int32(end_id).tobytes()]
        lengths = np.fromiter(map(len, entries), np.int64, len(entries)) // 4
        data = np.frombuffer(b"".join(entries), np.int32)
        starts = np.cumsum(lengths) - lengths
        # what follows what: the words of a text, its first one by itself, and then the end
        codes = words.indices.to_numpy(zero_copy_only=False).copy()
        codes[heads] = len(distinct) + np.arange(n, dtype=np.int32)
        order = np.full(len(codes) + n, len(entries) - 1, np.int32)
        order[np.arange(len(codes)) + np.repeat(np.arange(n), widths)] = codes
        counts = lengths[order]
        ends = np.cumsum(counts)
        place = np.repeat((starts[order] - (ends - counts)), counts)
        place += np.arange(ends[-1] if n else 0)
        ids = data[place]
        bounds = np.concatenate([[0], ends[np.cumsum(widths + 1) - 1]]) if n else np.zeros(1, np.int64)
        return ids, np.diff(bounds)


@functools.cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def slices(column: pa.Array, most_bytes: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Stretches of a text column of about ``most_bytes``, one row at least."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(sizes):
        base = sizes[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, base + most_bytes, side="right")))
        yield at, to - at
        at = to


def token_rows(texts: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """``doc_id, text_hash, n_tokens, tokens`` of the rows ``doc_id, text_hash, text``, in their order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        for batch in batches:
            for at, n in slices(batch.column("text")):
                part = batch.slice(at, n)
                ids, lengths = own.batch(part.column("text"), end_id)
                starts = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                tokens = pa.ListArray.from_arrays(pa.array(starts), pa.array(ids))
                columns = [part.column("doc_id"), part.column("text_hash"), pa.array(lengths.astype(np.int32)), tokens]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "n_tokens", "tokens"])

    schema = T.StructType(
        [
            T.StructField("doc_id", texts.schema["doc_id"].dataType),
            T.StructField("text_hash", T.LongType()),
            T.StructField("n_tokens", T.IntegerType()),
            T.StructField("tokens", T.ArrayType(T.IntegerType())),
        ]
    )
    return texts.mapInArrow(run, schema)


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    key: str = "doc_id",
    text: str = "text",
    stripe_bytes: int = 16 << 20,
) -> None:
    """Encode ``docs`` and write the ids to ORC files below ``path`` in ascending id, null ids first.

    Rows with one id follow each other by the hash of their text, so the order is the same in each run.  Texts are put
    in order first and encoded where they are written: the range exchange samples its input, which would encode twice.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).alias("text"))
    ordered = rows.repartitionByRange(F.col("doc_id"), F.col("text_hash")).sortWithinPartitions("doc_id", "text_hash")
    (
        token_rows(ordered, tokenizer, end_id)
        .write.option("orc.compress", "ZLIB")
        .option("orc.stripe.size", str(stripe_bytes))
        .option("orc.row.index.stride", str(ROW_GROUP))
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .orc(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, text_hash, n_tokens, tokens``; a filter on the id reaches stripe statistics, row index and Bloom filter."""
    return spark.read.orc(path)


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per stored document: ``doc_id, start, n_tokens, ids_crc32``, from the files.

    ``start`` is the number of ids before the document: sums per file give each file its start, a running sum inside
    the file does the rest, so no order over all rows is needed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("tokens")
            offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy().astype("<u4")
            crcs = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            lengths = pc.cast(pc.list_value_length(lists), pa.int64())
            columns = [*(batch.column(c) for c in ("file", "doc_id", "text_hash")), lengths, pa.array(crcs, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    stored = read_tokens(spark, path)
    schema = T.StructType(
        [
            T.StructField("file", T.StringType()),
            T.StructField("doc_id", stored.schema["doc_id"].dataType),
            *(T.StructField(c, T.LongType()) for c in ("text_hash", "n_tokens", "ids_crc32")),
        ]
    )
    rows = stored.select(F.col("_metadata.file_path").alias("file"), "doc_id", "text_hash", "tokens").mapInArrow(run, schema)
    # sums and first rows of files need no checksums, and no ids but their number
    per_file = stored.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.sum("n_tokens").alias("n"), F.min(F.struct("doc_id", "text_hash")).alias("least")
    )
    files = per_file.select(
        "file", F.coalesce(F.sum("n").over(Window.orderBy("least").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base")
    )
    inside = Window.partitionBy("file").orderBy("doc_id", "text_hash").rowsBetween(Window.unboundedPreceding, -1)
    return rows.join(files, "file").select(
        "doc_id",
        (F.col("base") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).alias("start"),
        "n_tokens",
        "ids_crc32",
    )
