"""Language-model scoring by subword lattices.

A text is its words in lower case (A-Z) and one end.  A word, led by the sign that pieces use for a word's start, can be cut
into pieces of an existing vocabulary in many ways; every way counts.  Pieces are drawn independently with the weights of
a unigram model, so the probability of a word is the sum over all its segmentations, which the forward recursion gives in
log space, and that of a text is the product over its words and the end.  No piece reaches over a word's start, so the
lattice of a text falls apart at the words, and a distinct word is solved once however often it occurs.

The vocabulary and its scores are those of a public file and are not trained.  Files of merge ranks give a piece of rank r
the weight 1 / (r + 1); log probabilities are taken as they are.  The weights are then fitted to the training texts by
expectation-maximisation: expected uses of each piece, from the forward and backward recursions over all distinct training
words, with the vocabulary's own weights as ``prior`` uses.  Every character can also be spelled in byte pieces, so every
text has a probability.

Documents are cut into blocks of about ``BLOCK_BYTES`` of text, each with the list of its distinct words, which go to
buckets by hash, packed as one row per block and bucket.  A bucket sums the counts of its words, solves each word once and
replies to each block in the order it was asked in; the replies in order of the buckets are the block's list, and each block
scores its own documents.  No row is larger than a few MB, whatever the number of blocks in a task.  Nothing grows with the
corpus on the driver or in a broadcast: the vocabulary is fixed, the words stay distributed.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sensorloom.llm.tables import bucket_bits, stored

BLOCK_BYTES = 1 << 22
ROW_CELLS = 1 << 17  # words of documents that one row holds, or one document
CELLS = 1 << 18  # characters times piece lengths that one call of the recursion holds
PRIOR = 1000.0
ROUNDS = 2
START = "▁"
U = np.uint64
MULTIPLIER = U(0x9E3779B97F4A7C15)
_BYTE = np.arange(256)
SMALL = np.where((_BYTE >= 65) & (_BYTE <= 90), _BYTE + 32, _BYTE).astype(np.uint8)
SPACE = np.isin(_BYTE, [32, *range(9, 14)])


@dataclass(frozen=True)
class Pieces:
    """A piece vocabulary: per length the sorted hashes of its pieces, their numbers and characters; 256 bytes; one end."""

    hashes: tuple[np.ndarray, ...]
    numbers: tuple[np.ndarray, ...]
    codes: tuple[np.ndarray, ...]
    prior: np.ndarray

    @property
    def first_byte(self) -> int:
        return len(self.prior) - 257

    @property
    def end(self) -> int:
        return len(self.prior) - 1


def _hash(codes: np.ndarray) -> np.ndarray:
    """Hash of each row of characters."""
    h = np.zeros(len(codes), np.uint64)
    for column in codes.T:
        h = (h + column.astype(np.uint64) + U(1)) * MULTIPLIER
    return h


def pieces_of(scored: list[tuple[str, float]]) -> Pieces:
    """``scored`` pieces of text; scores are log probabilities, or ranks below 0 if any is under -1,000."""
    best = {}
    for text, score in scored:
        best[text] = max(score, best.get(text, -np.inf))
    texts = [t for t in sorted(best) if t and START not in t[1:]]
    score = np.array([best[t] for t in texts])
    ranks = len(score) and score.min() < -1000
    weight = 1.0 / (1.0 - score) if ranks else np.exp(score)
    least = weight.min() if len(weight) else 1.0
    weight = np.concatenate([weight, np.full(257, least)])
    longest = max(map(len, texts), default=1)
    hashes, numbers, codes = [], [], []
    for length in range(1, longest + 1):
        own = np.array([k for k, t in enumerate(texts) if len(t) == length], np.int64)
        chars = np.array([[ord(c) for c in texts[k]] for k in own], np.uint32).reshape(len(own), length)
        h = _hash(chars)
        order = np.argsort(h, kind="stable")
        hashes.append(h[order])
        numbers.append(own[order])
        codes.append(chars[order])
    return Pieces(tuple(hashes), tuple(numbers), tuple(codes), weight / weight.sum())


def read_pieces(path: str) -> Pieces:
    """The text pieces of a sentencepiece file with their scores."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    plain = [k for k in range(model.get_piece_size()) if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k) or model.is_unused(k))]
    return pieces_of([(model.id_to_piece(k), model.get_score(k)) for k in plain])


def _arcs(codes: np.ndarray, pieces: Pieces) -> np.ndarray:
    """Number of the piece over characters ``t .. t + l`` of each row, at [l, row, t]; -1 for none.  Padding is 0."""
    n, width = codes.shape
    found = np.full((len(pieces.hashes), n, width), -1, np.int64)
    h = np.zeros((n, width), np.uint64)
    for l, (known, number, chars) in enumerate(zip(pieces.hashes, pieces.numbers, pieces.codes)):
        if l >= width:
            break
        h = (h[:, : width - l] + codes[:, l:].astype(np.uint64) + U(1)) * MULTIPLIER
        if not len(known):
            continue
        at = np.minimum(np.searchsorted(known, h), len(known) - 1)
        row, t = np.nonzero(known[at] == h)
        k = at[row, t]
        same = np.ones(len(k), bool)
        for j in range(l + 1):
            same &= codes[row, t + j] == chars[k, j]
        found[l, row[same], t[same]] = number[k[same]]
    return found


def _spelled(codes: np.ndarray, log: np.ndarray, first_byte: int) -> np.ndarray:
    """Log probability of each character spelled in byte pieces."""
    c = codes.astype(np.int64)
    byte = log[first_byte : first_byte + 256]
    tail = lambda shift: byte[0x80 | ((c >> shift) & 0x3F)]
    one = byte[np.minimum(c, 0x7F)]
    two = byte[0xC0 | np.minimum(c >> 6, 0x1F)] + tail(0)
    three = byte[0xE0 | np.minimum(c >> 12, 0x0F)] + tail(6) + tail(0)
    four = byte[0xF0 | np.minimum(c >> 18, 0x07)] + tail(12) + tail(6) + tail(0)
    return np.where(c < 0x80, one, np.where(c < 0x800, two, np.where(c < 0x10000, three, four)))


def _chunks(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Words of like length as padded characters with the start sign: their places, characters, lengths."""
    size = np.array([len(w) + 1 for w in words], np.int64)
    order = np.argsort(size, kind="stable")
    at = 0
    while at < len(order):
        to = at + 1
        while to < len(order) and (to + 1 - at) * size[order[to]] <= CELLS // 16 and size[order[to]] <= size[order[at]] + 4:
            to += 1
        own = order[at:to]
        width = int(size[own[-1]])
        text = "".join((START + words[k]).ljust(width, "\0") for k in own)
        yield own, np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(own), width), size[own]
        at = to


def _forward(codes: np.ndarray, arcs: np.ndarray, log: np.ndarray, spelled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log weights of the arcs, and log probability of all ways to each place of each row."""
    with np.errstate(invalid="ignore", divide="ignore"):
        weight = np.where(arcs >= 0, log[arcs], -np.inf)
        weight[0] = np.logaddexp(weight[0], spelled)
        longest, n, width = weight.shape
        alpha = np.full((width + 1, n), -np.inf)
        alpha[0] = 0.0
        for t in range(1, width + 1):
            back = min(longest, t)
            steps = np.stack([alpha[t - l] + weight[l - 1, :, t - l] for l in range(1, back + 1)])
            top = steps.max(axis=0)
            alpha[t] = top + np.log(np.exp(steps - top).sum(axis=0))
    return weight, alpha


def log_probabilities(words: list[str], pieces: Pieces, log: np.ndarray) -> np.ndarray:
    """Natural log probability of each word over all its segmentations; the empty word stands for the end."""
    out = np.full(len(words), log[pieces.end])
    for own, codes, size in _chunks(words):
        spelled = _spelled(codes, log, pieces.first_byte)
        _, alpha = _forward(codes, _arcs(codes, pieces), log, spelled)
        out[own] = alpha[size, np.arange(len(own))]
    out[[k for k, w in enumerate(words) if not w]] = log[pieces.end]
    return out


def expected_uses(words: list[str], times: np.ndarray, pieces: Pieces, log: np.ndarray) -> np.ndarray:
    """Expected uses of each piece over all segmentations of ``words``, each ``times`` often."""
    uses = np.zeros(len(log))
    some = [k for k, w in enumerate(words) if w]
    uses[pieces.end] = times.sum() - times[some].sum()
    words, times = [words[k] for k in some], times[some]
    for own, codes, size in _chunks(words):
        spelled = _spelled(codes, log, pieces.first_byte)
        arcs = _arcs(codes, pieces)
        weight, alpha = _forward(codes, arcs, log, spelled)
        longest, n, width = weight.shape
        rows = np.arange(n)
        beta = np.full((width + 1, n), -np.inf)
        beta[size, rows] = 0.0
        with np.errstate(invalid="ignore", divide="ignore"):
            for t in range(width - 1, -1, -1):
                steps = np.stack([weight[l - 1, :, t] + beta[t + l] for l in range(1, min(longest, width - t) + 1)])
                top = np.maximum(steps.max(axis=0), -1e300)
                beta[t] = np.maximum(beta[t], top + np.log(np.exp(steps - top).sum(axis=0)))
        total = alpha[size, rows]
        m = times[own]
        with np.errstate(over="ignore", invalid="ignore"):
            for l in range(min(longest, width)):
                share = alpha[: width - l].T + beta[l + 1 :].T - total[:, None]
                row, t = np.nonzero(arcs[l][:, : width - l] >= 0)
                k = arcs[l][row, t]
                uses += np.bincount(k, m[row] * np.exp(log[k] + share[row, t]), len(uses))
                if l == 0:
                    part = m[:, None] * np.exp(spelled + share)
                    part[np.arange(width)[None, :] >= size[:, None]] = 0.0
                    some = np.nonzero(part > 0)
                    for byte, value in _bytes(codes[some].astype(np.int64), part[some]):
                        uses += np.bincount(pieces.first_byte + byte, value, len(uses))
    return uses


def _bytes(c: np.ndarray, value: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The UTF-8 bytes of characters, each with the character's value."""
    for low, high, lead, shifts in ((0, 0x80, 0, ()), (0x80, 0x800, 0xC0, (0,)), (0x800, 0x10000, 0xE0, (6, 0)), (0x10000, 0x110000, 0xF0, (12, 6, 0))):
        own = (c >= low) & (c < high)
        chars, v = c[own], value[own]
        yield lead | (chars >> (6 * len(shifts))), v
        for shift in shifts:
            yield 0x80 | ((chars >> shift) & 0x3F), v


def fitted(pieces: Pieces, uses: np.ndarray, prior: float = PRIOR) -> np.ndarray:
    """Natural log weights from expected uses and ``prior`` uses dealt as the vocabulary's own weights."""
    own = uses + prior * pieces.prior
    return np.log(own / own.sum())


def _planes(x: np.ndarray) -> bytes:
    """Numbers below 2 ** 32, first the lowest bytes of all, then the next ones: high bytes are mostly 0 and compress away."""
    return np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _numbers(data: bytes) -> np.ndarray:
    """The numbers of ``_planes``."""
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4")[:, 0].astype(np.int64)


def _cut_blocks(batches: Iterator[pa.RecordBatch], schema: pa.Schema, bits: int) -> Iterator[pa.RecordBatch]:
    """Rows of two kinds.  With a bucket: the block's distinct words of that bucket and their counts in training documents.
    Without (-1): some of its documents, each with its distinct words as places in the block's words, which are in order of
    the buckets.  Words are led by a line break, as no word holds one; the end is the empty word."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        total = np.cumsum(size)
        at = 0
        while at < len(size):
            to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + BLOCK_BYTES, side="right")))
            part = batch.slice(at, to - at)
            at = to
            place: dict[bytes, int] = {}
            codes, sizes = [], []
            for text in part.column("text"):
                words = (text.as_py() or b"").translate(SMALL.tobytes()).split()
                words.append(b"")
                sizes.append(len(words))
                for word in words:
                    place.setdefault(word, len(place))
                codes.append(np.fromiter(map(place.__getitem__, words), np.int64, len(words)))
            owner = np.repeat(np.arange(len(sizes)), sizes)
            width = len(place)
            bucket = np.fromiter(map(zlib.crc32, place), np.int64, width) >> (32 - bits)
            order = np.argsort(bucket, kind="stable")
            rank = np.empty(width, np.int64)
            rank[order] = np.arange(width)
            code = rank[np.concatenate(codes)]
            held = part.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
            trained = np.bincount(code[~held[owner]], minlength=width)
            cell, times = np.unique(owner * width + code, return_counts=True)
            block = int.from_bytes(os.urandom(8), "little", signed=True)

            listed = list(place)
            cut = np.flatnonzero(np.diff(bucket[order], prepend=-1))
            ends = np.append(cut[1:], width)
            asked = {
                "block": pa.array([block] * len(cut)),
                "bucket": pa.array(bucket[order[cut]].astype(np.int32)),
                "words": pa.array([b"".join([b"\n" + listed[k] for k in order[b:e]]) for b, e in zip(cut, ends)], pa.binary()),
                "trained": pa.array([_planes(trained[b:e]) for b, e in zip(cut, ends)], pa.binary()),
            }
            yield _row_batch(asked, len(cut), schema)

            starts = np.searchsorted(cell, np.arange(len(sizes) + 1) * width)
            first = 0
            while first < len(sizes):
                last = max(first + 1, int(np.searchsorted(starts, starts[first] + ROW_CELLS, side="right")) - 1)
                own = slice(starts[first], starts[last])
                some = [part.column("key").slice(first, last - first), pa.array(held[first:last])]
                lists = [pa.ListArray.from_arrays(pa.array([0, last - first], pa.int32()), x) for x in some]
                steps = np.diff(cell[own] - first * width, prepend=0)
                docs = {"block": pa.array([block]), "bucket": pa.array([-1], pa.int32()), "keys": lists[0], "held": lists[1], "width": pa.array([width])}
                yield _row_batch(docs | {"steps": pa.array([_planes(steps)], pa.binary()), "times": pa.array([_planes(times[own])], pa.binary())}, 1, schema)
                first = last


def _row_batch(arrays: dict[str, pa.Array], n: int, schema: pa.Schema) -> pa.RecordBatch:
    """``n`` rows of the schema, null where no array is given."""
    return pa.RecordBatch.from_arrays([arrays[f.name].cast(f.type) if f.name in arrays else pa.nulls(n, f.type) for f in schema], [f.name for f in schema])


def _blocks(docs: DataFrame, key: str, text: str, folds: int, held_fold: int) -> DataFrame:
    """Stored blocks; their ids are drawn once and stay, as they are written."""
    id_text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(key).alias("key"),
        (F.pmod(F.crc32(id_text.cast("binary")), F.lit(folds)) == held_fold).alias("held_out"),
        F.col(text).cast("binary").alias("text"),
    )
    fields = [("block", T.LongType()), ("bucket", T.IntegerType()), ("words", T.BinaryType()), ("trained", T.BinaryType()), ("keys", T.ArrayType(rows.schema["key"].dataType))]
    fields += [("held", T.ArrayType(T.BooleanType())), ("width", T.LongType()), ("steps", T.BinaryType()), ("times", T.BinaryType())]
    schema = T.StructType([T.StructField(n, t) for n, t in fields])
    arrow, bits = to_arrow_schema(schema), bucket_bits(rows)
    return stored(rows.mapInArrow(lambda batches: _cut_blocks(batches, arrow, bits), schema), "lm-blocks")


#: A row of the vocabulary: a bucket's words, how often each occurs in training texts, what that adds up to, and for each block
#: that asks how many words it asks for and which.
VOCABULARY = "bucket int, words binary, c array<long>, tokens long, types long, once long, twice long, blocks array<long>, sizes array<long>, asked binary"


def _vocabulary(blocks: DataFrame) -> DataFrame:
    """Stored words of all blocks, a row per bucket."""

    def summed(table: pa.Table) -> pa.Table:
        place: dict[bytes, int] = {}
        asked = [np.fromiter([place.setdefault(w, len(place)) for w in data.split(b"\n")[1:]], np.int64) for data in table.column("words").to_pylist()]
        c = np.zeros(len(place), np.int64)
        for own, data in zip(asked, table.column("trained").to_pylist()):
            c[own] += _numbers(data)  # a block has a word once
        row = {"bucket": table.column("bucket")[0].as_py(), "words": b"".join([b"\n" + w for w in place]), "c": c}
        row |= {"tokens": c.sum(), "types": np.count_nonzero(c), "once": np.count_nonzero(c == 1), "twice": np.count_nonzero(c == 2)}
        row |= {"blocks": table.column("block").to_numpy(), "sizes": np.array([len(x) for x in asked]), "asked": _planes(np.concatenate(asked))}
        kinds = [pa.int32(), pa.binary(), pa.list_(pa.int64()), *[pa.int64()] * 4, pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
        return pa.table([pa.array([x], kind) for x, kind in zip(row.values(), kinds)], names=list(row))

    asked = blocks.where("bucket >= 0").select("block", "bucket", "words", "trained")
    return stored(asked.groupBy("bucket").applyInArrow(summed, VOCABULARY), "lm-words")


def _words(data: bytes) -> list[str]:
    return data.decode("utf-8", "surrogateescape").split("\n")[1:]


def fit(vocabulary: DataFrame, pieces: Pieces, rounds: int = ROUNDS, prior: float = PRIOR) -> np.ndarray:
    """Natural log weights of the pieces, from the distinct training words, each once."""
    log = np.log(pieces.prior)
    for _ in range(rounds):

        def uses(batches: Iterator[pa.RecordBatch], log: np.ndarray = log) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(log))
            for batch in batches:
                for data, c in zip(batch.column("words").to_pylist(), batch.column("c")):
                    words = [w for w, n in zip(_words(data), c.values.to_numpy()) if n > 0]
                    total += expected_uses(words, np.ones(len(words)), pieces, log)
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["piece", "part"])

        summed = vocabulary.select("words", "c").mapInArrow(uses, "piece long, part double").groupBy("piece").agg(F.sum("part").alias("part"))
        total = np.zeros(len(log))
        for row in summed.collect():  # at most one row per piece
            total[row["piece"]] = row["part"]
        log = fitted(pieces, total, prior)
    return log


def score(
    docs: DataFrame,
    pieces: Pieces,
    folds: int = 7,
    held_fold: int = 2,
    rounds: int = ROUNDS,
    prior: float = PRIOR,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document: ``key``, held_out, n_tokens, n_known, train_tokens, base_score, score (log10, whole text).

    ``score`` mixes, inside the lattice, the pieces with the words of the training texts: a word that occurs c times of N
    is one more way over its whole length with weight (c - d) / N, and what the discount d leaves over all words goes
    to the ways through pieces.  d is n1 / (n1 + 2 n2) by the numbers of words that occur once and twice.

    A null text is an empty one, which is the end alone.  A null id counts as empty text for the fold.  Repeated rows give
    repeated results.  An empty table gives an empty result, without training rows only pieces count.  Other columns are
    not read, so their names do not matter.
    """
    blocks = _blocks(docs, key, text, folds, held_fold)
    vocabulary = _vocabulary(blocks)
    tokens, types, once, twice = (x or 0 for x in vocabulary.agg(*[F.sum(c) for c in ("tokens", "types", "once", "twice")]).first())
    discount = min(max(once / (once + 2 * twice), 0.1), 0.9) if once + twice else 0.5
    log = fit(vocabulary, pieces, rounds, prior)
    rest = discount * types / tokens if tokens else 1.0

    def solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bucket, words, counts, owners, sizes, asked = (batch.column(c) for c in ("bucket", "words", "c", "blocks", "sizes", "asked"))
            for k in range(batch.num_rows):
                by_pieces = log_probabilities(_words(words[k].as_py()), pieces, log) + np.log(rest)
                c = counts[k].values.to_numpy()
                with np.errstate(divide="ignore"):
                    whole = np.log(np.maximum(c - discount, 0.0) / max(tokens, 1))
                both = np.logaddexp(by_pieces, whole) / np.log(10.0)
                own, ends = _numbers(asked[k].as_py()), np.cumsum(sizes[k].values.to_numpy())
                parts = [[x[own[b:e]].tobytes() for b, e in zip(np.append(0, ends), ends)] for x in (c, both)]
                yield pa.RecordBatch.from_arrays(
                    [owners[k].values, pa.repeat(bucket[k], len(ends)), *[pa.array(x, pa.binary()) for x in parts]], ["block", "bucket", "c", "log"]
                )

    # a row for each block and bucket
    answers = vocabulary.select("bucket", "words", "c", "blocks", "sizes", "asked").mapInArrow(solved, "block long, bucket int, c binary, log binary")
    asking = blocks.where("bucket < 0").select("block", "keys", "held", "width", "steps", "times")
    key_type = blocks.schema["keys"].dataType.elementType
    schema = T.StructType(
        [T.StructField(key, key_type), T.StructField("held_out", T.BooleanType())]
        + [T.StructField(n, T.LongType()) for n in ("n_tokens", "n_known", "train_tokens")]
        + [T.StructField(n, T.DoubleType()) for n in ("base_score", "score")]
    )

    def summed(docs: pa.Table, values: pa.Table) -> pa.Table:
        values = values.sort_by("bucket")
        count, log = (np.frombuffer(b"".join(values.column(n).to_pylist()), t) for n, t in (("c", np.int64), ("log", np.float64)))
        out = []
        for batch in docs.to_batches():
            for k in range(batch.num_rows):
                keys, held = (batch.column(n).slice(k, 1).flatten() for n in ("keys", "held"))
                width, steps, m = batch.column("width")[k].as_py(), _numbers(batch.column("steps")[k].as_py()), _numbers(batch.column("times")[k].as_py())
                owner, place = np.divmod(np.cumsum(steps), width)
                c, value = count[place], log[place]
                add = lambda x: np.bincount(owner, x, len(keys))
                base = np.log10((c + 1.0) / (tokens + types + 1.0))
                whole = [pa.array(x.round().astype(np.int64)) for x in (add(m), add(m * (c > 0)), np.full(len(keys), float(tokens)))]
                out.append(pa.RecordBatch.from_arrays([keys, held, *whole, pa.array(add(m * base)), pa.array(add(m * value))], schema.names))
        return pa.Table.from_batches(out)

    return asking.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(summed, schema)
