"""Near duplicates by SimHash, compared in bit slices.

Fingerprints are made in Arrow batches where the text is scanned.  Two fingerprints within 3 bits agree on at least 2 of
5 blocks of bits, so ten tables, one per pair of blocks, bring every linked pair together at least once.  Groups are
formed over distinct fingerprints, so copies cost nothing, and a group above ``BLOCK`` is cut into blocks that are
compared pair by pair as rows of their own: no task ever holds a whole large group.

Inside a task the comparison is bit-sliced: bit planes are stored vertically, one machine word holds one bit of 64
fingerprints, differing bits are added up by carry-save counters for 64 pairs per operation, and words (or whole
queries) whose 64 pairs have all exceeded the radius are abandoned after every 8 planes.

A comparison returns a spanning forest of the links it found, not all of them: no link between components is lost, and
a dense group gives at most one row per member.

``one_of_each_similar_group`` asks for a similarity of the texts instead of a radius.  At a Jaccard similarity of 0.8 of
the sets of 5-word shingles fingerprints lie 9.7 bits apart on average (standard deviation 2.9), too far for blocks of
bits.  Groups are formed on bands of min-wise hashes instead, whose size follows the copies and not the corpus; in a group
fingerprints within ``SIMILAR_RADIUS`` bits are compared by their sketches, and each link is verified on the sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.llm.components import components
from sensorloom.llm.tables import stored, unused

WORDS_PER_SHINGLE = 3
SEED = 42
BLOCK = 1024
#: Groups up to this size are compared together, lane by lane.
SMALL = 64
#: Widths of the five blocks of bits.
WIDTHS = (13, 13, 13, 13, 12)
ONES = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Of the similarity join: words of a shingle, least similarity in percent, radius of candidates.
SIMILAR_WIDTH, SIMILAR_PERCENT, SIMILAR_RADIUS = 5, 80, 22
#: Bands of min-wise slots: at 0.8 two sets share none of them with probability (1 - 0.8^4)^18 = 0.00008.
BANDS, BAND_SLOTS = 18, 4
#: Slots of 72 that two sketches must share; at 0.8 they share 57.6 on average (standard deviation 3.4).
LEAST_EQUAL = 44
#: Shingles of a block, and shingles that are counted at once in it.
BLOCK_SHINGLES, MATRIX_WIDTH = 1 << 20, 4096
#: Passes before the last that only look for the links that settle dense groups.
BEST_PASSES = 1
#: Odd multiplier that spreads bits upwards.
MIX = np.uint64(0x9E3779B97F4A7C15)
#: Spreads the bits of a byte over the bytes of a word, so that up to 255 of them add up side by side.
SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").copy().view("<u8").ravel()


# ---- fingerprints -----------------------------------------------------------------


def shingle_hashes(text: bytes | None, width: int = WORDS_PER_SHINGLE) -> list[int]:
    """XXH64 of the space-joined shingles of a text; a text of fewer words is one shingle, one of none has none."""
    import xxhash

    words = (text or b"").lower().split()
    if not words:
        return []
    digest = xxhash.xxh64_intdigest
    if len(words) <= width:
        return [digest(b" ".join(words), SEED)]
    return [digest(b" ".join(s), SEED) for s in zip(*(words[i:] for i in range(width)), strict=False)]


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Fingerprint of each run of ``counts`` hashes: a bit is 1 if over half of them have it; of no hashes 0."""
    out = np.zeros(len(counts), np.uint64)
    some = np.flatnonzero(counts)
    if not len(some):
        return out
    # runs in pieces of at most 255 hashes, as a byte counts no further
    n = counts[some]
    parts = -(-n // 255)
    first = np.cumsum(n) - n
    owner = np.repeat(np.arange(len(some)), parts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
    lanes = np.add.reduceat(SPREAD[hashes.astype("<u8").view(np.uint8).reshape(-1, 8)], first[owner] + 255 * nth, axis=0)
    sums = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 64).astype(np.int64), np.cumsum(parts) - parts, axis=0)
    bits = np.packbits(2 * sums > n[:, None], axis=1, bitorder="little")
    out[some] = bits.view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fp`` (the 64 bits as a long) and ``text_hash`` of every row; null and empty texts have fingerprint 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                lists = [shingle_hashes(t.as_py()) for t in part.column(1)]
                flat = np.array([h for x in lists for h in x], np.uint64)
                fps = majority(flat, np.array([len(x) for x in lists], np.int64))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fps.view(np.int64)), part.column(2)], schema.names)

    schema = T.StructType([T.StructField("doc_id", docs.schema[key].dataType), *(T.StructField(c, T.LongType()) for c in ("fp", "text_hash"))])
    texts = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("binary").alias("text"), F.xxhash64(F.col(text)).alias("text_hash"))
    return texts.mapInArrow(run, schema)


# ---- bit-sliced comparison -----------------------------------------------------------


def planes(x: np.ndarray) -> np.ndarray:
    """The 64 bit planes of the numbers: row b has bit b of number i in lane i."""
    bits = np.unpackbits(x.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    pad = -len(x) % 64
    if pad:
        bits = np.concatenate([bits, np.zeros((pad, 64), np.uint8)])
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")


class Counter:
    """Lanes that count differing bits: 1s, 2s, as many higher planes as ``radius`` needs, and whether the next power of
    two was ever reached (4 for a radius of at most 3, 8 up to 7, 16 up to 15)."""

    def __init__(self, shape, radius: int = 3):
        self.ones, self.twos, self.over = (np.zeros(shape, np.uint64) for _ in range(3))
        self.high = [np.zeros(shape, np.uint64) for _ in range(max(2, radius.bit_length()) - 2)]

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        """Two planes at once: a full adder on the ones, a half adder on the twos."""
        both = a ^ b
        carry = (a & b) | (self.ones & both)
        self.ones ^= both
        up = self.twos & carry
        self.twos ^= carry
        for plane in self.high:
            up, plane[:] = plane & up, plane ^ up
        self.over |= up

    def keep(self, which: np.ndarray) -> None:
        self.ones, self.twos, self.over = self.ones[which], self.twos[which], self.over[which]
        self.high = [plane[which] for plane in self.high]

    def within(self, radius: int) -> np.ndarray:
        """Lanes whose count is at most ``radius``, which is no more than the counter was made for."""
        far = self.over
        if self.high:
            equal = ~far
            for k, plane in reversed(list(enumerate([self.ones, self.twos, *self.high]))):
                if radius >> k & 1:
                    equal = equal & plane
                else:
                    far, equal = far | (equal & plane), equal & ~plane
            return ~far
        if radius == 2:
            far = far | (self.ones & self.twos)
        elif radius == 1:
            far = far | self.twos
        elif radius == 0:
            far = far | self.twos | self.ones
        return ~far


def lanes_of(words: np.ndarray, n: int) -> np.ndarray:
    """Words of lanes as booleans along the last axis."""
    shape = words.shape[:-1]
    return np.unpackbits(words.astype("<u8").view(np.uint8).reshape(*shape, -1), axis=-1, bitorder="little")[..., :n].astype(bool)


def near_matrix(x: np.ndarray, y: np.ndarray, radius: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``x`` and in ``y`` of all pairs within ``radius`` bits."""
    sliced = planes(y)
    out: list[tuple[np.ndarray, np.ndarray]] = []
    for at in range(0, len(x), 256):
        rows = np.arange(at, min(at + 256, len(x)))
        counter = Counter((len(rows), sliced.shape[1]), radius)
        for b in range(0, 64, 2):
            one, two = ((ONES * ((x[rows] >> np.uint64(k)) & np.uint64(1)))[:, None] ^ sliced[k] for k in (b, b + 1))
            counter.add(one, two)
            if b % 8 == 6:
                alive = (counter.over != ONES).any(axis=1)
                if not alive.all():
                    rows = rows[alive]
                    counter.keep(alive)
                if not len(rows):
                    break
        if len(rows):
            i, j = np.nonzero(lanes_of(counter.within(radius), len(y)))
            out.append((rows[i], j))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out])


def near_in_groups(x: np.ndarray, sizes: np.ndarray, radius: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all pairs within ``radius`` inside groups that lie one after the other.

    Largest groups first, the lanes with a partner ``d`` places on are a prefix; planes are shifted by ``d`` lanes
    against themselves, so one pass compares all pairs at that distance in all groups.
    """
    order = np.argsort(-sizes, kind="stable")
    starts = (np.cumsum(sizes) - sizes)[order]
    sizes = sizes[order]
    total = int(sizes.sum())
    place = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(total)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(total)  # members from here to the end of the group
    sliced = planes(x[place])
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for d in range(1, int(sizes[0]) if len(sizes) else 0):
        lanes = int(sizes[sizes > d].sum())
        words = np.arange(-(-lanes // 64))
        live = np.packbits(left[:lanes] > d, bitorder="little")
        live = np.concatenate([live, np.zeros(-len(live) % 8, np.uint8)]).view("<u8")
        whole, part = divmod(d, 64)
        counter = Counter(len(words), radius)

        def against(k: int, words: np.ndarray) -> np.ndarray:
            plane = sliced[k]
            near = plane[np.minimum(words + whole, len(plane) - 1)] >> np.uint64(part)
            if part:
                after = words + whole + 1
                near = near | np.where(after < len(plane), plane[np.minimum(after, len(plane) - 1)] << np.uint64(64 - part), np.uint64(0))
            return plane[words] ^ near

        for b in range(0, 64, 2):
            counter.add(against(b, words), against(b + 1, words))
            if b % 8 == 6:
                alive = (live[words] & ~counter.over) != 0
                if not alive.all():
                    words = words[alive]
                    counter.keep(alive)
                if not len(words):
                    break
        if len(words):
            w, lane = np.nonzero(lanes_of((counter.within(radius) & live[words])[:, None], 64))
            i = words[w] * 64 + lane
            found.append((place[i], place[i + d]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n positions the least position that the links ``a, b`` join it to."""
    label = np.arange(n)
    while len(a):
        before = label.copy()
        least = np.minimum(label[a], label[b])
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        label = label[label]
        if (label == before).all():
            break
    return label


# ---- Spark -------------------------------------------------------------------------


def block_masks() -> list[int]:
    """For each pair of blocks the bits of both, as a signed long."""
    at, blocks = 0, []
    for width in WIDTHS:
        blocks.append(((1 << width) - 1) << at)
        at += width
    return [m - (1 << 64) if m >> 63 else m for m in (x | y for x, y in combinations(blocks, 2))]


def _forest_rows(fps: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    label = forest(len(fps), a, b)
    moved = np.flatnonzero(label != np.arange(len(fps)))
    signed = fps.view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(signed[moved]), pa.array(signed[label[moved]])], ["u", "v"])


def _lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    offsets = column.offsets.to_numpy().astype(np.int64)
    return column.values.to_numpy()[offsets[0] : offsets[-1]].view(np.uint64), np.diff(offsets)


def _inside(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, sizes = _lists(batch.column(0))
            ends = np.cumsum(sizes)
            small = sizes <= SMALL
            mask = np.repeat(small, sizes)
            if small.any():
                own = flat[mask]
                yield _forest_rows(own, *near_in_groups(own, sizes[small], radius))
            for i in np.flatnonzero(~small):
                own = flat[ends[i] - sizes[i] : ends[i]]
                yield _forest_rows(own, *near_matrix(own, own, radius))

    return run


def _between(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y in zip(batch.column(0), batch.column(1), strict=True):
                a, b = (np.asarray(v.values.to_numpy()).view(np.uint64) for v in (x, y))
                i, j = near_matrix(a, b, radius)
                yield _forest_rows(np.concatenate([a, b]), i, j + len(a))

    return run


def near_links(fps: DataFrame, radius: int = 3) -> DataFrame:
    """Links ``u, v`` between distinct fingerprints within ``radius`` (at most 3): a forest that joins what they join."""
    tables = F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("k")) for t, m in enumerate(block_masks())])
    keyed = fps.select("fp").distinct().select("fp", F.explode(tables).alias("b")).select("b.t", "b.k", "fp")
    groups = keyed.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    cut = F.ceil(F.col("n") / BLOCK).cast("int")
    placed = keyed.join(groups, ["t", "k"]).select(
        "t", "k", "fp", cut.alias("parts"), F.pmod(F.xxhash64("fp"), cut).cast("int").alias("part")
    )
    blocks = stored(placed.groupBy("t", "k", "parts", "part").agg(F.collect_list("fp").alias("fps")), "simhash-blocks")
    schema = "u long, v long"
    inside = blocks.where(F.size("fps") > 1).select("fps").mapInArrow(_inside(radius), schema)
    large = blocks.where("parts > 1")
    other = large.select("t", "k", F.col("part").alias("other"), F.col("fps").alias("theirs"))
    pairs = (
        large.where("part + 1 < parts")
        .select("t", "k", "fps", F.explode(F.sequence(F.col("part") + 1, F.col("parts") - 1)).alias("other"))
        .join(other, ["t", "k", "other"])
    )
    between = pairs.select("fps", "theirs").repartition(F.xxhash64("fps"), F.xxhash64("theirs")).mapInArrow(_between(radius), schema)
    return inside.unionByName(between)


def _rooted(docs: DataFrame, radius: int, key: str, text: str) -> DataFrame:
    """``doc_id, fp, text_hash, root`` of every row; ``root`` is the least fingerprint of its component."""
    own = stored(fingerprints(docs, key, text), "simhash")
    roots = stored(components(near_links(own, radius)), "simhash-roots")
    joined = own.join(roots, F.col("fp") == F.col("node"), "left")
    return joined.select("doc_id", "fp", "text_hash", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, radius: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row ``doc_id, fingerprint, component_id``: the least id that links of at most ``radius`` bits reach.

    Rows with one fingerprint are linked, texts without words included; rows with a null id take part and never give
    the component its id unless all of its ids are null.  Rows that repeat an id are rows of their own.  An empty table
    gives an empty one.
    """
    rooted = _rooted(docs, radius, key, text)
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return rooted.join(least, "root").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each_group(docs: DataFrame, radius: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near duplicates: the one with the least id, null ids last, and of rows with
    that id the one with the least hash of its text.  Rows that are equal in both count once."""
    ident, mark = unused(docs, "near_ident"), "kept_ident"

    def named(doc_id: Column, text_hash: Column) -> Column:
        return F.concat_ws(":", text_hash.cast("string"), doc_id.cast("string"))

    chosen = _rooted(docs, radius, key, text).groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("text_hash"))).alias("b")
    )
    kept = chosen.select(named(F.col("b.doc_id"), F.col("b.text_hash")).alias(mark))
    rows = docs.withColumn(ident, named(F.col(key), F.xxhash64(F.col(text))))
    return rows.join(kept, rows[ident] == kept[mark], "left_semi").dropDuplicates([ident]).drop(ident)


# ---- similar texts ------------------------------------------------------------------


def _shingle_set(text: bytes | None) -> np.ndarray:
    return np.unique(np.array(shingle_hashes(text, SIMILAR_WIDTH), np.uint64))


def min_slots(sets: list[np.ndarray]) -> np.ndarray:
    """``BANDS * BAND_SLOTS`` min-wise values of each set, none of which is empty: two sets agree in one with the
    probability of their Jaccard similarity."""
    draw = np.random.default_rng(SEED).integers(0, 1 << 64, (BANDS * BAND_SLOTS, 2), np.uint64)
    sizes = np.array([len(x) for x in sets], np.int64)
    flat, first = np.concatenate(sets), np.cumsum(sizes) - sizes
    return np.stack([np.minimum.reduceat((flat ^ x) * (y | np.uint64(1)), first) for x, y in draw], axis=1)


def band_keys(slots: np.ndarray) -> np.ndarray:
    """One number per band from all of its slots; no two bands share numbers but by chance."""
    keys = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64) * MIX, (len(slots), 1))
    for k in range(BAND_SLOTS):
        keys = (keys ^ slots[:, k::BAND_SLOTS]) * MIX
        keys ^= keys >> np.uint64(29)
    return keys


def shingle_sets(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Stored table of the distinct sets of shingles: ``node`` (digest of the set) and ``b``, of the row that stands for it
    whether its id is null, its id, the hash of its text, and what follows from the set: ``fp``, ``n`` (its size), ``keys``
    (of the bands), ``sketch`` (a byte per slot)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sets = [_shingle_set(t.as_py()) for t in part.column(1)]
                sizes = np.array([len(x) for x in sets], np.int64)
                fps = majority(np.concatenate(sets), sizes)
                nodes = np.array([xxhash.xxh64_intdigest(x.tobytes(), SEED) for x in sets], np.uint64)
                keys = np.zeros((len(sets), BANDS), np.uint64)
                sketch = np.zeros((len(sets), BANDS * BAND_SLOTS), np.uint8)
                if sizes.any():
                    slots = min_slots([x for x in sets if len(x)])
                    keys[sizes > 0], sketch[sizes > 0] = band_keys(slots), (slots & np.uint64(255)).astype(np.uint8)
                lists = pa.ListArray.from_arrays(np.arange(len(sets) + 1, dtype=np.int32) * BANDS, keys.ravel().view(np.int64))
                columns = [part.column(0), part.column(2), *(pa.array(c.view(np.int64)) for c in (nodes, fps, sizes))]
                yield pa.RecordBatch.from_arrays([*columns, lists, pa.array([x.tobytes() for x in sketch], pa.binary())], schema.names)

    longs = [T.StructField(c, T.LongType()) for c in ("text_hash", "node", "fp", "n")]
    more = [T.StructField("keys", T.ArrayType(T.LongType())), T.StructField("sketch", T.BinaryType())]
    schema = T.StructType([T.StructField("doc_id", docs.schema[key].dataType), *longs, *more])
    texts = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("binary").alias("text"), F.xxhash64(F.col(text)).alias("text_hash"))
    row = F.struct(F.col("doc_id").isNull().alias("null_id"), "doc_id", "text_hash", "fp", "n", "keys", "sketch")
    return stored(texts.mapInArrow(run, schema).groupBy("node").agg(F.min(row).alias("b")), "similar-sets")


#: Columns of a member of a group, as numpy sees them.
MEMBER = ("fp", "node", "n", "label", "sketch")


def _columns(arrays: list[pa.Array]) -> list[np.ndarray]:
    """Columns ``MEMBER`` as numpy arrays, the sketches as rows of bytes."""
    fp, node, n, label = (c.to_numpy() for c in arrays[:4])
    sketch = arrays[4]
    at = np.frombuffer(sketch.buffers()[1], np.int32)[sketch.offset] if len(sketch) else 0
    size = BANDS * BAND_SLOTS
    bytes_ = np.frombuffer(sketch.buffers()[2], np.uint8)[at : at + size * len(sketch)] if len(sketch) else np.zeros(0, np.uint8)
    return [fp.view(np.uint64), node, n, label, bytes_.reshape(-1, size)]


def _open_pairs(i: np.ndarray, j: np.ndarray, members: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """Of pairs of positions those that may be similar by the sizes of their sets and their sketches and are not joined
    yet, and in how many slots each pair agrees."""
    _, _, n, label, sketch = members
    small, large = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
    some = (label[i] != label[j]) & (100 * small >= SIMILAR_PERCENT * large)
    i, j = i[some], j[some]
    equal = np.zeros(len(i), np.int64)
    for at in range(0, len(i), 20_000):
        part = slice(at, at + 20_000)
        equal[part] = (sketch[i[part]] == sketch[j[part]]).sum(axis=1)
    some = equal >= LEAST_EQUAL
    return i[some], j[some], equal[some]


def _best(i: np.ndarray, j: np.ndarray, equal: np.ndarray) -> np.ndarray:
    """Two pairs per member: with its first partner and with its most similar one."""
    i, j, equal = np.concatenate([i, j]), np.concatenate([j, i]), np.concatenate([equal, equal])
    orders = (np.lexsort((j, i)), np.lexsort((j, -equal, i)))
    at = np.concatenate([order[np.unique(i[order], return_index=True)[1]] for order in orders])
    return np.stack([i[at], j[at]])


def common_shingles(sets: list[np.ndarray]) -> np.ndarray:
    """How many members each two of the sets share, as a product of indicator matrices of bounded width; shingles that only
    one set has take no part."""
    sizes = [len(x) for x in sets]
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    first = np.append(True, flat[order][1:] != flat[order][:-1])
    owner, column = np.repeat(np.arange(len(sets)), sizes)[order], np.cumsum(first) - 1
    shared = np.bincount(column) > 1
    some = shared[column]
    owner, column = owner[some], (np.cumsum(shared) - 1)[column[some]]
    out = np.zeros((len(sets), len(sets)), np.int64)
    for lo in range(0, int(shared.sum()), MATRIX_WIDTH):
        at = slice(*np.searchsorted(column, [lo, lo + MATRIX_WIDTH]))
        x = np.zeros((len(sets), MATRIX_WIDTH), np.float32)
        x[owner[at], column[at] - lo] = 1
        out += np.rint(x @ x.T).astype(np.int64)
    return out


def _verified_links(i: np.ndarray, j: np.ndarray, members: list[np.ndarray], sets: pa.Array) -> np.ndarray:
    """Of the open pairs of one group those whose sets are similar; one for each two labels."""
    used, at = np.unique(np.concatenate([i, j]), return_inverse=True)
    common = common_shingles([np.frombuffer(sets[k].as_buffer(), np.uint64) for k in used.tolist()])[at[: len(i)], at[len(i) :]]
    _, _, n, label, _ = members
    some = 100 * common >= SIMILAR_PERCENT * (n[i] + n[j] - common)
    i, j = i[some], j[some]
    ends = np.stack([np.minimum(label[i], label[j]), np.maximum(label[i], label[j])])
    one = np.unique(ends, axis=1, return_index=True)[1]
    return np.stack([i[one], j[one]])


def _similar(best: bool):
    """Over rows ``k, a, b, part``, ``MEMBER`` and, unless ``best``, the sets ``s``, sorted by the first three: pairs ``u, v``
    of nodes within block ``a`` of group ``k``, or between its blocks ``a`` and ``b``."""

    def of(rows: pa.RecordBatch) -> pa.RecordBatch:
        starts = np.flatnonzero(_changes(rows))
        sizes = np.diff(np.append(starts, rows.num_rows))
        a, b, part = (rows.column(c).to_numpy() for c in (1, 2, 3))
        members = _columns(rows.columns[4:9])
        fp = members[0]
        small = (sizes <= 4 * SMALL) & (a[starts] == b[starts])
        mask = np.flatnonzero(np.repeat(small, sizes))
        found = [np.stack([mask[x] for x in near_in_groups(fp[mask], sizes[small], SIMILAR_RADIUS)])] if len(mask) else []
        for at, size in zip(starts[~small].tolist(), sizes[~small].tolist(), strict=True):
            one = at + np.flatnonzero(part[at : at + size] == a[at])
            two = one if a[at] == b[at] else at + np.flatnonzero(part[at : at + size] == b[at])
            i, j = near_matrix(fp[one], fp[two], SIMILAR_RADIUS)
            i, j = one[i], two[j]
            some = i < j if a[at] == b[at] else slice(None)
            found.append(np.stack(_open_pairs(i[some], j[some], members)[:2]))
        pairs = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
        i, j, equal = _open_pairs(*pairs, members)
        if best:
            links = _best(i, j, equal)
        else:
            group = np.searchsorted(starts, i, side="right")
            order = np.argsort(group, kind="stable")
            cuts = np.flatnonzero(np.diff(group[order])) + 1
            links = [_verified_links(i[x], j[x], members, rows.column(9)) for x in np.split(order, cuts) if len(x)]
            links = np.concatenate(links, axis=1) if links else np.zeros((2, 0), np.int64)
        ends = members[1][links]
        ends = np.unique(np.sort(ends, axis=0), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(ends[0]), pa.array(ends[1])], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch if left is None else pa.concat_batches([left, batch])
            last = int(np.flatnonzero(_changes(rows))[-1])  # the last group may go on in the next batch
            if last:
                yield of(rows.slice(0, last))
            left = rows.slice(last)
        if left is not None:
            yield of(left)

    return run


def _changes(rows: pa.RecordBatch) -> np.ndarray:
    """Whether a row is the first of its group ``k, a, b``; the first row always is."""
    k, a, b = (rows.column(c).to_numpy() for c in range(3))
    return np.append(True, (k[1:] != k[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1]))


def similar_places(nodes: DataFrame) -> DataFrame:
    """Stored table of the places of nodes in groups of at least two: ``k`` (band and its values), ``parts`` and ``part``
    (blocks of about ``BLOCK`` members and at most about ``BLOCK_SHINGLES`` shingles that the group is cut into), and what
    ``MEMBER`` names but the label."""
    keyed = nodes.where("b.n > 0").select("b.fp", "node", "b.n", "b.sketch", F.explode("b.keys").alias("k"))
    counts = stored(keyed.groupBy("k").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("all_n")).where("c > 1"), "similar-groups")
    cut = F.ceil(F.greatest(F.col("c") / BLOCK, F.least(F.col("all_n") / BLOCK_SHINGLES, F.col("c")))).cast("int")
    part = F.pmod(F.xxhash64("node"), cut).cast("int")
    return stored(keyed.join(counts, "k").select("k", cut.alias("parts"), part.alias("part"), "fp", "node", "n", "sketch"), "similar-places")


def _labelled(places: DataFrame, roots: DataFrame | None) -> DataFrame:
    if roots is None:
        return places.withColumn("label", F.col("node"))
    return places.join(roots, "node", "left").withColumn("label", F.coalesce("root", "node")).drop("root")


def _compared(rows: DataFrame, best: bool) -> DataFrame:
    """Distinct pairs of all blocks: a member goes to its own block and to each pair of blocks that has its own."""
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    whole = [*MEMBER] if best else [*MEMBER, "s"]
    dealt = rows.select("k", "part", *whole, other).select("k", F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b"), "part", *whole)
    sorted_ = dealt.repartition("k", "a", "b").sortWithinPartitions("k", "a", "b", "node")
    return sorted_.mapInArrow(_similar(best), "u long, v long").distinct()


def similar_candidates(places: DataFrame, roots: DataFrame | None) -> DataFrame:
    """Stored table of distinct pairs ``u, v`` of nodes of different labels that share a band, lie within
    ``SIMILAR_RADIUS`` bits and have sketches to match: at most two per member and block."""
    return stored(_compared(_labelled(places, roots), True), "similar-pairs")


def remaining_links(places: DataFrame, roots: DataFrame, own: DataFrame) -> DataFrame:
    """Stored table of verified links between different labels, at least one for each two labels that a link joins.

    Only groups with two labels or more take part; the sets of shingles go with the members, so that all candidates are
    verified where they meet and only links leave a task.
    """
    rows = _labelled(places, roots)
    mixed = rows.groupBy("k").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("k")
    return stored(_compared(rows.join(mixed, "k", "left_semi").join(own, "node"), False), "similar-rest")


def _row_name(doc_id: Column, text_hash: Column) -> Column:
    return F.concat_ws(":", text_hash.cast("string"), doc_id.cast("string"))


def sets_of(places: DataFrame, nodes: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """Stored table ``node, s`` of the sets of shingles of all nodes that have a place, each made from one text."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([_shingle_set(t.as_py()).tobytes() for t in part.column(1)], pa.binary())], ["node", "s"])

    used = nodes.join(places.select("node").distinct(), "node", "left_semi")
    wanted = used.select("node", _row_name(F.col("b.doc_id"), F.col("b.text_hash")).alias("name"))
    rows = docs.select(_row_name(F.col(key), F.xxhash64(F.col(text))).alias("name"), F.col(text).cast("binary").alias("text"))
    found = rows.join(wanted, "name").dropDuplicates(["name"]).select("node", "text")
    return stored(found.mapInArrow(sets, "node long, s binary"), "similar-shingles")


def verified(pairs: DataFrame, own: DataFrame) -> DataFrame:
    """Stored table of the pairs whose sets of shingles have a Jaccard similarity of ``SIMILAR_PERCENT`` at least."""

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (a, b))
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= SIMILAR_PERCENT * (len(both) - common))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    left, right = (own.select(F.col("node").alias(c), F.col("s").alias(s)) for c, s in (("u", "x"), ("v", "y")))
    return stored(pairs.join(left, "u").join(right, "v").select("u", "v", "x", "y").mapInArrow(similar, "u long, v long"), "similar-links")


def similar_roots(docs: DataFrame, nodes: DataFrame, key: str, text: str) -> DataFrame:
    """Stored table ``node, root`` of the components of verified links.

    The first passes verify at most two pairs per member of a block, which joins most of a dense group; the last one
    verifies every candidate whose two texts are not joined by then, so what they leave out cannot change a group.
    """
    places = similar_places(nodes)
    own = sets_of(places, nodes, docs, key, text)
    links = roots = None
    for _ in range(BEST_PASSES):
        new = verified(similar_candidates(places, roots), own)
        links = new if links is None else links.unionByName(new)
        roots = stored(components(links), "similar-roots")
    return stored(components(links.unionByName(remaining_links(places, roots, own))), "similar-roots")


def one_of_each_similar_group(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group that verified links join: the one with the least id, null ids last, and of rows
    with that id the one with the least hash of its text.  Rows that are equal in both count once.  Texts without words
    are one group."""
    nodes = shingle_sets(docs, key, text)
    roots = similar_roots(docs, nodes, key, text)
    row = F.struct("b.null_id", "b.doc_id", "b.text_hash")
    chosen = nodes.join(roots, "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(F.min(row).alias("b"))
    name, mark = unused(docs, "near_ident"), "kept_ident"
    kept = chosen.select(_row_name(F.col("b.doc_id"), F.col("b.text_hash")).alias(mark))
    rows = docs.withColumn(name, _row_name(F.col(key), F.xxhash64(F.col(text))))
    return rows.join(kept, rows[name] == kept[mark], "left_semi").dropDuplicates([name]).drop(name)
