"""Phrase collocations by double-array tries.

A phrase is a run of words inside a piece of text (pieces end at ``.,;:!?`` and line breaks).  Candidates are grown word by
word: hashes of phrases of k words are counted if both parts that are a word shorter may be frequent (Apriori), and may be
frequent themselves if their hash reaches ``least``.  Phrases that share a hash only add up, so no frequent one is missed.
The hashes that are left become a bit filter of bounded size; what it lets through beyond them is only counted in vain.

The phrases that pass are gathered with their numbers of occurrences in a stretch of text, where equal ones are merged byte
by byte, and dealt out by hash.  In byte order the candidates of a bucket are cut into shards of bounded size, and every
shard becomes a double-array trie.  numpy moves the states of all gathered phrases of the bucket together, one byte a step;
phrases that leave the trie drop out, and where a phrase ends its occurrences are added to the accepting state.  The sums
are the exact numbers of occurrences.  The text is read once per level and once to gather, however many candidates there are.

Each cut of a phrase into a first part and the rest is scored by 1,000,000 * a^2 / (l * r); all arithmetic is on whole numbers.

A text, a word or a language may be of any size.  A filter has ``FILTER_BITS`` bits per hash, for ``SENT_HASHES`` hashes at most;
beyond it it lets more through, with the same result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.llm.tables import bucket_bits, stored

SENT_HASHES = 1 << 24
FILTER_BITS = 16
HELD = 1 << 20  # hashes a task holds before it sends them
BATCH_BYTES = 1 << 21
SHARD_BYTES = 1 << 21  # of phrases in one trie
SENT_BYTES = 1 << 23  # of gathered phrases that a task holds before it sends them
BUCKET_HASHES = 1 << 16  # candidates of a bucket, about
COUNTED = 1 << 17  # gathered phrases that move through a trie together
NO_LANG = "und"
U = np.uint64
_BYTE = np.arange(256)
SMALL = np.where((_BYTE >= 65) & (_BYTE <= 90), _BYTE + 32, _BYTE).astype(np.uint8)
BREAK = np.isin(_BYTE, [*b".,;:!?", *range(10, 14)])
GAP = BREAK | np.isin(_BYTE, [32, 9])
LINE, BLANK = 10, 32
#: Multipliers of a word's bytes by place.
PLACES = 1 << 14
_power = np.array([pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) for k in range(PLACES)], np.uint64)


@dataclass(frozen=True)
class Words:
    """Words of a batch of texts: bytes with one separator after each word (blank inside a piece, line break at its end), where
    each word starts and ends, how many words of its piece follow it, and its text."""

    buf: np.ndarray
    start: np.ndarray
    end: np.ndarray
    after: np.ndarray
    owner: np.ndarray


def words_of(texts: list[bytes], longest: int) -> Words:
    raw = SMALL[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
    gap = GAP[raw]
    inside = ~gap
    first = inside & np.concatenate([[True], gap[:-1]])
    begin = np.flatnonzero(first)
    last = gap & np.concatenate([[False], inside[:-1]])  # the separator that is kept
    stop = np.flatnonzero(last)
    breaks = np.concatenate([[0], np.cumsum(BREAK[raw])])
    following = np.concatenate([begin[1:], [len(raw)]])[: len(begin)]
    piece_ends = breaks[following] > breaks[stop]
    kept = inside | last
    raw[stop] = np.where(piece_ends, LINE, BLANK)
    place = np.cumsum(kept) - 1
    start, end = place[begin], place[stop]
    ends = np.flatnonzero(piece_ends)
    k = np.arange(len(begin))
    after = np.minimum(ends[np.searchsorted(ends, k)] - k, longest - 1) if len(k) else k
    owner = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), begin, side="right")
    return Words(raw[kept], start, end, after, owner)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(32))) * U(0xD6E8FEB86659FD93)
    h = (h ^ (h >> U(32))) * U(0xD6E8FEB86659FD93)
    return h ^ (h >> U(32))


def hashes_of(words: Words, salt: np.ndarray, longest: int) -> list[np.ndarray]:
    """Per number of words the hash of the phrase from each word on, with its language; words of the next piece included."""
    if not len(words.start):
        return [np.zeros(0, np.uint64)] * longest
    size = words.end - words.start + 1
    inside = np.arange(len(words.buf)) - np.repeat(words.start, size)
    value = (words.buf.astype(np.uint64) + U(1)) * _power[inside & (PLACES - 1)]
    value[words.end] = size.astype(np.uint64)
    word = _mixed(np.add.reduceat(value, words.start))
    out, h = [], word + salt[words.owner]
    for k in range(longest):
        if k:
            h = h * U(0xD1342543DE82EF95) + np.concatenate([word[k:], np.zeros(min(k, len(word)), np.uint64)])
        out.append(_mixed(h + U(k)))
    return out


def _salts(langs: list[bytes]) -> np.ndarray:
    known: dict[bytes, int] = {}
    for lang in set(langs):
        known[lang] = int.from_bytes(hashlib.blake2b(lang, digest_size=8).digest(), "little")
    return np.array([known[x] for x in langs], np.uint64)


def _stretches(batch: pa.RecordBatch) -> Iterator[tuple[list[bytes], list[bytes]]]:
    """Languages and texts of stretches of rows of about ``BATCH_BYTES``."""
    total = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(total):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + BATCH_BYTES, side="right")))
        yield batch.column("lang").slice(at, to - at).to_pylist(), batch.column("text").slice(at, to - at).to_pylist()
        at = to


@dataclass(frozen=True)
class Filter:
    """Bits of a set of hashes, two for each: one by the leading bits, the other in the same bucket by the last bits."""

    bits: int
    inner: int
    data: np.ndarray

    def holds(self, h: np.ndarray) -> np.ndarray:
        """Which hashes may be in the set; those in it all are."""
        one, two = _places(h, self.bits, self.inner)
        set_ = lambda at: (self.data[at >> U(3)] >> (at & U(7)).astype(np.uint8)) & np.uint8(1) > 0
        out = set_(one)
        out[out] = set_(two[out])
        return out


def _places(h: np.ndarray, bits: int, inner: int) -> tuple[np.ndarray, np.ndarray]:
    """Two of the ``2 ** bits`` places for each hash that agree in all but the last ``inner`` bits."""
    one, mask = h >> U(64 - bits), U((1 << inner) - 1)
    return one, (one & ~mask) | (h & mask)


def _safe(words: Words, part: np.ndarray | None, k: int) -> np.ndarray:
    """Where a phrase of k + 1 words starts whose parts may be frequent, by where its parts of k words may be."""
    fits = words.after >= k
    if part is not None:
        fits = fits & part & np.concatenate([part[1:], [False]])[: len(part)]
    return fits


def _merged(h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes, sorted, with the sum of their counts."""
    order = np.argsort(h)
    h = h[order]
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
    return h[first], np.add.reduceat(n[order], first) if len(first) else n[:0]


def _counts(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes, sorted, and how often each occurs."""
    h = np.sort(h)
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
    return h[first], np.diff(np.append(first, len(h)))


def _binary(data: np.ndarray, cut: np.ndarray) -> pa.Array:
    """The values ``data[cut[j]:cut[j + 1]]`` as byte strings; they start at 0 and leave nothing out."""
    data = np.ascontiguousarray(data)
    return pa.Array.from_buffers(pa.binary(), len(cut) - 1, [None, pa.py_buffer((cut * data.itemsize).astype(np.int32)), pa.py_buffer(data)])


def _cuts(group: np.ndarray) -> np.ndarray:
    """Where runs of equal values start, and the end."""
    return np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(group)]]) if len(group) else np.zeros(1, np.int64)


def _packed(bits: int, h: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """Sorted hashes as one row per bucket of their leading bits."""
    bucket = (h >> U(64 - bits)).astype(np.int64)
    cut = _cuts(bucket)
    return pa.RecordBatch.from_arrays([pa.array(bucket[cut[:-1]]), _binary(h, cut), _binary(n.astype(np.int64), cut)], ["bucket", "h", "n"])


def level(rows: DataFrame, k: int, known: list[Broadcast], least: int, bits: int) -> DataFrame:
    """Stored hashes of phrases of k + 1 words that may be frequent, packed by bucket.

    Hashes travel as packed runs, so that Spark moves a row per task and bucket and numpy adds up a bucket.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = Filter(*known[-1].value) if k else None
        held: list[tuple[np.ndarray, ...]] = []
        size = 0
        for batch in batches:
            for langs, texts in _stretches(batch):
                words = words_of(texts, k + 1)
                hashes = hashes_of(words, _salts(langs), k + 1)
                held.append(_counts(hashes[k][_safe(words, last.holds(hashes[k - 1]) if last else None, k)]))
                size += len(held[-1][0])
                if size > HELD:
                    yield _packed(bits, *_merged(*map(np.concatenate, zip(*held))))
                    held, size = [], 0
        if held:
            yield _packed(bits, *_merged(*map(np.concatenate, zip(*held))))

    def summed(table: pa.Table) -> pa.Table:
        h, n = _merged(*[np.frombuffer(b"".join(table.column(c).to_pylist()), t) for c, t in (("h", np.uint64), ("n", np.int64))])
        row = {"bucket": table.column("bucket")[0].as_py(), "h": h[n >= least].tobytes()}
        return pa.Table.from_pylist([row], pa.schema([("bucket", pa.int64()), ("h", pa.binary())]))

    packed = rows.mapInArrow(counted, "bucket long, h binary, n binary")
    return stored(packed.groupBy("bucket").applyInArrow(summed, "bucket long, h binary"), f"phrase-hashes-{k + 1}")


def _sent(hashes: DataFrame, bits: int) -> tuple[Broadcast, int]:
    """The filter of the hashes as a broadcast, and how many hashes there are.  The tasks set the bits of their buckets."""
    total = (hashes.agg(F.sum(F.length("h"))).first()[0] or 0) // 8
    inner = max(3, (min(total, SENT_HASHES) * FILTER_BITS).bit_length() - bits)

    def filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, data in zip(batch.column("bucket").to_pylist(), batch.column("h").to_pylist()):
                part = np.zeros(1 << inner, bool)
                for at in _places(np.frombuffer(data, np.uint64), bits + inner, inner):
                    part[at & U((1 << inner) - 1)] = True
                yield pa.RecordBatch.from_arrays([pa.array([bucket]), pa.array([np.packbits(part, bitorder="little").tobytes()], pa.binary())], ["bucket", "part"])

    data = np.zeros(1 << (bits + inner - 3), np.uint8)
    for row in hashes.where(F.length("h") > 0).mapInArrow(filled, "bucket long, part binary").collect():  # FILTER_BITS bits per hash
        data[row["bucket"] << (inner - 3) : (row["bucket"] + 1) << (inner - 3)] = np.frombuffer(row["part"], np.uint8)
    return hashes.sparkSession.sparkContext.broadcast((bits + inner, inner, data)), total


@dataclass(frozen=True)
class Found:
    """Phrases with their hashes, numbers of occurrences, numbers of their languages, and bytes: each ends with a line break."""

    h: np.ndarray
    n: np.ndarray
    lang: np.ndarray
    size: np.ndarray
    buf: np.ndarray


def _pieces(size: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of strings of about 1 MB together, or one string: what is needed for each byte is held for so many only."""
    end = np.cumsum(size)
    cut = np.searchsorted(end, np.arange(1 << 20, end[-1] if len(end) else 0, 1 << 20))
    edges = np.unique(np.concatenate([[0], cut, [len(end)]])).tolist()
    return zip(edges[:-1], edges[1:])


def _bytes_at(buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Bytes of the strings of ``size`` bytes from ``start`` on, one after the other."""
    out = np.empty(int(size.sum()), np.uint8)
    done = 0
    for b, e in _pieces(size):
        end = np.cumsum(size[b:e])
        out[done : done + end[-1]] = buf[np.arange(end[-1]) + np.repeat(start[b:e] - (end - size[b:e]), size[b:e])]
        done += int(end[-1])
    return out


def _equal(buf: np.ndarray, start: np.ndarray, other: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Which strings of ``size`` bytes are the same at ``start`` and at ``other``."""
    out = start == other
    left = np.flatnonzero(~out)
    for b, e in _pieces(size[left]):
        own = left[b:e]
        same = _bytes_at(buf, start[own], size[own]) == _bytes_at(buf, other[own], size[own])
        out[own] = np.logical_and.reduceat(same, np.cumsum(size[own]) - size[own])
    return out


def _runs(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order by hash, the number of the run of equal hashes of each, and the first of each run."""
    order = np.argsort(h)
    first = np.concatenate([[True], np.diff(h[order]) != 0])[: len(h)]
    return order, np.cumsum(first) - 1, order[first]


def phrases_of(words: Words, lang: np.ndarray, hashes: list[np.ndarray], filters: list[Filter]) -> Iterator[Found]:
    """Per number of words the distinct phrases that may be frequent.  ``lang`` has the number of each text's language.

    Phrases are merged if their words are the same byte by byte; others of the same hash stay apart.
    """
    size = words.end - words.start
    number = np.arange(len(size))  # of each word the first that is the same
    part = None
    for k, h in enumerate(hashes):
        fits = _safe(words, part, k)
        fits[fits] = filters[k].holds(h[fits])
        part = fits
        own = np.flatnonzero(fits)
        order, run, first = _runs(h[own])
        at, by = own[order], own[first][run]
        if k:
            same = np.logical_and.reduce([number[at + j] == number[by + j] for j in range(k + 1)])
        else:
            same = (size[at] == size[by]) & (lang[words.owner[at]] == lang[words.owner[by]])
            same[same] = _equal(words.buf, words.start[at[same]], words.start[by[same]], size[at[same]])
            number[at[same]] = by[same]
        kept = np.concatenate([own[first], at[~same]])
        n = np.concatenate([np.bincount(run[same], minlength=len(first)), np.ones(np.count_nonzero(~same), np.int64)])
        length = words.end[kept + k] - words.start[kept] + 1
        buf = _bytes_at(words.buf, words.start[kept], length)
        buf[np.cumsum(length) - 1] = LINE
        yield Found(h[kept], n.astype(np.int64), lang[words.owner[kept]], length, buf)


def _together(held: list[Found]) -> Found:
    """All of ``held`` with equal phrases merged, byte by byte."""
    h, n, lang, size, buf = (np.concatenate([getattr(x, c) for x in held]) for c in ("h", "n", "lang", "size", "buf"))
    start = np.cumsum(size) - size
    at, run, first = _runs(h)
    by = first[run]
    same = (size[at] == size[by]) & (lang[at] == lang[by])
    same[same] = _equal(buf, start[at[same]], start[by[same]], size[at[same]])
    total = np.zeros(len(first), np.int64)
    np.add.at(total, run[same], n[at[same]])
    kept = np.concatenate([first, at[~same]])
    return Found(h[kept], np.concatenate([total, n[at[~same]]]), lang[kept], size[kept], _bytes_at(buf, start[kept], size[kept]))


def _dealt(found: Found, langs: list[bytes], bits: int) -> Iterator[pa.RecordBatch]:
    """A row for each bucket of leading bits and language; a batch for about ``BATCH_BYTES`` times 8 of phrases."""
    bucket = (found.h >> U(64 - bits)).astype(np.int64)
    start = np.cumsum(found.size) - found.size
    order = np.lexsort((found.lang, bucket))
    size = found.size[order]
    for own in np.split(order, np.searchsorted(np.cumsum(size), np.arange(BATCH_BYTES << 3, int(size.sum()), BATCH_BYTES << 3))):
        if not len(own):
            continue
        cut = _cuts(bucket[own] * len(langs) + found.lang[own])
        data = _bytes_at(found.buf, start[own], found.size[own])
        arrays = [pa.array(bucket[own][cut[:-1]]), pa.array([langs[j] for j in found.lang[own][cut[:-1]]], pa.binary())]
        arrays += [_binary(data, np.concatenate([[0], np.cumsum(found.size[own])])[cut]), _binary(found.n[own], cut)]
        yield pa.RecordBatch.from_arrays(arrays, ["bucket", "lang", "phrases", "n"])


def _gathered(batches: Iterator[pa.RecordBatch], filters: list[Filter], bits: int) -> Iterator[pa.RecordBatch]:
    """Rows of ``_dealt``.  The words of a language are counted as occurrences of a phrase without words."""
    held: list[Found] = []
    number: dict[bytes, int] = {}
    room = SENT_BYTES
    for batch in batches:
        for langs, texts in _stretches(batch):
            words = words_of(texts, len(filters))
            lang = np.array([number.setdefault(x, len(number)) for x in langs], np.int64)
            salts = _salts(langs)
            own = np.unique(lang, return_index=True)[1]
            n = np.bincount(lang[words.owner], minlength=len(number))[lang[own]]
            held.append(Found(_mixed(salts[own]), n, lang[own], np.ones(len(own), np.int64), np.full(len(own), LINE, np.uint8)))
            for found in phrases_of(words, lang, hashes_of(words, salts, len(filters)), filters):
                held.append(found)
                room -= len(found.buf)
            if room <= 0:
                yield from _dealt(_together(held), list(number), bits)
                held, number, room = [], {}, SENT_BYTES
    if held:
        yield from _dealt(_together(held), list(number), bits)


@dataclass(frozen=True)
class Trie:
    """A double array: from state s byte b leads to t = base[s] + b if check[t] == s; accept[t] is a key's number or -1."""

    root: int
    base: np.ndarray
    check: np.ndarray
    accept: np.ndarray


def build(keys: list[bytes]) -> Trie:
    """The trie of sorted distinct keys.  Children of branching states get places side by side, lone children fill the gaps."""
    size = np.array([len(k) for k in keys], np.int64)
    offset = np.concatenate([[0], np.cumsum(size)])
    data = np.frombuffer(b"".join(keys), np.uint8)
    shared = np.zeros(len(keys), np.int64)  # bytes a key shares with the one before
    live = np.arange(1, len(keys))
    depth = 0
    while len(live):
        live = live[np.minimum(size[live], size[live - 1]) > depth]
        live = live[data[offset[live] + depth] == data[offset[live - 1] + depth]]
        shared[live] += 1
        depth += 1
    node = np.zeros(len(keys), np.int64)  # node of each key at this depth
    accept_node = np.full(len(keys), 0, np.int64)
    parents, symbols, count = [], [], 1
    live = np.flatnonzero(size > 0)
    for depth in range(int(size.max(initial=0))):
        live = live[size[live] > depth]
        fresh = shared[live] <= depth
        own = count + np.cumsum(fresh) - 1
        parents.append(node[live[fresh]].copy())
        symbols.append(data[offset[live[fresh]] + depth])
        node[live] = own
        count += int(fresh.sum())
        done = live[size[live] == depth + 1]
        accept_node[done] = node[done]
    parent = np.concatenate([[-1], *parents]).astype(np.int64)
    symbol = np.concatenate([[0], *symbols]).astype(np.int64)
    children = np.bincount(parent[1:], minlength=count)
    order = 1 + np.argsort(parent[1:] * 256 + symbol[1:], kind="stable")
    lowest, highest = np.zeros(count, np.int64), np.zeros(count, np.int64)
    lowest[parent[order[::-1]]] = symbol[order[::-1]]
    highest[parent[order]] = symbol[order]
    many = np.flatnonzero(children > 1)
    span = highest[many] - lowest[many] + 1
    base = np.zeros(count, np.int64)
    base[many] = 1 + np.concatenate([[0], np.cumsum(span)[:-1]]) - lowest[many] if len(many) else 0
    used = np.zeros(1 + int(span.sum()), bool)
    used[0] = True
    slot = np.zeros(count, np.int64)
    crowd = np.flatnonzero(children[np.maximum(parent, 0)] > 1)
    crowd = crowd[crowd > 0]
    slot[crowd] = base[parent[crowd]] + symbol[crowd]
    used[slot[crowd]] = True
    alone = np.flatnonzero(children[np.maximum(parent, 0)] == 1)
    alone = alone[alone > 0]
    free = np.flatnonzero(~used)[: len(alone)]
    free = np.concatenate([free, len(used) + np.arange(len(alone) - len(free))])
    slot[alone] = free
    base[parent[alone]] = free - symbol[alone]
    length = int(slot.max(initial=0)) + 257
    low = max(0, -int(base.min(initial=0)))
    out_base, check, accept = np.full(length + low, low, np.int32), np.full(length + low, -1, np.int32), np.full(length + low, -1, np.int32)
    slot += low
    out_base[slot] = np.where(children > 0, base + low, length + low - 257)
    check[slot[1:]] = slot[parent[1:]]
    some = size > 0
    accept[slot[accept_node[some]]] = np.flatnonzero(some)
    return Trie(low, out_base, check, accept)


def walk(trie: Trie, state: int, path: bytes) -> int:
    """The state after ``path``, -1 if it leaves the trie."""
    for b in path:
        to = int(trie.base[state]) + b
        if trie.check[to] != state:
            return -1
        state = to
    return state


def count(trie: Trie, state: int, buf: np.ndarray, start: np.ndarray, n: np.ndarray, total: np.ndarray) -> None:
    """Adds to each key's total the occurrences ``n`` of the phrases that are that key from ``state`` on.  A phrase goes from its
    start to a line break."""
    at, pos = np.full(len(start), state, np.int32), start
    while len(pos):
        here = buf[pos]
        ends = here == LINE
        if ends.any():
            reached = trie.accept[at[ends]]
            np.add.at(total, reached[reached >= 0], n[ends][reached >= 0])
            at, pos, here, n = at[~ends], pos[~ends], here[~ends], n[~ends]
        to = trie.base[at] + here
        on = trie.check[to] == at
        at, pos, n = to[on], pos[on] + 1, n[on]


def _shards(keys: list[bytes]) -> Iterator[list[bytes]]:
    """Runs of at most ``SHARD_BYTES`` or one key."""
    shard, size = [], 0
    for key in keys:
        if size + len(key) > SHARD_BYTES and shard:
            yield shard
            shard, size = [], 0
        shard.append(key)
        size += len(key)
    if shard:
        yield shard


def _data(strings: pa.Array) -> np.ndarray:
    """The bytes of all strings, one after the other."""
    offset = np.frombuffer(strings.buffers()[1], np.int32)[strings.offset : strings.offset + len(strings) + 1]
    return np.frombuffer(strings.buffers()[2] or b"", np.uint8)[offset[0] : offset[-1]]


def _totals(table: pa.Table, least: int) -> pa.Table:
    """Exact numbers of occurrences of the phrases of a bucket, counted by tries whose keys are language, line break, phrase."""
    parts, keys = [], []
    for lang in pc.unique(table.column("lang")):
        own = table.filter(pc.equal(table.column("lang"), lang))
        buf, n = (np.concatenate([_data(x) for x in own.column(c).chunks if len(x)]) for c in ("phrases", "n"))
        cut = np.concatenate([[0], np.flatnonzero(buf == LINE) + 1])
        parts.append((lang.as_py(), buf, cut[:-1], n.view(np.int64)))
        keys += [lang.as_py() + b"\n" + phrase[:-1] for phrase in pc.unique(_binary(buf, cut)).to_pylist()]
    found, a = [], []
    for shard in _shards(sorted(keys)):
        trie, total = build(shard), np.zeros(len(shard), np.int64)
        for lang, buf, start, times in parts:
            if (state := walk(trie, trie.root, lang + b"\n")) >= 0:
                for b in range(0, len(start), COUNTED):
                    count(trie, state, buf, start[b : b + COUNTED], times[b : b + COUNTED], total)
        # a phrase has no line break, a language may
        some = [k for k in range(len(shard)) if total[k] >= least or shard[k].endswith(b"\n")]
        found += [shard[k].rpartition(b"\n") for k in some]
        a.append(total[some])
    arrays = [pa.array([x[k] for x in found], pa.binary()) for k in (0, 2)] + [pa.array(np.concatenate(a))]
    return pa.table(arrays, names=["lang", "phrase", "a"])


def occurrences(rows: DataFrame, longest: int, least: int) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, a`` of the phrases with ``a`` of at least ``least`` occurrences, and ``lang, n`` of the words of each language."""
    bits = bucket_bits(rows)
    known: list[Broadcast] = []
    hashes = 0
    for k in range(longest):
        sent, some = _sent(level(rows, k, known, least, bits), bits)
        known.append(sent)
        hashes += some
    bits = max(bits, (hashes // BUCKET_HASHES).bit_length())

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _gathered(batches, [Filter(*b.value) for b in known], bits)

    counted = rows.mapInArrow(gathered, "bucket long, lang binary, phrases binary, n binary").groupBy("bucket").applyInArrow(lambda table: _totals(table, least), "lang binary, phrase binary, a long")
    found = stored(counted.select(F.col("lang").cast("string").alias("lang"), F.col("phrase").cast("string").alias("phrase"), "a"), "phrases")
    return found.where("phrase <> ''"), found.where("phrase = ''").select("lang", F.col("a").alias("n"))


def collocations(
    docs: DataFrame,
    longest: int = 3,
    least: int = 10,
    inside_percent: int = 50,
    first: int = 2000,
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """The ``first`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Null texts are empty, a null language is ``und``, an empty one is a language of its own.  Repeated rows count each time.
    Texts without words and empty tables give no rows.  Ties go to more occurrences, then to byte order.  Other columns are
    not read.  A phrase inside a longer candidate that has at least ``inside_percent`` of its occurrences is left out.
    """
    rows = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANG)).cast("binary").alias("lang"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    frequent, per_lang = occurrences(rows, longest, least)
    words = F.split("phrase", " ", -1)
    phrases = frequent.select("lang", "phrase", "a", words.alias("w")).where(F.size("w") > 1)
    cuts = phrases.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("cut")).select(
        "lang", "phrase", "a", "cut", F.array_join(F.slice("w", F.lit(1), F.col("cut")), " ").alias("head"), F.expr("array_join(slice(w, cut + 1, size(w) - cut), ' ')").alias("tail")
    )
    heads = frequent.select("lang", F.col("phrase").alias("head"), F.col("a").alias("l"))
    tails = frequent.select("lang", F.col("phrase").alias("tail"), F.col("a").alias("r"))
    big = lambda c: F.col(c).cast("decimal(15,0)")
    parts = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).withColumns({"up": F.lit(1_000_000).cast("decimal(7,0)") * big("a") * big("a"), "down": big("l") * big("r")})
    best = parts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(F.expr("up div down").alias("score"), "cut", "l", "r")).alias("best"))
    inner = phrases.where(F.size("w") > 2).select(
        "lang", "a", F.explode(F.expr("flatten(transform(sequence(2, size(w) - 1), m -> transform(sequence(1, size(w) - m + 1), i -> array_join(slice(w, i, m), ' '))))")).alias("phrase")
    )
    around = inner.groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    kept = stored(
        best.join(around, ["lang", "phrase"], "left").where(F.col("around").isNull() | (100 * F.col("around") < inside_percent * F.col("a"))).select("lang", "phrase", "a", "best.*"),
        "phrase-scores",
    )
    # a language may hold most rows: the first of each of about sqrt(rows) shares, then the first of those
    shares = int((kept.count() / max(first, 1)) ** 0.5) + 1
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    some = Window.partitionBy("lang", "share").orderBy(*order)
    trimmed = kept.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(shares))).withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= first)
    ranked = trimmed.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= first)
    return ranked.join(per_lang, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
