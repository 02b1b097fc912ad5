"""Lattice scoring next to plain segmentation by hand."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from sensorloom.llm import lattice
from tests.llm.conftest import documents, words

SCORED = [("▁", -3.0), ("▁a", -2.0), ("a", -2.5), ("b", -2.0), ("ab", -1.5), ("▁ab", -4.0), ("aba", -3.5), ("ü", -5.0), ("üb", -6.0)]


@pytest.fixture(scope="module")
def pieces():
    return lattice.pieces_of(SCORED)


def ways(chars, pieces, log):
    """All segmentations of ``chars`` as lists of piece numbers."""
    if not chars:
        yield []
        return
    number = {"".join(map(chr, c)): int(n) for ns, cs in zip(pieces.numbers, pieces.codes) for n, c in zip(ns, cs)}
    for k in range(1, len(chars) + 1):
        heads = [[number[chars[:k]]]] if chars[:k] in number else []
        if k == 1:
            heads.append([pieces.first_byte + b for b in chars[0].encode()])
        for head in heads:
            for tail in ways(chars[k:], pieces, log):
                yield head + tail


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def tokens_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lowered(text or "")) + [""]


def word_probability(word, pieces, log):
    return math.exp(log[pieces.end]) if not word else sum(math.exp(sum(log[k] for k in way)) for way in ways("▁" + word, pieces, log))


def brute(rows, pieces, rounds, prior):
    held = {i: zlib.crc32(str(i).encode() if i is not None else b"") % 7 == 2 for i, _ in rows}
    counts = Counter(w for i, t in rows if not held[i] for w in tokens_of(t))
    n, v = sum(counts.values()), len(counts)
    log = np.log(pieces.prior)
    for _ in range(rounds):
        uses = np.zeros(len(log))
        for word in counts:
            total = word_probability(word, pieces, log)
            for way in ways("▁" + word, pieces, log) if word else [[pieces.end]]:
                for k in way:
                    uses[k] += math.exp(sum(log[j] for j in way)) / total
        log = np.log((uses + prior * pieces.prior) / (uses.sum() + prior))
    once, twice = (sum(c == k for c in counts.values()) for k in (1, 2))
    d = min(max(once / (once + 2 * twice), 0.1), 0.9) if once + twice else 0.5
    out = []
    for i, t in rows:
        own = tokens_of(t)
        rest = d * v / n if n else 1.0
        p = [max(counts[w] - d, 0) / max(n, 1) * (counts[w] > 0) + rest * word_probability(w, pieces, log) for w in own]
        out.append((i, held[i], len(own), sum(w in counts for w in own), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own), sum(map(math.log10, p))))
    return out


def close(got, want):
    order = lambda r: (r[0] is None, r[0] or 0, r[2], r[6])
    assert len(got) == len(want)
    for g, w in zip(sorted(map(tuple, got), key=order), sorted(want, key=order)):
        assert g[:5] == w[:5]
        assert g[5:] == pytest.approx(w[5:], rel=1e-9)


ROWS = [
    (1, "ab aba b"), (2, "AB\tab\nabab ü"), (3, None), (4, ""), (4, ""), (5, " \n\x0b "), (None, "ab übab"), (7, "😀 b a\x00b"), (8, "ab aba b"),
    (9, "b a b a ab"), (10, "bbb"), (11, "abü abü"), (12, "a"), (13, "ba ba"), (14, "ab b b"), (15, "z"),
]


def test_rows_against_plain_segmentation(spark, pieces):
    got = lattice.score(documents(spark, ROWS), pieces, rounds=2, prior=5.0).collect()
    assert any(r["held_out"] for r in got)
    close(got, brute(ROWS, pieces, 2, 5.0))


def test_small_blocks_change_nothing(spark, pieces, monkeypatch):
    want = lattice.score(documents(spark, ROWS), pieces, rounds=1).collect()
    monkeypatch.setattr(lattice, "BLOCK_BYTES", 1)
    close(lattice.score(documents(spark, ROWS), pieces, rounds=1).collect(), [tuple(r) for r in want])


def test_empty_table_and_only_held_out_rows(spark, pieces):
    assert lattice.score(documents(spark, []), pieces).collect() == []
    only = [(i, "ab zz") for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2]
    close(lattice.score(documents(spark, only), pieces, rounds=1).collect(), brute(only, pieces, 1, lattice.PRIOR))


def test_forward_recursion_of_long_and_mixed_words(pieces):
    log = np.log(pieces.prior)
    some = ["", "ab", "abababab", "übüb", "b" * 9, "xü", "a\x00"]
    got = lattice.log_probabilities(some, pieces, log)
    assert got == pytest.approx([math.log(word_probability(w, pieces, log)) for w in some], rel=1e-12)
    assert np.isfinite(lattice.log_probabilities(["ab" * 4000], pieces, log)).all()


def test_fit_raises_the_likelihood(pieces):
    some, log, last = ["abab", "ab", "aba", "b"], np.log(pieces.prior), -np.inf
    for _ in range(4):
        value = lattice.log_probabilities(some, pieces, log).sum()
        assert value > last
        last, log = value, lattice.fitted(pieces, lattice.expected_uses(some, np.ones(4), pieces, log), 1e-9)


def test_public_vocabulary_prefers_words_of_the_corpus(spark, rng):
    public = pytest.importorskip("public_tokenizers")
    own = lattice.read_pieces(public.path("piece_bpe_32k.model"))
    rows = [(k, words(rng, 30, 40)) for k in range(60)]
    scores = {r["doc_id"]: r["score"] for r in lattice.score(documents(spark, rows + [(100, "qzxj vvkq " * 15)]), own).collect()}
    assert min(scores[k] for k in range(60)) > scores[100]


def test_no_stored_row_grows_with_the_documents(spark, pieces, rng, monkeypatch):
    rows = [(k, words(rng, 60, 3000)) for k in range(20_000)]
    seen, stored = {}, lattice.stored
    monkeypatch.setattr(lattice, "stored", lambda df, name: seen.setdefault(name, stored(df, name)))
    got = lattice.score(documents(spark, rows).coalesce(1), pieces, rounds=1).collect()
    assert len(got) == len(rows) and all(r["n_tokens"] == 61 for r in got)
    sizes = [r[0] for df in seen.values() for r in df.selectExpr("length(to_json(struct(*)))").collect()]
    assert max(sizes) < 2_000_000  # one row for a batch of these documents has over 4,000,000


@pytest.mark.parametrize(("block", "cells", "bits"), [(1, 1, 1), (300, 7, 3), (1 << 20, 50, 4), (1 << 20, 1 << 17, 10)])
def test_blocks_hold_the_words_of_their_documents(rng, monkeypatch, block, cells, bits):
    rows = [(k, k % 3 == 0, rng.choice([None, "", "é \x00 é", words(rng, rng.randrange(30), 40)])) for k in range(100)]
    monkeypatch.setattr(lattice, "BLOCK_BYTES", block)
    monkeypatch.setattr(lattice, "ROW_CELLS", cells)
    batch = pa.RecordBatch.from_pydict({"key": [k for k, _, _ in rows], "held_out": [h for _, h, _ in rows], "text": pa.array([t and t.encode() for _, _, t in rows], pa.binary())})
    binary = [(n, pa.binary()) for n in ("words", "trained", "steps", "times")]
    schema = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("keys", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("width", pa.int64()), *binary])
    cut = [r for b in lattice._cut_blocks(iter([batch]), schema, bits) for r in b.to_pylist()]
    listed, trained, docs = {}, Counter(), {}
    for r in sorted((r for r in cut if r["bucket"] >= 0), key=lambda r: r["bucket"]):
        some = r["words"].decode().split("\n")[1:]
        listed.setdefault(r["block"], []).extend(some)
        trained.update(dict(zip(some, lattice._numbers(r["trained"]).tolist())))
    for r in (r for r in cut if r["bucket"] < 0):
        owner, place = np.divmod(np.cumsum(lattice._numbers(r["steps"])), r["width"])
        assert r["width"] == len(listed[r["block"]]) and (cells > 1 or len(r["keys"]) == 1)
        for o, p, n in zip(owner, place, lattice._numbers(r["times"])):
            docs.setdefault((r["keys"][o], r["held"][o]), Counter())[listed[r["block"]][p]] += int(n)
    assert docs == {(k, h): Counter(tokens_of(t)) for k, h, t in rows}
    assert +trained == sum((Counter(tokens_of(t)) for _, h, t in rows if not h), Counter())


def test_numbers_in_planes():
    some = np.array([0, 1, 255, 256, 65536, (1 << 32) - 1])
    assert lattice._numbers(lattice._planes(some)).tolist() == some.tolist()
    assert lattice._numbers(lattice._planes(some[:0])).tolist() == []
