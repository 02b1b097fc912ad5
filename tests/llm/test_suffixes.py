"""Repeated strings against a count of every string."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from sensorloom.llm import suffixes
from tests.llm.conftest import documents


def letters(rng, n):
    return "".join(rng.choice("abcdefghij é") for _ in range(n))


def brute(rows, length=200):
    texts = [(t or "").encode() for _, t, *_ in rows]
    seen = Counter(x[i : i + length] for x in texts for i in range(len(x) - length + 1))
    out = []
    for (d, *_), x in zip(rows, texts, strict=True):
        gone = np.zeros(len(x), bool)
        for i in range(len(x) - length + 1):
            if seen[x[i : i + length]] > 1:
                gone[i : i + length] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(np.frombuffer(x, np.uint8)[~gone])
        out.append((d, len(x), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.fixture
def rows(rng):
    p, q = letters(rng, 230), letters(rng, 420)
    odd = [None, "", "x" * 1000, "ab" * 150, p[:199], letters(rng, 50) + p + letters(rng, 70), letters(rng, 300) + p, p[5:] + letters(rng, 99), p[:205], p, letters(rng, 4000) * 2]
    near = [letters(rng, rng.randrange(300)) + q[rng.randrange(150) : 420 - rng.randrange(150)] + letters(rng, rng.randrange(300)) for _ in range(120)]
    copies = [letters(rng, 700)] * 5
    out = [(k, t) for k, t in enumerate(odd + near + copies)]
    return [*out, (None, p), (9, p), (9, p)]


@pytest.mark.parametrize("hot, stretch", [(1000, 4 << 20), (15, 700)])
def test_equals_brute_force(spark, rows, monkeypatch, hot, stretch):
    monkeypatch.setattr(suffixes, "HOT", hot)
    docs = documents(spark, rows).repartition(3)
    if stretch < 10_000:
        # long texts in stretches; workers have their own module, so look at the rows of one worker here
        monkeypatch.setattr(suffixes, "STRETCH", stretch)
    got = suffixes.without_repeats(docs)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_stretches_cover_every_string_once(rng, monkeypatch):
    import pyarrow as pa

    text = letters(rng, 3000).encode() * 2
    whole = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([text, b"short"])], ["row_key", "text"])

    def starts(stretch):
        monkeypatch.setattr(suffixes, "STRETCH", stretch)
        out = []
        for b in suffixes.suffix_rows(200)(iter([whole])):
            low, before, more = suffixes.unpacked(b["where"].to_numpy())
            for lo, be, m, g in zip(low.tolist(), before.tolist(), more.tolist(), b["gram"].to_pylist(), strict=True):
                out += [(lo + k, lo + be, g) for k in range(m + 1)]
        return sorted(out)

    one = starts(1 << 20)
    assert [s for s, *_ in one] == list(range(len(text) - 199))
    assert starts(500) == one


def test_multikey_order_and_neighbours_at_borders():
    gen = np.random.default_rng(3)
    a, b, c = (gen.integers(0, 4, 500).astype(np.int64) for _ in range(3))
    order = suffixes.multikey_order(a, b, c)
    keys = list(zip(a[order].tolist(), b[order].tolist(), c[order].tolist(), strict=True))
    assert keys == sorted(keys)


def test_other_lengths_and_empty_table(spark, rows):
    assert sorted(map(tuple, suffixes.without_repeats(documents(spark, rows), 150).collect()), key=str) == brute(rows, 150)
    assert suffixes.without_repeats(documents(spark, [])).count() == 0
    with pytest.raises(ValueError):
        suffixes.without_repeats(documents(spark, rows), 20)


@pytest.mark.parametrize("length", [300, 1000])
def test_lengths_beyond_384_bytes_of_surroundings(spark, rng, length):
    same = [letters(rng, 2000) for _ in range(3)]
    cases = [(k, letters(rng, 40 + k) + same[k % 3][k : 400 + 60 * k % 1600] + letters(rng, 30)) for k in range(24)]
    # alike but for one byte in the middle
    cases += [(100 + k, t[: len(t) // 2] + "~" + t[len(t) // 2 + 1 :]) for k, t in cases]
    got = sorted(map(tuple, suffixes.without_repeats(documents(spark, cases), length).collect()), key=str)
    assert got == brute(cases, length)
    assert 0 < sum(r[2] for r in got) < sum(r[1] for r in got)


@pytest.mark.parametrize("length", [200, 300])
def test_hot_grams_are_cut_where_repeats_end(spark, rng, monkeypatch, length):
    """A passage in hundreds of surroundings, near copies that differ in one letter: pieces stay few beside strings."""
    monkeypatch.setattr(suffixes, "HOT", 3)
    made, real = [], suffixes.stored

    def counted(df, name, **how):
        made.append((name, (out := real(df, name, **how)).count()))
        return out

    monkeypatch.setattr(suffixes, "stored", counted)
    p, q = letters(rng, 700), letters(rng, 900)
    cases = [(k, letters(rng, 60) + p[rng.randrange(40) : 700 - rng.randrange(300)] + letters(rng, 60)) for k in range(60)]
    for k in range(60):
        at = rng.randrange(900)
        cases.append((100 + k, q[:at] + rng.choice("XYZ") + q[at + 1 :]))
    got = suffixes.without_repeats(documents(spark, cases), length)
    assert sorted(map(tuple, got.collect()), key=str) == brute(cases, length)
    around = dict(made)["suffix-around"]
    assert any(name == "suffix-pieces" and n for name, n in made)
    assert max(n for name, n in made if name not in ("suffix-flags", "suffix-around")) <= 4 * around, made
