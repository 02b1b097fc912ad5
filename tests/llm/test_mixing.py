"""Mixing: budgets, word counts, whole documents, odd rows."""

import re

import pytest

from sensorloom.llm import mixing
from tests.llm.conftest import documents, words


def water(sizes, weights, most):
    """Shares by weight, the excess shared again until no source is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, target = float(sum(sizes.values())), set(names), {}
    while open_:
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] > most * sizes[s]}
        if not full:
            return target | share
        for s in full:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= full
    return target


@pytest.fixture
def rows(rng):
    out = [(i, words(rng, rng.randrange(1, 60)), rng.choice(["b", "b", "b", "é", "a", None])) for i in range(400)]
    return [*out, (1000, None, "a"), (1001, "", "void"), (1002, "  \t\n", "void"), (None, "one two", "a"), (3, out[3][1], out[3][2]), (1003, words(rng, 3000), "long")]


def test_targets_and_words(spark, rows):
    got = mixing.mix(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    target = water(sizes, (5, 2, 1), 3)
    taken = {}
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(target[r.source], abs=1e-5)
        assert 0 <= r.taken <= 3 * r.size
        # complete epochs come first
        if r.source_size:
            assert r.taken >= min(3, int(r.target / r.source_size + 1e-9)) * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, n in taken.items():
        assert abs(n - target[s]) <= 1
    assert sum(target.values()) == pytest.approx(sum(sizes.values()))


def test_reruns_agree_however_the_rows_are_dealt(spark, rows):
    one = mixing.mix(documents(spark, rows)).collect()
    two = mixing.mix(documents(spark, rows[::-1]).repartition(7)).collect()
    assert sorted(map(tuple, one), key=str) == sorted(map(tuple, two), key=str)


def test_quality_favours_plain_text(spark, rng):
    clean = [(i, words(rng, 40), "a") for i in range(300)]
    noisy = [(1000 + i, "### ".join(words(rng, 40).split()), "a") for i in range(300)]
    other = [(5000 + i, words(rng, 30), "b") for i in range(1200)]
    got = {r.doc_id: r.copies for r in mixing.mix(documents(spark, clean + noisy + other), weights=(1, 4)).collect()}
    assert sum(got[i] for i, *_ in clean) > 2 * sum(got[i] for i, *_ in noisy)


def test_whole_documents(spark, rows):
    docs = documents(spark, rows)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    plan = {}
    for r in mixing.mix(docs, whole_documents=True).collect():
        plan[r.doc_id] = max(plan.get(r.doc_id, 0), r.copies)
    counts = {}
    for r in mixed.collect():
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
    assert counts == {i: n * (2 if i == 3 else 1) for i, n in plan.items() if n}


def test_empty_table(spark):
    assert mixing.mix(documents(spark, [])).count() == 0
    assert mixing.mixed_documents(documents(spark, [])).count() == 0
