"""Decontamination against every window of every item."""

import hashlib
import re

import pytest

from sensorloom.llm import winnowing
from tests.llm.conftest import documents, words


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=10):
    wins = {}
    for i, t in items:
        w = split(t)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            wins.setdefault(tuple(w[k : k + n]), set()).add(i)
    out = []
    for d, t, *_ in docs:
        w, hit, ids = split(t), set(), set()
        for n in {len(x) for x in wins}:
            for k in range(len(w) - n + 1):
                if found := wins.get(tuple(w[k : k + n])):
                    hit |= set(range(k, k + n))
                    ids |= found
        named = sorted(str(i) for i in ids if i is not None)
        out.append((d, len(w), len(hit), len(named), hashlib.sha256(",".join(named).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def benchmark(spark, items):
    return spark.createDataFrame([(i, t, "w", "c") for i, t in items], "item_id long, text string, words string, codes string")


@pytest.fixture
def items(rng):
    return [(i, words(rng, rng.randrange(10, 40))) for i in range(30)]


@pytest.fixture
def rows(rng, items):
    out = []
    for i in range(80):
        w = words(rng, rng.randrange(0, 120)).split()
        item = rng.choice(items)[1].split()
        n = rng.randrange(7, 14)
        k = rng.randrange(max(1, len(item) - n))
        w[len(w) // 2 : len(w) // 2] = item[k : k + n]
        out.append((i, rng.choice([" ", ", ", "\n"]).join(w).title()))
    loop = [("a b " * 40), "x " * 300, (items[0][1] + " ") * 5]
    odd = [None, "", "...", "b c", "É é E", words(rng, 40_000)]
    return [*out, *((500 + k, t) for k, t in enumerate(odd + loop)), (None, items[3][1]), (7, out[7][1]), out[8]]


def test_equals_brute_force(spark, rows, items):
    more = [*items, (900, "a b a b a b a b a b a"), (901, "x x x x x x x x x x x x"), (902, "b c"), (903, None), (904, "!"), (905, "É é"), (None, "c"), (5, items[6][1])]
    got = winnowing.contamination(documents(spark, rows).repartition(3), benchmark(spark, more))
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, more)


def test_clean_documents(spark, rows, items):
    docs = documents(spark, rows)
    got = winnowing.clean_documents(docs, benchmark(spark, items))
    assert got.columns == docs.columns
    hit = {r[0] for r in brute(rows, items) if r[5]}
    assert sorted((r.doc_id for r in got.collect())) == sorted(r[0] for r in rows if r[0] not in hit)


def test_empty_tables(spark, rows, items):
    assert winnowing.contamination(documents(spark, []), benchmark(spark, items)).count() == 0
    got = winnowing.contamination(documents(spark, rows), benchmark(spark, []))
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, [])


def test_plan_has_no_python(spark, rows, items):
    plan = winnowing.contamination(documents(spark, rows), benchmark(spark, items))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
