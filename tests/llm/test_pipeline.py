"""The pipeline against its stages done by brute force on a small corpus, and the entry points."""

import math
import zlib

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from sensorloom.llm import mixing, orc_tokens, queries, resampling
from tests.llm import test_winnowing
from tests.llm.conftest import DOCS, documents, words

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture
def corpus(rng):
    good = [(i, words(rng, rng.randrange(30, 150)).capitalize() + ".", rng.choice(["a", "b", "b", None])) for i in range(120)]
    near = [(200 + i, good[i][1] + rng.choice(["", " again"]), "a") for i in range(30)]
    junk = [(300 + i, " | ".join(words(rng, 90).split()), "b") for i in range(30)]
    items = [(i, words(rng, 25)) for i in range(10)]
    leaks = [(400 + i, f"{words(rng, 60)} {items[i][1]} {words(rng, 50)}.", "c") for i in range(10)]
    odd = [(500, None, "a"), (501, "", "a"), (None, words(rng, 77), "b")]
    return good + near + junk + leaks + odd, [i for i, *_ in good[::2]], [i for i, *_ in junk[::2]], items


@pytest.fixture
def folder(spark, corpus, tmp_path):
    rows, good, bad, items = corpus
    documents(spark, rows).select(COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    marks = [(i, 1, 0) for i in good] + [(i, 0, 0) for i in bad]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def one_of_each_similar_group(rows):
    """The row with the least id of each group that pairs of a Jaccard similarity of 0.8 or more join, by comparing all pairs."""
    sets = [shingles(r[1]) for r in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j]) and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for g, r in zip(group, rows):
        least[g] = min(least.get(g, r), r, key=lambda x: (x[0] is None, x[0] or 0))
    return [r for g, r in zip(group, rows) if least[g] is r]


def test_stages(spark, corpus, folder):
    rows, _, bad, items = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    kept = {r.doc_id for r in resampling.resample(docs, labels).where("kept").collect()}
    left = [r for r in rows if r[0] in kept]
    assert not kept & set(bad) and len(left) > 140
    before = len(left)
    left = one_of_each_similar_group(left)
    assert before - len(left) >= 30  # copies with one word more go as well
    dirty = {r[0] for r in test_winnowing.brute(left, items) if r[5]}
    assert len(dirty) == 10
    left = [r for r in left if r[0] not in dirty]
    copies = {r.doc_id: r.copies for r in mixing.mix(documents(spark, left), whole_documents=True).collect()}
    want, start = [], 0
    tokenizer = orc_tokens.encoder(queries.tokenizer_file()).tokenizer
    for i, t, *_ in sorted((r for r in left for _ in range(copies[r[0]])), key=lambda r: -math.inf if r[0] is None else r[0]):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = sorted(map(tuple, corpus_pipeline.run(spark, folder).collect()), key=lambda r: r[1])
    assert got == want


def test_each_stage_but_the_last_returns_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == COLUMNS and out.count() <= 4 * docs.count()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), folder).count() == 0


def test_clashing_columns(spark, corpus, folder):
    docs = documents(spark, corpus[0])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == [f.name for f in DOCS.fields]


def test_entry_points():
    names = set(entry.queries())
    assert {"pipeline", *queries.QUERIES} <= names
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{k}" for k in range(1, 14)]
    assert set(queries.ORACLE) <= set(queries.QUERIES)
