"""Importance resampling: held-out labels, exact k, odd rows."""

import numpy as np
import pytest

from sensorloom.llm import resampling
from tests.llm.conftest import documents, words


@pytest.fixture
def corpus(rng):
    good = [(i, words(rng, rng.randrange(40, 300)) + ".") for i in range(300)]
    junk = [(1000 + i, " | ".join(words(rng, rng.randrange(40, 200)).split())) for i in range(60)]
    loud = [(2000 + i, f"{w} " * 200) for i, w in enumerate(words(rng, 40).split())]
    odd = [(5000, None), (5001, ""), (5002, " \n"), (None, good[0][1]), good[1], (5003, words(rng, 50_000))]
    return good, junk + loud, odd


def labels(spark, good, bad):
    rows = [(i, 1, 0, "t") for i, _ in good] + [(i, 0, 0, "t") for i, _ in bad] + [(None, 1, 0, "t"), (good[0][0], 1, 0, "t")]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string")


def test_held_out_documents(spark, corpus):
    good, bad, odd = corpus
    docs = documents(spark, good + bad + odd)
    got = resampling.resample(docs, labels(spark, good[::2], bad[::2]))
    rows = got.collect()
    assert len(rows) == len(good + bad + odd)
    kept = {r.doc_id: r.kept for r in rows}
    assert np.mean([kept[i] for i, _ in good[1::2]]) > 0.97
    assert not any(kept[i] for i, _ in bad)
    assert not kept[5000] and not kept[5001] and not kept[5002] and kept[5003]
    again = resampling.resample(docs.repartition(5), labels(spark, good[::2], bad[::2])).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    left = resampling.kept_documents(docs, labels(spark, good[::2], bad[::2]))
    assert left.columns == docs.columns
    assert sorted((r.doc_id for r in left.collect()), key=str) == sorted((r.doc_id for r in rows if r.kept), key=str)


def test_noise_draws_in_proportion(spark, corpus):
    good, bad, _ = corpus
    docs, marks = documents(spark, good + bad), labels(spark, good, bad)
    cold = resampling.resample(docs, marks, loss=0.5, heat=1e-9).where("kept").count()
    hot = resampling.resample(docs, marks, loss=0.5, heat=200.0)
    # the number drawn stays; who is drawn gets more random
    assert hot.where("kept").count() == cold
    assert hot.where("kept and doc_id >= 1000").count() > 0


@pytest.mark.parametrize("values", [[1.0, 2.0, 3.0], [5.0] * 7, [0.0, 1e-300, 1.0, 1e300], list(np.random.default_rng(1).normal(size=500))])
def test_kth_largest(spark, values):
    frame = spark.createDataFrame([(float(v),) for v in values], "v double")
    for k in {1, 2, len(values) // 2 + 1, len(values)}:
        assert resampling.kth_largest(frame, "v", min(k, len(values)), bins=7) == sorted(values, reverse=True)[min(k, len(values)) - 1]


def test_ngrams_are_those_of_the_words():
    def slow(text):
        import re

        t = re.findall(rb"[0-9A-Za-z\x80-\xff]+|[^\s0-9A-Za-z\x80-\xff]+", text.lower())
        return len(t), max(0, len(t) - 1)

    texts = [b"", b"One two, TWO three!", "é ü".encode(), b"  ", b"a.b.c", b"x" * 200]
    buckets, owner = resampling.ngrams(texts)
    assert [int((owner == i).sum()) for i in range(len(texts))] == [sum(slow(t)) for t in texts]
    one, two = (resampling.ngrams([t])[0] for t in (b"same words here", b"SAME   words\nhere"))
    assert (one == two).all()
    assert resampling.ngrams([])[0].size == 0


def test_without_labels_and_empty(spark, corpus):
    good, bad, _ = corpus
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert resampling.resample(documents(spark, good + bad), none).where("kept").count() == len(good + bad)
    assert resampling.resample(documents(spark, []), none).count() == 0
    assert resampling.kept_documents(documents(spark, []), none).count() == 0
