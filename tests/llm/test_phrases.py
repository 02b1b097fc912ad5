"""Phrase mining next to counting by hand, and the double array next to a dictionary."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from sensorloom.llm import phrases
from tests.llm.conftest import documents


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows, longest=3, least=10, percent=50, first=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + k])) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    candidates = {g: a for g, a in f.items() if a >= least and len(g[1]) > 1}
    kept = []
    for (lang, w), a in candidates.items():
        cuts = [(1_000_000 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w))]
        score, _, l, r = min(cuts)
        longer = [b for (other, v), b in candidates.items() if other == lang and len(v) > len(w) and any(v[i : i + len(w)] == w for i in range(len(v)))]
        if not any(100 * b >= percent * a for b in longer):
            kept.append((lang, -score, -a, " ".join(w).encode(), l, r))
    out, rank = [], Counter()
    for lang, score, a, phrase, l, r in sorted(kept):
        rank[lang] += 1
        if rank[lang] <= first:
            out.append((lang, rank[lang], phrase.decode(), -a, l, r, n[lang], -score))
    return out


def table(spark, rows):
    docs = documents(spark, [(k, t) for k, (_, t) in enumerate(rows)]).collect()
    from tests.llm.conftest import DOCS

    return spark.createDataFrame([(*d[:2], lang, *d[3:]) for d, (lang, _) in zip(docs, rows)], DOCS)


def same(spark, rows, **kw):
    got = sorted(tuple(r) for r in phrases.collocations(table(spark, rows), **kw).collect())
    names = {"inside_percent": "percent"}
    assert got == sorted(brute(rows, **{names.get(k, k): v for k, v in kw.items()}))
    return got


def text(rng, n):
    signs = [" "] * 12 + ["  ", "\t", ", ", ".", "\n", " ; ", "!", "\x0b", " \t "]
    return "".join(rng.choice(["the", "The", "of", "a", "New", "york", "times", "é", "ÉÀ", "x\x00y", " ", "日本", "b" * 70]) + rng.choice(signs) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    out = [(rng.choice(["en", "en", "en", "de", None, "", "und", "e\nn"]), text(rng, rng.randrange(80))) for _ in range(120)]
    return out + [("en", None), ("en", ""), ("en", " ., \n"), ("en", "new york times " * 40), ("xx", "a a a a a a a a a a a a a a")] + [("en", "same row of words here")] * 12


def test_rows_against_counting_by_hand(spark, rows):
    got = same(spark, rows)
    assert len({r[0] for r in got}) > 3


def test_other_parameters(spark, rows):
    same(spark, rows, longest=4, least=5, inside_percent=80, first=7)
    same(spark, rows, longest=2, least=2, first=3)


def test_many_shards_and_rounds_and_small_stretches(spark, rows, monkeypatch):
    for name, value in (("SHARD_BYTES", 60), ("SENT_BYTES", 4000), ("BATCH_BYTES", 50)):
        monkeypatch.setattr(phrases, name, value)
    same(spark, rows[:60] + rows[-14:], least=4)


def test_hashes_too_many_to_send(spark, rows, monkeypatch):
    monkeypatch.setattr(phrases, "SENT_HASHES", 3)
    same(spark, rows[:60], least=4)


def test_nothing_to_find(spark):
    for some in ([], [("en", None)], [("en", "a b c")], [(None, "a. " * 30)]):
        assert phrases.collocations(table(spark, some)).collect() == []


def test_trie_against_a_set():
    rng = random.Random(2)
    keys = sorted({bytes(rng.choice(b"ab\x00\xffcz\n") for _ in range(rng.randrange(1, 9))) for _ in range(3000)})
    trie = phrases.build(keys)
    for number, key in enumerate(keys):
        assert trie.accept[phrases.walk(trie, trie.root, key)] == number
    known = set(keys)
    for _ in range(5000):
        key = bytes(rng.randrange(256) if rng.random() < 0.05 else rng.choice(b"ab\x00\xffcz\n") for _ in range(rng.randrange(1, 10)))
        state = phrases.walk(trie, trie.root, key)
        assert (state >= 0 and trie.accept[state] >= 0) == (key in known)
    assert np.count_nonzero(trie.accept >= 0) == len(keys)
    assert phrases.walk(phrases.build([]), phrases.build([]).root, b"a") == -1


def test_hashes_depend_on_language_and_words():
    words = phrases.words_of([b"a b", b"a b", b"b a"], 2)
    one, two = phrases.hashes_of(words, phrases._salts([b"en", b"de", b"en"]), 2)
    assert len(set(one.tolist())) == 4 and len({two[0], two[2], two[4]}) == 3
    assert words.after.tolist() == [1, 0, 1, 0, 1, 0]


def test_text_is_read_as_often_for_any_number_of_candidates(spark, rows, monkeypatch):
    for name, value in (("SHARD_BYTES", 60), ("SENT_BYTES", 4000), ("SENT_HASHES", 3)):
        monkeypatch.setattr(phrases, name, value)
    some = rows[:60]
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    docs = table(spark, some).coalesce(1).select("text", "lang")
    got = phrases.collocations(docs.mapInArrow(seen, docs.schema), longest=3, least=4).collect()
    assert sorted(tuple(r) for r in got) == sorted(brute(some, least=4))
    assert read.value == len(some) * (3 + 1)


@pytest.mark.parametrize("sizes", [(50, 60, 400), (1 << 21, 1 << 21, 1 << 23)])
@pytest.mark.parametrize("alike", [False, True])
def test_gathered_phrases_are_counted_exactly(rows, monkeypatch, sizes, alike):
    for name, value in zip(("BATCH_BYTES", "SHARD_BYTES", "SENT_BYTES"), sizes):
        monkeypatch.setattr(phrases, name, value)
    if alike:  # phrases that share a hash stay apart
        own = phrases.hashes_of
        monkeypatch.setattr(phrases, "hashes_of", lambda *a: [h % np.uint64(3) for h in own(*a)])
    texts, langs = [(t or "").encode() for _, t in rows], [(lang or "und").encode() for lang, _ in rows]
    everything = phrases.Filter(6, 3, np.full(8, 255, np.uint8))
    batch = pa.RecordBatch.from_arrays([pa.array(langs, pa.binary()), pa.array(texts, pa.binary())], ["lang", "text"])
    sent = pa.Table.from_batches(phrases._gathered(iter([batch]), [everything] * 3, 4))
    total, want = {}, Counter()
    for bucket in pc.unique(sent["bucket"]):
        for r in phrases._totals(sent.filter(pc.equal(sent["bucket"], bucket)), 1).to_pylist():
            key = r["lang"].decode(), r["phrase"].decode()
            assert key not in total
            total[key] = r["a"]
    for lang, text in zip(langs, texts):
        want[lang.decode(), ""] += 0
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text.decode())):
            w = re.findall(r"[^\x20\x09]+", piece)
            want[lang.decode(), ""] += len(w)
            want.update((lang.decode(), " ".join(w[i : i + k])) for k in range(1, 4) for i in range(len(w) - k + 1))
    assert total == want
