"""Quality cascade: figures, order of rules, verdicts."""

import re

from sensorloom.llm import cascade
from tests.llm.conftest import documents, words


LETTERS = str.maketrans("0123456789", "abcdefghij")


def slow(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    twice = {p for i, x in enumerate(windows) if windows.count(x) > 1 for p in (i, i + 1, i + 2)}
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(twice)


def test_figures_and_verdicts(spark, rng):
    rows = [(i, " ".join(words(rng, rng.randrange(120), 30).split()) + rng.choice([".", "", "\n\na b\n a b\na b\n"])) for i in range(150)]
    prose = [(500 + i, words(rng, 80, 100_000).translate(LETTERS).capitalize() + ".") for i in range(20)]
    odd = [None, "", " \t", "é" * 60, "a b   c", "x " * 5000, "One two\nOne two\n\n\n" * 30, words(rng, 30_000, 10**6) + ".", "# | $ " * 30, "LOUD WORDS! " * 40]
    rows += prose + [(1000 + k, t) for k, t in enumerate(odd)] + [(None, prose[0][1]), prose[1]]
    got = cascade.screen(documents(spark, rows).repartition(3)).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    for i, t in rows:
        r, want = by[i][0], slow(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        facts = cascade.Facts(t or "")
        assert r.kept == (not r.base_failed and not any(x.rejects(facts) for x in cascade.RULES))
        assert (r.rejected_by is None) == r.kept
    assert all(by[i][0].kept for i, _ in prose)
    assert len(got) == len(rows)
    assert cascade.screen(documents(spark, [])).count() == 0


def test_order_by_rejections_per_cost_changes_no_verdict(spark, rng):
    import time

    def dear(f):
        time.sleep(0.002)
        return len(f.words) % 2 == 0

    rules = (
        cascade.Rule("dear", dear),
        cascade.Rule("never", lambda f: False),
        cascade.Rule("cheap", lambda f: len(f.words) % 3 == 0),
    )
    docs = documents(spark, [(i, words(rng, 60 + i % 30, 10**6)) for i in range(200)])
    texts = docs.select("doc_id", "text")
    assert cascade.measured_order(texts, rules, 60) == ["cheap", "dear", "never"]
    kept = {r.doc_id: r.kept for r in cascade.screen(docs, rules, 60).collect()}
    assert kept == {i: (60 + i % 30) % 2 != 0 and (60 + i % 30) % 3 != 0 for i in range(200)}


def test_many_distinct_words():
    many = [str(i).encode() for i in range(5000)]
    try:
        packed, cascade.PACKED = cascade.PACKED, 100
        assert cascade.repeated_words(many + many[:4]) == 8
    finally:
        cascade.PACKED = packed
    assert cascade.repeated_words(many + many[:4]) == 8
