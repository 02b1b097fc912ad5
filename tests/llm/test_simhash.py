"""SimHash: fingerprints, bit-sliced comparison, components, large groups."""

import numpy as np
import pytest
import xxhash

from sensorloom.llm import components, simhash
from tests.llm.conftest import documents, words


def fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = low.encode().split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def joined(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute(rows):
    fps = {}
    for i, t, *_ in rows:
        fps.setdefault(fingerprint(t), []).append(i)
    keys = list(fps)
    linked = [(a, b) for k, a in enumerate(keys) for b in keys[k + 1 :] if (a ^ b).bit_count() <= 3]
    root = joined(keys, linked)
    ids = {}
    for f, members in fps.items():
        ids.setdefault(root[f], []).extend(i for i in members if i is not None)
    return sorted(((i, f"{fingerprint(t):016x}", min(ids[root[fingerprint(t)]], default=None)) for i, t, *_ in rows), key=str)


@pytest.fixture
def rows(rng):
    out = []
    for i in range(60):
        base = words(rng, rng.randrange(1, 300), 5000).split()
        for _ in range(rng.randrange(1, 5)):
            w = list(base)
            for _ in range(rng.randrange(0, 3)):
                w[rng.randrange(len(w))] = "changed"
            out.append((len(out) * 3 + 7, " ".join(w)))
    odd = [(1, None), (2, ""), (0, " \n\t"), (None, "One TWO"), (5, "one two"), (6, "É"), (8, "é"), (None, "alone here now and then"), (9, words(rng, 60_000))]
    return [*out, *odd, out[0], out[0]]


def test_components_equal_brute_force(spark, rows):
    got = simhash.near_duplicates(documents(spark, rows).repartition(5))
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_a_large_group_is_cut_into_blocks(spark, monkeypatch, rng):
    monkeypatch.setattr(simhash, "BLOCK", 50)
    start = rng.getrandbits(64)
    ball = {start}
    while len(ball) < 700:
        ball.add(rng.choice(sorted(ball)) ^ (1 << rng.randrange(20)) ^ (1 << rng.randrange(64) if rng.random() < 0.1 else 0))
    signed = [f - (1 << 64) if f >> 63 else f for f in ball]
    links = simhash.near_links(spark.createDataFrame([(f,) for f in signed], "fp long")).collect()
    want = joined(signed, [(a, b) for k, a in enumerate(signed) for b in signed[k + 1 :] if ((a ^ b) & (2**64 - 1)).bit_count() <= 3])
    assert all(((r.u ^ r.v) & (2**64 - 1)).bit_count() <= 64 and want[r.u] == want[r.v] for r in links)
    assert joined(signed, [(r.u, r.v) for r in links]) == want
    assert len(links) < 40 * len(ball)


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_bit_sliced_comparison(radius):
    gen = np.random.default_rng(radius)
    base = gen.integers(0, 2**64, 30, dtype=np.uint64)
    x = np.array([int(b) ^ sum(1 << int(k) for k in {*gen.integers(0, 64, int(gen.integers(0, 6)))}) for b in base for _ in range(9)], np.uint64)
    near = np.bitwise_count(x[:, None] ^ x[None, :]) <= radius
    got = np.zeros(near.shape, bool)
    got[simhash.near_matrix(x, x, radius)] = True
    assert (got == near).all()
    sizes = np.array([1, 2, 64, 3, 65, 5, 1, 100, 29])
    sizes = np.append(sizes, len(x) - sizes.sum()) if sizes.sum() < len(x) else sizes
    i, j = simhash.near_in_groups(x, sizes, radius)
    group = np.repeat(np.arange(len(sizes)), sizes)
    pairs = {(min(a, b), max(a, b)) for a, b in zip(i.tolist(), j.tolist(), strict=True)}
    assert pairs == {(a, b) for a in range(len(x)) for b in range(a + 1, len(x)) if group[a] == group[b] and near[a, b]}


def test_components_of_a_chain_and_a_star(spark):
    chain = [(k, k + 1) for k in range(200, 300)]
    star = [(10, k) for k in range(11, 180)] + [(5, 179), (7, 7)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(chain + star, "u long, v long")).collect()}
    assert got == {k: 200 for k in range(201, 301)} | {k: 5 for k in range(10, 180)}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_one_of_each_group(spark, rows):
    docs = documents(spark, rows)
    kept = simhash.one_of_each_group(docs)
    assert kept.columns == docs.columns
    got = kept.collect()
    want = {r[2] for r in brute(rows)} - {None}
    assert sorted(r.doc_id for r in got if r.doc_id is not None) == sorted(want)
    assert [r.text for r in got if r.doc_id is None] == ["alone here now and then"]


def test_empty_table(spark):
    assert simhash.near_duplicates(documents(spark, [])).count() == 0
    assert simhash.one_of_each_group(documents(spark, [])).count() == 0


@pytest.mark.parametrize("radius", [4, 7, 11, 15])
def test_bit_sliced_comparison_of_wide_radii(radius):
    gen = np.random.default_rng(radius)
    base = gen.integers(0, 2**64, 30, dtype=np.uint64)
    x = np.array([int(b) ^ sum(1 << int(k) for k in {*gen.integers(0, 64, int(gen.integers(0, 14)))}) for b in base for _ in range(9)], np.uint64)
    near = np.bitwise_count(x[:, None] ^ x[None, :]) <= radius
    got = np.zeros(near.shape, bool)
    got[simhash.near_matrix(x, x, radius)] = True
    assert (got == near).all()
    i, j = simhash.near_in_groups(x, np.array([200, 70]), radius)
    group = np.repeat([0, 1], [200, 70])
    pairs = {(min(a, b), max(a, b)) for a, b in zip(i.tolist(), j.tolist(), strict=True)}
    assert pairs == {(a, b) for a in range(len(x)) for b in range(a + 1, len(x)) if group[a] == group[b] and near[a, b]}


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_similar_texts_are_linked_and_others_are_not(spark, monkeypatch, rng):
    monkeypatch.setattr(simhash, "BLOCK", 30)
    rows = []
    for k in range(40):
        base = words(rng, rng.randrange(120, 400), 5000).split()
        rows.append((10 * k, " ".join(base)))
        for c in range(1, 4):
            copy = list(base)
            for at in rng.sample(range(len(base)), max(1, len(base) // rng.choice([25, 60, 80]))):
                copy[at] = f"x{rng.randrange(10**6)}"
            rows.append((10 * k + c, " ".join(copy)))
    # four shingles of seven are the same
    rows += [(900, None), (901, ""), (None, "alone here"), (902, rows[0][1]), (903, "one two three four five six seven eight"), (904, "one two three four five six seven nine ten")]
    sets = [shingles(t) for _, t in rows]
    links = [(a, rows[m]) for k, a in enumerate(rows) for m in range(k + 1, len(rows)) if sets[k] and 5 * len(sets[k] & sets[m]) >= 4 * len(sets[k] | sets[m])]
    root = joined([r[0] for r in rows if r[0] is not None], [(a[0], b[0]) for a, b in links] + [(900, 901)])
    want = {min(i for i in root if root[i] == r) for r in root.values()}
    far = [(a[0], b[0]) for a, b in links if (fingerprint(a[1]) ^ fingerprint(b[1])).bit_count() > 3]
    assert len(far) > 20
    got = {r.doc_id for r in simhash.one_of_each_similar_group(documents(spark, rows).repartition(5)).collect()}
    assert got == want | {None}
    assert simhash.one_of_each_similar_group(documents(spark, [])).count() == 0


def test_common_shingles_against_sets(monkeypatch):
    monkeypatch.setattr(simhash, "MATRIX_WIDTH", 7)
    gen = np.random.default_rng(3)
    sets = [np.unique(gen.integers(0, 60, int(n)).astype(np.uint64)) for n in (1, 5, 40, 80, 3, 40)]
    want = [[len({*a.tolist()} & {*b.tolist()}) if a is not b else None for b in sets] for a in sets]
    got = simhash.common_shingles(sets)
    assert [[None if i == j else int(got[i, j]) for j in range(6)] for i in range(6)] == want


def test_large_group_near_the_border_of_similarity(spark, monkeypatch, rng):
    """Many texts a little more or less alike than 0.8, in one group that is cut into blocks."""
    monkeypatch.setattr(simhash, "BLOCK", 16)
    base = words(rng, 150, 5000).split()
    rows = []
    for k in range(90):
        copy = list(base)
        for at in rng.sample(range(len(base)), rng.randrange(1, 7)):
            copy[at] = f"x{rng.randrange(10**6)}"
        rows.append((k, " ".join(copy)))
    sets = [shingles(t) for _, t in rows]
    links = [(a, b) for a in range(90) for b in range(a) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    root = joined(range(90), links)
    want = {min(i for i in root if root[i] == r) for r in root.values()}
    assert 1 < len(want) < 60 and len(links) < 90 * 89 / 2
    got = [r.doc_id for r in simhash.one_of_each_similar_group(documents(spark, rows).repartition(4)).collect()]
    assert sorted(got) == sorted(want)
