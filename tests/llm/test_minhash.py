"""Min-max hashing against all pairs."""

from __future__ import annotations

import numpy as np
import pytest

from marketmill.llm import minhash

COLUMNS = "doc_id long, text string, size long, bands string, node long, label string, kept string"


def shingle_set(text, words):
    found = (text or "").encode().lower().split()
    if len(found) < words:
        return {tuple(found)} if found else set()
    return set(zip(*(found[i:] for i in range(words)), strict=False))


def by_brute_force(rows, words, least):
    """Component of each row of (id, text): the smallest id reachable."""
    sets = [shingle_set(text, words) for _, text in rows]
    ids = [id_ for id_, _ in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, one in enumerate(sets):
        for j, two in enumerate(sets[:i]):
            if one and two and 100 * len(one & two) >= least * len(one | two):
                label[root(i)] = root(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(root(i), []).append(ids[i])
    return [min((x for x in groups[root(i)] if x is not None), default=None) for i in range(len(rows))]


def check(spark, rows, words=2, least=80):
    docs = spark.createDataFrame([(i, t, 1, "x", 2, "y", "z") for i, t in rows], COLUMNS)
    found = minhash.near_duplicates(docs.repartition(3), words=words, least=least).collect()
    got = sorted((r["doc_id"], r["n_shingles"], r["component"], r["kept"]) for r in found if r["doc_id"] is not None)
    component = by_brute_force(rows, words, least)
    want = sorted(
        (i, len(shingle_set(t, words)), c, c == i)
        for (i, t), c in zip(rows, component, strict=True)
        if i is not None
    )
    assert got == want
    return [r for r in found if r["doc_id"] is None]


def edited(rng, words, share):
    out = list(words)
    for place in rng.choice(len(words), max(1, int(share * len(words))), replace=False):
        out[place] = f"v{rng.integers(0, 10**6)}"
    return out


def near_copies(rng, groups, size, share):
    texts = []
    for _ in range(groups):
        base = [f"w{n}" for n in rng.integers(0, 20_000, size)]
        texts += [" ".join(edited(rng, base, share)) for _ in range(6)] + [" ".join(base)] * 2
    return texts


def test_odd_rows(spark):
    words = [f"w{i}" for i in range(40)]
    rows = [
        (5, " ".join(words)), (3, " ".join(words)), (9, " ".join([*words, "more"])),
        (1, None), (2, ""), (4, " \t\n"), (6, "one"), (7, "ONE"), (8, "one one"), (10, "one one one"),
        (11, "É é"), (12, "é é"), (13, "a b c d e"), (14, "A b C d e"), (15, "!!!"),
        (16, " ".join(words * 4000)), (17, " ".join(words * 300)),
        (20, "own words of row twenty"), (20, " ".join([*words, "less"])),
        (21, "own words of row twenty"), (22, "x" * 3_000_000), (22, "x" * 3_000_000),
    ]
    assert check(spark, rows) == []
    without = check(spark, [*rows[:3], (None, " ".join(words)), (None, "only here"), (None, "only here")])
    assert sorted((r["component"], r["kept"]) for r in without if r["component"] is not None) == [(3, False)]
    assert [r["kept"] for r in without if r["component"] is None] == [True, True]
    empty = spark.createDataFrame([], COLUMNS)
    assert minhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("tile", [300, 500_000])
def test_against_all_pairs(spark, monkeypatch, tile):
    monkeypatch.setattr(minhash, "TILE_SHINGLES", tile)
    rng = np.random.default_rng(tile)
    texts = [t for size in (3, 9, 40, 200) for t in near_copies(rng, 4, size, 0.06)]
    check(spark, [(7 * i % 997, text) for i, text in enumerate(texts)])
    check(spark, [(7 * i % 997, text) for i, text in enumerate(texts)], words=5, least=60)


@pytest.mark.parametrize("tile", [2_000, 500_000])
def test_one_bucket_with_many_components(spark, monkeypatch, tile):
    """A shared core too small to link: all documents meet, few pairs are alike."""
    monkeypatch.setattr(minhash, "TILE_SHINGLES", tile)
    rng = np.random.default_rng(1)
    core = [f"c{i}" for i in range(70)]
    texts = []
    for _ in range(60):
        own = core + [f"o{n}" for n in rng.integers(0, 10**6, int(rng.integers(10, 30)))]
        texts += [" ".join(own), " ".join([*own, "end"])]
    check(spark, list(enumerate(texts)))


def test_pairs_at_the_bound_share_a_band():
    assert minhash.bands_for(80) == 28
    banded, rng, missed = minhash.MinMax(4), np.random.default_rng(2), 0
    for _ in range(3000):
        drawn = rng.integers(0, 2**63, 45).astype(np.uint64)
        one, two = np.sort(drawn[:40]), np.sort(np.append(drawn[:36], drawn[40:]))
        missed += not (banded.keys(one) == banded.keys(two)).any()
    similarity = 36 / 45
    assert abs(missed / 3000 - (1 - similarity**4) ** 4) < 0.04


def test_smallest_and_largest_agree_as_often_as_the_sets():
    banded, rng = minhash.MinMax(28), np.random.default_rng(3)
    low, high = [], []
    for _ in range(300):
        drawn = rng.integers(0, 2**63, 120).astype(np.uint64)
        one, two = drawn[:100], drawn[20:]
        x, y = banded.values(one), banded.values(two)
        low.append((x[0] == y[0]).mean())
        high.append((x[1] == y[1]).mean())
    assert abs(np.mean(low) - 80 / 120) < 0.02 and abs(np.mean(high) - 80 / 120) < 0.02
    # Both values of a permutation together vary less than two independent ones would.
    both = (np.array(low) + np.array(high)) / 2
    assert both.var() < (np.var(low) + np.var(high)) / 4 * 1.05
