"""The n-gram join against brute force over all pairs of small texts."""

import itertools
import random
import re

import numpy as np
import pytest

from tidemark.llm import ngram_join as J


def shingles(text):
    w = [x.translate(str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)}))
         for x in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    if not w:
        return set()
    return {tuple(w)} if len(w) < 3 else set(zip(w, w[1:], w[2:]))


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"x{rng.random()}"
    return words


def small_corpus(rng):
    """Copies near the threshold on both sides, shared passages, groups that meet in chains."""
    texts = [None, "", " \n\t", "one", "One", "one two", "one two", "ONE two", "É é", "é é"]
    common = [f"c{k}" for k in range(30)]
    for g in range(12):
        first = [f"g{g}w{k}" for k in range(rng.choice([9, 10, 11, 12, 40, 120, 200]))]
        texts.append(" ".join(first))
        now = first
        for _ in range(8):
            now = edited(rng, rng.choice([first, now]), rng.choice([0, 1, 1, 2, 3]))
            texts.append(rng.choice([" ", "\n", "  "]).join(now))
    for k in range(30):
        own = [f"o{k}w{j}" for j in range(rng.randint(0, 40))]
        texts.append(" ".join(own[:10] + common[:rng.randint(3, 30)] + own[10:]))
    texts += ["long text " + " ".join(f"l{k % 4000}" for k in range(9000))] * 2
    return texts


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 90 * len(sets[i] | sets[j]):
            up[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(least.get(top(i), d), d)
    return sorted(((d, len(s), least.get(top(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))),
                  key=repr)


@pytest.mark.parametrize("seed, block", [(1, 128), (2, 3)])
def test_components(spark, monkeypatch, seed, block):
    monkeypatch.setattr(J, "BLOCK", block)
    rng = random.Random(seed)
    texts = small_corpus(rng)
    ids = rng.sample(range(1000), len(texts))
    rows = list(zip(ids, texts)) + [(None, "one"), (None, "q r s t"), (ids[20], "other words here"),
                                    (ids[30], texts[30])]
    rng.shuffle(rows)
    df = spark.createDataFrame([(i, t, 0, 0) for i, t in rows],
                               "doc_id bigint, text string, node int, label int")
    got = sorted((tuple(r) for r in J.linked_components(df).collect()), key=repr)
    assert got == brute(rows)
    assert J.linked_components(df.limit(0)).count() == 0


def test_one_large_group_of_unlinked_near_copies(spark):
    """Members link to the first only, or to none: neither pairs nor links are lost."""
    rng = random.Random(3)
    first = [f"w{k}" for k in range(100)]
    rows = [(5000, " ".join(first))] + [
        (k, " ".join(edited(rng, first, 1 if k % 3 else 4))) for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted((tuple(r) for r in J.linked_components(df).collect()), key=repr) == brute(rows)


def test_sets_and_prefix_bounds():
    rng = random.Random(4)
    texts = [" ".join(rng.choices("abAB", k=rng.randint(0, 30))) for _ in range(200)]
    values, offsets = J.sets_of(texts)
    for t, a, e in zip(texts, offsets[:-1], offsets[1:]):
        assert e - a == len(shingles(t)) and (np.diff(values[a:e]) > 0).all()
    for n in range(1, 400):
        assert 100 * J.least(n) >= 90 * n > 100 * (J.least(n) - 1)
        assert J.first_matches(np.array([J.least(n)]))[0] <= J.first_matches(np.array([n]))[0]


def test_longer_prefixes_where_candidates_are_dear():
    assert J.choose_matches(100, np.zeros(0, np.int64)) == 1
    assert J.choose_matches(100, np.full(100, 2)) > 1
    assert J.choose_matches(1, np.array([50])) == 1


def test_linked_sets_share_the_matches_asked_for():
    """Blocks and single comparisons agree with the plain similarity for any choice of k."""
    rng = random.Random(5)
    sets = []
    for k in range(60):
        n = rng.randint(30, 60)
        v = sorted(rng.sample(range(40 if k % 2 else 62), min(n, 38)))
        n = len(v) + rng.randint(0, 2)
        m = rng.randint(1, max(1, min(J.least(n), n // J.LAST)))
        length = min(max(J.base(n) + m - (n - len(v)), 0), len(v))
        sets.append(J.Set(k, k, n, m, length, np.array(v)))
    got = J.block_links(sets, sets)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            both = len(np.intersect1d(a.values, b.values))
            want = i != j and 100 * both >= 90 * (a.n + b.n - both)
            assert got[i, j] == want and (i == j or J.pair_linked(a, b) == want)
    assert got.any()
