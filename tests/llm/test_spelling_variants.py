"""Spelling variants against brute force over all pairs of a small vocabulary."""

import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import spelling_variants as S


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + (len(a) == len(b)):] == b[k + 1:]


def made_up(rng, n, letters="aabbcdé"):
    return sorted({"".join(rng.choice(letters) for _ in range(rng.randint(4, 8)))
                   for _ in range(n)})


def test_both_searches_find_every_pair_once():
    rng = random.Random(1)
    for letters in ("ab", "aabbcdé", "abcdefghijklm"):
        words = made_up(rng, 400, letters)
        asked = rng.sample(words, len(words) // 2) + ["zzzzz"]
        got = []
        for side in (0, 1):
            for q, x in S.near_pairs(words, asked, side):
                got += [(asked[a], words[b]) for a, b in zip(q.tolist(), x.tolist())]
        want = {(a, b) for a in asked for b in words if one_edit(a, b)}
        assert len(got) == len(set(got)) and set(got) == want


def test_wide_and_narrow_intervals_agree(monkeypatch):
    words = made_up(random.Random(2), 300, "abc")
    find = lambda: [(q.tolist(), x.tolist()) for s in (0, 1)
                    for q, x in S.near_pairs(words, words, s)]
    narrow = find()
    monkeypatch.setattr(S, "WIDE", 0)
    assert find() == narrow


def brute(count):
    out = {}
    for w, n in count.items():
        near = [x for x in count if one_edit(w, x)] if len(w) >= S.SHORTEST else []
        near = [x for x in near if len(x) >= S.SHORTEST]
        best = min(near, key=lambda x: (-count[x], x), default=None)
        form = best if best and count[best] >= 2 * n else None
        out[w] = (form, n, len(near), count[form] if form else None)
    root = {}
    for w in count:
        r = w
        while out[r][0]:
            r = out[r][0]
        root[w] = r
    return {w: (f, root[w], n, m, fn) for w, (f, n, m, fn) in out.items()}


@pytest.mark.parametrize("bucket, block", [(1 << 13, 1 << 16), (40, 16)])
def test_variants(spark, monkeypatch, bucket, block):
    rng = random.Random(3)
    count = {w: 2 ** rng.randint(0, 9) for w in made_up(rng, 500, "abc")} | {"x": 3, "": 9}
    near = S.near_words
    monkeypatch.setattr(S, "near_words", lambda w: near(w, bucket, block))
    df = spark.createDataFrame([(w, n, "k") for w, n in count.items()] + [(None, 4, "k")],
                               "word string, n int, form string")
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"])
           for r in S.variants(df).collect()}
    assert got == brute(count)
    assert S.variants(df.limit(0)).count() == 0


def test_vocabulary_of_edge_rows(spark):
    rng = random.Random(4)
    pool = ["Straße", "LÀrge", "house", "houses", "thousand", "ab"]
    rows = [(i, " ".join(rng.choices(pool, k=60)) + "\n42 house-boat", "k", "w")
            for i in range(80)]
    rows += [(None, "house houses", "k", None), (500, None, "k", "w"), (501, "", "k", "w"),
             (502, "12 .", "k", "w"), (503, "house " * 20000, "k", "w"), (503, "house", "k", "w")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n string, word string")
    want = {}
    for i, text, *_ in rows:
        for run in re.findall(S.RUN, text or ""):
            run = run.translate(str.maketrans(S.UPPER, S.LOWER))
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            want[run] = want.get(run, 0) + 1
    want = {w: n for w, n in want.items() if len(w) >= 5 and n >= 3}
    got = {r["word"]: r["n"] for r in S.vocabulary(df, damage=97).collect()}
    assert got == want and len(got) > 4
    plain = S.vocabulary(df.where(F.col("doc_id") == 503)).collect()
    assert [(r["word"], r["n"]) for r in plain] == [("house", 20001)]
