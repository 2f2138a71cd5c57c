"""Mixing: targets against the resharing loop done by hand, draws, edge cases."""

import random
import re

import pytest

from tidemark.llm import source_mix as M

SCHEMA = "doc_id bigint, text string, source string, size string"


def loop_targets(sizes):
    """Share by weight; stop at three times the size; share the excess anew."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode())
    names += [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, stopped = sum(sizes.values()), {}
    while True:
        left = [s for s in names if s not in stopped]
        rest, w = total - sum(stopped.values()), sum(weight[s] for s in left)
        target = {s: rest * weight[s] / w for s in left}
        over = [s for s in left if target[s] > 3 * sizes[s]]
        if not over:
            return stopped | target
        stopped |= {s: 3 * sizes[s] for s in over}


@pytest.mark.parametrize("seed", range(4))
def test_targets_equal_the_loop(spark, seed):
    rng = random.Random(seed)
    rows = []
    for k in range(rng.randint(1, 9)):
        source = None if k == 3 else f"s{k}é"
        for _ in range(rng.randint(1, 6)):
            rows.append((len(rows), "w " * rng.choice([1, 3, 50, 400]), source, "x"))
    rows += [(len(rows), None, "empty", "x"), (len(rows), " \n", "empty", "x")]
    out = M.mix(spark.createDataFrame(rows, SCHEMA)).collect()
    sizes = {}
    for _, t, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want = loop_targets(sizes)
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))
    assert len(out) == len(rows)
    for r in out:
        assert r["target"] == pytest.approx(want[r["source"]])
        assert r["size"] == "x" and r["source_size"] == sizes[r["source"]]
        rate = want[r["source"]] / sizes[r["source"]] if sizes[r["source"]] else 0
        assert int(rate) <= r["copies"] <= int(rate) + 1 and r["copies"] <= 3


def test_words_taken_come_near_the_targets(spark):
    rows = [(i, "w " * (20 + i % 7), f"s{i % 10 if i % 3 else 0}", "x") for i in range(6000)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = M.mix(df).collect()
    taken, target = {}, {}
    for r in out:
        taken[r["source"]] = taken.get(r["source"], 0) + r["size_"] * r["copies"]
        target[r["source"]] = r["target"]
    for s in target:
        assert taken[s] == pytest.approx(target[s], rel=0.1)
    again = M.mix(df.repartition(7)).collect()
    key = lambda r: (r["doc_id"], r["copies"])
    assert sorted(map(key, out)) == sorted(map(key, again))
    emitted = M.taken(df)
    assert emitted.columns == df.columns
    assert emitted.count() == sum(r["copies"] for r in out)


def test_empty_null_and_repeated(spark):
    df = spark.createDataFrame([(None, None, None, None), (1, "a b", None, None),
                                (1, "a b", None, None)], SCHEMA)
    got = M.mix(df).collect()
    assert sorted(r["copies"] for r in got) == [1, 1, 1]
    assert M.mix(df.limit(0)).count() == 0
    none = M.mix(df.where("doc_id is null")).collect()
    assert none[0]["target"] == 0 and none[0]["copies"] == 0
