"""Conversation repair against brute force: every audit tried, ties and parts included."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import turn_repair as R

KIND = "conv_id bigint, turn bigint, role string, text string, c string, part string"
BLANK = re.compile(r"[\x20\x09-\x0D]*")


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        bare = text.rstrip(R.BLANKS)
        out.append("b" if not bare else "d" if (role, text) in seen else
                   "t" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def brute(rows, most_inserts=3):
    """The cheapest edits, ASCII-least, by trying all (roles and texts of each result)."""
    faults, best = faults_of(rows), None
    for ops in itertools.product("KRD", repeat=len(rows)):
        if any(f in ("b", "d") and o != "D" for f, o in zip(faults, ops)):
            continue
        for ins in itertools.product(range(most_inserts), repeat=len(rows) + 1):
            audit = "".join("I" * ins[k] + o for k, o in enumerate(ops)) + "I" * ins[-1]
            cost = sum({"K": 0, "R": 1, "D": 2}[o] + (5 if f == "t" and o != "D" else 0)
                       for o, f in zip(ops, faults)) + 5 * sum(ins)
            if best and (cost, audit) >= best[:2]:
                continue
            made, it = [], iter(rows)
            for e in audit:
                role, text = ("", "") if e == "I" else next(it)
                if e == "D":
                    continue
                if e != "K":
                    role = "assistant" if made and made[-1][0][:1] == "u" else "user"
                made.append((role, text))
            initials = "".join(r[:1] or "?" for r, _ in made)
            if re.fullmatch("(s?(ua)+)?", initials):
                best = (cost, audit, "\n".join(f"{r}:{t}" for r, t in made))
    return best


def solve(rows, cuts=()):
    """Through the operator's own block and joining steps, cut into parts at ``cuts``."""
    import pyarrow as pa
    data, part = [], 0
    for k, ((role, _), f) in enumerate(zip(rows, faults_of(rows))):
        part += k in cuts
        data.append({"c": "x", "part": part, "initial": role[:1], "fault": f, "n": 1})
    blocks = [r for b in R._solve_parts([pa.RecordBatch.from_pylist(data)])
              for r in b.to_pylist()]
    blocks.sort(key=lambda r: (r["part"], r["entry"]))
    schema = next(iter(R._solve_parts([]))).schema
    done = [r for b in R._join_parts([pa.RecordBatch.from_pylist(blocks, schema)])
            for r in b.to_pylist()]
    return sum(r["cost"] for r in done), "".join(r["edits"] for r in done)


def random_rows(rng, n):
    texts = ["a.", "b", "c!", " ", "d?", "a.", "e"]
    return [(rng.choice(["user", "assistant", "system", "tool", "user", "assistant"]),
             rng.choice(texts)) for _ in range(n)]


def test_cheapest_edits_are_the_least_of_all():
    rng = random.Random(5)
    for k in range(150):
        rows = random_rows(rng, rng.randint(1, 4 if k % 10 else 5))
        want = brute(rows, 3 if len(rows) < 5 else 2)
        assert solve(rows) == want[:2], rows


def test_parts_make_no_difference():
    rng = random.Random(6)
    for n in (7, 40, 300):
        for _ in range(20):
            rows = [(r, t + str(rng.randint(0, n)) + rng.choice([".", "!", "", "?"]))
                    for r, t in random_rows(rng, n)]
            whole = solve(rows)
            assert solve(rows, set(rng.sample(range(1, n), min(6, n - 1)))) == whole


def test_tree_stays_small_and_settles():
    """A well formed conversation of 100,000 rows leaves only a few nodes unsettled."""
    out, most = [], 0
    v = R.Survivors(R.NONE, lambda n: out.append(n.piece))
    for k in range(100_000):
        v.insert()
        v.step(R.EDGES["ua"[k % 2], "" if k % 7 else "t"])
        most = max(most, k + 1 - len(out))
    assert most < 40


def test_digests_of_edge_rows(spark):
    rng = random.Random(7)
    rows = [(i, t, r, x) for i in range(60)
            for t, (r, x) in enumerate(random_rows(rng, rng.randint(1, 4)))]
    rows += [(100, None, "user", "a."), (100, None, "user", "a."), (100, 3, "assistant", "ok."),
             (100, 9, None, None), (None, 1, "user", "q?"), (101, 1, "", "x."),
             (102, 5, "assistant", "r."), (102, 5, "assistant", "r."), (102, 5, "tool", "z")]
    rows += [(103, t, "user" if t % 2 == 0 else "assistant", "long " * 4000 + f"{t}.")
             for t in range(300)]
    df = spark.createDataFrame([(*r, "k", "p") for r in rows], KIND)
    got = {r["conv_id"]: r for r in R.digests(df).collect()}
    groups = {}
    for i, t, r, x in rows:
        groups.setdefault(i, []).append((t is not None, t or 0, r or "", x or ""))
    assert set(got) == set(groups)
    for i, g in groups.items():
        g.sort()
        own, r = [x[2:] for x in g], got[i]
        faults = faults_of(own)
        assert [r["blank"], r["duplicate"], r["truncated"]] == [faults.count(f) for f in "bdt"]
        assert r["illegal"] == sum(a[0][:1] + b[0][:1] not in R.LEGAL
                                   for a, b in zip(own, own[1:]))
        turns = [x[1] for x in g if x[0]]
        assert r["gaps"] == (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0)
        if i == 103:
            assert r["audit"] == "K" * 300 and r["cost"] == 0
            made = "\n".join(f"{a}:{b}" for a, b in own)
        else:
            cost, audit, made = brute(own)
            assert (r["cost"], r["audit"]) == (cost, audit)
        assert r["repaired_sha256"] == hashlib.sha256(made.encode()).hexdigest()
    assert R.digests(df.limit(0)).count() == 0


def test_damage_by_crc(spark):
    rows = [(i, t, "assistant", "One. Two!", "", "") for i in range(30) for t in range(4)]
    rows += [(None, None, None, None, "", "")]
    got = {(r["conv_id"], r["turn"]): r for r in
           R.damaged(spark.createDataFrame(rows, KIND)).collect()}
    for i, t, role, text, *_ in rows:
        key = f"{' ' if i is None else i}:{' ' if t is None else t}"
        k, r = zlib.crc32(key.encode()) % 20, got[i, t]
        assert r["n"] == {0: 0, 3: 2}.get(k, 1)
        text, role = text or " ", role or " "
        assert r["text"] == {1: "", 2: re.sub("[.!?]", "", text)}.get(k, text)
        assert r["role"] == ("user" if k == 4 else role)
    whole = R.digests(R.damaged(spark.createDataFrame(rows, KIND)).withColumn("n", F.lit(0)))
    assert {r["audit"] for r in whole.collect()} == {""} and whole.count() == 31


@pytest.mark.parametrize("whole", [True, False])
def test_repaired_rows(spark, whole):
    df = spark.createDataFrame([(1, 0, "assistant", "hi.", "", ""),
                                (1, 1, "assistant", "yes.", "", "")], KIND)
    rows = R.ordered(df)
    out = R.repaired(rows, R.edits(rows), whole).orderBy("part", "pos").collect()
    assert [(r["edit"], r["role"], r["text"]) for r in out] == [
        ("R", "user", "hi."), ("K", "assistant", "yes.")]
