"""Cases that broke earlier: long roles, reopened indexes, clashing names of a mix."""

import hashlib

import pytest

from tidemark.llm import chat_format, exact_dedup, source_mix


def test_a_very_long_role(spark):
    role = "a:b\\#" * 40_000
    df = spark.createDataFrame([(1, 0, role, "x"), (1, 1, "assistant", "y" * 200_000)],
                               "conv_id bigint, turn bigint, role string, text string")
    got = chat_format.digests(chat_format.formatted(df)).first()
    want = f"{role}\nx\nassistant\n{'y' * 200_000}\n"
    assert got["turns_sha256"] == hashlib.sha256(want.encode()).hexdigest()
    assert got["loss_chars"] == 200_000


def test_an_index_keeps_its_buckets(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(200)],
                                 "doc_id bigint, text string")
    first = exact_dedup.DigestIndex(spark, buckets=16)
    assert first.dedupe(docs).where("kept").count() == 200
    with pytest.raises(ValueError):
        exact_dedup.DigestIndex(spark, path=first.path, buckets=4)
    with pytest.raises(ValueError):
        exact_dedup.DigestIndex(spark, path=first.path, id_type="string")
    again = exact_dedup.DigestIndex(spark, path=first.path)
    assert again.buckets == 16 and again.dedupe(docs).where("kept").count() == 0
    assert exact_dedup.DigestIndex(spark).buckets == int(
        spark.conf.get("spark.sql.shuffle.partitions"))


def test_a_mix_with_clashing_names(spark):
    rows = [(i, "one two three", f"s{i % 3}", "a", 1, 2.0, "b", 7) for i in range(30)]
    rows += [(99, None, None, "a", 1, 2.0, "b", 7)]
    df = spark.createDataFrame(
        rows, "doc_id bigint, text string, source string, t_source string, t_size int, "
              "t_target double, of_source string, size int")
    out = source_mix.mix(df)
    assert out.columns[:8] == df.columns and out.count() == 31
    plain = source_mix.mix(df.select("doc_id", "text", "source"))
    pick = lambda x: sorted((r["doc_id"], r["copies"], r["target"])
                            for r in x.collect())
    assert pick(out) == pick(plain)
    assert source_mix.taken(df).columns == df.columns


def test_scores_beyond_what_floats_hold(spark):
    """Products above 2^53 come out exact, ties and bounds included."""
    import numpy as np

    from tidemark.llm import cover_search
    rng = np.random.default_rng(2)
    big = 2.0 ** 20 + rng.integers(0, 1 << 12, (120, 3)) / 256.0
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(big)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    v = np.floor(big * 256).astype(np.int64)
    want = {}
    for q in range(0, 120, 50):
        s = {c: int(sum(int(a) * int(b) for a, b in zip(v[q], v[c]))) for c in range(120) if c != q}
        assert max(s.values()) > 2 ** 53
        best = sorted(s, key=lambda c: (-s[c], c))[:5]
        want |= {(q, k + 1): (c, s[c]) for k, c in enumerate(best)}
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"])
           for r in cover_search.search(df).collect()}
    assert got == want


def test_both_sides_of_a_search_meet(spark, monkeypatch):
    """Scattered vectors in many blocks: each pass finds its candidates whichever way Spark
    joins the two sides, and scattered points aren't split to single ones."""
    import numpy as np

    from tidemark.llm import cover_search
    monkeypatch.setattr(cover_search, "BLOCK", 100)
    x = np.random.default_rng(4).standard_normal((3000, 16))
    v = np.floor(256 * x).astype(np.int64)
    assert cover_search.CoverTree(v[:64]).kids == [[]]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(x.tolist())],
                               "vec_id bigint, embedding array<double>")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for limit in (old, "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"])
                   for r in cover_search.search(df).collect()}
            assert len(got) == 300
            for q in range(0, 3000, 50):
                s = v @ v[q]
                best = sorted((i for i in range(3000) if i != q), key=lambda i: (-s[i], i))[:5]
                assert [got[q, k + 1] for k in range(5)] == [(c, s[c]) for c in best]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
