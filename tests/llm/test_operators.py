"""Small fixtures for the operators: nulls, empty, ties, repeats, clashing names, brute force."""

import collections
import hashlib
import math
import random
import re

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import (chat_format, cover_search, exact_dedup, icws_dedup, license_scan, lm_mix,
                          quality_mil, toxicity)

DOCS = "doc_id bigint, text string, kept string, class_id string"


def test_chat_digests(spark):
    rows = [(1, 0, "user", "a # \\ </turn> b"), (1, 1, "assistant", "x\n### y: z"),
            (1, 2, "assistant", None), (2, 0, None, "only"), (3, 1, "assistant", "b"),
            (3, 0, "a:b\\c", "f"), (None, 0, "assistant", "n"), (4, None, "user", "q"),
            (4, 0, "assistant", "r"), (4, 0, "assistant", "r")]
    rows += [(9, t, "assistant" if t % 2 else "user", f"t{t}") for t in range(1100)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    pieces = chat_format.formatted(df)
    got = {r["conv_id"]: r for r in chat_format.digests(pieces).collect()}
    groups = collections.defaultdict(list)
    for c, t, r, x in rows:
        groups[c].append((t is not None, t or 0, r or "", x or ""))
    assert set(got) == set(groups)
    for c, turns in groups.items():
        turns.sort()
        own = "".join(f"{r}\n{x}\n" for _, _, r, x in turns)
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        assert got[c]["n_turns"] == len(turns)
        assert got[c]["turns_sha256"] == hashlib.sha256(own.encode()).hexdigest()
        assert got[c]["loss_chars"] == len(loss)
        assert got[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    texts = chat_format.texts(pieces.where("conv_id < 9")).collect()
    spans = {(r["conv_id"], r["pos"]): r for r in chat_format.examples(pieces).collect()}
    for r in texts:
        e = spans[(r["conv_id"], r["pos"])]
        assert len(r["text"]) == e["example_end"] and r["loss_end"] == e["loss_end"]
        assert r["text"].count("</turn>\n") == r["pos"]
    assert chat_format.digests(chat_format.formatted(df.limit(0))).count() == 0


def test_chat_digests_come_from_the_examples(spark, monkeypatch):
    df = spark.createDataFrame([(1, 0, "user", "ask"), (1, 1, "assistant", "reply")],
                               "conv_id bigint, turn bigint, role string, text string")
    pieces, examples = chat_format.formatted(df), chat_format.examples
    right = chat_format.digests(pieces).first()
    monkeypatch.setattr(chat_format, "examples", lambda p: examples(p).withColumns(
        {"loss_end": F.col("loss_end") - 1, "example_end": F.col("example_end") + 1}))
    wrong = chat_format.digests(pieces).first()
    assert wrong["loss_chars"] == right["loss_chars"] - 1
    assert wrong["formatted_chars"] == right["formatted_chars"] + 1


def test_exact_index_over_batches(spark):
    first = spark.createDataFrame([(5, "a  b", "k", "c"), (3, "a\tb", "k", "c"),
                                   (None, None, "k", "c"), (7, "", None, None),
                                   (8, "x", "k", "c"), (8, "x", "k", "c")], DOCS)
    index = exact_dedup.DigestIndex(spark, buckets=4)
    rows = index.dedupe(first, carry=True).collect()
    assert len(rows) == 6 and rows[0]["kept"] in ("k", None)
    keep = collections.Counter((r["doc_id"], r["kept_"]) for r in rows)
    assert keep == {(3, True): 1, (5, False): 1, (7, True): 1, (None, False): 1,
                    (8, True): 1, (8, False): 1}
    again = exact_dedup.DigestIndex(spark, path=index.path, buckets=4)
    second = again.dedupe(spark.createDataFrame([(1, "a b", "", ""), (2, "new", "", "")], DOCS))
    got = {r["doc_id"]: (r["keep_id"], r["kept"]) for r in second.collect()}
    assert got == {1: (3, False), 2: (2, True)}
    assert again.rows().count() == 4
    assert index.dedupe(first.limit(0)).count() == 0
    assert exact_dedup.keep_first(spark, first).columns == first.columns


def test_license_rules(spark):
    s = license_scan.SENTENCES
    wrapped = s["mit-grant"][0].replace(" to whom", "\nto whom") + "\n\n" + s["mit-notice"][0]
    rows = [(1, "Intro.\nReleased under the MIT License.\nMore", "", ""), (2, wrapped, "", ""),
            (3, "Licensed under CC BY-NC 4.0.", "", ""), (4, None, "", ""), (5, "", "", ""),
            (6, "\n".join(s[k][0] for k in ("bsd-grant", "bsd-source", "bsd-binary",
                                            "bsd-names")), "", ""),
            (7, "the license of birds", "", ""), (8, "Licensed under CC BY-NC 4.0. "
                                                  "Released under the MIT License.", "", "")]
    got = {r["doc_id"]: r["licenses"] for r in
           license_scan.scan(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {1: "MIT", 2: "MIT", 3: "CC-BY-NC-4.0", 4: "", 5: "", 6: "BSD-3-Clause",
                   7: "", 8: "CC-BY-NC-4.0,MIT"}
    for texts in s.values():
        assert all(re.search("|".join(license_scan.ANCHORS), t.lower()) for t in texts)


def test_license_notices_keep_their_version(spark):
    notice = ("This {} is free software{} you can redistribute it and/or modify\n"
              "it under the terms of the GNU {} as published by\n"
              "the Free Software Foundation{} either version {} of the License, or\n"
              "(at your option) any later version.\n\n"
              "This program is distributed in the hope that it will be useful,\n"
              "but WITHOUT ANY WARRANTY; without even the implied warranty of\n"
              "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.")
    gpl, lesser = "General Public License", "Lesser General Public License"
    texts = {1: notice.format("program", ":", gpl, ",", 3),
             2: notice.format("program", ";", gpl, ";", 2),
             3: notice.format("program", ":", "Affero " + gpl, ",", 3),
             4: notice.format("library", ";", lesser, ";", "2.1"),
             5: notice.format("program", ":", lesser, ",", 3),
             6: notice.format("program", ":", gpl, ",", 7),
             7: "This program is free software: do as you like.",
             8: notice.format("program", ":", gpl, ",", 3).replace("\n\n", "\f").replace(
                 "\n", " ")}
    rows = [(i, t, "", "") for i, t in texts.items()]
    got = {r["doc_id"]: r["licenses"] for r in
           license_scan.scan(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {1: "GPL-3.0-or-later", 2: "GPL-2.0-or-later", 3: "AGPL-3.0-or-later",
                   4: "LGPL-2.1-or-later", 5: "LGPL-3.0-or-later", 6: "", 7: "",
                   8: "GPL-3.0-or-later"}


def test_license_scan_of_other_sentences(spark):
    rows = [(1, "Do what you want: nobody minds.", "", ""), (2, "Do what you want.", "", "")]
    got = license_scan.scan(spark.createDataFrame(rows, DOCS),
                            sentences={"free": ["Do what you want: nobody minds."]},
                            rules=[("Free", ["free"])]).collect()
    assert {r["doc_id"]: r["licenses"] for r in got} == {1: "Free", 2: ""}


def _near_rows():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    base = [[word() for _ in range(rng.randint(40, 120))] for _ in range(25)]
    rows = []
    for b in base:
        rows.append(b)
        for _ in range(rng.randint(0, 6)):
            c = list(b)
            for _ in range(rng.randint(0, 3)):
                c[rng.randrange(len(c))] = word()
            rows.append(c)
    out = [(i, " ".join(r), "k", "c") for i, r in enumerate(rows)]
    return out + [(900, None, None, None), (901, "", "k", "c"), (902, "two words", "k", "c"),
                  (902, "two words", "k", "c"), (903, "Two  WORDS", "k", "c"),
                  (None, "no id here at all", "k", "c")]


def test_near_classes_equal_brute_force(spark):
    rows = _near_rows()
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    got = icws_dedup.near_classes(df, carry=True).collect()
    assert len(got) == len(rows)
    sh = []
    for _, t, _, _ in rows:
        w = (t or "").lower().split()
        sh.append(collections.Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))
                  if w else collections.Counter({(): 1}))
    label = list(range(len(rows)))
    near = 0
    for i in range(len(rows)):
        for j in range(i):
            low = sum((sh[i] & sh[j]).values())
            s = low / (sum(sh[i].values()) + sum(sh[j].values()) - low)
            if s >= 0.83 or s == 1:
                near += 1
                a, b = label[i], label[j]
                label = [b if x == a else x for x in label]
    assert near > 10
    cls = {r["doc_id"]: r["class_id_"] for r in got}
    ids = [r[0] for r in rows]
    for i in range(len(rows)):
        for j in range(i):
            if label[i] == label[j]:
                assert cls[ids[i]] == cls[ids[j]]
    assert sum(r["kept_"] for r in got) == len({(r["class_id_"]) for r in got})
    assert cls[901] == 900 and cls[903] == 902
    assert icws_dedup.near_classes(df.limit(0)).count() == 0


def test_block_similarity_equals_pairs():
    rng = np.random.default_rng(1)
    idf = np.ones(1 << icws_dedup.DF_BITS, np.float32)
    texts = [icws_dedup._weights(rng.integers(0, 9, n).astype(np.int64), idf)
             for n in rng.integers(1, 60, 20)]
    got = icws_dedup.block_similarity(texts[:12], texts[6:])
    want = np.array([[icws_dedup._jaccard(a, b) for b in texts[6:]] for a in texts[:12]])
    assert np.allclose(got, want)


def test_cover_search_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((700, 8)).astype(float)
    x[100:160] = x[0]  # copies: ties
    rows = [(int(i), [float(v) for v in r]) for i, r in enumerate(x)]
    rows += [(1000, None), (1050, [1.0, None] + [0.0] * 6), (1100, [float("nan")] * 8),
             (1150, [float("inf")] + [0.0] * 7), (1200, [1.0, 2.0]), (None, [0.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = collections.defaultdict(list)
    for r in cover_search.search(df).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    v = np.floor(256 * x).astype(np.int64)
    for q in range(0, 700, 50):
        s = v @ v[q]
        order = sorted((i for i in range(700) if i != q), key=lambda i: (-s[i], i))[:5]
        assert got[q] == [(i, s[i]) for i in order]
    assert set(got) == set(range(0, 700, 50))
    assert cover_search.search(df.limit(0)).count() == 0


def test_lm_base_scores_and_probability(spark):
    rows = [(i, t, "k", "c") for i, t in enumerate(
        ["The cat sat", "the CAT\tran far away", "", None, "é ü the", "dog " * 700] * 5)]
    got = lm_mix.score(spark.createDataFrame(rows, DOCS)).collect()
    import zlib
    tokens = {i: [*re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower()), None]
              for i, t, _, _ in rows}
    c = collections.Counter()
    for i, w in tokens.items():
        if zlib.crc32(str(i).encode()) % 5 != 1:
            c.update(w)
    n, v = sum(c.values()), len(c)
    assert len(got) == len(rows)
    for r in got:
        w = tokens[r["doc_id"]]
        base = sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        assert abs(base - r["base_score"]) < 1e-6 * abs(base)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (
            len(w), sum(c[x] > 0 for x in w), n)
        assert r["score"] < 0 and r["bits_per_byte"] > 0
    assert lm_mix.score(spark.createDataFrame(rows, DOCS).limit(0)).count() == 0


def test_lm_tables_hold_every_training_text(spark):
    """Texts that teach the gate are counted like the others, to their last word."""
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("abcdefghij") for _ in range(n))
    rows = []
    for i in range(60):
        own = word(24)
        rows.append((i, " ".join([word(3) for _ in range(1100)] + [own] * 900), "k", "c"))
    got = lm_mix.score(spark.createDataFrame(rows, DOCS)).collect()
    bits = [r["bits_per_byte"] for r in got if not r["held_out"]]
    assert max(bits) < 1.2 * min(bits)


def test_lm_gate_learns_in_tasks(spark):
    """The weights depend on all words and not on how tasks share them, and lower the loss."""
    rng = random.Random(4)
    words = ["".join(rng.choice("abcd") for _ in range(rng.randint(1, 6))) for _ in range(900)]
    rows = [(w.encode(), n + 1) for n, w in enumerate(sorted(set(words)))]
    df = spark.createDataFrame(rows, "w binary, n bigint")
    code = lm_mix.Code(lm_mix.byte_counts(df))
    models = [lm_mix.Model(code, *lm_mix.bit_tables(df.where("n % 2 = 0"), code))
              for _ in range(2)]
    start = models[0].weights.copy()
    lm_mix.learn(df.where("n % 2 = 1").repartition(1), models[0])
    lm_mix.learn(df.where("n % 2 = 1").repartition(7), models[1])
    assert np.allclose(models[0].weights, models[1].weights, atol=1e-3)
    rest = [r for r in rows if r[1] % 2]

    def loss(weights):
        bit, x, gate, cut = models[0].inputs(*lm_mix._joined_words([w for w, _ in rest]))
        n = np.repeat([n for _, n in rest], np.diff(cut))
        z = np.einsum("ij,ij->i", weights[gate], x)
        return (n * (np.logaddexp(0, z) - bit * z)).sum()

    assert loss(models[0].weights) < loss(start)


def test_lm_bits_are_a_distribution():
    """The two values of a bit have probabilities that add up to one, whatever came before."""
    rng = np.random.default_rng(0)
    dot, far, bit = rng.normal(0, 2, 50), rng.normal(0, 2, 50), rng.integers(0, 2, 50)
    places = np.zeros((lm_mix.SEGMENT, 1), np.int32)
    places[:50, 0] = np.arange(50)
    run = lambda b: lm_mix.mixed(dot, far, b, places, np.array([0]), np.array([50]), 1)[0]
    head = lm_mix.mixed(dot, far, bit, places, np.array([0]), np.array([49]), 1)[0]
    other = bit.copy()
    other[49] = 1 - bit[49]
    assert abs(2 ** (run(bit) - head) + 2 ** (run(other) - head) - 1) < 1e-4


def _labelled(spark, bad):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    rows, labels = [], []
    for i in range(300):
        w = [word() for _ in range(rng.randint(10, 90))]
        y = int(i % 3 == 0)
        w = bad(w, rng) if y else w
        rows.append((i, " ".join(w), "k", "c"))
        labels.append((i, y))
    rows += [(900, None, "k", "c"), (901, "", "k", "c"), (0, rows[0][1], "k", "c")]
    labels += [(1, None), (None, 1)]
    return (spark.createDataFrame(rows, DOCS),
            spark.createDataFrame(labels, "doc_id bigint, toxic int").withColumn(
                "quality", F.col("toxic")), dict(labels[:300]))


def test_toxicity_learns_and_handles_edges(spark):
    def bad(w, rng):
        for _ in range(3):
            w[rng.randrange(len(w))] = rng.choice(["zzmoron", "zzclown"])
        return w
    docs, labels, y = _labelled(spark, bad)
    net = toxicity.fit(docs, labels)
    got = toxicity.score(docs, net).collect()
    assert len(got) == 303 and all(0 <= r["score"] <= 1 for r in got)
    right = [(r["score"] >= 0.5) == y[r["doc_id"]] for r in got if r["doc_id"] in y]
    assert np.mean(right) > 0.97
    assert toxicity.clean(docs, net).columns == docs.columns
    none = toxicity.fit(docs, labels.limit(0))
    assert toxicity.score(docs, none).count() == 303
    assert toxicity.score(docs.limit(0), net).count() == 0


def test_toxicity_sees_all_windows_of_long_texts():
    """One bad passage anywhere in a long text teaches and calibrates."""
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(3))
    texts, y = [], []
    for i in range(300):
        w = [word() for _ in range(3000)]
        y.append(i % 2)
        if y[-1]:
            at = rng.randrange(2988)
            w[at:at + 12] = [rng.choice(["zzmoron", "zzclown"]) for _ in range(12)]
        texts.append(" ".join(w))
    net = toxicity.train(texts[:225], y[:225])
    right = (net.scores(texts) >= 0.5) == np.array(y)
    assert right[:225].mean() > 0.97 and right[225:].mean() > 0.97


def test_toxicity_gradients():
    """Back-propagation against finite differences."""
    net = toxicity.Network(np.array([1, 2, 3], np.uint64), np.zeros(3, np.float32))
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    rng = np.random.default_rng(0)
    e = rng.standard_normal((4, toxicity.WORD_DIM + toxicity.CHAR_DIM))
    ids = rng.integers(0, 4, (3, 6))
    mask = np.ones((3, 6), bool)
    mask[1, 4:] = False
    y, w = np.array([1.0, 0.0, 1.0]), np.ones(3) / 3

    def loss():
        p = 1 / (1 + np.exp(-net.forward(e @ net.p["in"] + net.p["bias"], ids, mask)))
        return -(w * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum()

    grads, _ = net.gradients(e, e @ net.p["in"] + net.p["bias"], ids, mask, y, w)
    for k, at in (("rec", (0, 1, 2)), ("in", (3, 30)), ("att", (2, 1)), ("out", (1,)),
                  ("bias", (20,))):
        old = net.p[k][at]
        net.p[k][at] = old + 1e-2
        up = loss()
        net.p[k][at] = old - 1e-2
        down = loss()
        net.p[k][at] = old
        assert abs((up - down) / 2e-2 - grads[k][at]) < 2e-3, k


def test_quality_learns_and_handles_edges(spark):
    docs, labels, y = _labelled(spark, lambda w, rng: [w[0]] * len(w))
    model = quality_mil.fit(docs, labels)
    got = quality_mil.score(docs, model).collect()
    assert len(got) == 303 and all(0 <= r["score"] <= 1 for r in got)
    right = [(r["score"] >= 0.5) == y[r["doc_id"]] for r in got if r["doc_id"] in y]
    assert np.mean(right) > 0.97
    assert {r["score"] for r in got if r["doc_id"] in (900, 901)} == {0.0}
    assert quality_mil.score(docs, quality_mil.fit(docs, labels.limit(0))).count() == 303


def test_lm_contexts_reach_across_words(spark):
    """A word is told by the word before it, to the end of a long text."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(400)]
    follow = dict(zip(words, words[1:] + words[:1]))

    def text(chained, n):
        out = [rng.choice(words)]
        while len(out) < n:
            out.append(follow[out[-1]] if chained else rng.choice(words))
        return " ".join(out)

    rows = [(i, text(True, 300), "k", "c") for i in range(100)]
    rows += [(1000 + i, text(i % 2 == 0, 300), "k", "c") for i in range(60)]
    got = {r["doc_id"]: r for r in lm_mix.score(spark.createDataFrame(rows, DOCS)).collect()
           if r["held_out"]}
    mean = lambda ids: sum(got[i]["bits_per_byte"] for i in ids) / len(ids)
    chained = [i for i in got if i < 1000 or i % 2 == 0]
    loose = [i for i in got if i >= 1000 and i % 2]
    assert mean(chained) < 0.5 * mean(loose)
    assert all(got[i]["score"] > got[i]["base_score"] for i in chained)


def test_lm_text_scores_alike_in_any_part(spark, monkeypatch):
    """What a text has learned goes with it from one part to the next, and neighbours in a
    batch leave its score as it is."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(rng.randint(1, 5)))
    texts = [" ".join(word() for _ in range(n)).encode() for n in (1, 900, 3000, 0, 40)]
    known = lm_mix.Words(texts[1:3])
    keys, at, c = np.unique(known.hash, return_index=True, return_counts=True)
    vocabulary = lm_mix.Vocabulary(keys[::2], c[::2], c[::2] // 5, int(c.sum()), 3)
    r = np.random.default_rng(1)
    speller = lm_mix.Model(lm_mix.Code(np.ones(257)),
                           r.integers(-900, 900, lm_mix._BASE[-1]).astype(np.int16),
                           r.integers(0, 4, lm_mix._BASE[-1]).astype(np.uint8))
    model = lm_mix.TextModel(vocabulary, vocabulary.code.logits[1], r.integers(
        -4000, 4000, lm_mix._WORD_BASE[-1]).astype(np.int16), speller)

    def scores(part):
        w = lm_mix.Words(part)
        return model.log2(w, vocabulary.numbers(w.hash), len(part))

    whole = scores(texts)
    assert np.allclose(whole, np.concatenate([scores([t]) for t in texts]), rtol=1e-4)
    # Longer texts end a step early at places of their own.
    monkeypatch.setattr(lm_mix, "PART", 700)
    cut = scores(texts)
    assert np.allclose(whole, cut, rtol=2e-2)
    assert np.allclose(cut, np.concatenate([scores([t]) for t in texts]), rtol=1e-4)


def test_lm_groups_and_lanes_stay_small():
    """A large batch is cut where a group is full, and a bit waits for its turn in nine bytes."""
    import pyarrow as pa

    batches = [pa.RecordBatch.from_pydict({"t": pa.array([b"x" * n] * k, pa.binary())})
               for n, k in ((10, 95), (0, 0), (10, 7), (900, 1), (0, 3))]
    groups = [[t for b in g for t in b.column("t").to_pylist()]
              for g in lm_mix.grouped(batches, "t", 100)]
    assert [len(g) for g in groups] == [10] * 10 + [3, 3]
    assert [t for g in groups for t in g] == [t for b in batches for t in b["t"].to_pylist()]

    words = lm_mix.Words([b"a b c " * 1000])
    keys, at, c = np.unique(words.hash, return_index=True, return_counts=True)
    vocabulary = lm_mix.Vocabulary(keys, c, 0 * c, int(c.sum()), 0)
    model = lm_mix.TextModel(vocabulary, vocabulary.code.logits[1],
                             np.zeros(lm_mix._WORD_BASE[-1], np.int16), None)
    xs, bit, _, size = model.mixable(vocabulary.numbers(words.hash), words.before(), words.doc, 1)
    assert sum(x.nbytes for x in [*xs, bit]) <= 9 * (size.sum() + lm_mix.STEP)
