"""Piece codec: against a library's Viterbi with the same scores, chunked against whole,
exact round trips."""

import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import piece_codec as P

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def vocabulary():
    return P.Vocabulary.load(public_tokenizers.path("piece_bpe_32k.model"))


def _varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def _field(no, body):
    return _varint(no << 3 | 2) + _varint(len(body)) + body


@pytest.fixture(scope="module")
def library(vocabulary):
    """The same pieces with our whole-number scores, read as a unigram model."""
    import sentencepiece
    v = vocabulary
    score = {}
    for node in np.flatnonzero(v.piece_at >= 0):
        score[int(v.piece_at[node])] = int(v.score_at[node])
    model = b""
    for i, p in enumerate(v.pieces):
        kind = 2 if i == 0 else 3 if i in v.control else 6 if i in v.byte_of else 1
        model += _field(1, _field(1, p.encode()) + b"\x15" + struct.pack("<f", score.get(i, 0.0))
                        + b"\x18" + _varint(kind))
    model += _field(2, b"\x18\x01" + _varint(35 << 3) + b"\x01")  # unigram, byte fallback
    model += _field(3, _field(1, b"identity") + b"\x18\x01\x20\x00\x28\x01")
    return sentencepiece.SentencePieceProcessor(model_proto=model)


TEXTS = ["Hello world", "  two  spaces   here ", "Éçeau mentelle\nde la", "x", " ", "\t\r\n",
         "日本語テキスト", "emoji 🎉🎉 end", "aaaaaaaaaaaaaaaaaaaaaaaa", "the the the",
         "don't stop; (really) 3.14159", " nbsp"]


def test_best_paths_equal_the_librarys(vocabulary, library):
    rng = random.Random(3)
    texts = TEXTS + ["".join(rng.choice("abcdeénst  \n.") for _ in range(rng.randint(1, 60)))
                     for _ in range(200)]
    ours = P.encode_batch(vocabulary, texts)
    for t, ids in zip(texts, ours):
        assert ids.tolist() == library.encode(t), t


def test_round_trip_and_empty(vocabulary):
    texts = [*TEXTS, "", "literal ▁ block", "▁", "\ufffe end "]
    for t, ids in zip(texts, P.encode_batch(vocabulary, texts)):
        assert P.decode_one(vocabulary, ids.tolist()) == t


@pytest.mark.parametrize("text", [
    "word " * 40, "abcdefghij" * 30, "no spaces" + "x" * 90 + " tail", "é日" * 50, "a " * 100])
@pytest.mark.parametrize("size", [7, 16, 33])
def test_chunks_combine_to_the_whole(vocabulary, text, size):
    v, m = vocabulary, P.SPACE + P.marked(text)
    parts = [(m[a:a + size + v.longest - 1], min(size, len(m) - a))
             for a in range(0, len(m), size)]
    mats = [P.transfer(v, t, n) for t, n in parts]
    states = P.border_states(mats)
    ids = np.concatenate([P.traced(v, t, n, states[k], states[k + 1])
                          for k, (t, n) in enumerate(parts)])
    total = mats[0]
    for x in mats[1:]:
        total = P.combine(total, x)
    whole, own = P.words_best(v, P._UNIT.findall(m))
    assert total[0, 0] == whole.sum()
    left = P.combine(P.combine(mats[0], mats[1]), mats[2])
    assert np.array_equal(left, P.combine(mats[0], P.combine(mats[1], mats[2])))
    assert P.decode_one(v, ids.tolist()) == text
    score = {int(v.piece_at[n]): int(v.score_at[n]) for n in np.flatnonzero(v.piece_at >= 0)}
    plain = np.concatenate(own)
    value = lambda x: sum(score.get(int(i), 0) for i in x)
    if not set(ids.tolist()) & set(v.byte_of):
        assert value(ids) == value(plain)


def test_tables(spark, vocabulary):
    rows = [(1, "plain words", "x"), (2, None, "x"), (3, "", None), (3, "", None),
            (4, "giant text é " * 300, "y"), (5, "nospace" * 300, "y")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, piece_ids string")
    out = P.decode(P.encode(df, vocabulary, chunk=256), vocabulary, "piece_ids_")
    got = {(r.doc_id, r.piece_ids): r for r in out.collect()}
    assert out.count() == 6 and out.columns == ["doc_id", "text", "piece_ids", "piece_ids_",
                                                "decoded"]
    for r in got.values():
        assert r.decoded == (r.text or "")
        assert r.piece_ids_ == P.encode_batch(vocabulary, [r.text or ""])[0].tolist()
    assert P.encode(df.where(F.lit(False)), vocabulary).count() == 0


def test_solutions_are_kept_in_flat_arrays(vocabulary, monkeypatch):
    """Words keep their number, are solved once, and neither a full nor a half done memory is
    used again."""
    texts = ["the cat sat on the mat", "a ▁ literal\x00 日本 x", "", "the mat again " * 5]
    first = P.encode_batch(vocabulary, texts)
    known = P.solutions(vocabulary)
    solved = known.solved
    again = P.encode_batch(vocabulary, texts[::-1])[::-1]
    assert P.solutions(vocabulary) is known and known.solved == solved
    assert all(np.array_equal(a, b) for a, b in zip(first, again))
    words = ["▁the", "▁mat", "▁the", "▁日本"]
    totals, ids = P.words_best(vocabulary, words)
    assert totals[0] == totals[2] and np.array_equal(ids[0], ids[2])
    for w, x in zip(words, ids):
        assert P.decode_one(vocabulary, x) == w[1:]
    known.number["left by a task that failed"]
    assert P.solutions(vocabulary) is not known
    monkeypatch.setattr(P, "REMEMBERED", 3)
    monkeypatch.setattr(P, "TOGETHER", 8)
    for t, ids in zip(texts, [P.encode_batch(vocabulary, [t])[0] for t in texts]):
        assert P.decode_one(vocabulary, ids) == t
    assert all(np.array_equal(a, b) for a, b in zip(first, P.encode_batch(vocabulary, texts)))
