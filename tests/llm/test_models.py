"""Quality scores: gradients, learning, odd inputs.  Piece encoding against the library."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from sentencepiece import SentencePieceProcessor

from fulcrum.llm import quality_mil as Q
from fulcrum.llm import sentencepieces as S

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def test_gradients():
    rng = np.random.default_rng(0)
    net = Q.GatedAttention.start(rng)
    first = np.array([0, 3, 4, 9])
    x, y, weight = rng.normal(size=(9, Q.FEATURES)), np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 0.5])

    def loss():
        p = net.forward(x, first)["p"]
        return -(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / weight.sum()

    g = net.gradients(net.forward(x, first), y, weight)
    for name in ("W", "b", "V", "U", "w", "c", "c0"):
        flat, at = net.w[name].reshape(-1), rng.integers(net.w[name].size)
        old = flat[at]
        flat[at] = old + 1e-6
        up = loss()
        flat[at] = old - 1e-6
        down = loss()
        flat[at] = old
        assert (up - down) / 2e-6 == pytest.approx(np.asarray(g[name]).reshape(-1)[at], rel=1e-3, abs=1e-7)


def test_passages_cover_the_whole_text():
    texts = ["w " * 120, "", None, "one", "a\nb", "é " * 51]
    x, first = Q.encode_passages(pa.array(texts))
    assert np.diff(first).tolist() == [3, 1, 1, 1, 1, 2] and x.shape == (9, Q.FEATURES)
    alone = [Q.encode_passages(pa.array([t], pa.string()))[0] for t in texts]
    assert np.allclose(np.concatenate(alone), x)


def test_learns_and_scores(spark, make_docs):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8)))
    good = [" ".join(word() for _ in range(rng.randint(30, 200))) + "." for _ in range(150)]
    bad = [" ".join((word().upper() + "!!") if rng.random() < 0.5 else word() + "###" for _ in range(rng.randint(30, 200))) for _ in range(150)]
    odd = [None, "", "  ", good[0], good[0]]
    docs = make_docs(good + bad + odd).selectExpr("*", "1 AS score", "2 AS _y")
    rows = [(i, int(i < 150), 0) for i in range(300) if i % 3] + [(1, 0, 0), (9999, 1, 0), (None, 1, 0), (2, None, 0)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    net = Q.train(docs, labels)
    got = {r.doc_id: r.score for r in Q.score(docs, net).collect()}
    assert len(got) == 305 and all(0 <= s <= 1 for s in got.values())
    held = [(got[i] >= 0.5) == (i < 150) for i in range(0, 300, 3)]
    assert np.mean(held) >= 0.97
    assert got[303] == got[304] == got[0] and got[300] == got[301]


def test_without_labels(spark, make_docs):
    docs = make_docs(["a", None])
    net = Q.train(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r.score for r in Q.score(docs, net).collect()} == {0.5}
    assert Q.score(make_docs([]), net).count() == 0


def random_texts(n, alphabet, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def test_ids_are_the_librarys():
    model, library = S.PieceModel(MODEL), SentencePieceProcessor(model_file=MODEL)
    texts = random_texts(4000, "ab  ▁\n\tétheING1234.,!中文ﬁ😀\u0301x_") + ["x" * 3000, " lead", "a  b\n c ", "<s> </s> <0x0A> <unk>", "\n\n"]
    assert model.encode(pa.array(texts)).to_pylist() == library.encode(texts)


def test_unigram_rule_is_the_best_sum():
    """With every pair admissible the pass is plain Viterbi: the best sum over all segmentations."""
    model = S.PieceModel(MODEL, unigram=True)

    def best(text):
        table = [0.0] + [None] * len(text)
        for end in range(1, len(text) + 1):
            table[end] = max(table[a] + model.score[text[a:end]] for a in range(end) if text[a:end] in model.score and table[a] is not None)
        return table[-1]

    for t in random_texts(300, "abcdefthe▁ing"):
        if t:
            ids = model.viterbi(t)
            pieces = [model.pieces[i] for i in ids]
            assert "".join(pieces) == t and sum(model.score[p] for p in pieces) == pytest.approx(best(t))


def test_a_small_table_changes_nothing(monkeypatch):
    model, library = S.PieceModel(MODEL), SentencePieceProcessor(model_file=MODEL)
    monkeypatch.setattr(model.table, "most", 10)
    monkeypatch.setattr(S, "CACHE_PAIRS", 10)
    for seed in range(6):
        texts = random_texts(100, "the ing\nso", seed)
        assert model.encode(pa.array(texts)).to_pylist() == library.encode(texts)


def test_round_trip(make_docs):
    library = SentencePieceProcessor(model_file=MODEL)
    texts = [None, "", " ", "plain text\n\n and  more ", "é中😀\x00\x85", "y" * 4000, "with ▁ mark", "same", "same"]
    docs = make_docs(texts).selectExpr("*", "1 AS piece_ids", "2 AS round_trip")
    rows = {r.doc_id: r for r in S.encode_checked(docs, MODEL).collect()}
    for i, t in enumerate(texts):
        ids = library.encode(t or "")
        assert rows[i].piece_ids == ids and rows[i].n_pieces == len(ids)
        assert rows[i].ids_crc32 == zlib.crc32(np.array(ids, "<i4").tobytes())
        assert rows[i].round_trip == ("▁" not in (t or ""))
    back = S.decode(S.encode(make_docs(texts), MODEL), MODEL)
    assert {r.doc_id: r.decoded for r in back.collect()} == {i: (t or "").replace("▁", " ") for i, t in enumerate(texts)}
    assert S.encode_checked(make_docs([]), MODEL).count() == 0
