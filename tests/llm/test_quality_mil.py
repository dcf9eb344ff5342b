"""Passage features and scores against a plain Python version."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from fulcrum.llm import quality_mil as Q

BLANK = " \t\n\x0b\x0c\r"
CLASSES = [" \t\x0b\x0c\r\n", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".,;:'\"-()",
           "#*$%&|<>@^~=+/\\{}[]_`", "!?"]


def byte_class(b):
    for k, chars in enumerate(CLASSES):
        if b < 128 and chr(b) in chars:
            return k
    return 9 if 0x80 <= b < 0xC0 else 8 if b >= 0xC0 else 7


def plain_passages(text):
    """Feature rows of one text, word by word."""
    raw = (text or "").encode()
    words, at = [], 0  # (begin, bytes)
    while at < len(raw):
        if chr(raw[at]) in BLANK:
            at += 1
            continue
        end = at
        while end < len(raw) and chr(raw[end]) not in BLANK:
            end += 1
        words.append((at, raw[at:end]))
        at = end
    seen, again = set(), []
    for i in range(len(words)):
        pair = (words[i - 1][1], words[i][1]) if i else None
        again.append(pair in seen)
        seen.add(pair if pair else object())
    out = []
    n = max(1, -(-len(words) // Q.PASSAGE))
    for p in range(n):
        mine = words[p * Q.PASSAGE:(p + 1) * Q.PASSAGE]
        begin = 0 if p == 0 else mine[0][0]
        end = len(raw) if p == n - 1 else words[(p + 1) * Q.PASSAGE][0]
        own = raw[begin:end]
        counts = [0] * Q.N_CLASSES
        for b in own:
            counts[byte_class(b)] += 1
        k, size = max(len(mine), 1), len(mine)
        share = lambda f: sum(1 for _, w in mine if f(w)) / k
        solid = max(sum(counts[1:]) - counts[9], 1)
        out.append([c / max(len(own), 1) for c in counts] + [
            solid / k / 10, share(lambda w: len(w) <= 2), share(lambda w: len(w) > 14), share(lambda w: byte_class(w[-1]) == 4),
            share(lambda w: byte_class(w[-1]) in (5, 6)), share(lambda w: len(w) == 1), own.count(b"\n") / k,
            (size - len({w for _, w in mine})) / k, sum(again[p * Q.PASSAGE:(p + 1) * Q.PASSAGE]) / k, math.log1p(size) / 4])
    return out


def plain_score(rows, w):
    """Gated attention over a text's passages, one number at a time."""
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    col = lambda m: [list(c) for c in zip(*m)]
    hidden, scores = [], []
    for x in rows:
        z = [min(max((v - m) / s, -Q.CLIP), Q.CLIP) for v, m, s in zip(x, w["mean"], w["scale"])]
        h = [max(dot(z, c) + b, 0) for c, b in zip(col(w["W"]), w["b"])]
        gate = [math.tanh(dot(h, v)) / (1 + math.exp(-min(max(dot(h, u), -30), 30))) for v, u in zip(col(w["V"]), col(w["U"]))]
        hidden.append(h)
        scores.append(dot(gate, w["w"]))
    top = max(scores)
    e = [math.exp(s - top) for s in scores]
    bag = [sum(a * h[j] for a, h in zip(e, hidden)) / sum(e) for j in range(len(hidden[0]))]
    return 1 / (1 + math.exp(-min(max(dot(bag, w["c"]) + w["c0"][0], -30), 30)))


def texts():
    rng = random.Random(4)
    parts = ["word", "Word", "é名", "a", "12", "x" * 20, "end.", "what?!", "#tag", "re-do", "\n", "\x00"]
    out = [None, "", " \n ", "one"]
    for _ in range(40):
        out.append("".join(rng.choice(parts) + rng.choice([" ", " ", "  ", "\n", "\t"]) for _ in range(rng.randint(0, 230))))
    return out


def test_features_and_scores():
    rows = [plain_passages(t) for t in texts()]
    x, first = Q.encode_passages(pa.array(texts()))
    assert np.diff(first).tolist() == [len(r) for r in rows]
    assert np.abs(x - np.array([f for r in rows for f in r])).max() < 1e-12
    net = Q.GatedAttention.start(np.random.default_rng(1))
    net.w["mean"], net.w["scale"] = x.mean(axis=0), x.std(axis=0) + 1e-3
    got = net.forward(x, first)["p"]
    want = [plain_score(r, {k: v.tolist() for k, v in net.w.items()}) for r in rows]
    assert np.abs(got - want).max() < 1e-9


def test_scores_of_a_table(spark, make_docs):
    docs = make_docs(texts())
    labels = spark.createDataFrame([(i, i % 2) for i in range(44)], "doc_id long, quality int")
    net = Q.train(docs, labels)
    weights = {k: v.tolist() for k, v in net.w.items()}
    got = {r.doc_id: r.score for r in Q.score(docs, net).collect()}
    for i, t in enumerate(texts()):
        assert got[i] == pytest.approx(plain_score(plain_passages(t), weights), abs=1e-9)


def test_a_hot_id_is_one_training_row(spark, make_docs, monkeypatch):
    """Rows that share a labelled id collapse in Spark; the sample is the hash order's first ids, whatever their rows."""
    base = [f"text number {i} with words enough" for i in range(30)]
    once = make_docs(base)
    hot = make_docs(base + [base[3] + " more"] * 300, ids=[*range(30), *[3] * 300])
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, quality int")
    seen = []
    real = Q.GatedAttention.fit.__func__
    monkeypatch.setattr(Q.GatedAttention, "fit", classmethod(lambda cls, x, first, y: seen.append((x, first, y)) or real(cls, x, first, y)))
    for docs in (once, hot):
        Q.train(docs, labels, most=20)
    (x1, f1, y1), (x2, f2, y2) = seen
    assert len(y1) == 20 and (x1 == x2).all() and (f1 == f2).all() and (y1 == y2).all()


def test_long_texts_train_on_a_bounded_sample(spark, make_docs, monkeypatch):
    monkeypatch.setattr(Q, "TRAIN_PASSAGES", 8)
    long = " ".join(f"w{i}" for i in range(200_000))
    labels = spark.createDataFrame([(0, 1), (1, 0)], "doc_id long, quality int")
    net = Q.train(make_docs([long, "short text"]), labels)
    row = {r.doc_id: r.passages for r in Q.score(make_docs([long, "short text"]), net).collect()}
    assert row == {0: 4000, 1: 1}  # scoring reads all
