"""BagMinHash estimates, components, and near-duplicate classes against all pairs."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from fulcrum.llm import near_duplicates as N
from fulcrum.llm.bagminhash import shingle_counts, signatures
from fulcrum.llm.components import components


def bag(text):
    w = (text or "").split()
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def classes(ids, texts):
    """Smallest doc_id of each row's class, by comparing all pairs of texts."""
    texts = [t or "" for t in texts]
    bags = {t: bag(t) for t in texts}
    parent = {t: t for t in texts}

    def root(t):
        while parent[t] != t:
            t = parent[t]
        return t

    names = list(bags)
    for i, a in enumerate(names):
        for b in names[:i]:
            both = sum((bags[a] & bags[b]).values())
            if both and 9 * both >= 4 * (sum(bags[a].values()) + sum(bags[b].values())):
                parent[root(a)] = root(b)
    least = {}
    for i, t in zip(ids, texts):
        if i is not None:
            least[root(t)] = min(i, least.get(root(t), i))
    return [least.get(root(t)) for t in texts]


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"n{rng.randrange(10**6)}"
    return " ".join(words)


def corpus(rng, families=12, copies=6, length=80):
    texts = []
    for _ in range(families):
        base = [f"w{rng.randrange(10**6)}" for _ in range(length)]
        texts += [" ".join(base)] + [edited(rng, base, rng.randint(0, 4)) for _ in range(copies)]
    texts += [" ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randint(0, 30))) for _ in range(20)]
    return texts + [None, "", " \n", "one", "one", "one two three four", "a  b c\nd e", "a b c d e", "go " * 50, "go " * 60]


def test_signatures_are_unbiased_on_weights():
    rng, errors = np.random.default_rng(1), []
    for t in range(40):
        a = rng.integers(0, 9, 40)
        b = np.where(rng.random(40) < 0.6, a, rng.integers(0, 40, 40))
        text = np.repeat([0, 1], [np.count_nonzero(a), np.count_nonzero(b)])
        element = np.concatenate([np.flatnonzero(a), np.flatnonzero(b)]).astype(np.uint64) + np.uint64(1000 * t)
        s = signatures(text, element, np.concatenate([a[a > 0], b[b > 0]]), 2, 1000)
        errors.append((s[0] == s[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(errors)) < 0.008 and np.std(errors) < 0.03


def test_signature_does_not_depend_on_the_batch():
    texts = ["a b c d e f g h", "x " * 100, "", None, "one", "a b c d e f g h"]
    all_of = signatures(*shingle_counts(pa.array(texts)), len(texts), 125)
    for i, t in enumerate(texts):
        alone = signatures(*shingle_counts(pa.array([t], pa.string())), 1, 125)
        assert (alone[0] == all_of[i]).all()
    assert (all_of[2] == 0xFFFFFFFF).all() and (all_of[0] == all_of[5]).all()


def test_components(spark, scratch):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(500 + i, 501 + i) for i in range(60)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long"), scratch).collect()}
    parent = {x: x for link in links for x in link}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    assert got == {x: root(x) for link in links if link[0] != link[1] for x in link}
    assert components(spark.createDataFrame([], "a long, b long"), scratch).count() == 0


@pytest.mark.parametrize("chunk", [512, 4])
def test_classes(make_docs, scratch, monkeypatch, chunk):
    """With chunks of 4 every family goes through both passes."""
    monkeypatch.setattr(N.connect, "__defaults__", (chunk,))
    rng = random.Random(6)
    texts = corpus(rng)
    ids = rng.sample(range(1000), len(texts))
    ids[3] = None
    got = N.near_duplicates(make_docs(texts, ids), scratch).collect()
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(map(tuple, got), key=key) == sorted(zip(ids, classes(ids, texts)), key=key)


def test_a_large_family_of_unlike_copies(make_docs, scratch, monkeypatch):
    """Copies near 0.8 of each other: links exist across chunks only."""
    monkeypatch.setattr(N.connect, "__defaults__", (8,))
    rng = random.Random(9)
    base = [f"w{i}" for i in range(150)]
    texts = [edited(rng, base, rng.randint(1, 5)) for _ in range(60)]
    got = {r.doc_id: r.class_id for r in N.near_duplicates(make_docs(texts), scratch).collect()}
    assert [got[i] for i in range(60)] == classes(range(60), texts)


def test_keep_one(make_docs, scratch):
    rng = random.Random(7)
    texts = corpus(rng, families=4)
    ids = list(range(len(texts)))
    docs = make_docs(texts + texts[:3], ids + ids[:3]).selectExpr("*", "1 AS class_id", "'x' AS text_key")
    out = N.keep_one(docs, scratch)
    assert out.columns == docs.columns
    want = classes(ids, texts)
    assert sorted(r.doc_id for r in out.collect()) == sorted(set(want))


def test_empty_table(make_docs, scratch):
    assert N.near_duplicates(make_docs([]), scratch).count() == 0
    assert N.keep_one(make_docs([]), scratch).count() == 0


def test_one_text_per_node(spark, make_docs, scratch, monkeypatch):
    """A hot text whose copies all lack a doc_id, or share one, beside an edited copy: a cell gets it once."""
    rng = random.Random(11)
    words = [f"w{rng.randrange(10**6)}" for _ in range(80)]
    more = [f"w{rng.randrange(10**6)}" for _ in range(80)]
    texts = [" ".join(words)] * 60 + [edited(rng, words, 1)] + [" ".join(more)] * 50 + [edited(rng, more, 1)]
    ids = [None] * 60 + [5] + [9] * 50 + [7]
    written, write = {}, scratch.write
    monkeypatch.setattr(scratch, "write", lambda df, name: written.setdefault(name, write(df, name)) if name == "family-texts" else write(df, name))
    got = N.near_duplicates(make_docs(texts, ids), scratch).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.class_id) for r in got) == sorted(
        (i is None, i or 0, c) for i, c in zip(ids, classes(ids, texts)))
    assert written["family-texts"].count() == written["family-texts"].select("_n").distinct().count() == 4


def test_families_of_long_texts_are_dealt_by_their_words(make_docs, scratch, monkeypatch):
    """A handful of long texts is dealt over chunks like many short ones, and no link is lost."""
    monkeypatch.setattr(N, "CHUNK_WORDS", 300)
    rng = random.Random(21)
    base = [f"w{rng.randrange(500)}" for _ in range(400)]
    some = []
    for i in range(14):
        words = list(base)
        for _ in range(4):
            words[rng.randrange(400)] = f"x{i}"
        some.append(" ".join(words))
    some += [" ".join(f"y{rng.randrange(500)}" for _ in range(400)) for _ in range(3)]
    sizes = []
    real = N.group_sizes
    monkeypatch.setattr(N, "group_sizes", lambda members, s: sizes.append(real(members, s)) or sizes[-1])
    got = {r.doc_id: r.class_id for r in N.near_duplicates(make_docs(some), scratch).collect()}
    assert [got[i] for i in range(17)] == classes(list(range(17)), some) and len(set(got.values())) < 17
    assert any((r.w or 0) > 300 for r in sizes[-1].collect())
