"""Systematic mixing against a plain Python walk."""

import math
import random
import re
from hashlib import md5

import pytest

from fulcrum.llm import mixing
from fulcrum.llm.scratch import Scratch


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def fill(sizes):
    """Targets by repeated sharing under the caps."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in capped)
        free = sum(weight[s] for s in order if s not in capped)
        target = {s: 3.0 * sizes[s] if s in capped else left / free * weight[s] for s in order}
        over = {s for s in order if s not in capped and target[s] > 3 * sizes[s]}
        if not over:
            return target
        capped |= over


def expected(rows):
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + size_of(text)
    target, out = fill(sizes), []
    for s in sizes:
        shift = int(md5(f"{mixing.SEED}:{'null' if s is None else 's:' + s}".encode()).hexdigest()[:4], 16) / 65536
        each = target[s] / sizes[s] if sizes[s] else 0.0
        docs = sorted(((size_of(t), i is not None, i or 0) for i, t, x in rows if x == s))
        for k, (n, has, i) in enumerate(docs):
            copies = math.floor(shift + each * (k + 1)) - math.floor(shift + each * k)
            out.append((i if has else None, n, sizes[s], copies))
    return target, out


@pytest.mark.parametrize("seed", [1, 2])
def test_against_a_plain_walk(make_docs, scratch, seed):
    rng = random.Random(seed)
    sources = ["hot"] * 60 + ["a", "b", "c", "d", None, "ü"] * 8
    texts = [rng.choice([None, "", "one"]) if rng.random() < 0.1 else "w " * int(rng.paretovariate(0.8)) for _ in sources]
    ids = [None if rng.random() < 0.05 else rng.randrange(1000) for _ in sources]
    rows = list(zip(ids, texts, sources))
    target, want = expected(rows)
    got = mixing.systematic_mix(make_docs(texts, ids, sources), scratch).collect()
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(((r.doc_id, r["size"], r.source_size, r.copies) for r in got), key=key) == sorted(want, key=key)
    for r in got:
        assert r.copies <= 3 and any(r.target == pytest.approx(t) for t in target.values())


def test_taken_words_come_within_one_document(make_docs, scratch):
    rng = random.Random(3)
    sources = [f"s{i % 4}" for i in range(400)]
    texts = ["w " * rng.randint(1, 300) for _ in sources]
    got = mixing.systematic_mix(make_docs(texts, sources=sources), scratch, keep=("source",)).collect()
    for source in set(sources):
        rows = [r for r in got if r.source == source]
        assert abs(sum(r["size"] * r.copies for r in rows) - rows[0].target) <= max(r["size"] for r in rows)


def test_partitions_do_not_matter(spark, make_docs, scratch):
    docs = make_docs(["w " * (i % 17) for i in range(120)], sources=[f"s{i % 5}" for i in range(120)])
    runs = []
    for n in ("1", "5", "16"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        runs.append(sorted(tuple(r) for r in mixing.systematic_mix(docs, scratch).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert runs[0] == runs[1] == runs[2]


def test_copies_are_whole_rows(spark, make_docs):
    docs = make_docs(["a b c", "d", None, "e f"], sources=["x", "y", "x", "y"]).selectExpr("*", "7 AS size", "8 AS copies")
    out = mixing.emit_copies(docs, Scratch(spark))
    assert out.columns == docs.columns
    taken = mixing.systematic_mix(docs, Scratch(spark))
    assert out.count() == sum(r.copies for r in taken.collect())


def test_empty_table_and_sources_without_words(make_docs, scratch):
    assert mixing.systematic_mix(make_docs([]), scratch).count() == 0
    rows = mixing.systematic_mix(make_docs([None, "", " "], sources=["a", None, "b"]), scratch).collect()
    assert [(r.target, r.copies) for r in rows] == [(0.0, 0)] * 3
