"""Collocations against plain counting."""

import random
import re
from collections import Counter

from fulcrum.llm import collocations as C

LOWER = {i: i + 32 for i in range(65, 91)}


def brute(rows, least, longest=4, covered=80, top=2000):
    """rows: (lang, text)."""
    n, f = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i:i + k])] += 1
    often = {key: a for key, a in f.items() if a >= least}
    longer = Counter()
    for (lang, words), a in often.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                part = lang, words[i:i + k]
                longer[part] = max(longer[part], a)
    out = []
    for lang in sorted(n):
        found = []
        for (l2, words), a in often.items():
            if l2 != lang or len(words) < 2 or 100 * longer[lang, words] >= covered * a:
                continue
            score, _, l, r = min((2000000 * a // (f[lang, words[:k]] + f[lang, words[k:]]), k, f[lang, words[:k]], f[lang, words[k:]])
                                 for k in range(1, len(words)))
            found.append((-score, -a, " ".join(words).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return out


def ask(spark, rows, scratch, **options):
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    got = C.collocations(docs, scratch, **options).collect()
    return sorted((tuple(r) for r in got), key=lambda r: (r[0], r[1]))


def made(rng, n):
    words = ["a", "B", "b", "ça", "the", "of", "名前", "🙂", "x-y", "don't", "\x00", "q"]
    marks = [" ", " ", " ", " ", " ", "  ", "\t", ", ", ". ", "\n", "\x0b", ";"]
    return [(rng.choice(["en", "de", None, "und", ""]), "".join(rng.choice(words) + rng.choice(marks) for _ in range(rng.randint(0, 60))))
            for _ in range(n)]


def test_against_counting(spark, scratch):
    rng = random.Random(2)
    rows = made(rng, 250) + [(None, None), ("en", ""), ("fr", None), ("en", " \n.,")] + [("en", "one two three four five")] * 40
    for least, options in ((3, {}), (30, {}), (2, {"block_words": 40}), (4, {"longest": 3, "covered": 50, "top": 20})):
        want = brute(rows, least, **{k: v for k, v in options.items() if k != "block_words"})
        assert len(want) > (3 if least == 30 else 20)
        assert ask(spark, rows, scratch, least=least, **options) == want


def test_overlapping_and_tied(spark, scratch):
    rows = [("en", "a a a a a a a a")] * 10 + [("en", "c d"), ("en", "e f"), ("en", "d c")] * 30
    assert ask(spark, rows, scratch) == brute(rows, 30)


def test_odd_tables(spark, scratch):
    assert ask(spark, [], scratch) == []
    assert ask(spark, [(None, None), ("en", ""), ("en", "few words")], scratch) == []
    odd = spark.createDataFrame([("x y", "en", 1, 2, "z")] * 30, "text string, lang string, id int, block int, word string")
    assert [tuple(r) for r in C.collocations(odd, scratch).collect()] == [("en", 1, "x y", 30, 30, 30, 60, 1000000)]


def test_long_text(spark, scratch):
    """One text of some MB is a block of its own."""
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    text = " ".join(rng.choice(vocabulary) for _ in range(150_000)) + " one two three" * 40_000 + " " + "z" * 1_000_000
    rows = [("en", text), ("en", "one two three"), ("de", "one two three")]
    assert ask(spark, rows, scratch, block_words=1000) == brute(rows, 30)


def test_hot_passage(spark, scratch):
    """A passage that most texts share has a row per block, not per occurrence."""
    rows = [("en", f"u{i} the very same passage in many texts v{i}") for i in range(900)] + [("en", "other words")] * 50
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    _, found = C.phrase_counts(docs, scratch)
    assert [df.where("a = 900").count() for df in found] == [7, 6, 5, 4]
    assert ask(spark, rows, scratch) == brute(rows, 30)
