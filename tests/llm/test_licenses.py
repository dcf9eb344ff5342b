"""Licence scans against plain regular expressions and a recursive-descent evaluation."""

import random
import re

import pytest

from fulcrum.llm import licenses as L
from fulcrum.llm import queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def places_of(words, phrases):
    out = []
    for phrase in phrases:
        parts = phrase.split()
        out += [(i, phrase) for i in range(len(words)) if words[i:i + len(parts)] == parts]
    return out


def parse(tokens):
    """(score, text) of a sound expression, by recursive descent; labels of its licences."""
    labels = set()

    def operand(at):
        if tokens[at] == "(":
            value, at = either(at + 1)
            assert tokens[at] == ")"
            return value, at + 1
        token = tokens[at]
        labels.add(token.label)
        value = (L.FAMILIES[token.label], token.text)
        if at + 1 < len(tokens) and tokens[at + 1] == "with":
            known = tokens[at + 2].exception
            value = (min(value[0], L.WEAK) if known else value[0], f"({value[1]} with {tokens[at + 2].text})")
            return value, at + 3
        return value, at + 1

    def level(at, name, below, pick):
        value, at = below(at)
        while at < len(tokens) and tokens[at] == name:
            more, at = below(at + 1)
            value = (pick(value[0], more[0]), f"({value[1]} {name} {more[1]})")
        return value, at

    def both(at):
        return level(at, "and", operand, max)

    def either(at):
        return level(at, "or", both, min)

    value, at = either(0)
    assert at == len(tokens)
    return value, labels


def made(rng, depth=0):
    if depth > 3 or rng.random() < 0.4:
        one = rng.choice([L.Operand("mit", "mit"), L.Operand("gpl-2.0", "gpl"), L.Operand("foo", "unknown"), L.Operand("cc-by-nc-4.0", "cc-by-nc")])
        if rng.random() < 0.3:
            return [one, "with", rng.choice([L.Operand("classpath-exception-2.0", "classpath-exception-2.0", True), L.Operand("bar", "unknown")])]
        return [one]
    out = made(rng, depth + 1)
    for _ in range(rng.randint(1, 3)):
        more = made(rng, depth + 1)
        out = [*out, rng.choice(["and", "or"]), *(["(", *more, ")"] if rng.random() < 0.5 else more)]
    return ["(", *out, ")"] if rng.random() < 0.3 else out


def test_expressions():
    rng = random.Random(6)
    for _ in range(600):
        tokens = made(rng)
        rpn = L.postfix(tokens)
        value, labels = parse(tokens)
        assert L.evaluate(rpn) == value
        assert {t.label for t in rpn if isinstance(t, L.Operand) and not t.exception} == labels
        # any token soup gives nothing or a value, and never fails
        soup = rng.sample(tokens, len(tokens))[: rng.randint(0, 12)]
        got = L.evaluate(L.postfix(soup))
        assert got is None or 0 <= got[0] <= 1


def test_long_expressions():
    many = [L.Operand("mit", "mit")] + ["and", L.Operand("gpl", "gpl")] * 50_000
    assert L.evaluate(L.postfix(many))[0] == L.STRONG
    assert L.evaluate(L.postfix(["("] * 50_000 + [L.Operand("mit", "mit")]))[0] == L.PERMISSIVE
    nested = ["(", L.Operand("mit", "mit"), "or"] * 20_000 + [L.Operand("gpl", "gpl")]
    assert L.evaluate(L.postfix(nested))[0] == L.PERMISSIVE


@pytest.mark.parametrize("text, expressions, labels, score", [
    ("SPDX-License-Identifier: MIT", "mit", "mit", 0.25),
    ("// spdx-license-identifier: (MIT OR GPL-2.0-only) AND BSD-3-Clause\nmore", "((mit or gpl-2.0-only) and bsd-3-clause)", "bsd,gpl,mit", 0.25),
    ("SPDX-License-Identifier: GPL-2.0-or-later WITH Classpath-exception-2.0 */", "(gpl-2.0-or-later with classpath-exception-2.0)", "gpl", 0.5),
    ("SPDX-License-Identifier: GPL-2.0 WITH nonsense", "(gpl-2.0 with nonsense)", "gpl", 0.75),
    ("License-Expression: Foo-1.0 AND", "foo-1.0", "unknown", 0.5),
    ("SPDX-License-Identifier:\nMIT", "", "", 0.0),
    ("Licensed under the MIT License or the Apache License, Version 2.0.", "(mit or apache)", "apache,mit", 0.25),
    ("the MIT License. Nothing here. GNU General Public License", "mit; gpl", "gpl,mit", 0.75),
    ("GNU General Public License with the classpath exception", "(gpl with classpath)", "gpl", 0.5),
    ("GNU Lesser General Public License", "lgpl", "gpl,lgpl", 0.5),
    ("Licensed under CC BY-NC 4.0.", "cc-by-nc", "cc-by,cc-by-nc", 1.0),
    ("all rights reserved", "proprietary", "proprietary", 1.0),
    ("émit license, mit licenseé, classpath exception", "", "", 0.0),
    ("", "", "", 0.0), (None, "", "", 0.0),
])
def test_cases(make_docs, text, expressions, labels, score):
    row = L.report(L.scan(make_docs([text]))).first()
    assert (row.expressions, row.labels, row.score) == (expressions, labels, score)


def check_rows(rows, texts):
    phrases = [*L.BASE_PHRASES, *L.NOTICES]
    for r in rows:
        words = words_of(texts[r.doc_id])
        base = places_of(words, L.BASE_PHRASES)
        assert r.n_words == len(words) and r.n_base == len(base)
        assert (r.first_word, r.last_word) == ((min(base)[0], max(base)[0]) if base else (None, None))
        assert r.base_labels == ",".join(sorted({L.BASE_PHRASES[p] for _, p in base}))
        named = {{**L.NOTICES, **L.BASE_PHRASES}[p] for _, p in places_of(words, phrases)}
        if not places_of(words, L.TAGS):
            assert r.labels == ",".join(sorted(named))
            assert r.score <= max([L.FAMILIES[x] for x in named], default=0.0)
            assert (r.score > 0) == bool(named)


def test_against_regular_expressions(make_docs):
    rng = random.Random(9)
    parts = ["MIT", "mit license", "License", "general public", "General Public License", "apache", "Apache-License", "é", "0", "\n",
             "\x00", "-", "or", "and", "with", "the", "GNU", "cc by", "nc", "All rights", "reserved", "名", "mit mit license mit license"]
    texts = [None, "", "x", *["".join(rng.choice(parts) + rng.choice([" ", " ", "-", "", "\t"]) for _ in range(rng.randint(1, 40))) for _ in range(300)]]
    texts.append(" ".join(rng.choice(["mit license", "filler", "words"]) for _ in range(400_000)))  # some MB in one text
    check_rows(L.report(L.scan(make_docs(texts))).collect(), texts)


def test_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    rows = queries.QUERIES["op11_licenses"](spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(docs)
    check_rows(rows, {d.doc_id: d.text for d in docs})
    assert any(r.labels for r in rows)


def test_odd_tables(spark, make_docs):
    assert L.report(L.scan(make_docs([]))).collect() == []
    odd = spark.createDataFrame([(1, "the mit license", "x", 3, 4.0)] * 3 + [(None, None, None, None, None)],
                                "doc_id int, text string, labels string, n_words int, places double")
    rows = L.report(L.scan(odd)).collect()
    assert sorted((r.doc_id or 0, r.n_base, r.first_word, r.labels) for r in rows) == [(0, 0, None, "")] + [(1, 1, 1, "mit")] * 3
