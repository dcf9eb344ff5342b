"""Quality rules: measurements against plain Python, policies and ablations against recounts."""

import random
import re

from fulcrum.llm import quality_rules as Q


def measure(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [line for line in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    covered = {p for i, g in enumerate(grams) if grams.count(g) > 1 for p in range(i, i + 5)}
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
        "n_upper": sum(c.isupper() for c in text or ""),
    }


TEXTS = [
    None, "", "   \n\t ", "one", "a b c d e f g h i j", "x " * 40, "same line\nsame line\n \n \nother", "a\x0bb\x0cc\rd e",
    "SHOUT LOUD NOW " * 5 + "and then some quiet words follow here", "### $$$ %%% &&& a | b | c < d > e f g h",
    "w1 w2 w3 w4 w5 w6 w7 w8 w9 w1 w2 w3 w4 w5 q", "éü ñ 中文 ﬁ 😀 word word", "z" * 5000,
]


def random_text(rng):
    return "".join(rng.choice(["a ", "b ", "cc ", "dd\n", "A! ", "# ", "\t", "é "]) for _ in range(rng.randint(0, 60)))


def test_measurements(make_docs):
    rng = random.Random(4)
    texts = TEXTS + [random_text(rng) for _ in range(60)] + TEXTS[:5]
    rows = Q.rule_ledger(make_docs(texts)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = measure(texts[r.doc_id])
        assert {k: r[k] for k in want} == want, texts[r.doc_id]


def test_policies_and_ablations(make_docs):
    rng = random.Random(5)
    ledger = Q.rule_ledger(make_docs(TEXTS + [random_text(rng) for _ in range(80)]))
    rows = Q.apply_policies(ledger).collect()
    place = {r.name: 1 << i for i, r in enumerate(Q.RULES)}
    found = {(r.policy, r.rule): r for r in Q.ablations(ledger).collect()}
    for policy, rules in Q.POLICIES.items():
        mask = sum(place[n] for n in rules)
        assert all(r[f"kept_{policy}"] == (r.failed_bits & mask == 0) for r in rows)
        for name in rules:
            got = found[policy, name]
            assert got.documents == len(rows)
            assert got.rejected == sum(r.failed_bits & mask != 0 for r in rows)
            assert got.only_this_rule == sum(r.failed_bits & mask == place[name] for r in rows)
            assert got.rejected_without == sum(r.failed_bits & mask & ~place[name] != 0 for r in rows)


def test_reject_keeps_columns_and_rows(spark, make_docs):
    good = "plain words that say something new in every part of the text and go on a little"
    docs = make_docs([good, "short", None, good], ids=[1, 2, 3, 1])
    out = Q.reject(docs)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == [1, 1]
    clashing = docs.selectExpr("*", "1 AS _words", "2 AS n_words", "3 AS failed_bits")
    assert Q.reject(clashing).columns == clashing.columns
    assert Q.reject(clashing).count() == 2


def test_empty_table(make_docs):
    docs = make_docs([])
    assert Q.rule_ledger(docs).count() == 0 and Q.reject(docs).count() == 0 and Q.ablations(Q.rule_ledger(docs)).count() == 0
