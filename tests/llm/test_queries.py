"""The registered queries: SQL where there is some, and the pipeline stage by stage."""

import glob
import os
import re

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from fulcrum.llm import oracle, queries
from tests.llm.test_near_duplicates import classes
from tests.llm.test_quality_rules import measure
from tests.llm.test_secrets import spans_of

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    names = set(__spark_entry__.queries())
    assert set(queries.QUERIES) | {"pipeline"} <= names and set(oracle.QUERIES_SQL) <= set(__spark_entry__.oracle_sql())
    assert sorted(int(m[1]) for n in queries.QUERIES if (m := re.match(r"op(\d+)_", n))) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(oracle.QUERIES_SQL))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    want = con.execute(oracle.QUERIES_SQL[name])
    columns = sorted(c[0] for c in want.description)
    want = [tuple(dict(zip([c[0] for c in want.description], r))[c] for c in columns) for r in want.fetchall()]
    got = queries.QUERIES[name](spark, SF)
    assert sorted(got.columns) == columns
    got = [tuple(r) for r in got.select(*columns).collect()]
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(oracle.QUERIES_SQL)))
def test_runs_whole(spark, name):
    op = name.split("_")[0]
    table = {"op1": "embeddings", "op7": "pages", "op12": "embeddings"}.get(op, "documents")
    rows = spark.read.parquet(f"{SF}/{table}.parquet").count()
    got = queries.QUERIES[name](spark, SF).count()
    assert got == {"op1": rows // 20 * 20, "op12": 8 * rows}.get(op, rows)


def test_stages(spark, scratch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    done = [docs]
    for name, stage in corpus_pipeline.STAGES:
        done.append(scratch.write(stage(spark, done[-1], SF), name.replace(" ", "-")))
    for df in done[1:-1]:
        assert df.columns == docs.columns
    rows = [{r.doc_id: r for r in df.collect()} for df in done]
    raw, good, single, clean, mixed, coded = rows
    for i, r in raw.items():
        m = measure(r.text)
        words = m["n_words"]
        rejected = (words < 10 or 100 * m["n_repeat_words"] > 20 * words or 100 * m["n_symbols"] > 30 * words
                    or 100 * m["n_dup_lines"] > 40 * m["n_lines"] or 100 * m["n_upper"] > 40 * m["word_chars"]
                    or not 2 * words <= m["word_chars"] <= 14 * words)
        assert (i in good) == (not rejected)
    ids = sorted(good)
    assert set(single) == set(classes(ids, [good[i].text for i in ids]))
    assert set(clean) == set(single)
    for i, r in clean.items():
        found = spans_of(single[i].text)
        assert (r.text == single[i].text) == (not found) and not spans_of(r.text)
    assert set(mixed) <= set(clean) and all(mixed[i].text == clean[i].text for i in mixed)
    assert set(coded) == set(mixed) and all(r.round_trip for r in coded.values())
    assert done[5].count() == done[4].count()
    want = sorted(tuple(r) for r in done[5].select("doc_id", "n_pieces").collect())
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, SF).select("doc_id", "n_pieces").collect()) == want


def test_stages_on_odd_tables(spark, make_docs, scratch):
    text = "enough different words to pass every rule that the policy holds here"
    for docs in (make_docs([]), make_docs([None, "", text, text, text + " token = abcdefghijklmnop"], ids=[1, 2, 3, 3, None],
                                          sources=[None, "a", "a", "a", "b"])):
        for name, stage in corpus_pipeline.STAGES:
            docs = scratch.write(stage(spark, docs, SF), name.replace(" ", "-"))
        docs.collect()
