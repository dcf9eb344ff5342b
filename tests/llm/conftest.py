import pytest

from fulcrum.llm.scratch import Scratch

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def scratch(spark):
    s = Scratch(spark)
    yield s
    s.drop()


@pytest.fixture()
def make_docs(spark):
    def make(texts, ids=None, sources=None):
        ids = ids if ids is not None else list(range(len(texts)))
        sources = sources if sources is not None else ["src0"] * len(texts)
        rows = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in zip(ids, texts, sources)]
        return spark.createDataFrame(rows, DOC_SCHEMA).repartition(3)

    return make
