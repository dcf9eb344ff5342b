"""Words are told apart by their bytes, whatever their hashes."""

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

import corpus_pipeline
from fulcrum.llm import near_duplicates, sentencepieces, token_files, wordhash
from fulcrum.llm.bagminhash import exact_shingles
from fulcrum.llm.scratch import Scratch


def thue_morse(n, a, b):
    """Its mirror image has the same value under any polynomial hash modulo 2^64."""
    return "".join(a if bin(i).count("1") % 2 == 0 else b for i in range(n))


PAIR = thue_morse(1024, "a", "b"), thue_morse(1024, "b", "a")
TEXTS = [*PAIR, f"{PAIR[0]} and {PAIR[1]}", f"{PAIR[1]} and {PAIR[0]}", "plain words", None, ""]


@pytest.fixture(params=["hashed", "one hash for all", "two hashes"])
def hashing(request, monkeypatch):
    if request.param != "hashed":
        n = 1 if request.param.startswith("one") else 2
        monkeypatch.setattr(wordhash, "hashes_of", lambda units: np.arange(len(units), dtype=np.uint64) % np.uint64(n))


def test_unit_table(hashing):
    calls = []

    def encode(units):
        calls.append(len(units))
        return [np.frombuffer(u, np.uint8).astype("<i4").tobytes() for u in units]

    table = wordhash.UnitTable("<i4", encode, most=40)
    rng = np.random.default_rng(1)
    for _ in range(30):
        words = ["".join(rng.choice(list("abé"), rng.integers(1, 5))) for _ in range(rng.integers(0, 30))]
        found = wordhash.words_of(pa.array([" ".join(words)]))
        ids, size = table.ids(found.data, found.start, found.end)
        assert bytes(ids.astype(np.uint8)) == "".join(words).encode()
        assert size.tolist() == [len(w.encode()) for w in words]


def test_token_ids(hashing):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    coder = token_files.PieceEncoder(path, 2)
    for texts in (TEXTS, TEXTS[::-1]):
        got = [np.frombuffer(x, coder.dtype).tolist() for x in coder.encode(pa.array(texts))]
        assert got == [[*library.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]


def test_piece_ids(hashing):
    from sentencepiece import SentencePieceProcessor

    path = public_tokenizers.path("piece_bpe_32k.model")
    library, model = SentencePieceProcessor(model_file=path), sentencepieces.PieceModel(path)
    for texts in (TEXTS, TEXTS[::-1]):
        ids = model.encode(pa.array(texts))
        assert ids.to_pylist() == [library.encode(t or "") for t in texts]
        assert model.decode(ids).to_pylist() == [t or "" for t in texts]


def test_exact_shingles():
    texts = [f"{PAIR[0]} b c d e", f"{PAIR[1]} b c d e", "b c", "c b", "a b c d e a b c d e", "", None, "x " * 9]
    text, number, count = exact_shingles(pa.array(texts))
    words = [(t or "").split() for t in texts]
    want = [{} for _ in texts]
    for i, w in enumerate(words):
        for at in range(max(1, len(w) - 4) if w else 0):
            key = tuple(w[at:at + 5])
            want[i][key] = want[i].get(key, 0) + 1
    known = {}
    for i, w in enumerate(want):
        mine = dict(zip(number[text == i].tolist(), count[text == i].tolist()))
        assert sorted(mine.values()) == sorted(w.values())
        known[i] = set(mine)
    for i in known:
        for j in known:
            assert len(known[i] & known[j]) == len(set(want[i]) & set(want[j]))


def test_unlike_texts_of_equal_sketches():
    """The last word on a pair is its words: equal sketches alone make no link."""
    texts = [f"{PAIR[0]} b c d e", f"{PAIR[1]} b c d e", f"{PAIR[0]} b c d  e"]
    sketch = pa.array([np.zeros(near_duplicates.REGISTERS, np.uint32).tobytes()] * 3, pa.binary())
    a, b = near_duplicates.overlapping(
        [sketch, pa.array(texts)], iter([(np.array([0, 0, 1]), np.array([1, 2, 2]))]), np.arange(3))
    assert list(zip(a.tolist(), b.tolist())) == [(0, 2)]


def test_classes_and_pipeline(spark, make_docs, scratch):
    words = "so many other words stand here that every rule of the policy lets the text pass".split()
    texts = [" ".join([w, *words]) for w in PAIR] + [f"{w} b c d e" for w in PAIR]
    docs = make_docs(texts)
    got = {r.doc_id: r.class_id for r in near_duplicates.near_duplicates(docs, scratch).collect()}
    assert got[2] == 2 and got[3] == 3
    kept = {r.doc_id for r in corpus_pipeline.near_duplicate(spark, docs, "").collect()}
    assert {2, 3} <= kept
    coded = corpus_pipeline.encode(spark, docs, "").collect()
    assert all(r.round_trip for r in coded) and len({tuple(r.piece_ids) for r in coded}) == 4
