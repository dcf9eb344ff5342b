"""Token files and WARC archives: exact round trips."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from tokenizers import Tokenizer

from fulcrum.llm import files, token_files, warc

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    None, "", " \n\t", "plain words, and more.", "a<|endoftext|>b c", "don't we'll x's ''s", "İstanbul ﬁ é́ ΣΑΣ.", "x\x85y z\xa0w",
    "a" * 5000 + ". b", "12.5 !!. ,a .", "UPPER lower Ünï 中文 😀", "word. word, word", "tab\tnew\nline\x0b\x0c\r end",
]


def texts(n, seed):
    rng = random.Random(seed)
    parts = ["the ", "Thin", "tion", ". ", ", ", "\n", "éa", "'s ", "12", "<|startoftext|>", " ", "中"]
    return TEXTS + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_ids_are_the_tokenizers(monkeypatch):
    tokenizer = Tokenizer.from_file(PATH)
    coder = token_files.PieceEncoder(PATH, 2)
    monkeypatch.setattr(coder.table, "most", 50)  # the table starts anew again and again
    for seed in range(4):
        some = texts(60, seed)
        for t, raw in zip(some, coder.encode(pa.array(some))):
            assert np.frombuffer(raw, coder.dtype).tolist() == tokenizer.encode(t or "", add_special_tokens=False).ids + [2]


def test_token_files(make_docs, scratch, monkeypatch):
    monkeypatch.setattr(token_files, "SHARD_DOCS", 16)
    some = texts(70, 9)
    ids = random.Random(1).sample(range(-50, 500), len(some))
    ids[4], ids[5], ids[6] = None, 77, 77
    docs = make_docs(some, ids).selectExpr("*", "1 AS n", "2 AS frame")
    manifest, dictionary = token_files.token_files(docs, scratch.path("tokens"), scratch, PATH)
    rows = token_files.read_shards(manifest, dictionary).collect()
    tokenizer, at = Tokenizer.from_file(PATH), 0
    coded = {}
    for i, t in zip(ids, some):
        coded.setdefault(i, []).append(tokenizer.encode(t or "", add_special_tokens=False).ids + [2])
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at
        mine = [c for c in coded[r.doc_id] if len(c) == r.n_tokens and zlib.crc32(np.array(c, "<u4").tobytes()) == r.ids_crc32]
        coded[r.doc_id].remove(mine[0])
        at += r.n_tokens
    assert not any(coded.values())
    order = [r.doc_id for r in sorted(rows, key=lambda r: r.start)]
    assert order[0] is None and order[1:] == sorted(order[1:])
    shard = token_files.ShardReader(manifest.orderBy("shard").first().path, dictionary)
    known = int(shard.index["doc_id"][2])
    assert [x.tolist() for x in shard.find(known)] == [tokenizer.encode(some[ids.index(known)] or "", add_special_tokens=False).ids + [2]]
    assert shard.find(10**9) == []
    with pytest.raises(ValueError):
        token_files.ShardReader(manifest.first().path, dictionary + b"x")


def test_no_documents(make_docs, scratch):
    manifest, dictionary = token_files.token_files(make_docs([]), scratch.path("tokens"), scratch, PATH)
    assert manifest.count() == 0 and token_files.read_shards(manifest, dictionary).count() == 0


def make_pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest string, n int").repartition(3)


def page_rows():
    rng = random.Random(3)
    html = [None, "", "<p>é中😀</p>", "same", "same", "Content-Length: 5\r\n\r\nWARC/1.1", "x" * 70_000] + [
        rng.choice(["dup a", "dup b", f"own {i}"]) for i in range(60)]
    rows = [(i * 7 % 997, rng.choice([None, "http://a.org/b c\r\nd", f"https://h/{i}"]), h, "d", 1) for i, h in enumerate(html)]
    return rows + [(None, None, "dup a", "d", 1), rows[3], (5000, "u", "", "d", 1)]


@pytest.mark.parametrize("least", [0, 5])
def test_archives(spark, scratch, least):
    rows = page_rows()
    pages = make_pages(spark, rows)
    archives = warc.write_archives(
        warc.deduplicated(pages, scratch, least), scratch.path("archives"), scratch, warc.train_dictionary(pages))
    got = warc.read_archives(archives).collect()
    key = lambda r: tuple((x is None, x or 0) for x in r)
    want, used = [], set()
    smallest = {}
    for page, _, html, *_ in rows:
        p = (html or "").encode()
        if len(p) >= least:
            smallest[p] = min(smallest.get(p, (True, 0)), (page is None, page or 0))
    for page, _, html, *_ in rows:
        p = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(p).digest()).decode()
        first = len(p) < least or (smallest[p] == (page is None, page or 0) and p not in used)
        if first and len(p) >= least:
            used.add(p)
        want.append((page, len(p), digest, "response" if first else "revisit", None if first else smallest[p][1]))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_archive_layout(spark, scratch):
    pages = make_pages(spark, page_rows())
    dictionary = warc.train_dictionary(pages)
    archives = warc.write_archives(warc.deduplicated(pages, scratch), scratch.path("a"), scratch, dictionary)
    row = archives.first()
    with files.open_input(row.path) as f:
        raw = f.read()
    assert raw[:4] == (0x184D2A5D).to_bytes(4, "little") and raw[8:8 + len(dictionary)] == dictionary
    frames, rest = 0, raw[8 + len(dictionary):]
    unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    while rest:  # one frame per record
        one = unpacker.decompressobj()
        assert one.decompress(rest).startswith(b"WARC/1.1\r\n")
        rest, frames = one.unused_data, frames + 1
    assert frames == row.records


def test_no_pages(spark, scratch):
    pages = make_pages(spark, [])
    archives = warc.write_archives(
        warc.deduplicated(pages, scratch), scratch.path("a"), scratch, warc.train_dictionary(pages))
    assert archives.count() == 0 and warc.read_archives(archives).count() == 0


def test_a_hot_doc_id_spans_several_shards(make_docs, scratch, monkeypatch):
    """All rows without an id or with one id: several shards hold them, and none is lost."""
    monkeypatch.setattr(token_files, "SHARD_DOCS", 16)
    monkeypatch.setattr(token_files, "READ_DOCS", 5)
    tokenizer = Tokenizer.from_file(PATH)
    some = [f"text number {i} " + "word " * (i % 7) for i in range(160)]
    for ids in ([None] * 160, [7] * 160):
        manifest, dictionary = token_files.token_files(
            make_docs(some, ids=ids), scratch.path("tokens"), scratch, PATH)
        assert manifest.count() > 4 and max(r.docs for r in manifest.collect()) < 80
        rows = token_files.read_shards(manifest, dictionary).orderBy("start").collect()
        want = sorted(len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for t in some)
        assert [r.n_tokens for r in rows] == want and {r.doc_id for r in rows} == {ids[0]}
        assert [r.start for r in rows] == [sum(want[:i]) for i in range(160)]
