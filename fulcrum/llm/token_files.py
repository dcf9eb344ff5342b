"""Token-id files with a shared zstandard dictionary.

Texts are encoded with a given tokenizer; every document's ids, as little-endian integers,
are one zstandard frame of its own, compressed with one dictionary that is trained on
serialized id arrays of a bounded sample.  A shard file holds

    header   magic, id width, SHA-256 of the dictionary
    frames   one per document, in ascending doc_id order
    index    per document: doc_id, null flag, offset of the frame, number of ids
    footer   offset of the index, number of documents, magic

so that one short document is read by one look at the index and one small frame, and a
reader refuses a dictionary that is not the writer's.  Shards are ranges of (doc_id, number of ids, hash of the
frame), so rows that share a doc_id, or have none, are split like any others; the shards'
order and the order inside them is the order of the whole.

Encoding is the costly step.  It runs once, where the texts are read.  The tokenizer never
joins across blanks, so the ids of a text are those of its words in turn; each distinct word
of a slice of texts is looked up once, in a bounded table of the words seen before.

Defined results: null and empty texts hold only the end id; very long texts are one frame each; null
doc_ids come first; rows that share a doc_id stand side by side, fewer ids first (in one shard or in
neighbouring ones); an empty table gives no shard and no row; other columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fulcrum.llm import files, wordhash
from fulcrum.llm.scratch import Scratch

MAGIC = b"FTOKZST1"
HEADER, HEADER_BYTES = "<8sB32s", 41
FOOTER, FOOTER_BYTES = "<QQ8s", 24
INDEX = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("offset", "<u8"), ("n", "<u4")])

#: Sample for the dictionary: documents, and ids of each (only the ratio depends on them).
SAMPLE_DOCS, SAMPLE_IDS = 1000, 4096
DICT_BYTES = 64 * 1024
LEVEL = 3
#: Documents per shard file, and read at once.
SHARD_DOCS, READ_DOCS = 16384, 4096
#: Words remembered per worker.
CACHE_WORDS = 2_000_000


class PieceEncoder:
    """Ids of texts by a ``tokenizers`` file, as bytes of 16-bit (or 32-bit) integers."""

    def __init__(self, path: str, end_id: int | None):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab()
        top = max([*vocab.values(), end_id or 0])
        self.dtype = np.dtype("<u2" if top < 1 << 16 else "<u4")
        self.end = b"" if end_id is None else np.array([end_id], self.dtype).tobytes()
        # a run of letters is one word of the tokenizer, and its last id ends the word
        self.ends_word = np.zeros(top + 1, bool)
        for piece, i in vocab.items():
            self.ends_word[i] = piece.endswith("</w>")
        self.table = wordhash.UnitTable(self.dtype, self._of_words, CACHE_WORDS)

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.dtype).tobytes() for e in found]

    def _of_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word: runs of letters are encoded many at a time and cut at the word ends."""
        texts = [w.decode() for w in words]
        if not self.ends_word.any():
            return self._ids(texts)
        done: dict[str, bytes] = {}
        stems = [t[:-1] if t[-1] in ".," else t for t in texts]
        letters = list({s for s in stems if s.isalpha()})
        for at in range(0, len(letters), 256):
            own = letters[at:at + 256]
            raw = self._ids([" ".join(own)])[0]
            cut = ((np.flatnonzero(self.ends_word[np.frombuffer(raw, self.dtype)]) + 1) * self.dtype.itemsize).tolist()
            if len(cut) == len(own):  # else the tokenizer splits some of them; they are encoded one by one
                done.update(zip(own, [raw[a:b] for a, b in zip([0, *cut], cut)]))
        mark = dict(zip(".,", self._ids([".", ","])))
        mark = {t: done[s] + mark[t[-1]] for t, s in zip(texts, stems) if t is not s and s in done}
        done |= mark
        rest = [t for t in texts if t not in done]
        done.update(zip(rest, self._ids(rest)))
        return [done[t] for t in texts]

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Serialized ids of each text."""
        found = wordhash.words_of(texts)
        ids, size = self.table.ids(found.data, found.start, found.end)
        words = np.concatenate([[0], np.cumsum(found.counts())])
        ends = np.concatenate([[0], np.cumsum(size)])[words] * self.dtype.itemsize
        raw = ids.tobytes()
        return [raw[a:b] + self.end for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


@lru_cache(maxsize=2)
def encoder(path: str, end_id: int | None) -> PieceEncoder:
    return PieceEncoder(path, end_id)


def _encoded(batches: Iterator[pa.RecordBatch], tokenizer: str, end_id: int | None) -> Iterator[tuple[pa.Array, list[bytes]]]:
    coder = encoder(tokenizer, end_id)
    for batch in batches:
        for part in wordhash.slices(batch, 1):
            yield part.column(0), coder.encode(part.column(1))


def train_dictionary(docs: DataFrame, tokenizer: str, end_id: int | None) -> bytes:
    """A dictionary from at most about SAMPLE_DOCS documents, spread over the table by hash."""
    every = max(1, docs.count() // SAMPLE_DOCS)
    sample = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0).select("doc_id", "text").limit(2 * SAMPLE_DOCS)

    def ids(batches):
        width = encoder(tokenizer, end_id).dtype.itemsize
        for _, found in _encoded(batches, tokenizer, end_id):
            yield pa.record_batch([pa.array([x[:SAMPLE_IDS * width] for x in found], pa.binary())], ["ids"])

    samples = [bytes(r.ids) for r in sample.mapInArrow(ids, "ids binary").collect()]
    return dictionary_from(samples)


def dictionary_from(samples: list[bytes], size: int = DICT_BYTES) -> bytes:
    """Trained if there is enough to train on, else the samples themselves as raw content."""
    try:
        return zstandard.train_dictionary(min(size, sum(map(len, samples)) // 8), samples).as_bytes()
    except (zstandard.ZstdError, ValueError, MemoryError):
        return b"".join(samples)[:size] or b"\x00" * 8


def write_shards(docs: DataFrame, folder: str, scratch: Scratch, tokenizer: str, end_id: int | None,
                 dictionary: bytes) -> DataFrame:
    """Write the shard files under ``folder``; one row per shard: shard, path, docs, ids."""

    def encode(batches):
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary))
        width = encoder(tokenizer, end_id).dtype.itemsize
        for ids, found in _encoded(batches, tokenizer, end_id):
            yield pa.record_batch(
                [ids, pa.array([len(x) // width for x in found], pa.int64()),
                 pa.array([packer.compress(x) for x in found], pa.binary())], ["doc_id", "n", "frame"])

    frames = scratch.write(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .mapInArrow(encode, "doc_id long, n long, frame binary"), "frames")
    shards = max(1, -(-frames.count() // SHARD_DOCS))
    digest = hashlib.sha256(dictionary).digest()

    def write(batches):
        width = encoder(tokenizer, end_id).dtype.itemsize
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        shard, index, total = TaskContext.get().partitionId(), [], 0
        with files.create(folder, f"shard-{shard:06d}", ".tkz") as (path, out):
            out.write(struct.pack(HEADER, MAGIC, width, digest))
            at = HEADER_BYTES
            for batch in itertools.chain([first], batches):
                entries = np.zeros(batch.num_rows, INDEX)
                entries["doc_id"] = batch.column(0).fill_null(0).to_numpy()
                entries["null"] = batch.column(0).is_null().to_numpy(zero_copy_only=False)
                entries["n"] = batch.column(1).to_numpy()
                frames = batch.column(2).to_pylist()
                sizes = np.array([len(x) for x in frames], np.uint64)
                entries["offset"] = at + np.cumsum(sizes) - sizes
                out.write(b"".join(frames))
                at += int(sizes.sum())
                total += int(entries["n"].sum())
                index.append(entries)
            table = np.concatenate(index)
            out.write(table.tobytes())
            out.write(struct.pack(FOOTER, at, len(table), MAGIC))
        yield pa.record_batch([[shard], [path], [len(table)], [total]], ["shard", "path", "docs", "ids"])

    manifest = scratch.write(
        frames.withColumn("_hash", F.xxhash64("frame")).repartitionByRange(shards, "doc_id", "n", "_hash")
        .sortWithinPartitions("doc_id", "n", "_hash", "frame").drop("_hash")
        .mapInArrow(write, "shard long, path string, docs long, ids long"), "manifest")
    scratch.remove(frames)
    return manifest


class ShardReader:
    """Random access to the documents of one shard file."""

    def __init__(self, path: str, dictionary: bytes):
        self.file = files.open_input(path)
        magic, width, digest = struct.unpack(HEADER, self.file.read_at(HEADER_BYTES, 0))
        if magic != MAGIC or digest != hashlib.sha256(dictionary).digest():
            raise ValueError(f"{path}: not a shard of this dictionary")
        size = self.file.size()
        self.index_at, docs, magic = struct.unpack(FOOTER, self.file.read_at(FOOTER_BYTES, size - FOOTER_BYTES))
        if magic != MAGIC:
            raise ValueError(f"{path}: incomplete")
        self.dtype = np.dtype(f"<u{width}")
        self.index = np.frombuffer(self.file.read_at(docs * INDEX.itemsize, self.index_at), INDEX)
        self.unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))

    def __len__(self) -> int:
        return len(self.index)

    def ids(self, i: int) -> np.ndarray:
        start, n = int(self.index["offset"][i]), int(self.index["n"][i])
        end = int(self.index["offset"][i + 1]) if i + 1 < len(self.index) else self.index_at
        raw = self.unpacker.decompress(self.file.read_at(end - start, start), max_output_size=n * self.dtype.itemsize)
        return np.frombuffer(raw, self.dtype)

    def find(self, doc_id: int) -> list[np.ndarray]:
        """Ids of the documents of that doc_id (nulls stand first, the rest ascends)."""
        nulls = int(self.index["null"].sum())
        known = self.index["doc_id"][nulls:]
        lo, hi = np.searchsorted(known, doc_id, "left"), np.searchsorted(known, doc_id, "right")
        return [self.ids(nulls + i) for i in range(lo, hi)]


def read_shards(manifest: DataFrame, dictionary: bytes) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, from the files."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))

    def read(batches):
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                shard = ShardReader(path, dictionary)
                n = shard.index["n"].astype(np.int64)
                before = start + np.cumsum(n) - n
                for at in range(0, len(shard), READ_DOCS):
                    some = slice(at, at + READ_DOCS)
                    crc = [zlib.crc32(shard.ids(i).astype("<u4").tobytes()) for i in range(at, min(at + READ_DOCS, len(shard)))]
                    yield pa.record_batch(
                        [pa.array(shard.index["doc_id"][some], mask=shard.index["null"][some].astype(bool)),
                         pa.array(before[some]), pa.array(n[some]), pa.array(crc, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"])

    tasks = max(1, -(-manifest.count() // 4))
    return placed.select("path", "start").repartition(tasks).mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, folder: str, scratch: Scratch, tokenizer: str, end_id: int | None = 2) -> tuple[DataFrame, bytes]:
    """Train the dictionary, store it beside the shards, and write them: (manifest, dictionary)."""
    dictionary = train_dictionary(docs, tokenizer, end_id)
    with files.create(folder, f"dictionary-{hashlib.sha256(dictionary).hexdigest()[:16]}", ".zdict") as (_, out):
        out.write(dictionary)
    return write_shards(docs, folder, scratch, tokenizer, end_id, dictionary), dictionary
