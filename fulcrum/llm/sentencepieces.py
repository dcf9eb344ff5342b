"""SentencePiece encoding and decoding with a given model file.

Encoding is a single-pass Viterbi.  An Aho-Corasick automaton over the pieces runs along
the text once; at each position its output links name every piece that ends there, and each
of them may relax the best score of that position from the best score of its start.

In a unigram model every piece may follow every other, and the best sum of scores is the
library's own encoding.  A BPE model's scores are merge ranks whose best sum isn't what the
merges give, so there a relaxation is admissible only if the merges, run on the previous
piece and the new one together, give back exactly these two.  The encoding of a prefix ends
in one piece that meets this with its predecessor, so the same pass yields the library's
ids.

No piece holds a space mark after another character, so a text is cut before its space
marks and around its line ends, which no piece holds; each distinct segment of a slice of
texts is encoded once, and those seen before come from a bounded table.  Characters without a
piece become byte pieces.

Defined results: null and empty texts have no ids and decode to the empty text; a space mark
in a text reads as a space (as in the library), so such a text does not come back exactly; very long texts are
encoded whole; where two ways to encode score alike the one found first stays, as in the library; repeated rows
are encoded each; an empty table gives an empty result; of other columns only those that a function is told
to keep are read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame

from fulcrum.llm import wordhash

SPACE = "▁"
#: Segments and pairs of pieces remembered per worker.
CACHE_SEGMENTS, CACHE_PAIRS = 1_000_000, 400_000


class PieceModel:
    """Pieces, scores and the automaton of a model file."""

    def __init__(self, path: str, unigram: bool | None = None):
        import ahocorasick
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        # a plain SentencePiece setting: no rewriting of the text but the space mark
        spec = proto.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces:
            raise ValueError("models that rewrite the text are not supported")
        self.prefix = spec.add_dummy_prefix
        self.unigram = proto.trainer_spec.model_type == 1 if unigram is None else unigram
        model = SentencePieceProcessor(model_file=path)
        self.unknown = model.unk_id()
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.byte = [-1] * 256
        self.text: list[bytes] = []
        self.pieces: list[str] = []
        self.automaton = ahocorasick.Automaton()
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            shown = b""
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte[value], shown = i, bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.id[piece], self.score[piece] = i, model.get_score(i)
                self.automaton.add_word(piece, (len(piece), i, self.score[piece]))
                shown = piece.replace(SPACE, " ").encode()
            self.text.append(shown)
            self.pieces.append(piece)
        self.automaton.make_automaton()
        self.known = {c for piece in self.id for c in piece}
        if any(SPACE in p.lstrip(SPACE) for p in self.id):
            raise ValueError("pieces that hold a space mark inside are not supported")
        self.pairs: dict[int, bool] = {}
        self.cut_lines = "\n" not in self.known
        self.table = wordhash.UnitTable("<i4", lambda units: [self.segment_ids(u.decode()) for u in units], CACHE_SEGMENTS)

    def merges(self, text: str) -> list[str]:
        """The pieces that the merges give on a short text: best score first, then leftmost."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = score.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def admissible(self, before: int, piece: int) -> bool:
        """Whether a piece may follow the one before (-1: the start of the segment)."""
        if self.unigram:
            return True
        pair = (before + 1) * len(self.pieces) + piece
        known = self.pairs.get(pair)
        if known is None:
            if len(self.pairs) >= CACHE_PAIRS:
                self.pairs.clear()
            both = [*([self.pieces[before]] if before >= 0 else []), self.pieces[piece]]
            known = self.pairs[pair] = self.merges("".join(both)) == both
        return known

    def viterbi(self, segment: str) -> list[int]:
        """Ids of a segment whose characters all have pieces."""
        n = len(segment)
        best: list[float | None] = [None] * (n + 1)
        best[0], last, size = 0.0, [-1] * (n + 1), [0] * (n + 1)
        for end, (length, i, score) in self.automaton.iter(segment):
            start = end + 1 - length
            base = best[start]
            if base is None:
                continue
            now = best[end + 1]
            if (now is None or base + score > now) and self.admissible(last[start], i):
                best[end + 1], last[end + 1], size[end + 1] = base + score, i, length
        ids, at = [], n
        while at:
            ids.append(last[at])
            at -= size[at]
        return ids[::-1]

    def _bytes(self, c: str) -> list[int]:
        ids = [self.byte[b] for b in c.encode("utf-8", "surrogatepass")]
        return [self.unknown] if -1 in ids else ids

    def segment_ids(self, segment: str) -> bytes:
        """Ids (32-bit, little-endian) of text without an inner cut."""
        segment = segment.replace(" ", SPACE)
        strange = "".join(map(re.escape, sorted(set(segment) - self.known)))
        ids: list[int] = []
        for run in re.findall(f"[{strange}]|[^{strange}]+", segment) if strange else [segment]:
            ids += self.viterbi(run) if run[0] in self.known else self._bytes(run)
        return np.array(ids, "<i4").tobytes()

    def encode(self, texts: pa.Array) -> pa.ListArray:
        """Ids of each text of a column; nulls are empty."""
        found = wordhash.words_of(pa.compute.replace_substring(texts, SPACE, " "))
        sizes = np.diff(found.bounds)
        add = (sizes > 0).astype(np.int64) if self.prefix else np.zeros(len(sizes), np.int64)
        bounds = found.bounds + np.concatenate([[0], np.cumsum(add)])
        data = np.full(bounds[-1], 0x20, np.uint8)  # the prefix is a space before each text
        data[np.arange(len(found.data)) + np.repeat(np.cumsum(add), sizes)] = found.data
        space, line = data == 0x20, data == 0x0A
        begins = space.copy()
        begins[1:] &= ~space[:-1]
        if self.cut_lines:
            begins |= line
            begins[1:] |= line[:-1]
        begins[bounds[:-1][sizes > 0]] = True
        start = np.flatnonzero(begins)
        ids, size = self.table.ids(data, start, np.append(start[1:], len(data)) if len(start) else start)
        ends = np.concatenate([[0], np.cumsum(size)])[np.searchsorted(start, bounds)]
        return pa.ListArray.from_arrays(ends.astype(np.int32), pa.array(ids))

    def decode(self, ids: pa.Array) -> pa.Array:
        """Texts of a column of ids; nulls are empty."""
        out = []
        for x in ids:
            text = b"".join(map(self.text.__getitem__, x.values.to_pylist() if x.is_valid else ())).decode("utf-8", "replace")
            out.append(text[1:] if self.prefix and text.startswith(" ") else text)
        return pa.array(out, pa.string())


@lru_cache(maxsize=2)
def piece_model(path: str, unigram: bool | None = None) -> PieceModel:
    return PieceModel(path, unigram)


def _mapped(df: DataFrame, read: str, add: str, kind: str, build) -> DataFrame:
    """``df`` with a column made from the ``read`` column, some MB at a time."""
    at, names = df.columns.index(read), [*df.columns, add]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in wordhash.slices(batch, at):
                yield pa.record_batch([*part.columns, build(part.column(at))], names)

    return df.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + f", {add} {kind}")


def encode(docs: DataFrame, model: str, column: str = "text", out: str = "piece_ids") -> DataFrame:
    """``docs`` with the ids of ``column`` as ``out`` (array<int>, never null)."""

    def build(texts: pa.Array) -> pa.Array:
        return piece_model(model).encode(texts)

    return _mapped(docs, column, out, "array<int>", build)


def decode(df: DataFrame, model: str, column: str = "piece_ids", out: str = "decoded") -> DataFrame:
    """``df`` with the text of the ids in ``column`` as ``out`` (never null)."""

    def build(ids: pa.Array) -> pa.Array:
        return piece_model(model).decode(ids)

    return _mapped(df, column, out, "string", build)


def encode_checked(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_pieces, piece_ids, ids_crc32 (unsigned crc32 of the ids as little-endian 32-bit
    integers) and round_trip (whether decoding the ids gives the text back), in one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = piece_model(model)
        for batch in batches:
            for part in wordhash.slices(batch, 1):
                texts = part.column(1).fill_null("")
                ids = pieces.encode(texts)
                values, ends = ids.values.to_numpy().astype("<i4"), ids.offsets.to_numpy()
                crc = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(ends, ends[1:])]
                yield pa.record_batch(
                    [part.column(0), pa.array(np.diff(ends).astype(np.int64)), ids, pa.array(crc, pa.int64()),
                     pa.compute.equal(pieces.decode(ids), texts)],
                    ["doc_id", "n_pieces", "piece_ids", "ids_crc32", "round_trip"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_pieces long, piece_ids array<int>, ids_crc32 long, round_trip boolean")
