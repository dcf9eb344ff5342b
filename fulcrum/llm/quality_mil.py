"""Quality scores by attention-based multiple-instance learning.

A document is a bag of passages of PASSAGE words.  Every passage of the whole text is encoded;
gated attention weighs the passages, and the weighted representation is scored:

    h = relu(W x + b);  a = softmax over the bag of w . (tanh(V h) * sigmoid(U h))
    score = sigmoid(c . sum(a h) + c0)

Only document labels are given; the attention learns which passages decide.  Inputs are
the text's own form (character classes, word lengths, repetition); label, language, source
and doc_id are not among them.

The model is small and trained in the driver on at most TRAIN_DOCS labelled documents,
chosen by hash; scoring is a map over all documents with the weights in the task's closure.

Defined results: a text without words, null or empty, is a bag with one empty passage; very long texts
are scored whole; documents without a label are only scored; if a document has several
labels, the smallest counts, and of rows that share a doc_id the smallest text is learned from; without
labelled documents every score is 0.5; repeated rows score alike; an empty table gives an empty
result; other columns are not read, so their names don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fulcrum.llm import wordhash

PASSAGE = 50
#: Bounds of the training sample: documents, and passages of each (evenly spaced ones of a longer text;
#: scoring always reads the whole text).
TRAIN_DOCS, TRAIN_PASSAGES = 6000, 1024
HIDDEN, ATTENTION, EPOCHS, RATE, SEED = 24, 16, 40, 0.01, 7
CLIP, DECAY = 3.0, 1e-3

#: Byte classes: blank, lower, upper, digit, sentence marks, symbols, shouts, other ASCII, lead byte, trail byte.
_CLASSES = np.full(256, 7, np.uint8)
for _k, _chars in enumerate((b" \t\v\f\r\n", bytes(range(97, 123)), bytes(range(65, 91)), b"0123456789",
                             b".,;:'\"-()", b"#*$%&|<>@^~=+/\\{}[]_`", b"!?")):
    _CLASSES[list(_chars)] = _k
_CLASSES[0x80:0xC0] = 9
_CLASSES[0xC0:] = 8
N_CLASSES = 10
FEATURES = N_CLASSES + 10


def encode_passages(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(x, first): features of all passages, and the first passage of each text (texts + 1)."""
    w = wordhash.words_of(texts)
    n = w.counts()
    passages = np.maximum(1, -(-n // PASSAGE))
    first = np.concatenate([[0], np.cumsum(passages)])
    total = int(first[-1])
    word0 = np.concatenate([[0], np.cumsum(n)])
    place = np.arange(len(w.start)) - word0[w.text]  # of a word in its text
    of = first[w.text] + place // PASSAGE  # passage of a word
    lengths = (w.end - w.start).astype(np.float64)
    size = np.bincount(of, minlength=total).astype(np.float64)
    # a passage's bytes: from its first word (or the text's start) to the next passage
    begin = np.empty(total, np.int64)
    begin[first[:-1]] = w.bounds[:-1]
    inner = (place % PASSAGE == 0) & (place > 0)
    begin[of[inner]] = w.start[inner]
    owner = np.repeat(np.arange(total), np.diff(np.append(begin, w.bounds[-1])))
    counts = np.bincount(owner * N_CLASSES + _CLASSES[w.data], minlength=total * N_CLASSES).reshape(total, N_CLASSES)
    newlines = np.bincount(owner[w.data == 10], minlength=total)
    hashes = w.hashes()
    column = place % PASSAGE
    table = (np.uint64(1 << 63) + np.arange(total * PASSAGE, dtype=np.uint64)).reshape(total, PASSAGE)
    table[of, column] = hashes >> np.uint64(1)
    table.sort(axis=1)
    same = (table[:, 1:] == table[:, :-1]).sum(axis=1)
    # words whose pair with the word before stood earlier in the text
    pair = np.zeros(len(hashes), np.uint64)
    pair[1:] = wordhash.mix(hashes[:-1] * np.uint64(31) + hashes[1:])
    pair[place == 0] = wordhash.mix(np.flatnonzero(place == 0).astype(np.uint64) + np.uint64(1 << 62))
    order = np.lexsort((pair, w.text))
    again = np.zeros(len(pair), bool)
    again[order[1:]] = (pair[order[1:]] == pair[order[:-1]]) & (w.text[order[1:]] == w.text[order[:-1]])
    last = _CLASSES[w.data[w.end - 1]] if len(w.end) else np.zeros(0, np.uint8)
    per = lambda mask: np.bincount(of[mask], minlength=total)
    words = np.maximum(size, 1)
    solid = np.maximum(counts[:, 1:].sum(axis=1) - counts[:, 9], 1)  # characters that aren't blank
    x = np.column_stack([
        counts / np.maximum(counts.sum(axis=1, keepdims=True), 1),
        solid / words / 10,
        per(lengths <= 2) / words, per(lengths > 14) / words,
        per(last == 4) / words, per((last == 5) | (last == 6)) / words, per(lengths == 1) / words,
        newlines / words, same / words, per(again) / words, np.log1p(size) / 4,
    ])
    return x, first


class GatedAttention:
    """The network; ``weights`` is a dict of arrays."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights

    @classmethod
    def start(cls, rng: np.random.Generator) -> GatedAttention:
        init = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
        return cls({
            "mean": np.zeros(FEATURES), "scale": np.ones(FEATURES),
            "W": init(FEATURES, HIDDEN), "b": np.zeros(HIDDEN), "V": init(HIDDEN, ATTENTION), "U": init(HIDDEN, ATTENTION),
            "w": init(ATTENTION), "c": init(HIDDEN), "c0": np.zeros(1)})

    def forward(self, x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        w, at, n = self.w, first[:-1], np.diff(first)
        z = np.clip((x - w["mean"]) / w["scale"], -CLIP, CLIP)
        h = np.maximum(z @ w["W"] + w["b"], 0)
        t, g = np.tanh(h @ w["V"]), 1 / (1 + np.exp(-np.clip(h @ w["U"], -30, 30)))
        s = (t * g) @ w["w"]
        e = np.exp(s - np.repeat(np.maximum.reduceat(s, at), n))
        a = e / np.repeat(np.add.reduceat(e, at), n)
        bag = np.add.reduceat(a[:, None] * h, at, axis=0)
        p = 1 / (1 + np.exp(-np.clip(bag @ w["c"] + w["c0"], -30, 30)))
        return {"z": z, "h": h, "t": t, "g": g, "a": a, "bag": bag, "p": p, "at": at, "n": n}

    def gradients(self, f: dict[str, np.ndarray], y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        w, n = self.w, f["n"]
        d = weight * (f["p"] - y) / weight.sum()
        dbag = d[:, None] * w["c"]
        up = np.repeat(dbag, n, axis=0)
        da = (up * f["h"]).sum(axis=1)
        ds = f["a"] * (da - np.repeat(np.add.reduceat(f["a"] * da, f["at"]), n))
        dgate = ds[:, None] * w["w"]
        dt, dg = dgate * f["g"] * (1 - f["t"] ** 2), dgate * f["t"] * f["g"] * (1 - f["g"])
        dh = (f["a"][:, None] * up + dt @ w["V"].T + dg @ w["U"].T) * (f["h"] > 0)
        return {"W": f["z"].T @ dh, "b": dh.sum(axis=0), "V": f["h"].T @ dt, "U": f["h"].T @ dg,
                "w": (f["t"] * f["g"]).T @ ds, "c": f["bag"].T @ d, "c0": d.sum(keepdims=True)}

    @classmethod
    def fit(cls, x: np.ndarray, first: np.ndarray, y: np.ndarray) -> GatedAttention:
        """Adam on mini-batches of bags; rarer labels weigh more (square root of the ratio)."""
        rng = np.random.default_rng(SEED)
        net = cls.start(rng)
        if not len(y):
            net.w["c"] = np.zeros(HIDDEN)
            return net
        net.w["mean"], net.w["scale"] = x.mean(axis=0), x.std(axis=0) + 1e-3
        share = np.clip(y.mean(), 0.02, 0.98)
        weight = np.where(y == 1, np.sqrt(0.5 / share), np.sqrt(0.5 / (1 - share)))
        names = ("W", "b", "V", "U", "w", "c", "c0")
        m, v, step = {k: 0.0 for k in names}, {k: 0.0 for k in names}, 0
        for epoch in range(EPOCHS):
            rate = RATE * 0.5 * (1 + np.cos(np.pi * epoch / EPOCHS))
            order = rng.permutation(len(y))
            for at in range(0, len(order), 256):
                some = order[at:at + 256]
                n = first[some + 1] - first[some]
                rows = np.repeat(first[some] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                f = net.forward(x[rows], np.concatenate([[0], np.cumsum(n)]))
                g, step = net.gradients(f, y[some], weight[some]), step + 1
                for k in names:
                    grad = g[k] + (DECAY * net.w[k] if k != "c0" else 0)
                    m[k], v[k] = 0.9 * m[k] + 0.1 * grad, 0.999 * v[k] + 0.001 * grad ** 2
                    net.w[k] = net.w[k] - rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
        return net


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = TRAIN_DOCS) -> GatedAttention:
    """Fit on at most ``most`` labelled documents (``labels``: doc_id and ``label``, 0 or 1)."""
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .groupBy("doc_id").agg(F.min(label).alias("_y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        .withColumnRenamed("doc_id", "_id"))
    # one text per chosen id, map-side, before anything is encoded or collected
    texts = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
             .join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))  # at most ``most`` rows
             .groupBy("_id", F.col("_y").cast("double").alias("_y")).agg(F.min("text").alias("text"))
             .select(F.xxhash64("_id").alias("_h"), F.col("_id").cast("string").alias("_id"), "_y", "text"))

    def passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in wordhash.slices(batch, 3):
                x, first = encode_passages(part.column(3))
                blocks = []
                for a, b in zip(first, first[1:]):
                    some = x[a:b] if b - a <= TRAIN_PASSAGES else x[np.linspace(a, b - 1, TRAIN_PASSAGES).astype(np.int64)]
                    blocks.append(some.astype("<f4").tobytes())
                yield pa.record_batch([part.column(0), part.column(1), part.column(2), pa.array(blocks, pa.binary())], ["h", "id", "y", "x"])

    rows = texts.mapInArrow(passages, "h long, id string, y double, x binary").collect()
    rows.sort(key=lambda r: (r.h, r.id))
    bags = [np.frombuffer(r.x, "<f4").reshape(-1, FEATURES) for r in rows]
    first = np.concatenate([[0], np.cumsum([len(b) for b in bags])]).astype(np.int64)
    x = np.concatenate(bags).astype(np.float64) if bags else np.zeros((0, FEATURES))
    return GatedAttention.fit(x, first, np.array([r.y for r in rows]))


def score(docs: DataFrame, net: GatedAttention) -> DataFrame:
    """``docs``' doc_id, with score (double) and passages (long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in wordhash.slices(batch, 1):
                x, first = encode_passages(part.column(1))
                p = net.forward(x, first)["p"]
                yield pa.record_batch([part.column(0), pa.array(p), pa.array(np.diff(first))], ["doc_id", "score", "passages"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double, passages long")
