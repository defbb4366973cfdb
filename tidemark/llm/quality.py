"""Quality by attention-based multiple-instance learning (operator 2).

Method. A document is a bag of passages of ``PASSAGE`` words. Every passage is
described by ``N_FEATURES`` numbers (kinds of bytes, word shapes, distinct
words, what the document said before, hashed letter triples) and encoded by one
tanh layer. Gated attention, softmax of w . (tanh(V h) * sigmoid(U h)), weighs
the encoded passages; the logistic output sees their weighted sum. Encoder,
gates and output are learned together, from document labels only, by Adam on a
bounded sample of at most ``TRAIN_DOCUMENTS`` labelled documents (chosen by
hash; whole texts). The network is a few thousand numbers and is broadcast.

Defined cases: null or empty text is one passage without content, and is
scored. Rows with a null doc_id are scored, never learned from, not held out.
With labels of one class only every score is their mean (0.5 without labels).
Contradicting labels of a doc_id count as the smaller. Extra columns are
ignored.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _bytes as B
from ._ship import ready
from .toxicity import fold

PASSAGE = 64
TRAIN_DOCUMENTS = 6000
HIDDEN, GATE = 24, 12
EPOCHS, BATCH, RATE, DECAY = 40, 128, 4e-3, 1e-4
THRESHOLD = 0.5
TRIPLES = 24

#: kinds of bytes: lower, upper, digit, space, line end, ., !?, other marks, signs, brackets and bars, other alphabets
_KIND = np.full(256, 8, np.int64)
for _k, _chars in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t", "\n\r",
                             ".,;:", "!?", "'\"-", "", "|[](){}<>/\\_")):
    for _c in _chars:
        _KIND[ord(_c)] = _k
_KIND[128:] = 10
_KINDS = 11
N_FEATURES = _KINDS + 9 + TRIPLES


def passage_features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage of a slice, and each text's first passage
    (with the total at the end). A text without words is one passage."""
    n = len(off) - 1
    h, starts, ends, owner = B.words(data, off, "space")
    bound = np.searchsorted(owner, np.arange(n + 1))
    many = np.maximum(-(-np.diff(bound) // PASSAGE), 1)
    first = np.concatenate([[0], np.cumsum(many)])
    total = int(first[-1])
    index = np.arange(len(h)) - bound[owner]
    passage = first[owner] + index // PASSAGE
    # a passage's bytes: from its first word (the text's start) to the next passage
    begin = np.zeros(total + 1, np.int64)
    begin[first[:-1]] = off[:-1]
    head = index % PASSAGE == 0
    inner = head & (index > 0)
    begin[passage[inner]] = starts[inner]
    begin[-1] = off[-1]
    size = np.diff(begin)
    of_byte = np.repeat(np.arange(total), size)
    kinds = np.bincount(of_byte * _KINDS + _KIND[data], minlength=total * _KINDS).reshape(total, _KINDS)
    n_bytes = np.maximum(size, 1)[:, None]
    low = B._LOWER[data].astype(np.uint32)
    triple = np.zeros(len(low), np.uint32)
    triple[2:] = ((low[:-2] * np.uint32(2654435761) ^ low[1:-1]) * np.uint32(2246822519) ^ low[2:]) * np.uint32(3266489917)
    triples = np.bincount(of_byte * TRIPLES + (triple >> np.uint32(16)) % TRIPLES, minlength=total * TRIPLES).reshape(total, TRIPLES)
    words = np.bincount(passage, minlength=total)
    per = np.maximum(words, 1)
    length = (ends - starts).astype(np.float64)
    short = h >> np.uint64(32)

    def new_in(group: np.ndarray, key: np.ndarray) -> np.ndarray:
        """1 where a (group, key) pair occurs for the first time."""
        _, at = np.unique(group.astype(np.uint64) << np.uint64(32) | key, return_index=True)
        out = np.zeros(len(key))
        out[at] = 1
        return out

    pair = short.copy()
    pair[1:] = B.mix(h[1:] + h[:-1] * B._STEP) >> np.uint64(32)
    mean_length = np.bincount(passage, length, total) / per
    marks = np.isin(data[ends - 1], np.frombuffer(b".,;:!?", np.uint8)) if len(ends) else np.zeros(0, bool)
    signs = _KIND[data[ends - 1]] == 8 if len(ends) else np.zeros(0, bool)
    upper = _KIND[data[starts]] == 1 if len(starts) else np.zeros(0, bool)
    extra = np.column_stack([
        np.log1p(words), mean_length,
        np.sqrt(np.maximum(np.bincount(passage, length ** 2, total) / per - mean_length ** 2, 0)),
        np.bincount(passage, new_in(passage, short), total) / per,
        np.bincount(passage, new_in(owner, short), total) / per,
        np.bincount(passage, new_in(owner, pair), total) / per,
        np.bincount(passage, marks, total) / per, np.bincount(passage, signs, total) / per,
        np.bincount(passage, upper, total) / per])
    return np.column_stack([kinds / n_bytes, extra, triples / n_bytes]).astype(np.float32), first


class Network:
    """Encoder, gated attention and output, with gradients written out."""

    def __init__(self, x: np.ndarray, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.mean, self.dev = x.mean(0), x.std(0) + 1e-6
        scale = lambda a, b: rng.normal(0, 1 / np.sqrt(a), (a, b))
        self.p = {"w": scale(N_FEATURES, HIDDEN), "b": np.zeros(HIDDEN), "v": scale(HIDDEN, GATE), "u": scale(HIDDEN, GATE),
                  "a": rng.normal(0, 0.3, GATE), "c": rng.normal(0, 0.3, HIDDEN), "d": np.zeros(1)}

    def forward(self, x: np.ndarray, first: np.ndarray) -> dict:
        """first: each bag's first passage and the total at the end."""
        p = self.p
        z = np.clip((x - self.mean) / self.dev, -6, 6)
        h = np.tanh(z @ p["w"] + p["b"])
        t, g = np.tanh(h @ p["v"]), 1 / (1 + np.exp(-h @ p["u"]))
        e = (t * g) @ p["a"]
        bag = np.repeat(np.arange(len(first) - 1), np.diff(first))
        e = np.exp(e - np.maximum.reduceat(e, first[:-1])[bag])
        weight = e / np.add.reduceat(e, first[:-1])[bag]
        rep = np.add.reduceat(weight[:, None] * h, first[:-1], axis=0)
        score = 1 / (1 + np.exp(-np.clip(rep @ p["c"] + p["d"][0], -30, 30)))
        return {"z": z, "h": h, "t": t, "g": g, "weight": weight, "bag": bag, "rep": rep, "score": score}

    def gradients(self, x: np.ndarray, first: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, s = self.p, self.forward(x, first)
        out = (s["score"] - y) / len(y)
        d_rep = out[:, None] * p["c"]
        along = (s["h"] * d_rep[s["bag"]]).sum(1)
        mean = np.add.reduceat(s["weight"] * along, first[:-1])
        d_e = s["weight"] * (along - mean[s["bag"]])
        d_tg = d_e[:, None] * p["a"]
        d_t = d_tg * s["g"] * (1 - s["t"] ** 2)
        d_g = d_tg * s["t"] * s["g"] * (1 - s["g"])
        d_h = s["weight"][:, None] * d_rep[s["bag"]] + d_t @ p["v"].T + d_g @ p["u"].T
        d_h *= 1 - s["h"] ** 2
        return {"w": s["z"].T @ d_h, "b": d_h.sum(0), "v": s["h"].T @ d_t, "u": s["h"].T @ d_g,
                "a": ((s["t"] * s["g"]) * d_e[:, None]).sum(0), "c": s["rep"].T @ out, "d": np.array([out.sum()])}

    def fit(self, x: np.ndarray, first: np.ndarray, y: np.ndarray, seed: int = 4) -> "Network":
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        q = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for epoch in range(EPOCHS):
            rate = RATE * (1 - epoch / EPOCHS) + 1e-4
            order = rng.permutation(len(y))
            for a in range(0, len(order), BATCH):
                bags = order[a:a + BATCH]
                size = first[bags + 1] - first[bags]
                heads = np.concatenate([[0], np.cumsum(size)])
                rows = np.arange(heads[-1]) - np.repeat(heads[:-1], size) + np.repeat(first[bags], size)
                step += 1
                for k, g in self.gradients(x[rows], heads, y[bags]).items():
                    g = g + DECAY * self.p[k]
                    m[k] = 0.9 * m[k] + 0.1 * g
                    q[k] = 0.999 * q[k] + 0.001 * g * g
                    self.p[k] -= rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(q[k] / (1 - 0.999 ** step)) + 1e-8)
        return self


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, label) rows -> (label, passages as float32) of the sample."""
    for batch in batches:
        data, off = B.buffers(batch.column(0))
        cells = []
        for a, b in B.slices(off):
            x, first = passage_features(data[off[a]:off[b]], off[a:b + 1] - off[a])
            cells += [x[s:e].tobytes() for s, e in zip(first[:-1], first[1:])]
        yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(cells, pa.binary())], ["label", "x"])


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, base = model.value
        for batch in batches:
            data, off = B.buffers(batch.column(1))
            out = []
            for a, b in B.slices(off):
                if net is None:
                    out.append(np.full(b - a, base))
                else:
                    x, first = passage_features(data[off[a]:off[b]], off[a:b + 1] - off[a])
                    out.append(net.forward(x, first)["score"])
            score = np.concatenate(out) if out else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(score)], ["doc_id", "held_out", "score"])

    return run


def quality(docs: DataFrame, labels: DataFrame, held_out: tuple[int, int] = (3, 1)) -> DataFrame:
    """(doc_id, text) rows and (doc_id, quality) labels -> doc_id, held_out,
    score, predicted of each row. Rows whose fold is ``held_out`` teach nothing."""
    spark = ready(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    modulus, rest = held_out
    out_of_fold = F.coalesce(fold(F.col("doc_id"), modulus) == rest, F.lit(False))
    marks = (labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(F.col("quality").cast("int")).alias("label"))
             .filter(~out_of_fold))
    n = marks.count()
    if n > TRAIN_DOCUMENTS:
        marks = marks.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(TRAIN_DOCUMENTS / n * 1_000_000))
    sample = docs.join(F.broadcast(marks), "doc_id").select("text", "label").mapInArrow(_encode, "label int, x binary").toArrow()
    y = sample.column(0).to_numpy().astype(float)
    net, base = None, float(y.mean()) if len(y) else 0.5
    if 0 < y.sum() < len(y):
        bags = [np.frombuffer(x.as_buffer(), np.float32).reshape(-1, N_FEATURES) for x in sample.column(1)]
        order = sorted(range(len(bags)), key=lambda k: (len(bags[k]), bags[k].tobytes()))  # rows come in no fixed order
        bags, y = [bags[k] for k in order], y[order]
        x = np.concatenate(bags).astype(np.float64)
        net = Network(x).fit(x, np.concatenate([[0], np.cumsum([len(b) for b in bags])]), y)
    model = spark.sparkContext.broadcast((net, base))
    scored = docs.select("doc_id", "text", out_of_fold.alias("held_out")).mapInArrow(
        _score(model), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
