"""Toxicity by class-conditional Kneser-Ney models (operator 8).

Method. Two character models of order ``ORDER`` over 32 symbols, one for toxic
and one for ordinary text, counted over every labelled training row. A class's
discounted counts back off to one distribution shared by both classes, built
from continuation counts (distinct left neighbours) of both, so that an
expression that neither class has seen says nothing for either. The log ratio
of the two models at each character gives a document's length-normalised
difference of log-likelihoods, and that of each word; a logistic regression on
the first, the largest of the second and their number above ``CLEAR`` turns
these into a score. It is fitted by cross-fitting: the labelled rows fall into
``FOLDS`` parts, and a part's rows get their features from counts without that
part (of each part a bounded sample, at most ``MAX_CALIBRATION`` rows in all).
Scores use all counts.

Counts are summed within tasks before they are exchanged, and grow with the
text up to the 32 ** ORDER expressions there are. The scoring table is that
size whatever the corpus (33.5 MB, one byte each), so it is broadcast.

Defined cases: null or empty text scores by its length alone. Rows with a null
doc_id are scored, never learned from, and are not held out. Without labels of
both classes every score is the share of toxic labels (0 without labels).
Repeated label rows count once each; a doc_id with contradicting labels is
toxic. Extra columns are ignored.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import drop_tables, materialize, written, written_since
from . import _bytes as B
from ._ship import ready

ORDER = 5
BITS = 5  # symbols as numbers below 32
CLEAR = 3.0  # log ratio of a word that counts as toxic
N_FEATURES = 6
DISCOUNT = 0.75
FOLDS = 3
MAX_CALIBRATION = 20_000
THRESHOLD = 0.3
_STEP = 12  # table entries per unit of log ratio

#: symbol of each byte: 0 white space and signs, 1-26 letters, 27 digits, 28-31 other alphabets
_SYMBOL = np.zeros(256, np.uint32)
_SYMBOL[97:123] = np.arange(1, 27)
_SYMBOL[65:91] = np.arange(1, 27)
_SYMBOL[48:58] = 27
_SYMBOL[128:] = 28 + (np.arange(128) & 3)


def _grams(data: np.ndarray) -> np.ndarray:
    """Number of the ORDER symbols that end at each byte (signs before the first)."""
    s = _SYMBOL[data]
    out = s.copy()
    for k in range(1, ORDER):
        out[k:] |= s[:-k] << np.uint32(BITS * k)
    return out


def _texts(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with ORDER - 1 spaces before each, so that none reads on."""
    gap = ORDER - 1
    n = len(off) - 1
    size = np.diff(off)
    out = np.full(len(data) + gap * n, 32, np.uint8)
    out[np.arange(len(data)) + np.repeat(gap * np.arange(1, n + 1), size)] = data
    return out, off + gap * np.arange(n + 1)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, label, fold) rows -> (gram, n0, n1, fold) summed over the task."""
    sums: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        label, part = (batch.column(k).to_numpy(zero_copy_only=False) for k in (1, 2))
        for which in sorted(set(zip(part.tolist(), label.tolist()))):
            data, off = B.buffers(batch.column(0).filter(pa.array((part == which[0]) & (label == which[1]))))
            for a, b in B.slices(off):
                text, ends = _texts(data[off[a]:off[b]], off[a:b + 1] - off[a])
                real = np.ones(len(text), bool)
                real[(ends[:-1][:, None] + np.arange(ORDER - 1)).ravel()] = False
                keys, counts = np.unique(_grams(text)[real], return_counts=True)
                if which in sums:
                    old = sums[which]
                    keys, at = np.unique(np.concatenate([old[0], keys]), return_inverse=True)
                    counts = np.bincount(at, np.concatenate([old[1], counts]), len(keys)).astype(np.int64)
                sums[which] = keys, counts
    for part in sorted({k[0] for k in sums}):
        sides = [sums.get((part, label), (np.zeros(0, np.uint32), np.zeros(0, np.int64))) for label in (0, 1)]
        both = np.union1d(sides[0][0], sides[1][0])
        n = np.zeros((2, len(both)), np.int64)
        for row, (keys, counts) in zip(n, sides):
            row[np.searchsorted(both, keys)] = counts
        yield pa.RecordBatch.from_arrays([pa.array(both.astype(np.int64)), pa.array(n[0]), pa.array(n[1]),
                                          pa.array(np.full(len(both), part, np.int32))], ["gram", "n0", "n1", "fold"])


def log_ratio_table(gram: np.ndarray, n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """log P(toxic) - log P(ordinary) of every expression, in steps of 1 / _STEP."""
    shared = np.full(1, 1.0)
    kinds = gram.astype(np.int64)
    levels = []  # distinct expressions of orders ORDER - 1 .. 1 by their last symbols
    for order in range(ORDER - 1, 0, -1):
        kinds = np.unique(kinds)
        suffix = kinds & ((1 << BITS * order) - 1)
        levels.append((order, suffix))  # one entry for each distinct left neighbour
        kinds = np.unique(suffix)
    shared = np.full(1 << BITS, 1.0 / (1 << BITS))
    for order, suffix in reversed(levels):
        size = 1 << BITS * order
        cont = np.bincount(suffix, minlength=size).astype(np.float64).reshape(-1, 1 << BITS)
        total, types = cont.sum(1, keepdims=True), (cont > 0).sum(1, keepdims=True)
        low = np.tile(shared, size // len(shared)).reshape(-1, 1 << BITS) if order > 1 else shared.reshape(1, -1)
        with np.errstate(invalid="ignore", divide="ignore"):
            mixed = (np.maximum(cont - DISCOUNT, 0) + DISCOUNT * types * low) / total
        shared = np.where(total > 0, mixed, low).ravel()
    out = np.zeros(1 << BITS * ORDER, np.int8)
    width = 1 << BITS * (ORDER - 1)  # one first symbol at a time
    bound = np.searchsorted(gram, np.arange(0, (1 << BITS * ORDER) + 1, width))
    low = shared.reshape(-1, 1 << BITS)
    for block in range(1 << BITS):
        lo, hi = bound[block], bound[block + 1]
        logs = []
        for n in (n0, n1):
            count = np.zeros(width)
            count[gram[lo:hi] - block * width] = n[lo:hi]
            count = count.reshape(-1, 1 << BITS)
            total, types = count.sum(1, keepdims=True), (count > 0).sum(1, keepdims=True)
            with np.errstate(invalid="ignore", divide="ignore"):
                p = (np.maximum(count - DISCOUNT, 0) + DISCOUNT * types * low) / total
            logs.append(np.log(np.where(total > 0, p, low)))
        out[block * width:(block + 1) * width] = np.clip(np.rint((logs[1] - logs[0]).ravel() * _STEP), -127, 127)
    return out


def _table_of(gram: np.ndarray, n0: np.ndarray, n1: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """``log_ratio_table`` of the chosen rows, summed by expression."""
    keys, at = np.unique(gram[rows], return_inverse=True)
    return log_ratio_table(keys, *(np.bincount(at, n[rows], len(keys)).astype(np.int64) for n in (n0, n1)))


def features(data: np.ndarray, off: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    """Per text: mean log ratio, largest sum over a word, mean of the three
    largest, share and (log) number of words above CLEAR, log length."""
    n = len(off) - 1
    text, ends = _texts(data, off)
    out = np.zeros((n, N_FEATURES))
    if not n:
        return out
    r = ratio[_grams(text)].astype(np.int64)
    r[(ends[:-1][:, None] + np.arange(ORDER - 1)).ravel()] = 0
    size = np.diff(off)
    out[:, 0] = np.add.reduceat(r, ends[:-1]) / _STEP / np.maximum(size, 1)
    # a word is its symbols and the sign that ends it
    after = np.ones(len(text), bool)
    after[1:] = _SYMBOL[text[:-1]] == 0
    begin = after & (_SYMBOL[text] != 0)
    begin[ends[:-1]] = True  # signs before a text's first word
    at = np.flatnonzero(begin)
    word = np.add.reduceat(r, at) / _STEP
    owner = np.searchsorted(ends, at, side="right") - 1
    order = np.lexsort((-word, owner))
    rank = np.arange(len(order)) - np.searchsorted(owner, owner[order])
    best = np.zeros((n, 3))
    top = rank < 3
    best[owner[order[top]], rank[top]] = np.maximum(word[order[top]], 0)
    words = np.bincount(owner, minlength=n)
    clear = np.bincount(owner, word > CLEAR, n)
    out[:, 1], out[:, 2] = best[:, 0], best.mean(1)
    out[:, 3], out[:, 4], out[:, 5] = clear / np.maximum(words, 1), np.log1p(clear), np.log1p(size)
    return out


def _features_of(table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = B.buffers(batch.column(0))
            parts = [features(data[off[a]:off[b]], off[a:b + 1] - off[a], table.value) for a, b in B.slices(off)]
            x = np.concatenate(parts) if parts else np.zeros((0, N_FEATURES))
            cells = pa.array([row.tobytes() for row in x], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(1), cells], ["toxic", "x"])

    return run


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.3, rounds: int = 60) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Newton's method with halved steps where the loss would rise. Returns
    means, deviations and weights (the last: constant)."""
    mean, dev = x.mean(0), x.std(0) + 1e-9
    z = np.column_stack([(x - mean) / dev, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    w[-1] = np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6))

    def loss(w: np.ndarray) -> float:
        m = z @ w
        return float(np.logaddexp(0, m).sum() - y @ m + ridge / 2 * w @ w)

    now = loss(w)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (p - y) + ridge * w
        hess = (z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        while (new := loss(w - step)) > now and np.abs(step).max() > 1e-9:
            step = step / 2
        w, now = w - step, new
        if np.abs(step).max() < 1e-8:
            break
    return mean, dev, w


def _scores(model: tuple, column: pa.Array) -> np.ndarray:
    table, (mean, dev, w), base = model
    data, off = B.buffers(column)
    out = []
    for a, b in B.slices(off):
        if table is None:
            out.append(np.full(b - a, base))
            continue
        x = (features(data[off[a]:off[b]], off[a:b + 1] - off[a], table) - mean) / dev
        out.append(1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30))))
    return np.concatenate(out) if out else np.zeros(0)


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(_scores(model.value, batch.column(1)))],
                                             ["doc_id", "held_out", "score"])

    return run


def _ordinary(model, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_scores(model.value, batch.column(text_at)) < THRESHOLD))

    return run


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the decimal doc_id, modulo ``folds``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def labelled(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, text, label) of the documents that have a label. Texts are dealt
    by doc_id once, by the same plan at every size."""
    marks = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")) \
        .agg(F.max(F.col(label).cast("int")).alias("label"))
    return docs.join(marks.hint("merge"), "doc_id").select("doc_id", "text", "label")


def _out_of_fold(held_out: tuple[int, int]) -> Column:
    return F.coalesce(fold(F.col("doc_id"), held_out[0]) == held_out[1], F.lit(False))


def _learn(docs: DataFrame, labels: DataFrame, held_out: tuple[int, int]):
    """The broadcast model (table, fit, share of toxic labels)."""
    spark = ready(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out_of_fold = _out_of_fold(held_out)
    train = labelled(docs.filter(F.col("doc_id").isNotNull() & ~out_of_fold), labels.filter(~out_of_fold), "toxic")
    train = train.withColumn("fold", F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int"))
    counts = (train.select("text", "label", "fold").mapInArrow(_count, "gram long, n0 long, n1 long, fold int")
              .groupBy("gram", "fold").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toArrow())
    gram, part, n0, n1 = (counts.column(k).to_numpy() for k in range(4))
    table, fitted, base = None, (None, None, None), 0.0
    if not (n0.sum() and n1.sum()):
        base = float(train.agg(F.avg("label")).first()[0] or 0.0)
        return spark.sparkContext.broadcast((table, fitted, base))
    table = _table_of(gram, n0, n1, np.ones(len(gram), bool))
    n, mark = labels.count(), written()
    share = min(1.0, MAX_CALIBRATION / max(n, 1))  # a hash decides, so the sample is the same each time
    sample = train.filter(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1_000_000)) < int(share * 1_000_000))
    sample = materialize(sample, "calibration")  # read once for each fold
    xs, ys = [], []
    for k in range(FOLDS):
        other = part != k
        if not (n0[other].sum() and n1[other].sum()):
            continue
        held = spark.sparkContext.broadcast(_table_of(gram, n0, n1, other))
        rows = sample.filter(F.col("fold") == k).select("text", "label").mapInArrow(
            _features_of(held), "toxic int, x binary").toArrow()
        held.unpersist()
        xs.append(np.frombuffer(b"".join(rows.column(1).to_pylist()), np.float64).reshape(-1, N_FEATURES))
        ys.append(rows.column(0).to_numpy().astype(float))
    drop_tables(spark, written_since(mark))
    y = np.concatenate(ys) if ys else np.zeros(0)
    if 0 < y.sum() < len(y):
        x = np.concatenate(xs)
        order = np.lexsort(x.T)  # rows come in no fixed order
        fitted = fit_logistic(x[order], y[order])
    else:  # too few rows to fit on: the mean ratio decides
        fitted = (np.zeros(N_FEATURES), np.ones(N_FEATURES), np.array([20.0] + [0.0] * (N_FEATURES - 1) + [-1.0]))
    return spark.sparkContext.broadcast((table, fitted, base))


def toxicity(docs: DataFrame, labels: DataFrame, held_out: tuple[int, int] = (4, 2)) -> DataFrame:
    """(doc_id, text) rows and (doc_id, toxic) labels -> doc_id, held_out,
    score, predicted of each row. Rows whose fold is ``held_out`` (modulus,
    remainder) teach nothing."""
    model = _learn(docs, labels, held_out)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = rows.select("doc_id", "text", _out_of_fold(held_out).alias("held_out")).mapInArrow(
        _score(model), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame, held_out: tuple[int, int] = (4, 2)) -> DataFrame:
    """``docs`` without the rows predicted to be toxic, columns unchanged."""
    return docs.mapInArrow(_ordinary(_learn(docs, labels, held_out), docs.columns.index("text")), docs.schema)
