import math
import random

import cases
import numpy as np
import pyarrow as pa

from tidemark.llm import _bytes as B
from tidemark.llm import toxicity as X

BAD = ("vermin", "blighter", "rotter", "swine")


def corpus(n=900, seed=1):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    docs, labels = [], []
    for k in range(n):
        w = [rng.choice(vocab) for _ in range(rng.randint(20, 200))]
        toxic = int(rng.random() < 0.2)
        if toxic:
            for _ in range(max(1, len(w) // 40)):
                w.insert(rng.randrange(len(w)), rng.choice(BAD))
        docs.append((k, " ".join(w)))
        if rng.random() < 0.7:
            labels.append((k, toxic))
    return docs, labels


def test_held_out_accuracy_and_defined_cases(spark):
    docs, labels = corpus()
    rows = docs + [(5000, None), (5001, ""), (None, "vermin rotter swine vermin"), (0, docs[0][1]), (5002, "swine vermin " * 5000)]
    out = X.toxicity(cases.frame(spark, rows), spark.createDataFrame(labels + [(None, 1), (3, None)], "doc_id long, toxic int")).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    assert all(r.predicted == int(r.score >= 0.3) for r in out)
    import zlib
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    truth = dict(labels)
    held = [(r.predicted, truth[r.doc_id]) for r in out if r.held_out and r.doc_id in truth]
    assert len(held) > 80 and np.mean([a == b for a, b in held]) > 0.95
    assert [r.predicted for r in out if r.doc_id is None] == [1]


def test_without_toxic_keeps_columns_and_clean_rows(spark):
    docs, labels = corpus()
    frame, marks = cases.frame(spark, docs), spark.createDataFrame(labels, "doc_id long, toxic int")
    kept = X.without_toxic(frame, marks)
    assert kept.schema == frame.schema
    judged = {r.doc_id for r in X.toxicity(frame, marks).collect() if not r.predicted}
    assert {r.doc_id for r in kept.collect()} == judged


def test_labels_of_one_class_or_none(spark):
    docs = cases.frame(spark, corpus(40)[0])
    some = X.toxicity(docs, spark.createDataFrame([(k, 1) for k in range(20)], "doc_id long, toxic int")).collect()
    none = X.toxicity(docs, spark.createDataFrame([], "doc_id long, toxic int")).collect()
    assert {r.score for r in some} == {1.0} and {r.score for r in none} == {0.0}
    assert X.toxicity(docs.limit(0), spark.createDataFrame([], "doc_id long, toxic int")).count() == 0


def kneser_ney(gram, n0, n1, key):
    """log P(toxic) - log P(ordinary) of one expression, as the text states it."""
    def digits(g):
        return tuple(g >> 5 * k & 31 for k in reversed(range(X.ORDER)))

    kinds = {digits(int(g)) for g in gram}
    full = kinds

    def shared(x):
        if not x:
            return 1 / 32
        low = shared(x[1:]) if len(x) > 1 else 1 / 32
        tails = full
        for _ in range(X.ORDER - len(x) - 1):
            tails = {t[1:] for t in tails}
        left = {}
        for t in tails:
            if t[1:-1] == x[:-1]:
                left[t[-1]] = left.get(t[-1], 0) + 1
        total = sum(left.values())
        return low if not total else (max(left.get(x[-1], 0) - X.DISCOUNT, 0) + X.DISCOUNT * len(left) * low) / total

    logs = []
    for n in (n0, n1):
        count = {digits(int(g)): int(c) for g, c in zip(gram, n) if c and digits(int(g))[:-1] == key[:-1]}
        total, low = sum(count.values()), shared(key[1:])
        p = (max(count.get(key, 0) - X.DISCOUNT, 0) + X.DISCOUNT * len(count) * low) / total if total else low
        logs.append(math.log(p))
    return logs[1] - logs[0]


def test_table_is_kneser_ney():
    docs, labels = corpus(60)
    truth = dict(labels)
    batch = pa.RecordBatch.from_arrays([pa.array([t for k, t in docs if k in truth]), pa.array([truth[k] for k, _ in docs if k in truth]),
                                       pa.array([0] * len(truth))], ["t", "l", "f"])
    out = next(X._count(iter([batch])))
    gram, n0, n1 = (out.column(k).to_numpy() for k in range(3))
    table = X.log_ratio_table(gram, n0, n1)
    rng = np.random.default_rng(1)
    keys = [*rng.choice(gram, 12), *rng.integers(0, 1 << 25, 6)]
    for g in map(int, keys):
        want = kneser_ney(gram, n0, n1, tuple(g >> 5 * k & 31 for k in reversed(range(X.ORDER))))
        assert abs(table[g] - np.clip(round(want * X._STEP), -127, 127)) <= 1


def test_features_do_not_cross_texts():
    ratio = np.random.default_rng(2).integers(-20, 20, 1 << 25).astype(np.int8)
    texts = ["abc", "", "hello world " * 30, "x", "final text here"]
    data, off = B.buffers(pa.array(texts))
    together = X.features(data, off, ratio)
    for k, t in enumerate(texts):
        assert np.allclose(together[k], X.features(*B.buffers(pa.array([t])), ratio)[0])
