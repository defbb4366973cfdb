import random
import zlib

import cases
import numpy as np
import pyarrow as pa

from tidemark.llm import _bytes as B
from tidemark.llm import quality as Q


def corpus(n=500, seed=3):
    rng = random.Random(seed)
    docs, labels = [], []
    for k in range(n):
        good = int(rng.random() < 0.6)
        text = cases.prose(rng, rng.randint(10, 300))
        if not good:
            text = " ".join(w + rng.choice(["$$$", "%%%"]) if rng.random() < 0.7 else w for w in text.split())
        docs.append((k, text))
        if rng.random() < 0.7:
            labels.append((k, good))
    return docs, labels


def test_held_out_accuracy_and_defined_cases(spark):
    docs, labels = corpus()
    rows = docs + [(9000, None), (9001, ""), (9002, " \n"), (None, "w$$$ " * 100), (1, docs[1][1]), (9003, "plain words here " * 8000)]
    out = Q.quality(cases.frame(spark, rows), spark.createDataFrame(labels + [(None, 0), (2, None)], "doc_id long, quality int")).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    assert all(r.predicted == int(r.score >= 0.5) for r in out)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)
    truth = dict(labels)
    held = [(r.predicted, truth[r.doc_id]) for r in out if r.held_out and r.doc_id in truth]
    assert len(held) > 60 and np.mean([a == b for a, b in held]) > 0.95


def test_labels_of_one_class_or_none(spark):
    docs = cases.frame(spark, corpus(30)[0])
    one = Q.quality(docs, spark.createDataFrame([(k, 1) for k in range(30)], "doc_id long, quality int")).collect()
    none = Q.quality(docs, spark.createDataFrame([], "doc_id long, quality int")).collect()
    assert {r.score for r in one} == {1.0} and {r.score for r in none} == {0.5}
    assert Q.quality(docs.limit(0), spark.createDataFrame([], "doc_id long, quality int")).count() == 0


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(1)
    x, first, y = rng.normal(0, 1, (12, Q.N_FEATURES)), np.array([0, 3, 4, 12]), np.array([1.0, 0.0, 1.0])
    net = Q.Network(x)

    def loss():
        s = net.forward(x, first)["score"]
        return -(y * np.log(s) + (1 - y) * np.log(1 - s)).mean()

    for name, g in net.gradients(x, first, y).items():
        flat, grad = net.p[name].reshape(-1), g.reshape(-1)
        for k in rng.choice(len(flat), min(4, len(flat)), replace=False):
            was = flat[k]
            flat[k] = was + 1e-5
            up = loss()
            flat[k] = was - 1e-5
            down = loss()
            flat[k] = was
            assert abs((up - down) / 2e-5 - grad[k]) < 1e-5


def test_attention_sums_to_one_and_texts_are_apart():
    texts = ["a b c " * 100, "", "word", "x " * 64, "y " * 65]
    together, first = Q.passage_features(*B.buffers(pa.array(texts)))
    assert np.diff(first).tolist() == [5, 1, 1, 1, 2]
    for k, t in enumerate(texts):
        alone, _ = Q.passage_features(*B.buffers(pa.array([t])))
        got = together[first[k]:first[k + 1]].copy()
        assert np.allclose(got[:, :Q._KINDS + 9], alone[:, :Q._KINDS + 9])
    state = Q.Network(together).forward(together, first)
    assert np.allclose(np.add.reduceat(state["weight"], first[:-1]), 1)
