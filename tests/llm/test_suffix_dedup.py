import random

import brute
import cases
import numpy as np
import pytest

from tidemark.llm import suffix_dedup as S


def result(docs):
    frame, c = S.remove_repeats(docs.select("doc_id", "text"), kept="bytes")
    rows = frame.select("c0", *[c[n] for n in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")]).collect()
    return sorted((tuple(r[:5]) + (bytes(r[5]),) for r in rows), key=str)


def shared(rng, n=60):
    """Texts that share passages of 80 to 400 bytes at their edges and inside."""
    passages = [cases.prose(rng, rng.randint(20, 80)) for _ in range(6)]
    out = []
    for k in range(n):
        parts = [cases.prose(rng, rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, 30)
            parts += [p[a:a + rng.randint(60, 400)], cases.prose(rng, rng.randint(0, 20))]
        out.append((1000 + k, "".join(parts)))
    return out


@pytest.mark.parametrize("chunk", [4 << 20, 3000])
def test_against_brute_force(spark, monkeypatch, chunk):
    """In one chunk per batch and in many: within and across chunks."""
    monkeypatch.setattr(S, "CHUNK_BYTES", chunk)
    rows = cases.awkward(shared(random.Random(3)))
    docs = cases.frame(spark, rows).coalesce(1)
    assert result(docs) == sorted(brute.repeats(rows), key=str)


def test_order_of_documents_decides(spark):
    text = cases.prose(random.Random(1), 60)
    rows = [(9, text), (2, text), (5, text)]
    got = {r[0]: r[2] for r in result(spark.createDataFrame(rows, "doc_id long, text string"))}
    n = len(text.encode())
    assert got == {2: 0, 5: n, 9: n}


def test_segments_and_blocks(spark, monkeypatch):
    """Work cut into small segments and blocks gives the same."""
    data = np.frombuffer(" ".join(t for _, t in shared(random.Random(7), 40)).encode(), np.uint8)
    off = np.array([0, len(data) // 3, len(data)])
    whole = S.anchor_runs(data, off)
    monkeypatch.setattr(S, "SEGMENT", 777)
    cut = S.anchor_runs(data, off)

    def windows(runs):
        return {(p, a, l, r) for a, q1, q2, l, r in zip(*runs) for p in range(q1, q2 + 1) if l and r}

    assert {(p, a) for p, a, _, _ in windows(cut)} <= {(p, a) for a, q1, q2, _, _ in zip(*whole) for p in range(q1, q2 + 1)}
    assert sum(q2 - q1 + 1 for _, q1, q2, _, _ in zip(*cut)) == sum(q2 - q1 + 1 for _, q1, q2, _, _ in zip(*whole))


def test_multikey_order():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    at = rng.integers(0, 2900, 500)
    order, group = S.multikey_order(data, at, 20)
    keys = [data[a:a + 20].tobytes() for a in at[order]]
    assert keys == sorted(keys)
    assert [a == b for a, b in zip(group, group[1:])] == [a == b for a, b in zip(keys, keys[1:])]


def test_later_marks_all_but_the_first():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 50, 400).astype(np.uint64) * np.uint64(1)  # equal in their high bits
    seen = set()
    want = [v in seen or seen.add(v) is not None for v in x.tolist()]
    assert S._later(x).tolist() == want


def test_empty_table_and_columns(spark):
    docs = cases.frame(spark, cases.awkward())
    frame, new = S.remove_repeats(docs.limit(0))
    assert frame.count() == 0 and set(new) == {"n_bytes", "n_removed", "n_spans", "kept_sha256"}
    frame, _ = S.remove_repeats(docs)
    assert [f.dataType for f in frame.schema.fields][:len(docs.columns)] == [f.dataType for f in docs.schema.fields]
    assert frame.count() == docs.count()
