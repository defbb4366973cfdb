import hashlib
import random
import re
from collections import Counter

import cases
import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import passage_dedup as P

SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    words = [SPACED.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[i:i + 35]) for w in words for i in range(len(w) - 34))
    out = []
    for (doc, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - 34):
            if seen[tuple(w[i:i + 35])] > 1:
                gone |= set(range(i, i + 35))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out, key=str)


def answer(docs):
    frame, c = P.remove_passages(docs, kept=True)
    return sorted((tuple(r) for r in frame.select("c0", c["n_words"], c["n_removed"], c["kept_sha256"], c["kept"]).collect()), key=str)


def shared(rng, n=150):
    """Passages of 30 to 120 words, whole and in part, between other words and at edges."""
    pool = [cases.prose(rng, 120).split() for _ in range(5)]
    out = []
    for k in range(n):
        words = []
        for _ in range(rng.randint(1, 4)):
            p = rng.choice(pool)
            a = rng.randint(0, 60)
            words += cases.prose(rng, rng.choice([0, 1, 5, 20, 40])).split() + p[a:a + rng.choice([30, 34, 35, 36, 40, 54, 55, 56, 60])]
        out.append((1000 + k, rng.choice([" ", "  ", "\n", "\t\r"]).join(words) + rng.choice(["", " ", "\n"])))
    return out


def test_cover():
    """Each shift takes two of its places to each other, so any two places meet on it."""
    for d in range(P.PERIOD):
        assert any((x + d) % P.PERIOD in P.COVER for x in P.COVER)


@pytest.mark.parametrize("seed, parts", [(1, 1), (2, 7)])
def test_against_brute_force(spark, seed, parts):
    rng = random.Random(seed)
    rows = cases.awkward(shared(rng)) + [(50, "a " * 500), (51, "a " * 34), (52, "a b " * 40), (53, " ".join("w" * (60 + k % 9) for k in range(80))),
                                         (53, " ".join("w" * (60 + k % 9) for k in range(80)))]
    rng.shuffle(rows)
    assert answer(cases.frame(spark, rows).select("doc_id", "text").repartition(parts)) == brute(rows)


def test_case_counts_and_other_columns_stay(spark):
    rng = random.Random(9)
    text = cases.prose(rng, 80)
    docs = cases.frame(spark, [(1, text), (2, text.upper()), (3, text.replace(" ", "\n"))])
    frame, c = P.remove_passages(docs)
    assert [f.dataType for f in frame.schema.fields][:len(docs.columns)] == [f.dataType for f in docs.schema.fields]
    assert {r[0]: r[1] for r in frame.select("c0", c["n_removed"]).collect()} == {1: 80, 2: 0, 3: 80}


def test_table_of_chunks_goes(spark):
    before = {t.name for t in spark.catalog.listTables()}
    frame, _ = P.remove_passages(spark.createDataFrame([(1, "a b")], "doc_id long, text string"))
    assert frame.count() == 1 and {t.name for t in spark.catalog.listTables()} == before


def batches(rows, names, rng, kinds):
    """Sorted rows in batches of one to five."""
    out, at = [], 0
    while at < len(rows):
        n = rng.randint(1, 5)
        out.append(pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows[at:at + n]], t) for k, t in enumerate(kinds)], names))
        at += n
    return out


@pytest.mark.parametrize("seed", range(30))
def test_streamed_marks(seed):
    """Marks do not depend on how a task's rows fall into batches."""
    rng = random.Random(seed)
    rows = sorted((rng.randint(0, 6), rng.randint(0, 3), 0, k) for k in range(40))
    got = {}
    for b in P._mark(iter(batches(rows, ["anchor", "around", "chunk", "word"], rng, [pa.int64(), pa.int64(), pa.int64(), pa.int32()]))):
        for m in b.column("mark").to_pylist():
            assert m >> 2 not in got
            got[m >> 2] = m & 3
    twins, kinds = Counter(r[:2] for r in rows), Counter(a for a, _ in {r[:2] for r in rows})
    edge = {rows[0][0], rows[-1][0]}
    seen, want = set(), {}
    for a, c, _, k in rows:
        state = P.TWIN * (twins[a, c] > 1) + P.WITNESS * ((kinds[a] > 1 or a in edge) and (a, c) not in seen)
        seen.add((a, c))
        if state:
            want[k] = state
    assert got == want


@pytest.mark.parametrize("seed", range(30))
def test_streamed_verdicts(seed):
    rng = random.Random(seed)
    rows = sorted((rng.randint(0, 9), 0, c, 0, rng.random() < 0.6) for c in range(30))
    sure, border = set(), []
    for b in P._judge(iter(batches(rows, ["h1", "h2", "chunk", "word", "asks"], rng, [pa.int64()] * 3 + [pa.int32(), pa.bool_()]))):
        for r in b.to_pylist():
            if r["kind"] == P.SURE:
                assert r["chunk"] not in sure
                sure.add(r["chunk"])
            else:
                border.append((r["h1"], r["kind"], r["chunk"]))
    many = Counter(r[0] for r in rows)
    assert sure == {r[2] for r in rows if many[r[0]] > 1 and r[4]}
    assert sorted(x[0] for x in border) == sorted({rows[0][0], rows[-1][0]})
    for h, kind, chunk in border:
        assert (kind == P.OPEN) == (many[h] == 1 and any(r[0] == h and r[4] for r in rows))


def test_segments(monkeypatch):
    """Bytes and words worked on in small segments give the same."""
    rng = random.Random(4)
    texts = [t or "" for _, t in cases.awkward()] + ["x" * 300, " " * 200, "a b " * 100]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    off = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    whole = P.Words(data, off)
    monkeypatch.setattr(P, "SEGMENT", 97)
    cut = P.Words(data, off)
    for x, y in zip((whole.start, whole.end, *whole.hash, whole.off), (cut.start, cut.end, *cut.hash, cut.off)):
        assert (x == y).all()
    for x, y in zip(P.anchors(whole), P.anchors(cut)):
        monkeypatch.setattr(P, "SEGMENT", 1 << 20)
        assert (x == y).all()
    found = [data[a:b].tobytes().decode() for a, b in zip(whole.start, whole.end)]
    assert found == [w for t in texts for w in SPACED.findall(t)]


def test_empty_table(spark):
    frame, new = P.remove_passages(cases.frame(spark, cases.awkward()).limit(0))
    assert frame.count() == 0 and set(new) == {"n_words", "n_removed", "kept_sha256"}
