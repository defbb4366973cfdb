import hashlib
import random

import cases
import pytest
from pyspark.sql import functions as F

from tidemark.llm import manifest as M

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, pos long, block long, path string, digest int"


def H(x):
    return hashlib.sha256(x.encode()).hexdigest()


def leaf(row):
    return H("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in row))


def lower(t):
    return t and "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def tree(nodes):
    """Levels of a tree, the nodes first."""
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H("".join(out[-1][k:k + 16])) for k in range(0, len(out[-1]), 16)])
    return out


def climb(i, node, grown):
    """Siblings and the digest that a node in place i leads to."""
    met = ""
    for level in grown[:-1]:
        run = level[i // 16 * 16:i // 16 * 16 + 16]
        met += "".join(run[:i % 16] + run[i % 16 + 1:])
        node = H("".join(run[:i % 16] + [node] + run[i % 16 + 1:]))
        i //= 16
    return met, node


def brute(rows, tampered):
    """rows: tuples of the fields; tampered: doc_id -> bool."""
    sources = {}
    for r in rows:
        sources.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf(r), r))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    grown = {s: tree([x[2] for x in sorted(sources[s], key=lambda x: x[:3])]) for s in order}
    top = tree([grown[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for i, (_, _, own, r) in enumerate(sorted(sources[s], key=lambda x: x[:3])):
            start = leaf(r[:4] + (lower(r[4]),)) if tampered(r[0]) else own
            low, node = climb(i, start, grown[s])
            high, node = climb(k, node, top)
            out.append((r[0], own, grown[s][-1][0], top[-1][0], H(low + high), node, node == top[-1][0]))
    return sorted(out, key=str)


def answer(spark, rows, parts=3):
    docs = spark.createDataFrame([(*r, "x", 3, 9, "p", 1) for r in rows], SCHEMA).repartition(parts)
    out = M.manifest(docs, {"text": F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")}, F.col("doc_id") % 5 == 0)
    names = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    assert tuple(out.columns) == names
    return sorted((tuple(r) for r in out.collect()), key=str)


def five(doc):
    return doc is not None and doc % 5 == 0


def table(rng, sizes):
    rows, ids = [], list(range(sum(sizes.values())))
    rng.shuffle(ids)
    for s, n in sizes.items():
        rows += [(ids.pop(), s, rng.choice(["en", None]), rng.choice([None, 7]), rng.choice([None, "", "Ab é", "plain", cases.prose(rng, 20).upper()]))
                 for _ in range(n)]
    return rows


@pytest.mark.parametrize("sizes", [
    {"a": 1}, {"a": 2}, {"a": 16}, {"a": 17, None: 1}, {None: 40, "": 257, "b": 256, "é": 255, "z": 1},
    {f"s{k}": 1 + k % 3 for k in range(300)},
    {"hot": 4097, "cold": 3},
])
def test_against_a_plain_tree(spark, sizes):
    rows = table(random.Random(str(sizes)), sizes)
    assert answer(spark, rows) == brute(rows, five)


def test_small_blocks_make_a_deep_tree(spark):
    """Blocks of one run each: four rounds up, four down."""
    rows = table(random.Random(8), {"a": 5000, "b": 17, "c": 1})
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert M.levels(5000, 9) == 4
    got = M.manifest(docs, height=1).select("doc_id", "proof_sha256", "folded_root", "verified").collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted((x[:1] + x[4:] for x in brute(rows, lambda d: False)), key=str)


def test_awkward_rows(spark):
    """Nulls, repeated ids and rows, a long text."""
    rows = [(i, "s" if (i or 0) % 2 else None, None, len(t or ""), t) for i, t in cases.awkward()]
    rows += rows[:3] + [(None, None, None, None, None)]
    assert answer(spark, rows) == brute(rows, five)


def test_midstates():
    kids = [hashlib.sha256(bytes([k])).digest() for k in range(16)]
    p = M.Parent(kids)
    assert p.digest.hex() == H("".join(k.hex() for k in kids))
    for s in range(16):
        other = kids[:s] + [b"\0" * 32] + kids[s + 1:]
        assert p.fold(s, b"\0" * 32) == M.Parent(other).digest and p.fold(s, kids[s]) == p.digest


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, source string, lang string, n_chars long, text string")
    out = M.manifest(docs)
    assert out.count() == 0 and out.columns[0] == "doc_id"
