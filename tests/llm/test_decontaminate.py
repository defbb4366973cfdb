import random

import brute
import cases
import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontaminate as D


def items():
    rng = random.Random(5)
    base = cases.awkward()[0][1]
    w = base.split()
    return [(1, " ".join(w[10:40])), (2, "one two"), (3, None), (4, ""), (5, " ".join(w[30:43])), (5, "日本語"),
            (10, cases.prose(rng, 30)), (2, "one two"), (None, " ".join(w[80:100])), (7, "."), (8, "z" * 150)]


def result(spark, docs, bench):
    frame, c = D.decide(docs.select("doc_id", "text"), bench)
    ids = F.array_join(F.array_sort(F.transform(c["items"], lambda x: x.cast("string"))), ",")
    rows = frame.select("c0", c["n_words"], c["n_hit"], c["n_items"], F.sha2(ids, 256), c["contaminated"]).collect()
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("block,segment", [(512, 4096), (2, 5)])
def test_against_brute_force(spark, monkeypatch, block, segment):
    """Also with the benchmark in many small blocks (several passes)."""
    monkeypatch.setattr(D, "BLOCK", block)
    monkeypatch.setattr(D, "SEGMENT", segment)
    w = cases.awkward()[0][1].split()
    rows = cases.awkward([(20, "a b " + " ".join(w[12:26]) + " c"), (21, " ".join(w[10:22])), (22, "Z" * 150 + " one TWO"),
                          (23, cases.prose(random.Random(6), 400) + " " + " ".join(w[30:43]))])
    bench = spark.createDataFrame(items(), "item_id long, text string")
    assert result(spark, cases.frame(spark, rows), bench) == sorted(brute.contamination(rows, items()), key=str)


def test_longest_matches(spark):
    w = [f"w{k}" for k in range(60)]
    docs = spark.createDataFrame([(1, "x y " + " ".join(w[5:45]) + " z " + " ".join(w[20:40]))], "doc_id long, text string")
    frame, c = D.benchmark_matches(docs, spark.createDataFrame([(9, " ".join(w))], "item_id long, text string"))
    found = {tuple(m) for m in frame.select(c["matches"].alias("m")).first()["m"]}
    assert found == {(9, 5, 2, 40), (9, 20, 43, 20)}


def test_removal_keeps_columns(spark):
    rows = cases.awkward()
    docs = cases.frame(spark, rows)
    bench = spark.createDataFrame(items(), "item_id long, text string")
    out = D.decontaminate(docs, bench)
    assert out.schema == docs.schema
    clean = [r[0] for r in brute.contamination(rows, items()) if not r[5]]
    assert sorted(map(str, (r.doc_id for r in out.collect()))) == sorted(map(str, clean))


def test_empty_tables(spark):
    docs, bench = cases.frame(spark, cases.awkward()), spark.createDataFrame([], "item_id long, text string")
    assert D.decontaminate(docs, bench).count() == len(cases.awkward())
    assert result(spark, docs.limit(0), spark.createDataFrame(items(), "item_id long, text string")) == []
