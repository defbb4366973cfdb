"""The pipeline against the brute-force statements, on a small table; the
learned first stage is taken from its operator."""

import os

import brute
import corpus_pipeline as P
import test_packing
from conftest import SF_SMALL
from pyspark.sql import Row

from tidemark.llm.toxicity import toxicity


def test_run_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    ordinary = {r.doc_id for r in toxicity(docs, labels).collect() if not r.predicted}
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect() if r.doc_id in ordinary]
    kept = {r[0] for r in brute.near_classes(rows) if r[3]}
    rows = [(i, k.decode("utf-8", "ignore")) for i, *_, k in brute.repeats([r for r in rows if r[0] in kept])]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    clean = {r[0] for r in brute.contamination(rows, items) if not r[5]}
    rows = [r for r in rows if r[0] in clean]
    assert 0 < len(rows) < docs.count()
    test_packing.check(rows, P.run(spark, SF_SMALL).collect(), 2048)


def test_stages_keep_the_columns(spark, tmp_path):
    from cases import awkward, frame
    docs = frame(spark, awkward()).withColumnRenamed("length", "n_chars")
    spark.createDataFrame([(k, k % 2) for k in range(30)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "one two")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    names = [n for n, _ in P.STAGES]
    assert names == ["toxicity", "minhash near-dedup", "suffix-array dedup", "benchmark decontamination", "best-fit packing"]
    for name, stage in P.STAGES[:-1]:
        for rows in (docs, docs.limit(0)):
            out = stage(spark, rows, str(tmp_path))
            assert out.schema.names == docs.schema.names and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema], name
            assert out.count() <= rows.count()


def test_cut_texts_have_their_length(spark):
    text = "é" * 40 + " " + "passage " * 20
    docs = spark.createDataFrame([Row(doc_id=1, text=text, n_chars=201), Row(doc_id=2, text="new " + text, n_chars=205)])
    out = {r.doc_id: r for r in P.suffix_dedup(spark, docs, "").collect()}
    assert all(r.n_chars == len(r.text) for r in out.values()) and out[1].n_chars < 201
    assert os.path.basename(SF_SMALL) == "sf0.001"


def test_near_dedup_keeps_one_row_of_each_class(spark):
    """Null and repeated doc_ids with texts of their own: no class is lost."""
    texts = [" ".join(f"t{k}w{j}" for j in range(40)) for k in range(8)]
    near = texts[0].replace("t0w39", "changed")
    rows = [(None, texts[0]), (None, texts[0]), (None, texts[1]), (None, texts[2]),  # one class twice, two alone
            (5, texts[0]), (6, near),  # the class of the null rows: 5 stays
            (7, texts[3]), (7, texts[4]), (7, texts[3]),  # two classes under one id, one twice
            (8, texts[5]), (8, texts[5] + " more"),  # one class under one id
            (9, ""), (9, ""), (None, None), (None, " ")]  # empty sets: classes of their own
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, row int")
    out = P.near_dedup(spark, docs, "").collect()
    got = sorted([(r.doc_id, r.text) for r in out if r.doc_id != 8], key=str)
    assert got == sorted([(None, texts[1]), (None, texts[2]), (5, texts[0]), (7, texts[3]), (7, texts[4]),
                          (9, ""), (9, ""), (None, None), (None, " ")], key=str)
    assert sum(r.doc_id == 8 for r in out) == 1 and len({r.row for r in out}) == len(out)
    assert all(rows[r.row] == (r.doc_id, r.text) for r in out)
