"""Corpus cleaning pipeline over ``documents``: each stage is one operator of
``tidemark.llm``; its result is written as Parquet in the shared checkpoint
folder and read again as the next stage's documents.

A stage's own intermediate tables are deleted when the next stage begins, since
its result has been written by then. All stages but the last return the columns
of ``documents``; rows keep every other column they came with. A document whose text is null or empty passes the
filters (its toxicity score permitting) and is packed as the end token alone.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.decontaminate import decontaminate
from tidemark.llm.near_dedup import one_of_each
from tidemark.llm.packing import pack
from tidemark.llm.suffix_dedup import remove_repeats
from tidemark.llm.toxicity import without_toxic
from tidemark.session import drop_tables, materialize, written, written_since


_left: dict[str, list[str]] = {}  # by application: tables the stage before has left


def _stage(f: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    @wraps(f)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        app = spark.sparkContext.applicationId
        drop_tables(spark, _left.pop(app, []))
        mark = written()
        out = f(spark, docs, sf_dir)
        _left[app] = written_since(mark)
        return out

    return run_stage


@_stage
def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the operator predicts to be toxic go."""
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@_stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate class stays: that of its smallest doc_id."""
    return one_of_each(docs)


@_stage
def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages are cut out of the texts; n_chars follows the text.
    Bytes of a character that a cut has split are dropped with it."""
    frame, new = remove_repeats(docs, kept="text")
    cut = new["n_removed"] > 0
    changed = {"text": F.when(cut, new["kept"]).otherwise(_column(docs, "text"))}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(cut, F.length(new["kept"]).cast("long")).otherwise(_column(docs, "n_chars"))
    return frame.select(*[changed.get(c, _column(docs, c)).alias(c) for c in docs.columns])


def _column(docs: DataFrame, name: str) -> Column:
    return F.col(f"c{docs.columns.index(name)}")


@_stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark text go."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@_stage
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left is packed into training sequences."""
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", reject_toxic),
    ("minhash near-dedup", near_dedup),
    ("suffix-array dedup", suffix_dedup),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", packing),
]

#: SQL cannot express the learned first stage; tests/llm holds run() against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
