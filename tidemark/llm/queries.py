"""The registered queries of this folder: each applies its operator, with
production parameters, to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate as D
from . import token_counts as K
from .html_extract import extract
from .manifest import manifest
from .near_dedup import near_duplicates
from .packing import pack
from .passage_dedup import remove_passages
from .quality import quality
from .suffix_dedup import remove_repeats
from .token_align import align
from .topk import top_k
from .toxicity import toxicity
from .url_filter import judge


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame, c = D.decide(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark"))
    ids = F.array_join(F.array_sort(F.transform(c["items"], lambda x: x.cast("string"))), ",")
    return frame.select(F.col("c0").alias("doc_id"), c["n_words"].alias("n_words"), c["n_hit"].alias("n_hit"),
                        c["n_items"].alias("n_items"), F.sha2(ids, 256).alias("items_sha256"),
                        c["contaminated"].alias("contaminated"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"))


def op4_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(_table(spark, sf_dir, "pages"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = K.answers(K.stored_counts(_table(spark, sf_dir, "documents")), K.LIMIT)
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("fit_bytes") < F.col("n_bytes")).alias("over_limit"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame, c = remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    names = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
    return frame.select(F.col("c0").alias("doc_id"), *[c[n].alias(n) for n in names])


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(_table(spark, sf_dir, "pages"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(_table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return manifest(_table(spark, sf_dir, "documents"), {"text": lower}, F.crc32(F.col("doc_id").cast("string")) % 5 == 0)


def op13_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame, c = remove_passages(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return frame.select(F.col("c0").alias("doc_id"), *[c[n].alias(n) for n in ("n_words", "n_removed", "kept_sha256")])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_decontaminate, op2_quality, op3_best_fit_packing, op4_html_extract, op5_token_counts, op6_suffix_dedup, op7_top_k, op8_toxicity, op9_near_duplicates, op10_url_filter,
                            op11_token_alignment, op12_merkle_manifest, op13_passage_dedup)
}
