"""URL filter: rules first, then gradient-boosted trees over lexical features
(operator 10). DataFrame functions and MLlib only; no Python runs on executors.

Method. A rule (verdict, host and path) fits its host and all subdomains when
the url's path starts with the rule's; the longest fitting rule decides. The
urls that a rule decides are the labelled urls: trees are boosted on a bounded
sample of them (``TRAIN_ROWS``, chosen by hash) over length, depth, digit and
letter ratios, character entropy, parameter counts, label and hyphen counts,
and the smoothed share of blocked urls among the labelled ones with the same
last two host labels, last label and first path segment. Those shares are
counted over all labelled urls, and hidden in some training rows, as for a
suffix not met before. Where no rule fits, the trees decide.

Defined cases: a null url, or one without "://", has an empty host and path,
fits no rule and is judged by the trees like any other. Repeated rows and null
page_ids are judged each. With labelled urls of one verdict only, that verdict
is given; with none, "allow". Between fitting rules of one length, block wins.
Extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: fixed values: the rules of the contract
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))
TRAIN_ROWS = 20_000
TREES = 15
DEPTH = 4
SMOOTHING = 20.0
UNSEEN = 3  # in one of so many training rows a share is hidden, so that the trees learn to do without it
SEED = 11
_COUNTED = "abcdefghijklmnopqrstuvwxyz0123456789-._~%/?=&#:+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = ["length", "host_length", "path_length", "depth", "digits", "letters", "entropy", "parameters",
            "query_length", "labels", "hyphens", "fragment", "suffix_share", "last_share", "segment_share"]


def host_and_path(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^([^/?#]*)([^?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), F.regexp_extract(rest, "^([^/?#]*)([^?#]*)", 2)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (rule, verdict) of the longest fitting rule, or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    order = sorted(rules, key=lambda r: (len(r[1] + r[2]), r[0] == "block"))
    for verdict, h, p in order:  # the last one asked is the longest
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _count(s: Column, char: str) -> Column:
    return F.length(s) - F.length(F.replace(s, F.lit(char), F.lit("")))


def _lexical(pages: DataFrame) -> DataFrame:
    url = F.translate(F.coalesce("url", F.lit("")), _UPPER, _LOWER)
    n = F.greatest(F.length(url), F.lit(1))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    counts = {c: _count(url, c) / n for c in _COUNTED}
    total = lambda chars: reduce(lambda a, b: a + b, [counts[c] for c in chars])
    entropy = reduce(lambda a, b: a + b, [F.when(p > 0, -p * F.log2(p)).otherwise(F.lit(0.0)) for p in counts.values()])
    labels = F.split("host", r"\.")
    return pages.select(
        "*", F.length(url).cast("double").alias("length"), F.length("host").cast("double").alias("host_length"),
        F.length("path").cast("double").alias("path_length"), _count(F.col("path"), "/").cast("double").alias("depth"),
        total("0123456789").alias("digits"), total(_LOWER).alias("letters"), entropy.alias("entropy"),
        (F.when(query != "", F.lit(1)).otherwise(F.lit(0)) + _count(query, "&")).cast("double").alias("parameters"),
        F.length(query).cast("double").alias("query_length"), F.size(labels).cast("double").alias("labels"),
        _count(F.col("host"), "-").cast("double").alias("hyphens"), url.contains("#").cast("double").alias("fragment"),
        F.concat_ws(".", F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2)).alias("suffix"),
        F.element_at(labels, -1).alias("last"), F.regexp_extract("path", "^/([^/]*)", 1).alias("segment"))


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, url) rows -> page_id, host, path, rule, verdict of each row."""
    host, path = host_and_path(F.col("url").cast("string"))
    rows = pages.select(F.col("page_id"), F.col("url").cast("string").alias("url"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("hit", rule_of(F.col("host"), F.col("path"), rules))
    rows = _lexical(rows).withColumn("blocked", (F.col("hit.verdict") == "block").cast("double"))
    known = rows.filter(F.col("hit").isNotNull())
    total = known.agg(F.count(F.lit(1)).alias("n"), F.sum("blocked").alias("blocked")).first()
    n, blocked = total["n"], total["blocked"] or 0.0
    if not 0 < blocked < n:
        other = F.lit("block" if n and blocked == n else "allow")
        return rows.select("page_id", "host", "path", F.col("hit.rule").alias("rule"),
                           F.coalesce("hit.verdict", other).alias("verdict"))
    prior = blocked / n
    for name, share in (("suffix", "suffix_share"), ("last", "last_share"), ("segment", "segment_share")):
        stats = known.groupBy(name).agg(F.sum("blocked").alias("_b"), F.count(F.lit(1)).alias("_n"))
        stats = stats.select(name, ((F.col("_b") + SMOOTHING * prior) / (F.col("_n") + SMOOTHING)).alias(share))
        rows = rows.join(stats, name, "left").withColumn(share, F.coalesce(share, F.lit(prior)))
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    sample = rows.filter(F.col("hit").isNotNull())
    if n > TRAIN_ROWS:
        cut = int(TRAIN_ROWS / n * 1_000_000)
        sample = sample.filter(F.pmod(F.xxhash64("url", F.col("page_id").cast("string")), F.lit(1_000_000)) < cut)
    for share in ("suffix_share", "last_share", "segment_share"):  # as if not met before, in some of the rows
        unseen = F.pmod(F.xxhash64("url", F.lit(share)), F.lit(UNSEEN)) == 0
        sample = sample.withColumn(share, F.when(unseen, F.lit(prior)).otherwise(F.col(share)))
    trees = GBTClassifier(featuresCol="features", labelCol="blocked", maxIter=TREES, maxDepth=DEPTH, seed=SEED,
                          featureSubsetStrategy="onethird", subsamplingRate=0.8)
    model = trees.fit(assembler.transform(sample).select("features", "blocked"))
    chance = vector_to_array(F.col("probability"))[1]
    judged = model.transform(assembler.transform(rows))
    other = F.when(chance >= 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return judged.select("page_id", "host", "path", F.col("hit.rule").alias("rule"),
                         F.coalesce("hit.verdict", other).alias("verdict"))
