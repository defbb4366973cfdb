"""Sequence numbering under skew, archived-log reading, Kafka start offsets."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.offsets import resolve_offsets, starting_offsets_json
from tidemark.operators.sequence import sequence_number
from tidemark.session import scratch_path
from tidemark.sources.log import read_archive
from tidemark.sources.topics import SourceTopic


def test_sequence_number_hot_group(spark):
    # one group holds two thirds of the rows; 16 range partitions
    df = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("cold")).otherwise(F.lit("hot")).alias("g"),
        ((F.col("id") * 7919) % 100003).alias("k"), F.col("id"))
    got = sequence_number(df, ["k", "id"], "n", group_cols=["g"], num_partitions=16)
    w = Window.partitionBy("g").orderBy("k", "id")
    exp = df.withColumn("n", F.row_number().over(w) - 1)
    a = {(r.g, r.id): r.n for r in got.collect()}
    b = {(r.g, r.id): r.n for r in exp.collect()}
    assert a == b


def test_sequence_number_global(spark):
    df = spark.range(0, 5000).select(((F.col("id") * 31) % 97).alias("ts"), F.col("id"))
    got = {r.id: r.n for r in sequence_number(df, ["ts", "id"], "n", num_partitions=7).collect()}
    exp = {r.id: r.n for r in df.withColumn("n", F.row_number().over(Window.orderBy("ts", "id")) - 1).collect()}
    assert got == exp


def test_read_archive_and_starting_offsets(spark):
    base = scratch_path(spark, "archive-test")
    rows = [("a", 0, 0, 100, "k", "v"), ("a", 0, 1, 200, None, None), ("a", 1, 0, 150, "k", "v")]
    spark.createDataFrame(rows, "topic string, partition int, offset long, timestamp_ms long, key string, value string") \
        .drop("topic").write.parquet(f"{base}/a")
    spark.createDataFrame([(0, 5, 1000)], "partition int, offset long, timestamp_ms long").write.parquet(f"{base}/b")
    log = read_archive(spark, {"a": f"{base}/a", "b": f"{base}/b"})
    assert sorted((r.topic, r.partition, r.offset) for r in log.collect()) == [
        ("a", 0, 0), ("a", 0, 1), ("a", 1, 0), ("b", 0, 5)]
    ranges = resolve_offsets(log, [SourceTopic.from_absolute_time("a", 150), SourceTopic.from_latest("b")])
    js = starting_offsets_json(ranges.collect())
    assert js == '{"a": {"0": 1, "1": 0}, "b": {"0": 6}}'


def test_cover_min_long_intervals(spark):
    """Mark over idle partitions: segment-tree blocks equal brute force."""
    import random
    from tidemark.operators.watermark import cover_min
    rnd = random.Random(5)
    e_end = 700
    rows = []
    for p in range(12):
        s = rnd.randint(0, 200)
        while s <= e_end:
            t = min(e_end, s + rnd.choice([0, 1, 3, 70, 150, 500]))
            rows.append((s, t, rnd.choice([10, 20, 20, 30, 40])))
            s = t + 1 + rnd.randint(0, 5)
    df = spark.createDataFrame(rows, "epoch long, until long, value long")
    got = {r.epoch: (r.min_value, r.at_min) for r in cover_min(df, e_end).collect()}
    exp = {}
    for e in range(e_end + 1):
        vals = [v for s, t, v in rows if s <= e <= t]
        if vals:
            exp[e] = (min(vals), vals.count(min(vals)))
    assert got == exp
