"""Offset-range resolution over a message log.

Every policy is resolved in ONE pass over the log: a single
``groupBy(topic, partition)`` computes the low / high watermark and, for timed
policies, the first offset at or after the topic's target time. Targets are
per-topic literals (specs are driver-side arguments), so Catalyst folds them
and pushes ``topic IN (...)`` into the scan.
"""

from __future__ import annotations

import json
from typing import Any, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import TP
from ..sources.topics import START_OF_DAY, SourceTopic, validate_topics


_EPOCH_NTZ = "timestamp_ntz'1970-01-01 00:00:00'"


def start_of_day_target(as_of_ms: int, time_ms: int, timezone: str) -> Column:
    """Local midnight (in ``timezone``) of the day containing ``as_of_ms``,
    plus ``time_ms``, as epoch ms. A constant expression that Catalyst folds."""
    secs = f"{as_of_ms // 1000}.{as_of_ms % 1000:03d}"
    as_of_utc = F.expr(f"{_EPOCH_NTZ} + make_dt_interval(0, 0, 0, {secs})")
    local = F.convert_timezone(F.lit("UTC"), F.lit(timezone), as_of_utc)
    midnight_utc = F.convert_timezone(F.lit(timezone), F.lit("UTC"), F.date_trunc("DAY", local).cast("timestamp_ntz"))
    return F.timestamp_diff("MILLISECOND", F.expr(_EPOCH_NTZ), midnight_utc) + F.lit(int(time_ms))


def policy_target(topic: SourceTopic, as_of_ms: int | None) -> Column | None:
    """The target time (epoch ms) of a timed policy, else None."""
    if topic.policy == "absolute_time":
        return F.lit(int(topic.time_ms))
    if topic.policy == "relative_time":
        if as_of_ms is None:
            raise ValueError("relative_time needs an explicit as_of_ms")
        return F.lit(int(as_of_ms) - int(topic.time_ms))
    if topic.policy == START_OF_DAY:
        if as_of_ms is None:
            raise ValueError("start_of_day needs an explicit as_of_ms")
        return start_of_day_target(as_of_ms, topic.time_ms, topic.timezone)
    return None


def partition_watermarks(log: DataFrame) -> DataFrame:
    """Low / high watermark and message count per partition."""
    return log.groupBy(*TP).agg(
        F.min("offset").alias("low_watermark"),
        (F.max("offset") + 1).alias("high_watermark"),
        F.count(F.lit(1)).alias("messages"),
    )


def _case(topics: list[SourceTopic], value) -> Column:
    expr = None
    for t in topics:
        v = value(t)
        if v is None:
            continue
        cond = F.col("topic") == F.lit(t.name)
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    return expr if expr is not None else F.lit(None)


def resolve_offsets(log: DataFrame, topics: Iterable[Any], as_of_ms: int | None = None) -> DataFrame:
    """One immutable ``[replay_start_offset, replay_end_offset)`` range
    per partition of every requested topic.

    earliest -> low watermark (S2); latest -> high watermark (S3);
    relative / absolute / start-of-day -> first offset whose timestamp is at
    or after the target, or the high watermark when none is (S4-S7).
    """
    specs = validate_topics(topics)
    names = [t.name for t in specs]
    target = _case(specs, lambda t: policy_target(t, as_of_ms)).cast("long")
    policy = _case(specs, lambda t: F.lit(t.policy))
    scoped = log.filter(F.col("topic").isin(names)).select(
        *TP, "offset", "timestamp_ms", target.alias("_target"))
    agg = scoped.groupBy(*TP).agg(
        F.min("offset").alias("_low"),
        (F.max("offset") + 1).alias("_high"),
        F.min(F.when(F.col("timestamp_ms") >= F.col("_target"), F.col("offset"))).alias("_at_time"),
    )
    pol = policy
    start = (F.when(pol == "earliest", F.col("_low"))
             .when(pol == "latest", F.col("_high"))
             .otherwise(F.coalesce(F.col("_at_time"), F.col("_high"))))
    return agg.select(
        F.col("topic"), F.col("partition").cast("int").alias("partition"),
        start.cast("long").alias("replay_start_offset"),
        F.col("_high").cast("long").alias("replay_end_offset"),
    )


def missing_topics(log: DataFrame, topics: Iterable[Any]) -> DataFrame:
    """Requested topics that have no partition in the log."""
    spark = log.sparkSession
    names = [(t.name,) for t in validate_topics(topics)]
    wanted = spark.createDataFrame(names, "topic string")
    present = log.filter(F.col("topic").isin([n for (n,) in names])).select("topic").distinct()
    return wanted.join(present, "topic", "left_anti")


def replay_slice(log: DataFrame, ranges: DataFrame, bounded: bool = True) -> DataFrame:
    """S10 + S11: the messages inside each partition's range.

    ``ranges`` has one row per topic-partition, so it is broadcast; the log
    is never shuffled. ``bounded=False`` keeps rows past the end offset, as a
    live replay would (Q14).
    """
    r = F.broadcast(ranges.select(*TP, "replay_start_offset", "replay_end_offset"))
    out = log.join(r, TP).filter(F.col("offset") >= F.col("replay_start_offset"))
    if bounded:
        out = out.filter(F.col("offset") < F.col("replay_end_offset"))
    return out


def starting_offsets_json(rows: Iterable[Any]) -> str:
    """Kafka ``startingOffsets`` JSON from collected range rows."""
    out: dict[str, dict[str, int]] = {}
    for r in rows:
        out.setdefault(r["topic"], {})[str(int(r["partition"]))] = int(r["replay_start_offset"])
    return json.dumps(out, sort_keys=True)


def derive_ranges(log: DataFrame, partitions: DataFrame, end_overrides: DataFrame | None = None) -> DataFrame:
    """fixture ranges. start = smallest offset in the data, end = override
    or largest + 1. ``partitions`` lists the wanted (topic, partition)."""
    agg = log.groupBy(*TP).agg(F.min("offset").alias("_min"), (F.max("offset") + 1).alias("_max1"))
    out = partitions.select(*TP).join(agg, TP, "left")
    if end_overrides is not None:
        out = out.join(end_overrides.select(*TP, F.col("end_offset").alias("_ovr")), TP, "left")
        end = F.coalesce(F.col("_ovr"), F.col("_max1"))
    else:
        end = F.col("_max1")
    return out.select(
        "topic", F.col("partition").cast("int"),
        F.col("_min").cast("long").alias("replay_start_offset"),
        end.cast("long").alias("replay_end_offset"),
        F.col("_min").isNull().alias("missing"),
    )
