"""Consumption state, low-water mark and release limit, poll by poll
(A1-A4, W1).

A poll ("epoch") consumes every message whose ``arrival_epoch`` is that poll.
Inside a partition messages arrive in offset order, so the state after poll
``e`` is the message with the largest offset consumed so far.

Nothing here builds a full partitions x epochs grid up front: per partition
only the polls in which it received data are kept (one aggregate row per
partition and poll, map-side combined), and each row is expanded to the
polls until its next change only while the partition still holds the mark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import MAX_LIMIT, TP
from .prefix import following


def consumed_messages(slice_df: DataFrame) -> DataFrame:
    """Messages that are consumed: inside the range and with a timestamp."""
    return slice_df.filter(F.col("timestamp_ms").isNotNull())


def consumption_events(msgs: DataFrame, ranges: DataFrame) -> DataFrame:
    """Per (topic, partition, poll): last consumed offset and its timestamp
    (the *last* one, not the max), message count, caught-up flag."""
    ev = msgs.groupBy(*TP, "arrival_epoch").agg(
        F.max("offset").alias("last_offset"),
        F.max_by("timestamp_ms", "offset").alias("last_ts"),
        F.count(F.lit(1)).alias("consumed"),
    )
    r = F.broadcast(ranges.select(*TP, "replay_end_offset"))
    return (ev.join(r, TP, "left")
            .withColumn("caught", (F.col("last_offset") + 1) >= F.coalesce(
                F.col("replay_end_offset"), F.lit(MAX_LIMIT)))
            .drop("replay_end_offset")
            .withColumnRenamed("arrival_epoch", "epoch"))


def state_intervals(events: DataFrame, e_end: int) -> DataFrame:
    """Each partition state with the polls it stays valid: [epoch, until]."""
    out = following(events, TP, "epoch", "until")
    return out.withColumn("until", F.coalesce(F.col("until") - 1, F.lit(e_end)).cast("long"))


# Intervals up to this many polls are expanded poll by poll; longer ones are
# cut into at most two aligned power-of-two blocks per level.
SHORT_INTERVAL = 64


def _min_count(df: DataFrame, keys: list[str]) -> DataFrame:
    """Per key: the smallest value ``v`` and how many rows hold it."""
    per_v = df.groupBy(*keys, "v").agg(F.sum("c").alias("c"))
    return per_v.groupBy(*keys).agg(F.min("v").alias("v"), F.min_by("c", "v").alias("c"))


def cover_min(intervals: DataFrame, e_end: int) -> DataFrame:
    """For each poll, the smallest value over the intervals ``[epoch, until]``
    that cover it, and how many intervals hold that value.

    Short intervals are expanded poll by poll. Longer ones (a partition idle
    for many polls) are split into the canonical aligned blocks of a segment
    tree, at most two per level, so the work per interval is O(log polls),
    not its length. Each poll then reads the blocks above it: polls x levels
    rows."""
    levels = max(1, int(e_end + 1).bit_length())
    iv = intervals.select(F.col("epoch").alias("s"), F.col("until").alias("t"), F.col("value").alias("v"))
    short = iv.filter(F.col("t") - F.col("s") < SHORT_INTERVAL).select(
        F.lit(0).alias("k"), F.explode(F.sequence("s", "t")).alias("j"), "v")
    long_ = iv.filter(F.col("t") - F.col("s") >= SHORT_INTERVAL).select(
        "s", "t", "v", F.explode(F.sequence(F.lit(0), F.lit(levels))).alias("k"))
    lk = F.expr("shiftright(s + shiftleft(1L, k) - 1, k)")  # ceil(s / 2^k)
    rk = F.expr("shiftright(t + 1, k)")                     # floor((t + 1) / 2^k)
    open_ = lk < rk
    left = F.when(open_ & (lk % 2 == 1), lk)
    right = F.when(open_ & (rk % 2 == 1), rk - 1)
    blocks = long_.select("k", "v", F.explode(F.array(left, right)).alias("j")).filter(F.col("j").isNotNull())
    nodes = _min_count(short.unionByName(blocks.select("k", "j", "v")).withColumn("c", F.lit(1).cast("long")),
                       ["k", "j"])
    spark = intervals.sparkSession
    polls = spark.range(0, e_end + 1).select(F.col("id").alias("epoch"))
    up = polls.crossJoin(spark.range(0, levels + 1).select(F.col("id").cast("int").alias("k"))) \
        .withColumn("j", F.expr("shiftright(epoch, k)"))
    hit = up.join(nodes, ["k", "j"]).select("epoch", "v", "c")
    return _min_count(hit, ["epoch"]).select("epoch", F.col("v").alias("min_value"),
                                             F.col("c").alias("at_min"))


def low_water_marks(events: DataFrame, e_end: int) -> DataFrame:
    """A2 per poll: min last timestamp over partitions that are not caught up
    (nothing is paused in this model) and have consumed something (Q1)."""
    iv = state_intervals(events, e_end).filter(~F.col("caught"))
    cov = cover_min(iv.select("epoch", "until", F.col("last_ts").alias("value")), e_end)
    return cov.select("epoch", F.col("min_value").alias("low_water_mark"),
                      F.col("at_min").alias("partitions_at_mark"))


def caught_up_from(events: DataFrame, ranges: DataFrame) -> DataFrame:
    """One row: first poll from which every partition is caught up (A3), or
    null; plus the partition count. Empty ranges are caught up before poll 0."""
    first_caught = events.filter("caught").groupBy(*TP).agg(F.min("epoch").alias("_c"))
    per = ranges.select(*TP, (F.col("replay_start_offset") >= F.col("replay_end_offset")).alias("_empty")) \
        .join(first_caught, TP, "left") \
        .select(F.when(F.col("_empty"), F.lit(-1)).otherwise(F.col("_c")).alias("_c"))
    return per.agg(
        F.count(F.lit(1)).alias("partitions"),
        F.when(F.count(F.lit(1)) == F.count("_c"), F.max("_c")).alias("all_caught_from"),
    )


def release_limits(spark, events: DataFrame, ranges: DataFrame, e_end: int) -> DataFrame:
    """A3 + A4 + W1: per poll 0..e_end the low-water mark, whether every
    partition is caught up, and the release limit
    (``MAX`` when all caught up, else the mark, ``MAX`` when there is none)."""
    epochs = spark.range(0, e_end + 1).withColumnRenamed("id", "epoch")
    lwm = low_water_marks(events, e_end)
    cu = F.broadcast(caught_up_from(events, ranges))  # one row
    out = epochs.join(lwm, "epoch", "left").crossJoin(cu)
    all_caught = (F.col("partitions") > 0) & F.coalesce(
        F.col("epoch") >= F.col("all_caught_from"), F.lit(False))
    return out.select(
        "epoch", "low_water_mark", "partitions_at_mark",
        all_caught.alias("all_caught_up"),
        F.when(all_caught, F.lit(MAX_LIMIT))
        .otherwise(F.coalesce(F.col("low_water_mark"), F.lit(MAX_LIMIT))).alias("release_limit"),
    )


def consumption_state(msgs: DataFrame, ranges: DataFrame, upto_epoch: int | None = None) -> DataFrame:
    """A1: per partition after poll ``upto_epoch`` (all polls when None):
    consumed offset, last consumed timestamp, caught-up flag."""
    m = msgs if upto_epoch is None else msgs.filter(F.col("arrival_epoch") <= upto_epoch)
    agg = m.groupBy(*TP).agg(
        F.max("offset").alias("_last"), F.max_by("timestamp_ms", "offset").alias("_ts"))
    out = ranges.join(agg, TP, "left")
    return out.select(
        *TP, "replay_start_offset", "replay_end_offset",
        F.coalesce(F.col("_last"), F.col("replay_start_offset")).alias("consumed_offset"),
        F.col("_ts").alias("last_consumed_timestamp_ms"),
        F.when(F.col("_last").isNull(), F.col("replay_start_offset") >= F.col("replay_end_offset"))
        .otherwise(F.col("_last") + 1 >= F.col("replay_end_offset")).alias("is_caught_up"),
    )


# --- the same rules on a partition-state table --------------------------------
# A state table has one row per partition: topic, partition, timestamp_ms
# (last consumed, nullable), is_caught_up, is_paused.

def low_water_mark_of(state: DataFrame) -> DataFrame:
    """A2 on a state table: one row, ``low_water_mark`` (null if none)."""
    active = ~F.col("is_caught_up") & ~F.col("is_paused")
    return state.agg(F.min(F.when(active, F.col("timestamp_ms"))).alias("low_water_mark"))


def release_limit_of(state: DataFrame) -> DataFrame:
    """A3 + A4 on a state table: one row with the mark, all-caught-up and limit."""
    out = state.agg(
        F.min(F.when(~F.col("is_caught_up") & ~F.col("is_paused"), F.col("timestamp_ms"))).alias("low_water_mark"),
        ((F.count(F.lit(1)) > 0) & F.coalesce(F.bool_and("is_caught_up"), F.lit(False))).alias("all_caught_up"))
    return out.withColumn("release_limit", F.when(F.col("all_caught_up"), F.lit(MAX_LIMIT))
                          .otherwise(F.coalesce(F.col("low_water_mark"), F.lit(MAX_LIMIT))))
