"""State merges of one poll (T1, T2): the partition table after its arrivals and
after its release."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import TP


def advance_state(state: DataFrame, new_rows: DataFrame) -> DataFrame:
    """A1 as a merge: the state table updated with one poll's arrivals.

    ``state`` columns: topic, partition, replay_start_offset,
    replay_end_offset, consumed_offset, released_offset, timestamp_ms,
    is_caught_up, is_live, is_paused.
    """
    upd = new_rows.groupBy(*TP).agg(F.max("offset").alias("_o"), F.max_by("timestamp_ms", "offset").alias("_t"))
    j = state.join(F.broadcast(upd), TP, "left")  # at most one row per partition
    got = F.col("_o").isNotNull()
    return j.select(
        *TP, "replay_start_offset", "replay_end_offset",
        F.when(got, F.col("_o")).otherwise(F.col("consumed_offset")).alias("consumed_offset"),
        "released_offset",
        F.when(got, F.col("_t")).otherwise(F.col("timestamp_ms")).alias("timestamp_ms"),
        F.when(got, F.col("_o") + 1 >= F.col("replay_end_offset")).otherwise(F.col("is_caught_up")).alias("is_caught_up"),
        "is_live", "is_paused")


def apply_release(state: DataFrame, released: DataFrame) -> DataFrame:
    """R8 as a merge: last released offset per partition in release order."""
    key = F.struct("release_epoch", "timestamp_ms", "arrival_epoch", "offset")
    upd = released.groupBy(*TP).agg(F.max_by("offset", key).alias("_r"))
    j = state.join(F.broadcast(upd), TP, "left")  # at most one row per partition
    got = F.col("_r").isNotNull()
    return j.select(
        *TP, "replay_start_offset", "replay_end_offset", "consumed_offset",
        F.when(got, F.col("_r")).otherwise(F.col("released_offset")).alias("released_offset"),
        "timestamp_ms", "is_caught_up",
        F.when(got, F.col("_r") + 1 >= F.col("replay_end_offset")).otherwise(F.col("is_live")).alias("is_live"),
        "is_paused")


def initial_state(ranges: DataFrame) -> DataFrame:
    """State before the first poll: consumed = released = start; an empty
    range is caught up and live at once."""
    empty = F.col("replay_start_offset") >= F.col("replay_end_offset")
    return ranges.select(
        *TP, "replay_start_offset", "replay_end_offset",
        F.col("replay_start_offset").alias("consumed_offset"),
        F.col("replay_start_offset").alias("released_offset"),
        F.lit(None).cast("long").alias("timestamp_ms"),
        empty.alias("is_caught_up"), empty.alias("is_live"), F.lit(False).alias("is_paused"))
