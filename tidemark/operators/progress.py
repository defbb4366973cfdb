"""Progress, liveness and flow-control reports.

Per-poll totals are built from *changes*: each partition contributes a row
only in polls where its state changes, and running sums over the poll axis
(one row per poll) turn them into totals. No partitions x polls grid.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import TP, ms_to_timestamp
from .prefix import running
from .release import RELEASE_KEY
from .watermark import consumption_state, state_intervals
from .release import released_state


def partition_state(msgs_rel: DataFrame, ranges: DataFrame, upto_epoch: int | None = None,
                    as_timestamp: bool = False) -> DataFrame:
    """The partition-state report (sorted by topic, partition)."""
    cons = consumption_state(msgs_rel, ranges, upto_epoch)
    rel = released_state(msgs_rel, ranges, upto_epoch)
    out = cons.join(rel, TP)
    ts = ms_to_timestamp("last_consumed_timestamp_ms") if as_timestamp else F.col("last_consumed_timestamp_ms")
    return out.select(
        F.col("topic"), F.col("partition").cast("int"),
        F.col("replay_start_offset").cast("long"), F.col("replay_end_offset").cast("long"),
        F.col("consumed_offset").cast("long"), F.col("released_offset").cast("long"),
        ts.alias("last_consumed_timestamp" if as_timestamp else "last_consumed_timestamp_ms"),
        F.col("is_live"), F.lit(False).alias("is_paused"),
    ).orderBy(*TP)


def _epochs(spark, e_end: int) -> DataFrame:
    return spark.range(0, e_end + 1).withColumnRenamed("id", "epoch")


def _running(df: DataFrame, cols: list[str]) -> DataFrame:
    out = running(df, "epoch", {f"_sum_{c}": ("sum", c) for c in cols})
    return out.select("epoch", *[F.col(f"_sum_{c}").alias(c) for c in cols])


def replay_progress(spark, msgs_rel: DataFrame, events: DataFrame, ranges: DataFrame,
                    limits: DataFrame, e_end: int) -> DataFrame:
    """A3, A5, A6, A10 per poll: all caught up, live, priming watermark and
    pending = sum(consumed_offset) - sum(released_offset)."""
    r = ranges.select(*TP, "replay_start_offset", "replay_end_offset")
    base = r.agg(
        F.count(F.lit(1)).alias("partitions"),
        F.sum(F.when(F.col("replay_start_offset") >= F.col("replay_end_offset"), 1).otherwise(0)).alias("live0"),
    )
    # consumed offset changes: last offset per poll minus the previous one
    wtp = Window.partitionBy(*TP).orderBy("epoch")
    ce = events.join(F.broadcast(r), TP).select(
        "epoch", (F.col("last_offset") - F.coalesce(F.lag("last_offset").over(wtp),
                                                     F.col("replay_start_offset"))).alias("_dc"))
    # released offset and live changes, per partition and release poll
    key = F.struct(*[F.col(c) for c in RELEASE_KEY if c not in TP])
    rel = msgs_rel.filter(F.col("release_epoch").isNotNull()).groupBy(*TP, "release_epoch").agg(
        F.max_by("offset", key).alias("_ro"))
    rel = rel.join(F.broadcast(r), TP).withColumn(
        "_live", ((F.col("_ro") + 1) >= F.col("replay_end_offset")).cast("int"))
    prev_ro = F.coalesce(F.lag("_ro").over(Window.partitionBy(*TP).orderBy("release_epoch")),
                         F.col("replay_start_offset"))
    prev_live = F.coalesce(F.lag("_live").over(Window.partitionBy(*TP).orderBy("release_epoch")),
                           (F.col("replay_start_offset") >= F.col("replay_end_offset")).cast("int"))
    re = rel.select(F.col("release_epoch").alias("epoch"), (F.col("_ro") - prev_ro).alias("_dr"),
                    (F.col("_live") - prev_live).alias("_dl"))
    dc = ce.groupBy("epoch").agg(F.sum("_dc").alias("_dc"))
    dr = re.groupBy("epoch").agg(F.sum("_dr").alias("_dr"), F.sum("_dl").alias("_dl"))
    out = _epochs(spark, e_end).join(dc, "epoch", "left").join(dr, "epoch", "left").fillna(0, ["_dc", "_dr", "_dl"])
    out = _running(out, ["_dc", "_dr", "_dl"])
    out = out.crossJoin(F.broadcast(base)).join(limits, "epoch")
    live = (F.col("partitions") > 0) & ((F.col("live0") + F.col("_dl")) == F.col("partitions"))
    return out.select(
        "epoch",
        F.col("all_caught_up"),
        live.alias("is_live"),
        F.when(~live, F.col("low_water_mark")).alias("priming_watermark"),
        (F.col("_dc") - F.col("_dr")).cast("long").alias("pending"),
    )


def epoch_metrics(spark, msgs_rel: DataFrame, e_end: int) -> DataFrame:
    """A9 + A7: per poll (= per flush) messages consumed and released, the
    held count after the poll, and paused / resumed partitions (always 0:
    admission control replaces pausing)."""
    c = msgs_rel.groupBy(F.col("arrival_epoch").alias("epoch")).agg(F.count(F.lit(1)).alias("consumed"))
    r = msgs_rel.filter(F.col("release_epoch").isNotNull()).groupBy(
        F.col("release_epoch").alias("epoch")).agg(F.count(F.lit(1)).alias("released"))
    out = _epochs(spark, e_end).join(c, "epoch", "left").join(r, "epoch", "left").fillna(0, ["consumed", "released"])
    out = running(out, "epoch", {"_in": ("sum", "consumed"), "_out": ("sum", "released")})
    return out.select(
        "epoch", F.col("consumed").cast("long"), F.col("released").cast("long"),
        (F.col("_in") - F.col("_out")).cast("long").alias("held"),
        F.lit(0).cast("long").alias("partitions_paused"),
        F.lit(0).cast("long").alias("partitions_resumed"),
    )


def flow_report(spark, events: DataFrame, limits: DataFrame, metrics: DataFrame,
                partitions: int, batch_size: int, e_end: int) -> DataFrame:
    """B1-B3 + A8 per poll: partitions ahead of the mark (timestamp above it,
    caught-up ones included), whether paused partitions would resume, whether
    the buffer is over its 5 x batch bound, and the paused count. The last two
    decisions are taken before the poll releases, on the buffer with its
    arrivals (held afterwards plus released)."""
    lwm = limits.select("epoch", "low_water_mark")
    # partitions still behind: all of them are at or above the mark, so those
    # ahead are the ones behind minus the ones at the mark; the count behind
    # is a running sum of +1 / -1 changes (no per-poll expansion)
    iv = state_intervals(events, e_end).filter(~F.col("caught"))
    chg = iv.select(F.col("epoch").alias("e"), F.lit(1).alias("d")).unionByName(
        iv.select((F.col("until") + 1).alias("e"), F.lit(-1).alias("d")))
    n_behind = _running(_epochs(spark, e_end).join(
        chg.groupBy(F.col("e").alias("epoch")).agg(F.sum("d").alias("_n")), "epoch", "left")
        .fillna(0, ["_n"]), ["_n"])
    at_mark = limits.select("epoch", "partitions_at_mark")
    behind = n_behind.join(at_mark, "epoch").select(
        "epoch", (F.col("_n") - F.coalesce(F.col("partitions_at_mark"), F.lit(0))).alias("_behind"))
    # caught-up partitions keep their last timestamp from the poll they catch
    # up on: one array row (one entry per partition), checked per poll
    caught = events.filter("caught").groupBy(*TP).agg(
        F.min("epoch").alias("c"), F.min_by("last_ts", "epoch").alias("t"))
    arr = caught.agg(F.collect_list(F.struct("c", "t")).alias("_arr"))
    done = lwm.crossJoin(F.broadcast(arr)).select(
        "epoch", F.size(F.filter("_arr", lambda x: (x["c"] <= F.col("epoch"))
                                 & (x["t"] > F.col("low_water_mark")))).alias("_done"))
    ahead = done.join(behind, "epoch", "left").select(
        "epoch", (F.col("_done") + F.coalesce(F.col("_behind"), F.lit(0))).alias("ahead"))
    out = (limits.select("epoch", "all_caught_up")
           .join(metrics.select("epoch", "held", (F.col("held") + F.col("released")).alias("_buffer")), "epoch")
           .join(ahead, "epoch", "left").fillna(0, ["ahead"]))
    b = F.lit(batch_size)
    return out.select(
        "epoch", "held",
        F.col("ahead").cast("long").alias("partitions_ahead"),
        ((F.col("_buffer") < b) | F.lit(partitions == 0) | F.col("all_caught_up")).alias("should_resume"),
        (F.col("_buffer") > b * 5).alias("over_buffer"),
        F.lit(0).cast("long").alias("paused_partitions"),
    )


# --- flow decisions on a partition-state table (B1, B2) -----------------------

def partitions_ahead_of(state: DataFrame, low_water_mark: int) -> DataFrame:
    """B1: partitions whose last timestamp is above the mark and that are not
    paused (caught-up ones included; no timestamp, not included)."""
    return state.filter((F.col("timestamp_ms") > F.lit(low_water_mark)) & ~F.col("is_paused")).select(*TP)


def should_resume_of(state: DataFrame, held: int, batch_size: int) -> DataFrame:
    """B2: one row, true when the buffer is below one batch or every unpaused
    partition is caught up (vacuously true)."""
    all_active_caught = F.coalesce(
        F.bool_and(F.when(~F.col("is_paused"), F.col("is_caught_up"))), F.lit(True))
    return state.agg((F.lit(held < batch_size) | all_active_caught).alias("should_resume"))
