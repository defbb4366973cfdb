"""The registered queries: the reference's operators run over the driver's
``events`` table seen as a message log (see ``sources.log.log_from_events``).

Every query reads the whole table; topics are those that the table has. Fixed
parameters are below.
"""

from __future__ import annotations

import os
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import checks as C
from ..operators import offsets as O
from ..operators.paced import paced_replay
from ..operators import release as R
from ..operators import watermark as W
from ..schema import LOG_COLUMNS, TP, decode_value, timestamp_to_ms, to_messages
from ..session import ensure_utc
from ..sources.log import log_from_events
from ..sources.topics import SourceTopic
from .replay import Replay

# Fixed parameters of the registered queries.
AS_OF_MS = 1706659200000            # 2024-01-31T00:00:00Z, never the clock
BATCH_SIZE = 100
STREAM_POLLS = 5_000                # polls that a micro-batch of the streams takes at most
FINE_SCALE = 100                    # polls per poll in the many-polls variant
ABSOLUTE_MS = 1704844800000         # 2024-01-10T00:00:00Z
RELATIVE_MS = 20 * 86_400_000       # 20 days before AS_OF_MS
DAY_TIME_MS = 34_200_000            # 09:30 local time
DAY_TZ = "America/New_York"
JITTER_MS = 86_400_000              # out-of-order variant: one day back
MIXED = [
    SourceTopic.from_earliest("click"),
    SourceTopic.from_absolute_time("error", ABSOLUTE_MS),
    SourceTopic.from_relative_time("purchase", RELATIVE_MS),
    SourceTopic.from_start_of_day("signup", DAY_TIME_MS, DAY_TZ),
    SourceTopic.from_latest("view"),
]
ABSENT = [SourceTopic.from_earliest("refund"), SourceTopic.from_latest("login")]
END_OVERRIDES = [("click", 0, 100_000)]
FIXTURE_PARTITIONS = 5              # one more than the log has: reported missing


SLIM = ["topic", "partition", "offset", "timestamp_ms"]


def all_topics(spark: SparkSession, sf_dir: str, policy: str, time_ms: int | None = None, tz: str | None = None):
    """A spec for every topic of the table (topics are few: names only)."""
    names = events(spark, sf_dir).select("event_type").distinct().filter("event_type IS NOT NULL").collect()
    return [SourceTopic(r["event_type"], policy, time_ms, tz) for r in sorted(names)]


def mid_epoch(rp: Replay) -> int:
    """The poll inspected by point-in-time reports: half-way."""
    return rp.last_epoch // 2


# --- inputs -------------------------------------------------------------------

def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    return spark.read.parquet(os.path.join(sf_dir, "events.parquet"))


def base_log(spark, sf_dir, topics=None, columns=LOG_COLUMNS):
    return log_from_events(events(spark, sf_dir), topics=topics, columns=columns)


def jitter_log(spark, sf_dir):
    return log_from_events(events(spark, sf_dir), jitter_ms_when=(F.col("value") >= 100, JITTER_MS), columns=SLIM)


def fine_log(spark, sf_dir):
    return log_from_events(events(spark, sf_dir), jitter_ms_when=(F.col("value") >= 100, JITTER_MS), columns=SLIM,
                           epoch_scale=FINE_SCALE)


def steady_log(spark, sf_dir):
    return log_from_events(events(spark, sf_dir), columns=SLIM, epoch_scale=FINE_SCALE)


def untimestamped_log(spark, sf_dir, columns=LOG_COLUMNS):
    return log_from_events(events(spark, sf_dir), null_timestamp_when=F.col("value") < 1.0, columns=columns)


def tombstone_log(spark, sf_dir):
    return log_from_events(events(spark, sf_dir), null_value_when=F.col("value") >= 200)


def earliest_replay(spark, sf_dir, log=None) -> Replay:
    return Replay(log if log is not None else base_log(spark, sf_dir, columns=SLIM),
                  all_topics(spark, sf_dir, "earliest"), AS_OF_MS, BATCH_SIZE)


def mixed_replay(spark, sf_dir, columns=SLIM) -> Replay:
    return Replay(base_log(spark, sf_dir, [t.name for t in MIXED], columns), MIXED, AS_OF_MS, BATCH_SIZE)


SLICE_COLS = ["topic", "partition", "offset", "timestamp_ms"]


# --- queries --------------------------------------------------------------------

def q_message_log(spark, d):
    return base_log(spark, d)


def _offsets(policy, time_ms=None, tz=None):
    def q(spark, d):
        return O.resolve_offsets(base_log(spark, d, columns=SLIM), all_topics(spark, d, policy, time_ms, tz), AS_OF_MS)
    return q


def q_offsets_mixed(spark, d):
    return O.resolve_offsets(base_log(spark, d, [t.name for t in MIXED], SLIM), MIXED, AS_OF_MS)


def q_partition_watermarks(spark, d):
    return O.partition_watermarks(base_log(spark, d, columns=()))


def q_replay_slice(spark, d):
    return mixed_replay(spark, d, LOG_COLUMNS).slice


def q_missing_topics(spark, d):
    return O.missing_topics(base_log(spark, d, columns=()), MIXED + ABSENT)


def _message_view(msgs: DataFrame) -> DataFrame:
    return msgs.select("topic", "partition", "offset",
                       timestamp_to_ms("timestamp").alias("timestamp_ms"),
                       decode_value("key").alias("key"), decode_value("value").alias("value"))


def q_drop_untimestamped(spark, d):
    return _message_view(to_messages(untimestamped_log(spark, d)))


def q_tombstones(spark, d):
    m = to_messages(tombstone_log(spark, d))
    return m.groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("messages"),
        F.count_if(F.col("value").isNull()).alias("tombstones"))


def q_filter_topic(spark, d):
    return _message_view(to_messages(base_log(spark, d)).filter(F.col("topic") == "click"))


def q_decode_value(spark, d):
    m = to_messages(base_log(spark, d))
    return m.select("topic", "partition", "offset", decode_value("value").alias("value_text"))


def q_consumption_state(spark, d):
    rp = earliest_replay(spark, d)
    return W.consumption_state(rp.messages, rp.ranges, mid_epoch(rp))


def q_low_water_mark(spark, d):
    return earliest_replay(spark, d).limits.select("epoch", "low_water_mark")


def q_release_limits(spark, d):
    return earliest_replay(spark, d).limits.select("epoch", "low_water_mark", "all_caught_up", "release_limit")


def q_replay_progress(spark, d):
    return earliest_replay(spark, d).progress()


def q_held_counts(spark, d):
    return earliest_replay(spark, d).metrics().select("epoch", "held")


def q_epoch_metrics(spark, d):
    return earliest_replay(spark, d).metrics()


def q_flow_report(spark, d):
    return earliest_replay(spark, d).flow()


def q_ordered_replay(spark, d):
    return R.ordered_replay(earliest_replay(spark, d).messages.select(*SLICE_COLS))


def q_ordered_replay_untimestamped(spark, d):
    return R.ordered_replay(earliest_replay(spark, d, untimestamped_log(spark, d, SLIM)).messages.select(*SLICE_COLS))


def q_replay_batches(spark, d):
    return R.replay_batches(mixed_replay(spark, d).messages.select(*SLICE_COLS), BATCH_SIZE)


def _release_view(rp: Replay) -> DataFrame:
    rel = rp.released.select(*SLICE_COLS, "arrival_epoch", "release_epoch")
    return R.release_order(rel)


def q_release_epochs(spark, d):
    return _release_view(earliest_replay(spark, d))


def q_release_epochs_mixed(spark, d):
    return _release_view(mixed_replay(spark, d))


def q_release_epochs_jitter(spark, d):
    return _release_view(earliest_replay(spark, d, jitter_log(spark, d)))


def q_release_epochs_fine(spark, d):
    return _release_view(earliest_replay(spark, d, fine_log(spark, d)))


def _mid_batch(rp: Replay):
    mid = mid_epoch(rp)
    held = R.held_at(rp.released.select(*SLICE_COLS, "arrival_epoch", "release_epoch"), mid)
    lim = rp.limits.filter(F.col("epoch") == mid).select("release_limit").first()
    limit = lim[0] if lim is not None else -1  # no poll: nothing is held either
    return held, R.release_batch(held, limit, BATCH_SIZE)


def q_release_batch(spark, d):
    _, batch = _mid_batch(earliest_replay(spark, d))
    return batch.select(*SLICE_COLS, "arrival_epoch", "batch_position")


def q_held_messages(spark, d):
    held, batch = _mid_batch(earliest_replay(spark, d))
    return R.held_after(held, batch).select(*SLICE_COLS, "arrival_epoch")


def q_paced_counts(spark, d):
    return earliest_replay(spark, d).paced_counts()


def q_paced_counts_jitter(spark, d):
    return earliest_replay(spark, d, jitter_log(spark, d)).paced_counts()


def q_released_state(spark, d):
    rp = earliest_replay(spark, d, jitter_log(spark, d))
    return R.released_state(rp.released, rp.ranges)


def q_partition_state(spark, d):
    rp = mixed_replay(spark, d)
    return rp.partition_state(mid_epoch(rp), as_timestamp=False)


def q_order_violations(spark, d):
    rp = earliest_replay(spark, d, jitter_log(spark, d))
    live = rp.progress().select(F.col("epoch").alias("release_epoch"), "is_live")
    rel = rp.released.filter(F.col("release_epoch").isNotNull())
    return C.order_violations(rel, "release_epoch", live)


def q_batch_size_violations(spark, d):
    rel = earliest_replay(spark, d).released.filter(F.col("release_epoch").isNotNull())
    return C.batch_size_violations(rel, "release_epoch", BATCH_SIZE)


def q_late_messages(spark, d):
    rp = earliest_replay(spark, d, jitter_log(spark, d))
    return R.late_messages(rp.released).select(*SLICE_COLS, "release_epoch", "prior_max_ts")


def _fixture_partitions(log: DataFrame) -> DataFrame:
    topics = log.select("topic").distinct()
    return topics.select("topic", F.explode(F.sequence(F.lit(0), F.lit(FIXTURE_PARTITIONS - 1))).alias("partition"))


def q_derived_ranges(spark, d):
    log = base_log(spark, d, columns=())
    ovr = spark.createDataFrame(END_OVERRIDES, "topic string, partition int, end_offset long")
    return O.derive_ranges(log, _fixture_partitions(log), ovr)


def q_poll_plan_missing(spark, d):
    from .fixtures import poll_plan_missing
    log = base_log(spark, d, columns=())
    wm = O.partition_watermarks(log)
    plan = wm.select(*TP, F.lit(0).cast("long").alias("poll"),
                     F.sequence(F.lit(0).cast("long"), F.col("high_watermark") + 1).alias("offsets"))
    return poll_plan_missing(log, plan)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "message_log": q_message_log,
    "offsets_earliest": _offsets("earliest"),
    "offsets_latest": _offsets("latest"),
    "offsets_relative_time": _offsets("relative_time", RELATIVE_MS),
    "offsets_absolute_time": _offsets("absolute_time", ABSOLUTE_MS),
    "offsets_start_of_day": _offsets("start_of_day", DAY_TIME_MS, DAY_TZ),
    "offsets_mixed": q_offsets_mixed,
    "partition_watermarks": q_partition_watermarks,
    "replay_slice": q_replay_slice,
    "missing_topics": q_missing_topics,
    "drop_untimestamped": q_drop_untimestamped,
    "tombstones": q_tombstones,
    "filter_topic": q_filter_topic,
    "decode_value": q_decode_value,
    "consumption_state": q_consumption_state,
    "low_water_mark": q_low_water_mark,
    "release_limits": q_release_limits,
    "replay_progress": q_replay_progress,
    "held_counts": q_held_counts,
    "epoch_metrics": q_epoch_metrics,
    "flow_report": q_flow_report,
    "ordered_replay": q_ordered_replay,
    "ordered_replay_untimestamped": q_ordered_replay_untimestamped,
    "replay_batches": q_replay_batches,
    "release_epochs": q_release_epochs,
    "release_epochs_mixed": q_release_epochs_mixed,
    "release_epochs_jitter": q_release_epochs_jitter,
    "release_epochs_fine": q_release_epochs_fine,
    "release_batch": q_release_batch,
    "held_messages": q_held_messages,
    "paced_counts": q_paced_counts,
    "paced_counts_jitter": q_paced_counts_jitter,
    "released_state": q_released_state,
    "partition_state": q_partition_state,
    "order_violations": q_order_violations,
    "batch_size_violations": q_batch_size_violations,
    "late_messages": q_late_messages,
    "derived_ranges": q_derived_ranges,
    "poll_plan_missing": q_poll_plan_missing,
}


# --- iterative and streaming queries -------------------------

def _paced_view(rp: Replay) -> DataFrame:
    rel = paced_replay(rp.released.select(*SLICE_COLS, "arrival_epoch", "release_epoch"), rp.limits, BATCH_SIZE, rp.last_epoch)
    return R.release_order(rel)


def q_paced_replay(spark, d):
    return _paced_view(earliest_replay(spark, d))


def q_paced_replay_fine(spark, d):
    return _paced_view(earliest_replay(spark, d, steady_log(spark, d)))


def _stream(spark, d, batch_size):
    """The log as a stream: a poll takes 10 * (partition + 1) messages of each
    partition, as the batch queries' arrival polls do."""
    from ..session import scratch_path
    from ..sources.archive import read_log_stream, write_archive
    from ..streaming.stream import run_ordered_release
    rp = earliest_replay(spark, d, base_log(spark, d))
    root = scratch_path(spark, "stream-replay")
    msgs = rp.messages.select(*SLICE_COLS, "key", "value")
    archive = write_archive(msgs, f"{root}/archive")
    ranges = rp.ranges.withColumn("rows_per_poll", 10 * (F.col("partition") + 1))
    source = read_log_stream(spark, archive, msgs.schema, ranges, f"{root}/progress", polls=STREAM_POLLS)
    return run_ordered_release(source, ranges, root, batch_size, polls=STREAM_POLLS)


def q_stream_ordered_release(spark, d):
    handler = _stream(spark, d, BATCH_SIZE)
    return R.release_order(handler.released(spark).select(*SLICE_COLS, "arrival_epoch", "release_epoch"))


def q_stream_replay_until_live(spark, d):
    handler = _stream(spark, d, None)
    return handler.partition_state(spark)


QUERIES.update({
    "paced_replay": q_paced_replay,
    "paced_replay_fine": q_paced_replay_fine,
    "stream_ordered_release": q_stream_ordered_release,
    "stream_replay_until_live": q_stream_replay_until_live,
})
