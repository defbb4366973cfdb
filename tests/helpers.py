from pyspark.sql import functions as F

from tidemark.operators import release as R
from tidemark.plans.replay import Replay

LOG_SCHEMA = ("topic string, partition int, offset long, timestamp_ms long, key string, "
              "value string, arrival_epoch long")
RANGE_SCHEMA = "topic string, partition int, replay_start_offset long, replay_end_offset long"


def make_log(spark, polls):
    """polls: list of lists of message dicts -> log DataFrame with arrival_epoch."""
    rows = []
    for e, msgs in enumerate(polls):
        for m in msgs:
            rows.append((m["topic"], m["partition"], m["offset"], m["ts"], m.get("key"), m.get("value"), e))
    return spark.createDataFrame(rows, LOG_SCHEMA)


def make_ranges(spark, ranges):
    rows = [(t, p, s, e) for (t, p), (s, e) in sorted(ranges.items())]
    return spark.createDataFrame(rows, RANGE_SCHEMA)


def replay_of(spark, ranges, polls, batch_size=None):
    return Replay(make_log(spark, polls), ranges=make_ranges(spark, ranges),
                  batch_size=batch_size, materialized=False)


def released_by_poll(rp):
    rows = R.release_order(rp.released).orderBy("release_position").collect()
    out = {}
    for r in rows:
        out.setdefault(r["release_epoch"], []).append((r["topic"], r["partition"], r["offset"]))
    return out


def states_by_poll(rp, n_polls):
    out = []
    for e in range(n_polls):
        st = {}
        for r in rp.partition_state(e, as_timestamp=False).collect():
            st[(r["topic"], r["partition"])] = r.asDict()
        out.append(st)
    return out


def msg(topic, partition, offset, ts, value=None):
    return {"topic": topic, "partition": partition, "offset": offset, "ts": ts, "value": value}
