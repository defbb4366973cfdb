"""Message-log sources.

Inside the library a log is a DataFrame with ``topic, partition, offset,
timestamp_ms, key, value`` (timestamp as epoch-ms long; key/value as text or
binary). Sources:

* ``read_archive``: a log already written as parquet (e.g. a topic dump),
  one ``spark.read`` per topic, combined with ``unionByName`` (S1).
* ``log_from_events``: the driver's ``events`` table seen as a topic log.
* ``kafka_options``: option maps for Spark's own Kafka source (S1, S15).
"""

from __future__ import annotations

import json
from datetime import datetime
from functools import reduce
from typing import Any, Iterable, Mapping
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.sequence import sequence_number
from ..schema import LOG_COLUMNS, int_div
from .topics import START_OF_DAY, validate_topics


def epoch_ms(df: DataFrame, col: str) -> Column:
    """Epoch milliseconds (floor) of a timestamp column, independent of the
    session time zone for ``timestamp_ntz`` (read as UTC wall time)."""
    dtype = df.schema[col].dataType
    if isinstance(dtype, T.TimestampNTZType):
        us = F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', `{col}`)")
    elif isinstance(dtype, T.TimestampType):
        us = F.unix_micros(F.col(col))
    else:  # already a number of ms
        return F.col(col).cast("long")
    return int_div(us - F.pmod(us, F.lit(1000)), 1000)


def arrival_epoch(divisor_per_partition: int = 10, scale: int = 1) -> Column:
    """Poll in which a message is consumed: each partition delivers
    ``divisor * (partition + 1) / scale`` messages per poll, so partition 0 is
    the slow one and holds back the mark."""
    return int_div(F.col("offset") * F.lit(scale), F.lit(divisor_per_partition) * (F.col("partition") + 1))


def log_from_events(events: DataFrame, partitions: int = 4,
                    null_timestamp_when: Column | None = None,
                    null_value_when: Column | None = None,
                    jitter_ms_when: tuple[Column, int] | None = None,
                    epoch_divisor: int = 10, topics: list[str] | None = None,
                    columns: Iterable[str] = LOG_COLUMNS, epoch_scale: int = 1) -> DataFrame:
    """The ``events`` table as a multi-topic log.

    topic = event_type, partition = user_id mod ``partitions``, offset = dense
    position inside (topic, partition) by event_id, timestamp = ts in ms,
    key = user_id as text, value = props. ``arrival_epoch`` is added for
    poll-by-poll replay.

    Optional rules derived from the row's own columns make the variants used
    by the tests: missing timestamps (P2), tombstones (P3) and timestamps
    moved back (out-of-order data, T5 / Q3 / Q11). ``topics`` keeps whole
    topics only; offsets are per topic, so the filter is applied before the
    numbering and reaches the parquet scan. ``columns`` names the log columns
    wanted: numbering writes its rows, so a payload that nobody reads is neither
    shuffled nor written.
    """
    if topics is not None:
        events = events.filter(F.col("event_type").isin(list(topics)))
    ts_ms = epoch_ms(events, "ts")
    if jitter_ms_when is not None:
        cond, delta = jitter_ms_when
        ts_ms = F.when(cond, ts_ms - F.lit(delta)).otherwise(ts_ms)
    if null_timestamp_when is not None:
        ts_ms = F.when(null_timestamp_when, F.lit(None).cast("long")).otherwise(ts_ms)
    value = F.col("props")
    if null_value_when is not None:
        value = F.when(null_value_when, F.lit(None).cast("string")).otherwise(value)
    fields = {"timestamp_ms": ts_ms, "key": F.col("user_id").cast("string"), "value": value}
    base = events.select(
        F.col("event_type").alias("topic"),
        F.pmod(F.col("user_id"), F.lit(partitions)).cast("int").alias("partition"),
        F.col("event_id"), *[e.alias(c) for c, e in fields.items() if c in columns],
    )
    log = sequence_number(base, ["event_id"], "offset", group_cols=["topic", "partition"])
    return log.select(*[c for c in LOG_COLUMNS if c in columns or c in ("topic", "partition", "offset")],
                      arrival_epoch(epoch_divisor, epoch_scale).alias("arrival_epoch"))


def read_archive(spark: SparkSession, paths: Mapping[str, str] | Iterable[str]) -> DataFrame:
    """S1 for archived logs: read one parquet log per topic and union them.

    ``paths`` maps topic -> path (the topic column is then set from the key)
    or is a list of paths whose files already hold a ``topic`` column.
    Columns are projected to the log layout so only they are scanned.
    """
    frames = []
    if isinstance(paths, Mapping):
        for topic, path in paths.items():
            df = spark.read.parquet(path)
            if "topic" not in df.columns:
                df = df.withColumn("topic", F.lit(topic))
            else:
                df = df.filter(F.col("topic") == topic)
            frames.append(_to_log(df))
    else:
        frames = [_to_log(spark.read.parquet(p)) for p in paths]
    if not frames:
        raise ValueError("no topic paths given")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _to_log(df: DataFrame) -> DataFrame:
    if "timestamp_ms" not in df.columns and "timestamp" in df.columns:
        df = df.withColumn("timestamp_ms", epoch_ms(df, "timestamp"))
    for c in ("key", "value"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("binary"))
    return df.select(
        F.col("topic").cast("string"), F.col("partition").cast("int"),
        F.col("offset").cast("long"), F.col("timestamp_ms").cast("long"),
        F.col("key"), F.col("value"))


# --- Spark's Kafka source (S1, S15) -------------------------------------------

# Fixed value: the batch size used when none is given.
DEFAULT_BATCH_SIZE = 10_000


def kafka_options(config: Mapping[str, str], topic_offsets: Mapping[str, str] | None = None,
                  subscribe: Iterable[str] = (), max_per_trigger: int | None = DEFAULT_BATCH_SIZE,
                  starting_timestamp_ms: int | None = None,
                  source: Mapping[str, str] | None = None) -> dict[str, str]:
    """Map client properties and resolved starts to ``format("kafka")`` options.

    ``source`` holds options of Spark's source itself (``failOnDataLoss``,
    ``minPartitions``, ...), passed as they are. Nothing weakens Spark's
    defaults: a query whose offsets were lost fails unless the caller says
    otherwise. A poll takes ``max_per_trigger`` messages (None: no bound).

    Client properties are passed through with the ``kafka.`` prefix;
    ``group.id`` is dropped (Spark makes its own group per query, and nothing
    is committed back to the broker: S16). ``topic_offsets`` is the
    per-partition JSON built by :func:`tidemark.operators.offsets.starting_offsets_json`.
    """
    opts: dict[str, str] = {}
    for k, v in config.items():
        if k == "group.id":
            continue
        opts[k if k.startswith("kafka.") else f"kafka.{k}"] = str(v)
    topics = list(subscribe)
    if topics:
        opts["subscribe"] = ",".join(topics)
    if topic_offsets is not None:
        opts["startingOffsets"] = topic_offsets if isinstance(topic_offsets, str) else str(topic_offsets)
    if starting_timestamp_ms is not None:
        opts["startingTimestamp"] = str(int(starting_timestamp_ms))
        opts["startingOffsetsByTimestampStrategy"] = "latest"
    if max_per_trigger is not None:
        opts["maxOffsetsPerTrigger"] = str(int(max_per_trigger))
    return opts | {k: str(v) for k, v in (source or {}).items()}


def kafka_policy_options(policy: str, time_ms: int | None = None,
                         as_of_ms: int | None = None) -> dict[str, str]:
    """Starting position of one topic under a single policy."""
    if policy == "earliest":
        return {"startingOffsets": "earliest"}
    if policy == "latest":
        return {"startingOffsets": "latest"}
    if policy == "absolute_time":
        target = int(time_ms)
    elif policy == "relative_time":
        if as_of_ms is None:
            raise ValueError("relative_time needs an explicit as_of_ms")
        target = int(as_of_ms) - int(time_ms)
    else:
        raise ValueError(f"no starting position for policy {policy!r}")
    return _from_instant(target)


def kafka_topic_options(config: Mapping[str, str], topics: Iterable[Any], as_of_ms: int | None = None,
                        batch_size: int | None = None, ends: Mapping[str, Mapping[int, int]] | None = None,
                        source: Mapping[str, str] | None = None, streaming: bool = True) -> dict[str, dict[str, str]]:
    """One option map per topic, each with its own starting
    policy. A start of day is resolved to its instant here.

    A stream's poll bound is shared by the topics (Spark bounds each reader by
    itself). ``ends`` fixes a batch read at ``{topic: {partition: offset}}``;
    a topic without an entry is read to its end as of the start of the query.
    """
    specs = validate_topics(topics)
    share = -(-int(batch_size or DEFAULT_BATCH_SIZE) // max(len(specs), 1)) if streaming else None
    out = {}
    for t in specs:
        opts = kafka_options(config, subscribe=[t.name], max_per_trigger=share, source=source)
        if t.policy == START_OF_DAY:
            opts |= _from_instant(start_of_day_ms(as_of_ms, t.time_ms, t.timezone))
        else:
            opts |= kafka_policy_options(t.policy, t.time_ms, as_of_ms)
        if not streaming:
            fixed = (ends or {}).get(t.name)
            opts["endingOffsets"] = json.dumps({t.name: {str(p): int(o) for p, o in sorted(fixed.items())}}) if fixed else "latest"
        out[t.name] = opts
    return out


def start_of_day_ms(as_of_ms: int | None, time_ms: int, timezone: str) -> int:
    """Local midnight of the day of ``as_of_ms`` plus ``time_ms``, in epoch ms."""
    if as_of_ms is None:
        raise ValueError("start_of_day needs an explicit as_of_ms")
    local = datetime.fromtimestamp(as_of_ms / 1000, tz=ZoneInfo(timezone))
    midnight = local.replace(hour=0, minute=0, second=0, microsecond=0)
    return int(midnight.timestamp() * 1000) + int(time_ms)


def _from_instant(ms: int) -> dict[str, str]:
    return {"startingTimestamp": str(int(ms)), "startingOffsetsByTimestampStrategy": "latest"}


def read_kafka_topics(spark: SparkSession, config: Mapping[str, str], topics: Iterable[Any],
                      streaming: bool = True, **kw) -> DataFrame:
    """S1 over live topics: one Kafka reader per topic with its own policy,
    united. Needs the Kafka connector on the classpath."""
    options = kafka_topic_options(config, topics, streaming=streaming, **kw)
    if not options:
        raise ValueError("no topics given")
    return reduce(DataFrame.unionByName, [read_kafka(spark, o, streaming) for o in options.values()])


def read_kafka(spark: SparkSession, options: Mapping[str, str], streaming: bool = True) -> DataFrame:
    """Kafka records projected to the log layout (needs the Kafka connector
    on the classpath; it is not installed in the local test image)."""
    reader = spark.readStream if streaming else spark.read
    raw = reader.format("kafka").options(**options).load()
    return raw.select(
        "topic", F.col("partition").cast("int"), F.col("offset").cast("long"),
        F.unix_millis("timestamp").alias("timestamp_ms"), "key", "value")
