"""The two fixed output schemas and the message projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names, types and nullability of the two output tables.
MESSAGE_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType(), True),
    T.StructField("value", T.BinaryType(), True),
    T.StructField("topic", T.StringType(), False),
    T.StructField("partition", T.IntegerType(), False),
    T.StructField("offset", T.LongType(), False),
    T.StructField("timestamp", T.TimestampType(), False),
])

PARTITION_STATE_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType(), False),
    T.StructField("partition", T.IntegerType(), False),
    T.StructField("replay_start_offset", T.LongType(), False),
    T.StructField("replay_end_offset", T.LongType(), False),
    T.StructField("consumed_offset", T.LongType(), False),
    T.StructField("released_offset", T.LongType(), False),
    T.StructField("last_consumed_timestamp", T.TimestampType(), True),
    T.StructField("is_live", T.BooleanType(), False),
    T.StructField("is_paused", T.BooleanType(), False),
])

# Internal log layout: the message columns with the timestamp kept as epoch ms.
LOG_COLUMNS = ["topic", "partition", "offset", "timestamp_ms", "key", "value"]
TP = ["topic", "partition"]
MAX_LIMIT = (1 << 63) - 1  # "no limit" for the release gate


def int_div(value: Column, by: Column | int) -> Column:
    """Whole quotient of two longs, exact (no detour through doubles)."""
    by = F.lit(by) if isinstance(by, int) else by
    return F.call_function("div", value.cast("long"), by.cast("long"))


def get_message_schema() -> T.StructType:
    return MESSAGE_SCHEMA


def get_partition_state_schema() -> T.StructType:
    return PARTITION_STATE_SCHEMA


def ms_to_timestamp(col: Column | str) -> Column:
    """Epoch ms (long) -> TimestampType with ms precision."""
    return F.timestamp_millis(F.col(col) if isinstance(col, str) else col)


def timestamp_to_ms(col: Column | str) -> Column:
    """TimestampType -> epoch ms, truncating sub-ms digits (floor)."""
    return F.unix_millis(F.col(col) if isinstance(col, str) else col)


def drop_untimestamped(log: DataFrame) -> DataFrame:
    """A message without a timestamp is not consumed at all."""
    return log.filter(F.col("timestamp_ms").isNotNull())


def to_messages(log: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Project a log (epoch-ms layout) to the fixed message schema.

    Null keys and values (tombstones, P3) pass through unchanged.
    """
    cols = [
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.col("topic").cast("string").alias("topic"),
        F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("long").alias("offset"),
        ms_to_timestamp("timestamp_ms").alias("timestamp"),
    ]
    return drop_untimestamped(log).select(*cols, *(extra or []))


def decode_value(col: str = "value") -> Column:
    """P5: null-safe UTF-8 decode of a binary payload."""
    return F.decode(F.col(col).cast("binary"), "UTF-8")
