"""Log-fixture operators (F1, F3): nested topic logs and poll plans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import TP

# topic -> partition id (as text) -> messages
MESSAGE_FIELDS = T.StructType([
    T.StructField("offset", T.LongType(), False),
    T.StructField("timestamp_ms", T.LongType(), False),
    T.StructField("key", T.StringType(), True),
    T.StructField("value", T.StringType(), True),
])
NESTED_LOG_TYPE = T.MapType(T.StringType(), T.MapType(T.StringType(), T.ArrayType(MESSAGE_FIELDS)))


def flatten_nested_log(nested: DataFrame, col: str = "log") -> DataFrame:
    """explode topic map, partition map and message array into log rows."""
    t = nested.select(F.explode(col).alias("topic", "_parts"))
    p = t.select("topic", F.explode("_parts").alias("_pid", "_msgs"))
    m = p.select("topic", F.col("_pid").cast("int").alias("partition"), F.explode("_msgs").alias("_m"))
    return m.select("topic", "partition", F.col("_m.offset").alias("offset"),
                    F.col("_m.timestamp_ms").alias("timestamp_ms"),
                    F.col("_m.key").alias("key"), F.col("_m.value").alias("value"))


def read_nested_log(spark, path: str) -> DataFrame:
    """Read a JSON topic-data file (one object per file) with an explicit schema."""
    schema = T.StructType([T.StructField("log", NESTED_LOG_TYPE)])
    raw = spark.read.text(path, wholetext=True)
    parsed = raw.select(F.from_json("value", NESTED_LOG_TYPE).alias("log"))
    return flatten_nested_log(parsed)


def apply_poll_plan(log: DataFrame, plan: DataFrame) -> DataFrame:
    """plan rows ``(poll, topic, partition, offsets array)`` -> the log
    messages of each poll, keeping the listed order as ``position``."""
    exploded = plan.select("poll", *TP, F.posexplode("offsets").alias("position", "offset"))
    return exploded.join(log, [*TP, "offset"])


def poll_plan_missing(log: DataFrame, plan: DataFrame) -> DataFrame:
    """F3 errors: planned offsets that the log does not have."""
    exploded = plan.select("poll", *TP, F.explode("offsets").alias("offset"))
    return exploded.join(log.select(*TP, "offset"), [*TP, "offset"], "left_anti") \
        .select("poll", *TP, F.col("offset").cast("long"))
