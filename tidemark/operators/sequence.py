"""Dense sequence numbers without a single-task window.

``row_number().over(Window.orderBy(...))`` moves every row into one task, and
``partitionBy(group)`` does the same for a hot group. Here the rows are
range-partitioned on ``group + order`` (Spark samples the keys, so a group
holding a third of all rows is split over many tasks), sorted inside each
task, numbered locally with ``monotonically_increasing_id`` and shifted by the
running count of earlier tasks. Only the per-(task, group) count table moves
between stages; it has at most ``tasks + groups`` rows.

The keys must be unique per row. The range-partitioned, locally numbered
rows are written once to the shared checkpoint folder before the counts are
taken: both uses then read the same partitions (Catalyst would otherwise plan
two range exchanges with different column sets, which adaptive execution may
coalesce differently), and a lost executor cannot renumber them.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

_LOW_BITS = (1 << 33) - 1


def sequence_number(df: DataFrame, order_cols: Sequence[str], out_col: str,
                    group_cols: Sequence[str] = (), base: int = 0,
                    num_partitions: int | None = None) -> DataFrame:
    """Add ``out_col`` = base + position of the row inside its group, ordered
    by ``order_cols`` ascending (ties must not exist)."""
    group_cols = list(group_cols)
    keys = group_cols + list(order_cols)
    ranged = (df.repartitionByRange(num_partitions, *keys) if num_partitions
              else df.repartitionByRange(*keys))
    ranged = (ranged.sortWithinPartitions(*keys)
              .withColumn("_mid", F.monotonically_increasing_id())
              .withColumn("_pid", F.shiftright("_mid", 33))
              .withColumn("_idx", F.col("_mid").bitwiseAND(F.lit(_LOW_BITS))))
    ranged = materialize(ranged)
    counts = ranged.groupBy("_pid", *group_cols).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_idx").alias("_first"))
    w = (Window.partitionBy(*group_cols) if group_cols else Window.partitionBy())
    w = w.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("_pid", *group_cols, "_first",
                           F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before"))
    if not group_cols:
        # One row per task: bounded by the partition count, safe to broadcast.
        # With groups there are at most tasks + groups rows; Spark decides by
        # their measured size.
        counts = F.broadcast(counts)
    out = ranged.join(counts, ["_pid", *group_cols])
    return out.withColumn(
        out_col,
        (F.col("_before") + F.col("_idx") - F.col("_first") + F.lit(base)).cast("long"),
    ).drop("_mid", "_pid", "_idx", "_first", "_before")
