"""Quality checks on a released stream."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .prefix import running


def batch_size_violations(batches: DataFrame, batch_col: str, batch_size: int) -> DataFrame:
    """Batches holding more than ``batch_size`` messages."""
    return (batches.groupBy(batch_col).agg(F.count(F.lit(1)).alias("messages"))
            .filter(F.col("messages") > F.lit(batch_size)))


def order_violations(batches: DataFrame, batch_col: str, live: DataFrame | None = None) -> DataFrame:
    """Batches whose smallest timestamp is below the largest one of the
    batch before. Batches released while live are left out altogether: they
    are not judged and do not count as the batch before (W2).
    """
    per = batches.groupBy(batch_col).agg(F.min("timestamp_ms").alias("min_ts"),
                                         F.max("timestamp_ms").alias("max_ts"))
    if live is not None:
        per = per.join(live.filter("is_live").select(batch_col), batch_col, "left_anti")
    per = running(per, batch_col, {"prev_max_ts": ("last", "max_ts")}, exclusive=True)
    return per.filter(F.col("min_ts") < F.col("prev_max_ts")).select(
        batch_col, "min_ts", "max_ts", "prev_max_ts")


def compare_expected(actual: DataFrame, expected: DataFrame, keys: list[str],
                     checked: list[str], complete: bool = True) -> DataFrame:
    """what differs from the expectations. A null expectation of a present
    row means "not checked". ``problem`` says which: "value" (a checked value
    differs), "absent" (expected, not there) or, with ``complete``, "extra"
    (there, not expected)."""
    a = actual.select(*keys, *[F.col(c).alias(f"actual_{c}") for c in checked], F.lit(True).alias("_a"))
    e = expected.select(*keys, *[F.col(c).alias(f"expected_{c}") for c in checked], F.lit(True).alias("_e"))
    differs = reduce(lambda x, y: x | y, [
        F.col(f"expected_{c}").isNotNull() & ~F.col(f"actual_{c}").eqNullSafe(F.col(f"expected_{c}")) for c in checked],
        F.lit(False))
    problem = F.when(F.col("_a").isNull(), F.lit("absent")) \
        .when(F.col("_e").isNull(), F.lit("extra" if complete else None)).when(differs, F.lit("value"))
    return a.join(e, keys, "full_outer").withColumn("problem", problem).filter("problem IS NOT NULL").drop("_a", "_e")
