"""Running sums, maxima and last values over a long axis, in blocks.

``Window.orderBy(axis)`` alone moves every row into one task. Here the axis (a
non-negative long: polls, batches) is cut into blocks of ``2 ** BLOCK_BITS``
values: a window inside each block, one total per block, the same again over
the blocks, and a last window over at most axis / 2 ** (2 * BLOCK_BITS) rows.
Totals return by an equi-join on the block. Values may be missing. The rows
(one per value of the axis) are written to the shared folder first.
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

BLOCK_BITS = 12
LEVELS = 2
_FUNCTIONS = {"sum": F.sum, "max": F.max, "min": F.min}


def _window_value(fn: str, col: str, axis: str, w) -> Column:
    if fn == "last":
        return F.max(F.struct(F.col(axis), F.col(col))).over(w)[col]
    return _FUNCTIONS[fn](col).over(w)


def _block_value(fn: str, col: str, axis: str) -> Column:
    return F.max_by(col, axis) if fn == "last" else _FUNCTIONS[fn](col)


def _together(fn: str, before: Column, own: Column) -> Column:
    if fn == "sum":
        return F.coalesce(before, F.lit(0)) + F.coalesce(own, F.lit(0))
    if fn == "last":
        return F.coalesce(own, before)
    return (F.greatest if fn == "max" else F.least)(before, own)  # both skip nulls


def running(df: DataFrame, axis: str, columns: Mapping[str, tuple[str, str]], exclusive: bool = False,
            levels: int = LEVELS) -> DataFrame:
    """Add ``{name: (fn, column)}`` over the rows up to each one in ``axis``
    order (without its own, if ``exclusive``). ``axis`` must be unique. fn: sum,
    max, min, or last (the nearest row's value; its column must not be null).
    With no row before it an exclusive sum is 0, the others are null."""
    end = -1 if exclusive else 0
    if levels == LEVELS:
        df = materialize(df, "axis")  # read twice on each level below
    if levels == 0:
        w = Window.orderBy(axis).rowsBetween(Window.unboundedPreceding, end)
        out = df.select("*", *[_window_value(fn, c, axis, w).alias(n) for n, (fn, c) in columns.items()])
        sums = [n for n, (fn, _) in columns.items() if fn == "sum"]
        return out.fillna(0, sums) if sums else out
    key = f"_block{levels}"
    df = df.withColumn(key, F.shiftright(F.col(axis).cast("long"), BLOCK_BITS))
    w = Window.partitionBy(key).orderBy(axis).rowsBetween(Window.unboundedPreceding, end)
    own = df.select("*", *[_window_value(fn, c, axis, w).alias(f"_own{levels}_{n}") for n, (fn, c) in columns.items()])
    totals = df.groupBy(key).agg(*[_block_value(fn, c, axis).alias(f"_total{levels}_{n}") for n, (fn, c) in columns.items()])
    before = running(totals, key, {f"_before{levels}_{n}": (fn, f"_total{levels}_{n}") for n, (fn, _) in columns.items()},
                     True, levels - 1)
    out = own.join(before.select(key, *[f"_before{levels}_{n}" for n in columns]), key)
    return out.select(*[c for c in df.columns if c != key], *[
        _together(fn, F.col(f"_before{levels}_{n}"), F.col(f"_own{levels}_{n}")).alias(n) for n, (fn, _) in columns.items()])


def following(df: DataFrame, group: list[str], axis: str, out: str) -> DataFrame:
    """Add the next larger ``axis`` value of the row's group; null in its last row.
    ``axis`` must be unique in a group. A window over a group would move it into one
    task; here it goes over its blocks, and the blocks' first values are looked up."""
    block = F.shiftright(F.col(axis).cast("long"), BLOCK_BITS)
    df = df.withColumn("_block", block)
    own = F.lead(axis).over(Window.partitionBy(*group, "_block").orderBy(axis))
    firsts = df.groupBy(*group, "_block").agg(F.min(axis).alias("_first"))
    firsts = firsts.withColumn("_next", F.lead("_first").over(Window.partitionBy(*group).orderBy("_block")))
    renamed = firsts.select(*[F.col(c).alias(f"_of_{c}") for c in (*group, "_block")], "_next")
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in (*group, "_block")]
    joined = df.withColumn("_own", own).join(renamed, same, "left")
    return joined.select(*[c for c in df.columns if c != "_block"], F.coalesce("_own", "_next").alias(out))
