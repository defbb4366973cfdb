"""Ordered release.

Release key (the stable sort of the held buffer, ties made deterministic,
Q5): ``(release_epoch, timestamp_ms, arrival_epoch, topic, partition,
offset)``.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import MAX_LIMIT, TP, int_div
from ..session import materialize
from .prefix import running
from .sequence import sequence_number

ORDER_KEY = ["timestamp_ms", "topic", "partition", "offset"]
BUFFER_KEY = ["timestamp_ms", "arrival_epoch", "topic", "partition", "offset"]
RELEASE_KEY = ["release_epoch"] + BUFFER_KEY
SPREAD = 4096  # keys of rows that a join has nothing for


def ordered_replay(slice_df: DataFrame, out_col: str = "position") -> DataFrame:
    """Every message of a fully available replay in timestamp order, as a
    dense 0-based position. Range-partitioned, no single-task window."""
    return sequence_number(slice_df, ORDER_KEY, out_col)


def replay_batches(slice_df: DataFrame, batch_size: int) -> DataFrame:
    """Cut the ordered replay into batches of ``batch_size`` messages."""
    ranked = ordered_replay(slice_df)
    return ranked.withColumn("batch_id", int_div(F.col("position"), batch_size))


def release_epochs(msgs: DataFrame, limits: DataFrame, e_end: int) -> DataFrame:
    """The poll that releases each message without a cap: the first poll
    at or after its arrival ``a`` whose limit is at or above its timestamp
    ``t``; null when it is held for ever.

    With ``M`` the running maximum of the limit (non-decreasing):

    * ``limit(a) >= t``: released at ``a``;
    * ``t > M(a)``: released at the first poll where ``M`` reaches ``t``, which
      is after ``a`` by construction: an as-of lookup on the rises of ``M``,
      by equi-join on a value bucket that lists the rises in it;
    * otherwise (the limit dipped below an earlier high): the limits in blocks
      of ``K ~ sqrt(polls)`` polls, one array row each. The message searches its
      own block from its arrival on, else the one-row summary (largest limit
      per block) for the first later block that can release it, then that.

    One pass over the messages with four equi-joins to tables of at most one
    row per poll. A message that does not need a join has a key that occurs
    nowhere, spread over ``SPREAD`` values, so no key gathers them.
    """
    lim = limits.select(F.col("epoch").cast("long").alias("e"), F.col("release_limit").alias("l"))
    lim = running(lim, "e", {"mp": ("max", "l")}, exclusive=True).withColumn("m", F.greatest("mp", "l"))
    lim = materialize(lim, "limits")
    steps = (lim.filter(F.col("mp").isNull() | (F.col("m") > F.col("mp")))
             .select(F.col("e").alias("se"), F.col("mp").alias("lo"), F.col("m").alias("hi")))
    finite = F.col("hi") < MAX_LIMIT
    st = steps.agg(F.count(F.lit(1)).alias("n"), F.min(F.when(finite, F.col("hi"))).alias("base"),
                   F.max(F.when(finite, F.col("hi"))).alias("top"),
                   F.min(F.when(F.col("lo").isNull(), F.col("se"))).alias("first_e"),
                   F.min(F.when(~finite, F.col("se"))).alias("max_e")).first()
    base, top = (int(st["base"]), int(st["top"])) if st["base"] is not None else (0, -1)
    width = max(1, -(-(top - base) // max(int(st["n"]), 1)))
    first_e, max_e = (F.lit(st[c]).cast("long") for c in ("first_e", "max_e"))
    no_finite = F.lit(st["base"] is None)

    def bucket(c):
        return int_div(c - F.lit(base), width)

    rises = steps.filter(finite & F.col("lo").isNotNull()).select(
        F.explode(F.sequence(bucket(F.col("lo") + 1), bucket(F.col("hi")))).alias("_b"), F.struct("lo", "hi", "se").alias("x"))
    rises = rises.groupBy("_b").agg(F.collect_list("x").alias("_rises"))
    k = max(16, int(math.ceil(math.sqrt(max(e_end + 1, 1)))))
    blocks = lim.groupBy(int_div(F.col("e"), k).alias("_blk")).agg(
        F.array_sort(F.collect_list(F.struct("e", "l"))).alias("_own"), F.max("l").alias("_top"))
    summary = blocks.agg(F.array_sort(F.collect_list(F.struct(F.col("_blk").alias("b"), F.col("_top").alias("m")))).alias("_sum"))
    later = blocks.select(F.col("_blk").alias("_nb"), F.col("_own").alias("_later"))

    a, t = F.col("arrival_epoch"), F.col("timestamp_ms")
    nowhere = -1 - F.pmod(F.col("offset"), F.lit(SPREAD))
    m = msgs.join(lim.select(F.col("e").alias("arrival_epoch"), F.col("l").alias("_la"), F.col("m").alias("_ma")),
                  "arrival_epoch", "left")
    m = m.withColumn("_case", F.when(F.col("_la") >= t, "now").when(F.col("_ma") < t, "rise").otherwise("dip"))
    rise, dip = F.col("_case") == "rise", F.col("_case") == "dip"
    m = m.withColumn("_b", F.when(rise & (t > base) & (t <= top), bucket(t)).otherwise(nowhere)).join(rises, "_b", "left")
    m = m.withColumn("_blk", F.when(dip, int_div(a, k)).otherwise(nowhere)).join(blocks.select("_blk", "_own"), "_blk", "left")
    own = F.try_element_at(F.filter("_own", lambda x: (x["e"] >= a) & (x["l"] >= t)), F.lit(1))["e"]
    m = m.withColumn("_here", own).crossJoin(F.broadcast(summary))  # one row
    nb = F.try_element_at(F.filter("_sum", lambda x: (x["b"] > F.col("_blk")) & (x["m"] >= t)), F.lit(1))["b"]
    m = m.withColumn("_nb", F.coalesce(F.when(dip & F.col("_here").isNull(), nb), nowhere)).join(later, "_nb", "left")
    there = F.try_element_at(F.filter("_later", lambda x: x["l"] >= t), F.lit(1))["e"]
    risen = F.try_element_at(F.filter("_rises", lambda x: (x["lo"] < t) & (t <= x["hi"])), F.lit(1))["se"]
    risen = F.when(no_finite | (t > top), max_e).when(t <= base, first_e).otherwise(risen)
    out = F.when(F.col("_case") == "now", a).when(rise, risen).otherwise(F.coalesce("_here", there))
    return m.withColumn("release_epoch", out.cast("long")).drop(
        "_la", "_ma", "_case", "_b", "_rises", "_blk", "_own", "_here", "_sum", "_nb", "_later")


def release_order(released: DataFrame, out_col: str = "release_position") -> DataFrame:
    """Global 0-based position of released messages in release order."""
    return sequence_number(released.filter(F.col("release_epoch").isNotNull()), RELEASE_KEY, out_col)


def held_at(msgs_with_release: DataFrame, epoch: int) -> DataFrame:
    """The buffer when poll ``epoch`` releases: arrived by then and not
    released before it."""
    re = F.col("release_epoch")
    return msgs_with_release.filter(
        (F.col("arrival_epoch") <= epoch) & (re.isNull() | (re >= epoch)))


def release_batch(held: DataFrame, limit: int, batch_size: int) -> DataFrame:
    """R2: the first ``batch_size`` held messages with timestamp <= limit, in
    buffer order (``TakeOrderedAndProject``; the output is bounded by the
    batch size)."""
    top = (held.filter(F.col("timestamp_ms") <= F.lit(limit))
           .orderBy(*BUFFER_KEY).limit(batch_size))
    w = Window.orderBy(*BUFFER_KEY)  # over at most batch_size rows
    return top.withColumn("batch_position", (F.row_number().over(w) - 1).cast("long"))


def held_after(held: DataFrame, released: DataFrame) -> DataFrame:
    """What stays in the buffer: rows whose buffer key is above that of
    the last released one (a filter; the buffer is neither joined nor moved),
    all of them when nothing was released."""
    last = released.agg(F.max(F.struct(*BUFFER_KEY)).alias("k")).first()["k"]
    if last is None:
        return held
    types = {f.name: f.dataType for f in held.schema.fields}
    key = F.struct(*[F.lit(last[c]).cast(types[c]).alias(c) for c in BUFFER_KEY])
    return held.filter(F.struct(*BUFFER_KEY) > key)


def eligible_counts(msgs_rel: DataFrame, spark, e_end: int) -> DataFrame:
    """Per poll: messages that became releasable (uncapped release poll)."""
    per = msgs_rel.filter(F.col("release_epoch").isNotNull()).groupBy(
        F.col("release_epoch").alias("epoch")).agg(F.count(F.lit(1)).alias("_new"))
    epochs = spark.range(0, e_end + 1).withColumnRenamed("id", "epoch")
    return epochs.join(per, "epoch", "left").fillna(0, ["_new"])


def paced_counts(msgs_rel: DataFrame, limits: DataFrame, batch_size: int, spark, e_end: int) -> DataFrame:
    """Messages released per poll under a cap of ``batch_size``.

    While rows that are ready stay ready, R(e) = min(R(e-1) + B, E(e)) where E(e)
    is the number of messages releasable by poll e, i.e.
    R(e) = B*(e+1) + min(0, min_{k<=e} (E(k) - B*(k+1))). After the last arrival
    (T6) the backlog leaves in full batches, so those polls are listed in closed
    form. Where a limit falls while rows wait, the counts are those of the exact
    rows (R7).
    """
    counts = running(eligible_counts(msgs_rel, spark, e_end), "epoch", {"eligible_total": ("sum", "_new")})
    b = F.lit(batch_size)
    cum = counts.withColumn("_slack", F.col("eligible_total") - b * (F.col("epoch") + 1))
    cum = running(cum, "epoch", {"_low": ("min", "_slack")}, exclusive=True)
    before = b * F.col("epoch") + F.least(F.lit(0), F.col("_low"))
    total = b * (F.col("epoch") + 1) + F.least(F.lit(0), F.col("_low"), F.col("_slack"))
    cum = materialize(cum.select("epoch", F.col("eligible_total").cast("long"), (total - before).cast("long").alias("released"),
                                 total.cast("long").alias("released_total")), "paced")
    waits = cum.filter("eligible_total > released_total").select((F.col("epoch") + 1).alias("epoch"))
    earlier = limits.select((F.col("epoch") + 1).alias("epoch"), F.col("release_limit").alias("_before"))
    falls = limits.select("epoch", "release_limit").join(earlier, "epoch").filter("release_limit < _before")
    if not falls.join(waits, "epoch").isEmpty():
        from .paced import paced_totals
        per = paced_totals(msgs_rel, limits, batch_size, e_end)
        out = cum.select("epoch", "eligible_total").join(per, "epoch", "full_outer").fillna(0, ["released"])
        out = running(out.withColumn("_e", F.coalesce("eligible_total", F.lit(0))), "epoch",
                      {"_total": ("max", "_e"), "released_total": ("sum", "released")})
        return out.select("epoch", F.col("_total").cast("long").alias("eligible_total"),
                          F.col("released").cast("long"), F.col("released_total").cast("long"))
    end = cum.filter(F.col("epoch") == e_end).first()
    left = 0 if end is None else int(end["eligible_total"] - end["released_total"])
    k = F.col("id")
    tail = spark.range(0, -(-left // batch_size)).select(
        (k + e_end + 1).alias("epoch"), F.lit(int(end["eligible_total"]) if end else 0).cast("long").alias("eligible_total"),
        F.least(b, F.lit(left) - k * b).cast("long").alias("released"),
        (F.lit(int(end["released_total"]) if end else 0) + F.least((k + 1) * b, F.lit(left))).cast("long").alias("released_total"))
    return cum.unionByName(tail)


def released_state(msgs_rel: DataFrame, ranges: DataFrame, upto_epoch: int | None = None) -> DataFrame:
    """Per partition the last released offset in *release order* (can go
    back with out-of-order data, Q3) and whether it reached the end."""
    m = msgs_rel.filter(F.col("release_epoch").isNotNull())
    if upto_epoch is not None:
        m = m.filter(F.col("release_epoch") <= upto_epoch)
    key = F.struct(*[F.col(c) for c in RELEASE_KEY if c not in TP])
    agg = m.groupBy(*TP).agg(F.max_by("offset", key).alias("_rel"))
    out = ranges.join(agg, TP, "left")
    return out.select(
        *TP,
        F.coalesce(F.col("_rel"), F.col("replay_start_offset")).alias("released_offset"),
        F.when(F.col("_rel").isNull(), F.col("replay_start_offset") >= F.col("replay_end_offset"))
        .otherwise(F.col("_rel") + 1 >= F.col("replay_end_offset")).alias("is_live"),
    )


def late_messages(msgs_rel: DataFrame) -> DataFrame:
    """T5: messages released after a newer message already went out; they
    are never dropped, only flagged. ``prior_max_ts`` is the largest
    timestamp released in earlier polls (one row per poll, running max)."""
    per = msgs_rel.filter(F.col("release_epoch").isNotNull()).groupBy("release_epoch").agg(
        F.max("timestamp_ms").alias("_mx"))
    prior = running(per, "release_epoch", {"prior_max_ts": ("max", "_mx")}, exclusive=True)
    return (msgs_rel.join(prior.select("release_epoch", "prior_max_ts"), "release_epoch")
            .filter(F.col("timestamp_ms") < F.col("prior_max_ts")))


def drain_tail(held: DataFrame, limit: int, batch_size: int, first_epoch: int) -> DataFrame:
    """After the last arrival the buffer no longer changes, so the
    remaining releasable rows leave in buffer order, ``batch_size`` per
    poll, from ``first_epoch`` on. Rows above the limit stay held (null)."""
    ok = held.filter(F.col("timestamp_ms") <= F.lit(limit))
    ranked = sequence_number(ok, BUFFER_KEY, "_pos")
    tail = ranked.withColumn("release_epoch", F.lit(first_epoch) + int_div(F.col("_pos"), batch_size)) \
        .drop("_pos")
    never = held.filter(~(F.col("timestamp_ms") <= F.lit(limit))).withColumn(
        "release_epoch", F.lit(None).cast("long"))
    return tail.unionByName(never)
