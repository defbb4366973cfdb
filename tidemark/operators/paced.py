"""Capped release, exact rows (R7), without a loop over polls.

A poll releases the first ``batch_size`` of the rows that are there and at or below
its limit, in buffer order. A row is *ready* at the first poll from its arrival on
whose limit covers it: its uncapped release poll (R5). As long as ready rows stay
ready, taking the rows in buffer order and giving each the first poll from its
readiness on that has room yields the same as going poll by poll: what a row gets
depends only on the rows before it in that order, and those are served first.

* How many rows wait after each poll follows from counts per poll alone: running sums
  and a running minimum. A poll that begins and ends with nobody waiting releases
  what is ready. Polls between two such moments are a *busy period*; no row leaves
  its period, so periods are solved apart, small ones bundled into one task.
* A period of more than ``LEAF`` rows is halved by rank in buffer order, and again.
  The lower half is served first: which polls it fills is again a running sum and a
  running minimum over counts, here of all halves at once; the upper half gets the
  rest. Ranks are given once; only counts per (half, poll) move at each level.
* In a task, rows in buffer order take the first poll with room.

Only a limit below an earlier one takes readiness away, and that changes a poll only
if too few rows stay below it. A row is *settled* at the first poll from its arrival on
from which no limit is below it. Where the settled rows fill a poll, whatever has left
before, it releases the same rows as if readiness stayed. At the first poll that is not
sure in this way, the rows of up to ``CHUNK`` rows' worth of polls around it go through
one task, poll by poll; a longer sure stretch before it is placed as above. Rows not
served by then are carried, with the next poll whose limit covers them; all others are
neither read nor written again. So the number of jobs grows with the rows of the unsure
polls / CHUNK and with log(rows of a period / LEAF), not with the polls or the falls.

A caller whose rows are few by its own bound (a stream's micro-batch) says so with
``whole``: up to so many rows then go through all polls in one task, in a few jobs.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import int_div
from ..session import materialize
from .prefix import running
from .release import BUFFER_KEY, release_epochs
from .sequence import sequence_number

LEAF = 1 << 17  # rows that one task places
CHUNK = 1 << 19  # rows that one task takes through polls whose limits fall


def paced_replay(msgs: DataFrame, limits: DataFrame, batch_size: int, e_end: int, leaf: int = LEAF, chunk: int = CHUNK,
                 whole: int = 0) -> DataFrame:
    """``msgs`` (arrival_epoch and buffer key; release_epoch if R5 has been run)
    with the poll that releases each row under a cap, null where none does. After
    poll ``e_end`` empty polls drain what is left (T6)."""
    spark = msgs.sparkSession
    cols = [c for c in msgs.columns if c != "release_epoch"]
    if whole:
        msgs = materialize(msgs if "release_epoch" in msgs.columns else release_epochs(msgs, limits, e_end), "ready")
        if msgs.count() <= whole:
            rows = msgs.withColumnRenamed("release_epoch", "ready")
            done = _by_poll(spark, rows.filter("ready IS NOT NULL"), limits.select("epoch", "release_limit"), batch_size, 0, None, None)
            never = rows.filter("ready IS NULL").select(*cols, F.lit(None).cast("long").alias("release_epoch"))
            return done.select(*cols, "release_epoch").unionByName(never)
    limits, rows = _begin(msgs, limits, e_end)
    parts, start, carry, queue, _ = _sure_from(rows, limits, batch_size, e_end, leaf, chunk)
    parts.append(materialize(_place(spark, _pool(rows, carry, start), queue, batch_size, e_end, None, leaf), "paced"))
    never = rows.filter("ready IS NULL")
    if carry is not None:
        never = never.unionByName(carry.filter("ready IS NULL"))
    out = never.select(*cols, F.lit(None).cast("long").alias("release_epoch"))
    for p in parts:
        out = out.unionByName(p.select(*cols, "release_epoch"))
    return out


def paced_totals(msgs: DataFrame, limits: DataFrame, batch_size: int, e_end: int, chunk: int = CHUNK) -> DataFrame:
    """R6 from R7: epoch and released, the rows that each poll up to ``e_end`` releases,
    and those of the empty polls after it. Rows after the last unsure poll are only counted."""
    spark = msgs.sparkSession
    limits, rows = _begin(msgs, limits, e_end)
    parts, _, _, queue, _ = _sure_from(rows, limits, batch_size, e_end, LEAF, chunk)
    out = queue.select("epoch", (F.col("n") + F.col("waiting") - F.col("after")).alias("released"))
    end = queue.agg(F.max_by("after", "epoch").alias("after")).first()["after"] or 0
    left = F.lit(end) - F.col("id") * batch_size
    out = out.unionByName(spark.range(-(-end // batch_size)).select(
        (F.col("id") + e_end + 1).alias("epoch"), F.least(F.lit(batch_size), left).cast("long").alias("released")))
    for p in parts:
        out = out.unionByName(p.groupBy(F.col("release_epoch").alias("epoch")).agg(F.count(F.lit(1)).alias("released")))
    return out.filter("released > 0")


def _begin(msgs: DataFrame, limits: DataFrame, e_end: int) -> tuple[DataFrame, DataFrame]:
    """The limits, and the rows with the poll at which they are ready, both written."""
    cols = [c for c in msgs.columns if c != "release_epoch"]
    limits = materialize(limits.select("epoch", "release_limit"), "limits")
    if "release_epoch" not in msgs.columns:
        msgs = release_epochs(msgs, limits, e_end)
    order = ("ready", "topic", "partition", "offset")
    return limits, materialize(msgs.select(*cols, F.col("release_epoch").alias("ready"))
                               .repartitionByRange(*order).sortWithinPartitions(*order), "ready")


def _pool(rows: DataFrame, carry: DataFrame | None, start: int) -> DataFrame:
    pool = rows.filter(F.col("ready") >= start)
    return pool if carry is None else pool.unionByName(carry.filter("ready IS NOT NULL"))


def _sure_from(rows: DataFrame, limits: DataFrame, batch_size: int, e_end: int, leaf: int,
               chunk: int) -> tuple[list[DataFrame], int, DataFrame | None, DataFrame, int]:
    """Goes through the polls up to the last unsure one. Gives the placed rows, the first
    poll not gone through, the carried rows, the queue from that poll on, and how many
    rows have been placed."""
    spark = rows.sparkSession
    cols = [c for c in rows.columns if c != "ready"]
    start, gone, carry, parts, settled = 0, 0, None, [], None
    while True:
        pool = _pool(rows, carry, start)
        queue = _queue(spark, pool, limits, batch_size, start, e_end)
        unsure = queue.filter("low AND waiting > 0")
        if settled is None and not unsure.isEmpty():
            settled = _settled(rows, limits, e_end)
        if settled is not None:
            left = F.col("settled") - F.lit(gone) - F.col("earlier") + F.col("waiting")
            unsure = unsure.join(settled, "epoch").filter(left < batch_size)
        first = unsure.agg(F.min("epoch").alias("cut"), F.min_by("earlier", "epoch").alias("rows")).first()
        cut = first["cut"]
        if cut is None:
            return parts, start, carry, queue, gone
        head = queue.filter(F.col("epoch") == start).first()["n"]
        # of the rows ready at the start, so many polls release no others than the first of them
        polls = max(chunk // (2 * batch_size), 1) if head > chunk // 2 else e_end + 1
        most = min(head, polls * batch_size)
        if first["rows"] - head + most <= chunk and most <= chunk:
            fits = F.col("earlier") + F.col("n") - F.lit(head) + F.lit(most) <= chunk
            over = queue.filter((F.col("epoch") > start) & ~fits).agg(F.min("epoch")).first()[0]
            cut = min(over or e_end, start + polls, start + chunk, e_end)  # the last poll drains
            pool = pool.filter(F.col("ready") < cut)
            done = materialize(_by_poll(spark, pool, limits, batch_size, start, cut, most if most < head else None), "paced")
        else:
            pool, queue = pool.filter(F.col("ready") < cut), queue.filter(F.col("epoch") < cut)
            done = materialize(_place(spark, pool, queue, batch_size, e_end, cut, leaf), "paced")
        parts.append(done.filter(F.col("release_epoch") < cut))
        gone += parts[-1].count()
        over = done.filter(F.col("release_epoch") >= cut).select(*cols).withColumn("arrived", F.col("arrival_epoch"))
        over = release_epochs(over.withColumn("arrival_epoch", F.lit(cut).cast("long")), limits, e_end)
        over = over.select(*[F.col("arrived").alias(c) if c == "arrival_epoch" else F.col(c) for c in cols], F.col("release_epoch").alias("ready"))
        if carry is not None:
            over = over.unionByName(carry.filter((F.col("ready") >= cut) | F.col("ready").isNull()))
        start, carry = cut, materialize(over, "carried")


def _settled(rows: DataFrame, limits: DataFrame, e_end: int) -> DataFrame:
    """Per poll, the rows arrived by then that no limit from then on is below."""
    back = limits.withColumn("back", F.lit(e_end) - F.col("epoch"))
    lowest = running(back, "back", {"lowest": ("min", "release_limit")}).select("epoch", F.col("lowest").alias("release_limit"))
    once = release_epochs(rows.drop("ready"), lowest, e_end).filter("release_epoch IS NOT NULL")
    n = once.groupBy(F.col("release_epoch").alias("epoch")).agg(F.count(F.lit(1)).alias("n"))
    polls = limits.select("epoch").join(n, "epoch", "left").fillna(0, ["n"])
    return materialize(running(polls, "epoch", {"settled": ("sum", "n")}).select("epoch", "settled"), "settled")


def _queue(spark: SparkSession, pool: DataFrame, limits: DataFrame, batch_size: int, start: int, e_end: int) -> DataFrame:
    """Of each poll from ``start`` on: rows that become ready (n), rows that wait
    before it and after it, its busy period, the rows ready before the poll, and
    whether its limit is below an earlier one (low)."""
    n = pool.groupBy(F.col("ready").alias("epoch")).agg(F.count(F.lit(1)).alias("n"))
    polls = spark.range(start, e_end + 1).withColumnRenamed("id", "epoch").join(n, "epoch", "left").fillna(0, ["n"])
    q = running(polls.join(limits, "epoch"), "epoch", {"total": ("sum", "n")})
    q = q.withColumn("slack", F.col("total") - batch_size * (F.col("epoch") - start + 1))
    q = running(q, "epoch", {"lowest": ("min", "slack"), "high": ("max", "release_limit")}, exclusive=True)
    zero = F.lit(0).cast("long")
    q = q.select("epoch", "n", (F.col("total") - F.col("n")).alias("earlier"),
                 (F.col("slack") - F.col("n") + batch_size - F.least(zero, "lowest")).alias("waiting"),
                 (F.col("slack") - F.least(zero, "lowest", "slack")).alias("after"),
                 F.coalesce(F.col("release_limit") < F.col("high"), F.lit(False)).alias("low"))
    q = running(q.withColumn("idle", (F.col("after") == 0).cast("long")), "epoch", {"period": ("sum", "idle")}, exclusive=True)
    return materialize(q.drop("idle"), "queue")


def _by_poll(spark: SparkSession, pool: DataFrame, limits: DataFrame, batch_size: int, start: int, cut: int | None, most: int | None) -> DataFrame:
    """Rows ready before ``cut`` with their poll, from ``cut`` on if they are not served,
    in one task. Only the first ``most`` of those ready at the start can be. Without a cut
    empty polls follow the last one, and rows that none releases have null."""
    rest = None
    if most is not None:
        at = pool.filter(F.col("ready") == start)
        ranked = sequence_number(at, BUFFER_KEY, "rank")
        rest = ranked.filter(F.col("rank") >= most).select(*pool.columns, F.lit(cut).cast("long").alias("release_epoch"))
        pool = pool.filter(F.col("ready") > start).unionByName(ranked.filter(F.col("rank") < most).drop("rank"))
    schema = T.StructType([f for f in pool.schema.fields] + [T.StructField("release_epoch", T.LongType())])
    polls = limits.filter((F.col("epoch") >= start) & (F.lit(True) if cut is None else F.col("epoch") < cut)).withColumn("of", F.lit(0))

    def run(rows: pa.Table, polls: pa.Table) -> pa.Table:
        return _take_by_poll(rows, polls, batch_size, cut)

    found = pool.withColumn("group", F.lit(0)).groupBy("group").cogroup(polls.groupBy("of")).applyInArrow(run, schema)
    return found if rest is None else found.unionByName(rest)


def _take_by_poll(rows: pa.Table, polls: pa.Table, batch_size: int, cut: int | None) -> pa.Table:
    rows = rows.sort_by([(c, "ascending") for c in BUFFER_KEY])
    polls = polls.sort_by("epoch")
    times = rows.column("timestamp_ms").to_pylist()
    became: dict[int, list[int]] = {}
    for k, ready in enumerate(rows.column("ready").to_pylist()):
        became.setdefault(ready, []).append(k)
    out, waiting = [cut] * len(times), []
    epoch = limit = -1
    for epoch, limit in zip(polls.column("epoch").to_pylist(), polls.column("release_limit").to_pylist()):
        for k in became.get(epoch, ()):
            heapq.heappush(waiting, k)
        room = batch_size
        while room and waiting and times[waiting[0]] <= limit:
            out[heapq.heappop(waiting)] = epoch
            room -= 1
    if cut is None:  # the last limit stays
        n = 0
        while waiting and times[waiting[0]] <= limit:
            out[heapq.heappop(waiting)] = epoch + 1 + n // batch_size
            n += 1
    return rows.drop_columns(["group"]).append_column("release_epoch", pa.array(out, pa.int64()))


def _place(spark: SparkSession, pool: DataFrame, queue: DataFrame, batch_size: int, e_end: int, cut: int | None, leaf: int) -> DataFrame:
    """Rows of one stretch with their poll; from ``cut`` on, if they are not served."""
    busy = (F.col("waiting") > 0) | (F.col("after") > 0)
    per = queue.filter(busy).groupBy("period").agg(F.sum("n").alias("rows"), F.min("earlier").alias("earlier"))
    # whole small periods of about so many rows together; a large one is split below
    small = F.col("rows") <= leaf
    per = materialize(per.select("period", (~small).alias("large"), F.when(small, -1).otherwise(F.col("period")).alias("group"),
                                 F.when(small, int_div(F.col("earlier"), leaf)).otherwise(0).alias("leaf")), "periods")
    at = queue.select(F.col("epoch").alias("ready"), "period", busy.alias("busy"))
    met = pool.join(at, "ready")
    direct = met.filter(~F.col("busy")).select(*pool.columns, F.col("ready").alias("release_epoch"))
    held = met.filter("busy").join(per, "period")
    slots = queue.filter(busy).select("period", "epoch", (F.col("n") + F.col("waiting") - F.col("after")).alias("room"))
    end = queue.agg(F.max_by("after", "epoch").alias("after"), F.max_by("period", "epoch").alias("period")).first()
    if end["after"]:  # the last period goes on: to the cut, or poll by poll until it is empty
        n = 1 if cut is not None else -(-end["after"] // batch_size)
        room = F.lit(end["after"]) if cut is not None else F.least(F.lit(batch_size), F.lit(end["after"]) - F.col("id") * batch_size)
        slots = slots.unionByName(spark.range(n).select(
            F.lit(end["period"]).alias("period"), (F.col("id") + (cut if cut is not None else e_end + 1)).alias("epoch"), room.cast("long").alias("room")))
    slots = slots.filter("room > 0").join(per, "period")
    keep = [*pool.columns, "group", "leaf"]
    few = held.filter(~F.col("large")).select(*keep)
    few_slots = slots.filter(~F.col("large")).select("group", "leaf", "epoch", "room")
    if not per.filter("large").isEmpty():
        ranked = sequence_number(held.filter("large").drop("leaf"), BUFFER_KEY, "rank", ["group"])
        ranked = materialize(ranked.withColumn("leaf", int_div(F.col("rank"), leaf)).select(*keep), "ranked")
        parts = _halve(ranked, slots.filter("large").select("group", "epoch", "room"))
        few, few_slots = few.unionByName(ranked), few_slots.unionByName(parts)
    schema = T.StructType([f for f in pool.schema.fields] + [T.StructField("release_epoch", T.LongType())])
    few_slots = few_slots.select(F.col("group").alias("of"), F.col("leaf").alias("at"), "epoch", "room")
    found = few.groupBy("group", "leaf").cogroup(few_slots.groupBy("of", "at")).applyInArrow(_take, schema)
    return direct.unionByName(found)


def _halve(rows: DataFrame, slots: DataFrame) -> DataFrame:
    """Slots (group, leaf, epoch, room) that each leaf's rows fill, from those of
    their group. A group's slots have room for its rows, neither more nor less."""
    counts = materialize(rows.groupBy("group", "leaf", F.col("ready").alias("epoch")).agg(F.count(F.lit(1)).alias("n")), "counts")
    depth = int(counts.agg(F.max("leaf")).first()[0]).bit_length()
    nodes = slots.withColumn("node", F.lit(0).cast("long"))
    for level in range(depth):
        node = F.shiftright("leaf", depth - level - 1)
        lower = (counts.withColumn("node", node).filter("node % 2 = 0")
                 .groupBy("group", F.shiftright("node", 1).alias("node"), "epoch").agg(F.sum("n").alias("n")))
        both = nodes.join(lower, ["group", "node", "epoch"], "full_outer").fillna(0, ["room", "n"])
        line = sequence_number(both.withColumn("more", F.col("n") - F.col("room")), ["group", "node", "epoch"], "place")
        line = running(line, "place", {"total": ("sum", "more")})
        line = running(line, "place", {"lowest": ("min", "total")}, exclusive=True)
        # nobody waits where a node ends, so the minimum starts anew by itself
        zero = F.lit(0).cast("long")
        waiting = F.col("total") - F.col("more") - F.least(zero, "lowest")
        after = F.col("total") - F.least(zero, "lowest", "total")
        line = materialize(line.withColumn("filled", F.col("n") + waiting - after), "halves")
        node = F.col("node") * 2
        nodes = (line.select("group", node.alias("node"), "epoch", F.col("filled").alias("room"))
                 .unionByName(line.select("group", (node + 1).alias("node"), "epoch", (F.col("room") - F.col("filled")).alias("room")))
                 .filter("room > 0"))
    return nodes.select("group", F.col("node").alias("leaf"), "epoch", "room")


def _take(rows: pa.Table, slots: pa.Table) -> pa.Table:
    """Each row, in buffer order, takes the first poll from its readiness on with room."""
    rows = rows.sort_by([(c, "ascending") for c in BUFFER_KEY])
    slots = slots.sort_by("epoch")
    polls, room = slots.column("epoch").to_pylist(), slots.column("room").to_pylist()
    onward = list(range(len(polls) + 1))  # a poll at or after this one with room

    def find(k: int) -> int:
        root = k
        while onward[root] != root:
            root = onward[root]
        while onward[k] != root:
            onward[k], k = root, onward[k]
        return root

    out = []
    for ready in rows.column("ready").to_pylist():
        k = find(bisect_left(polls, ready))
        out.append(polls[k])
        room[k] -= 1
        if not room[k]:
            onward[k] = k + 1
    return rows.drop_columns(["group", "leaf"]).append_column("release_epoch", pa.array(out, pa.int64()))
