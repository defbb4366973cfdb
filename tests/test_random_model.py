"""Set-based operators against the literal poll model on seeded random logs."""

import random

import pytest

from helpers import make_log, make_ranges, msg, replay_of
from model import MAX, run
from tidemark.operators import release as R
from tidemark.operators.paced import paced_replay


def random_log(seed, topics=2, max_parts=3, max_msgs=25, out_of_order=0.2, null_ts=0.05,
               late_start=0.3, never_caught=0.15, first_epoch_max=3):
    rnd = random.Random(seed)
    ranges, polls = {}, {}
    for t in range(topics):
        for p in range(rnd.randint(1, max_parts)):
            n = rnd.randint(0, max_msgs)
            start = rnd.randint(0, n // 2) if rnd.random() < late_start else 0
            end = n + (rnd.randint(1, 3) if rnd.random() < never_caught else 0)
            ranges[(f"t{t}", p)] = (start, end)
            ts = rnd.randint(0, 50)
            epoch = rnd.randint(0, first_epoch_max)
            for o in range(start, n):
                ts += rnd.randint(0, 30)
                mts = ts - rnd.randint(0, 200) if rnd.random() < out_of_order else ts
                if rnd.random() < null_ts:
                    mts = None
                if o > start:
                    epoch += rnd.choice([0, 0, 1, 1, 2])
                polls.setdefault(epoch, []).append(msg(f"t{t}", p, o, mts))
    last = max(polls) if polls else -1
    return ranges, [polls.get(e, []) for e in range(last + 1)]


def model_release(ranges, polls, cap=None, drain=False):
    out = {}
    for e, (rel, lim, st) in enumerate(run(ranges, polls, cap, drain)):
        for i, m in enumerate(rel):
            out[(m["topic"], m["partition"], m["offset"])] = e
    return out


def spark_release(rows):
    return {(r["topic"], r["partition"], r["offset"]): r["release_epoch"] for r in rows
            if r["release_epoch"] is not None}


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_uncapped_release_and_state(spark, seed):
    ranges, polls = random_log(seed)
    rp = replay_of(spark, ranges, polls)
    got = spark_release(rp.released.collect())
    assert got == model_release(ranges, polls)
    # release order inside each poll follows the model's buffer order
    order = [(r.topic, r.partition, r.offset) for r in R.release_order(rp.released).orderBy("release_position").collect()]
    expected = [(m["topic"], m["partition"], m["offset"]) for rel, _, _ in run(ranges, polls) for m in rel]
    assert order == expected
    # limits per poll
    lims = {r.epoch: r.release_limit for r in rp.limits.collect()}
    for e, (_, lim, state) in enumerate(run(ranges, polls)):
        assert lims[e] == lim, f"poll {e}"
    # partition state and liveness at a few polls
    model = run(ranges, polls)
    prog = {r.epoch: r for r in rp.progress().collect()}
    for e in sorted({0, len(polls) // 2, len(polls) - 1}):
        if e < 0:
            continue
        st = {(r.topic, r.partition): r for r in rp.partition_state(e, as_timestamp=False).collect()}
        for tp, m in model[e][2].items():
            assert st[tp].consumed_offset == m["consumed"]
            assert st[tp].released_offset == m["released"]
            assert st[tp].last_consumed_timestamp_ms == m["ts"]
            assert st[tp].is_live == m["live"]
        live = bool(model[e][2]) and all(v["live"] for v in model[e][2].values())
        assert prog[e].is_live == live
        pending = sum(v["consumed"] for v in model[e][2].values()) - sum(v["released"] for v in model[e][2].values())
        assert prog[e].pending == pending


def test_release_blocks_many_polls(spark):
    """Many polls: the block search crosses block boundaries."""
    rnd = random.Random(7)
    ranges = {("a", 0): (0, 400), ("a", 1): (0, 400)}
    polls = [[] for _ in range(400)]
    for p in (0, 1):
        ts = 0
        for o in range(400):
            ts += rnd.randint(0, 10)
            mts = ts - 3000 if rnd.random() < 0.1 else ts
            polls[o if p == 0 else o // 3].append(msg("a", p, o, mts))
    rp = replay_of(spark, ranges, polls)
    assert spark_release(rp.released.collect()) == model_release(ranges, polls)


@pytest.mark.parametrize("seed", [11, 12])
def test_capped_exact_replay(spark, seed):
    ranges, polls = random_log(seed, max_msgs=20)
    cap = 3
    rp = replay_of(spark, ranges, polls, batch_size=cap)
    expected = model_release(ranges, polls, cap, drain=True)
    got = paced_replay(rp.messages, rp.limits, cap, rp.last_epoch)
    assert spark_release(got.collect()) == expected
    # periods split into leaves of four rows, halves of halves
    got = paced_replay(rp.released, rp.limits, cap, rp.last_epoch, leaf=4)
    assert spark_release(got.collect()) == expected


@pytest.mark.parametrize("seed", [11, 43])
def test_few_rows_go_through_all_polls_in_one_task(spark, seed):
    ranges, polls = random_log(seed, out_of_order=0.4, max_msgs=20)
    rp = replay_of(spark, ranges, polls, batch_size=3)
    got = paced_replay(rp.released, rp.limits, 3, rp.last_epoch, whole=1000)
    assert spark_release(got.collect()) == model_release(ranges, polls, 3, drain=True)


def test_capped_counts(spark):
    # in-order timestamps, all partitions start at once: limits never decrease
    ranges, polls = random_log(21, out_of_order=0.0, null_ts=0.0, late_start=0.0, never_caught=0.0,
                               first_epoch_max=0)
    cap = 4
    rp = replay_of(spark, ranges, polls, batch_size=cap)
    counts = {r.epoch: r.released for r in rp.paced_counts().collect()}
    model = run(ranges, polls, cap, drain=True)
    for e, (rel, _, _) in enumerate(model):
        assert counts.get(e, 0) == len(rel), f"poll {e}"


@pytest.mark.parametrize("seed", [41, 42])
def test_capped_counts_with_falling_limits(spark, seed):
    """R6 where the limit falls: the counts of the exact rows."""
    ranges, polls = random_log(seed, out_of_order=0.4, max_msgs=20)
    rp = replay_of(spark, ranges, polls, batch_size=3)
    counts = {r.epoch: r.released for r in rp.paced_counts().collect()}
    for e, (rel, _, _) in enumerate(run(ranges, polls, 3, drain=True)):
        assert counts.get(e, 0) == len(rel), f"poll {e}"


@pytest.mark.parametrize("seed", [51, 52])
def test_flow_decisions_are_taken_before_release(spark, seed):
    """On the buffer with the poll's arrivals, as the poll loop has it."""
    ranges, polls = random_log(seed, max_msgs=30)
    rp = replay_of(spark, ranges, polls, batch_size=2)
    flow = {r.epoch: r for r in rp.flow().collect()}
    before = 0
    for e, (rel, _, state) in enumerate(run(ranges, polls)):
        buffer = before + sum(1 for m in polls[e] if m["ts"] is not None)
        caught = all(v["caught"] for v in state.values())
        assert flow[e].over_buffer == (buffer > 10), f"poll {e}"
        assert flow[e].should_resume == (buffer < 2 or caught), f"poll {e}"
        before = buffer - len(rel)


@pytest.mark.parametrize("seed", [31, 32])
def test_mark_and_ahead_with_tree_blocks(spark, seed, monkeypatch):
    """Force the segment-tree path for every interval; mark and partitions
    ahead of it (B1) per poll equal the model."""
    from tidemark.operators import watermark as W
    monkeypatch.setattr(W, "SHORT_INTERVAL", 0)
    ranges, polls = random_log(seed, never_caught=0.5)
    rp = replay_of(spark, ranges, polls, batch_size=5)
    lim = {r.epoch: r.low_water_mark for r in rp.limits.collect()}
    ahead = {r.epoch: r.partitions_ahead for r in rp.flow().collect()}
    for e, (_, _, state) in enumerate(run(ranges, polls)):
        behind = [v["ts"] for v in state.values() if not v["caught"] and v["ts"] is not None]
        mark = min(behind) if behind else None
        assert lim[e] == mark, f"poll {e}"
        n = sum(1 for v in state.values() if v["ts"] is not None and mark is not None and v["ts"] > mark)
        assert ahead[e] == n, f"poll {e}"


def test_many_falls_make_few_cuts(spark):
    """A fall in every second poll, while rows wait: one cut, not one for each fall."""
    from tidemark.operators import paced as P
    rows = [("a", 0, o, o, o // 4) for o in range(160)]
    msgs = spark.createDataFrame(rows, "topic string, partition int, offset long, timestamp_ms long, arrival_epoch long")
    lims = [(e, 4 * e + 3 - (6 if e % 2 else 0)) for e in range(40)]
    limits = spark.createDataFrame(lims, "epoch long, release_limit long")
    start, held, want = P._begin(msgs, limits, 39), [], {}
    parts, *_ = P._sure_from(start[1], start[0], 2, 39, P.LEAF, P.CHUNK)
    assert len(parts) <= 1
    got = {r.offset: r.release_epoch for r in P.paced_replay(msgs, limits, 2, 39).collect()}

    for e in range(400):
        held += [o for o in range(4 * e, 4 * e + 4) if o < 160]
        out = [o for o in held if o <= lims[min(e, 39)][1]][:2]
        want |= {o: e for o in out}
        held = [o for o in held if o not in out]
    assert {o: e for o, e in got.items() if e is not None} == want
