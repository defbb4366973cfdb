"""Golden poll-by-poll scenarios (released order and partition state)."""

import pytest

from helpers import msg, released_by_poll, replay_of, states_by_poll

E = "events"

# Golden rows and expectations, partition -> (offset, timestamp_ms, value).
TWO_PARTITION_ORDERING = {0: [(0, 1000, "p0-msg0"), (1, 1500, "p0-msg1")],
                          1: [(0, 500, "p1-msg0"), (1, 800, "p1-msg1")]}
LIVE_DETECTION_EVENTS = {0: [(0, 500, None), (1, 600, None)],
                         1: [(0, 400, None), (1, 700, None), (2, 1000, None)]}
SINGLE_PARTITION = {0: [(0, 100, None)]}


def _resolve(data, end_overrides, polls):
    """Scenario resolution: start = smallest offset, end = override or max + 1;
    polls name offsets per partition."""
    ranges = {}
    for p, msgs in data.items():
        offs = [m[0] for m in msgs]
        ranges[(E, p)] = (min(offs), end_overrides.get(p, max(offs) + 1))
    resolved = []
    for poll in polls:
        arrivals = []
        for p in sorted(poll):
            for off in poll[p]:
                o, ts, v = next(m for m in data[p] if m[0] == off)
                arrivals.append(msg(E, p, o, ts, v))
        resolved.append(arrivals)
    return ranges, resolved


def _check(spark, ranges, polls, expected_released, expected_states, batch_size=10):
    rp = replay_of(spark, ranges, polls, batch_size)
    got = released_by_poll(rp)
    states = states_by_poll(rp, len(polls))
    for e, exp in enumerate(expected_released):
        assert got.get(e, []) == [(E, p, o) for p, o in exp], f"poll {e}"
    for e, exp in enumerate(expected_states):
        for p, fields in exp.items():
            actual = states[e][(E, p)]
            for k, v in fields.items():
                assert actual[k] == v, f"poll {e} partition {p} {k}: {actual[k]} != {v}"


def test_mark_of_the_slower_partition_holds_back(spark):
    ranges, polls = _resolve(TWO_PARTITION_ORDERING, {0: 100, 1: 100}, [{0: [0, 1], 1: [0, 1]}])
    _check(spark, ranges, polls, [[(1, 0), (1, 1)]],
           [{0: dict(consumed_offset=1, released_offset=0, is_live=False),
             1: dict(consumed_offset=1, released_offset=1, is_live=False)}])


def test_partitions_become_live_one_by_one(spark):
    ranges, polls = _resolve(LIVE_DETECTION_EVENTS, {}, [{0: [0, 1], 1: [0]}, {1: [1]}, {1: [2]}])
    _check(spark, ranges, polls,
           [[(1, 0)], [(0, 0), (0, 1), (1, 1)], [(1, 2)]],
           [{0: dict(consumed_offset=1, released_offset=0, is_live=False),
             1: dict(consumed_offset=0, released_offset=0, is_live=False)},
            {0: dict(consumed_offset=1, released_offset=1, is_live=True),
             1: dict(consumed_offset=1, released_offset=1, is_live=False)},
            {0: dict(is_live=True),
             1: dict(consumed_offset=2, released_offset=2, is_live=True)}])


def test_one_message_to_its_end(spark):
    ranges, polls = _resolve(SINGLE_PARTITION, {}, [{0: [0]}])
    _check(spark, ranges, polls, [[(0, 0)]], [{0: dict(consumed_offset=0, is_live=True)}])


def test_one_message_after_an_empty_poll(spark):
    ranges, polls = _resolve(SINGLE_PARTITION, {}, [{}, {0: [0]}])
    _check(spark, ranges, polls, [[], [(0, 0)]],
           [{0: dict(is_live=False)}, {0: dict(consumed_offset=0, is_live=True)}])


def test_one_message_before_its_end(spark):
    ranges = {(E, 0): (0, 100)}
    polls = [[msg(E, 0, 0, 1000)]]
    _check(spark, ranges, polls, [[(0, 0)]],
           [{0: dict(consumed_offset=0, released_offset=0, is_live=False)}])


def test_late_polls_release_earlier_arrivals(spark):
    ranges = {(E, 0): (0, 100), (E, 1): (0, 100)}
    polls = [[msg(E, 0, 0, 1000), msg(E, 1, 0, 500), msg(E, 0, 1, 1500), msg(E, 1, 1, 800)],
             [msg(E, 1, 2, 1600)], [msg(E, 0, 2, 1700)], [msg(E, 1, 3, 1800)]]
    _check(spark, ranges, polls,
           [[(1, 0), (1, 1)], [(0, 0), (0, 1)], [(1, 2)], [(0, 2)]],
           [{0: dict(consumed_offset=1, released_offset=0, is_live=False),
             1: dict(consumed_offset=1, released_offset=1, is_live=False)},
            {0: dict(consumed_offset=1, released_offset=1, is_live=False),
             1: dict(consumed_offset=2, released_offset=1, is_live=False)},
            {0: dict(consumed_offset=2, released_offset=1, is_live=False),
             1: dict(consumed_offset=2, released_offset=2, is_live=False)},
            {0: dict(consumed_offset=2, released_offset=2, is_live=False),
             1: dict(consumed_offset=3, released_offset=2, is_live=False)}])


def test_end_offset_reached(spark):
    _check(spark, {(E, 0): (0, 1)}, [[msg(E, 0, 0, 500)]], [[(0, 0)]], [{0: dict(is_live=True)}])


def test_nothing_to_replay(spark):
    _check(spark, {(E, 0): (0, 0)}, [[]], [[]], [{0: dict(is_live=True)}])


@pytest.mark.parametrize("polls,missing", [([{0: [999]}], "offset 999")])
def test_poll_plan_unknown_offset(spark, polls, missing):
    from pyspark.sql import functions as F
    from tidemark.plans.fixtures import poll_plan_missing
    from helpers import make_log
    log = make_log(spark, [[msg(E, p, o, ts) for o, ts, _ in m] for p, m in TWO_PARTITION_ORDERING.items()])
    plan = spark.createDataFrame([(0, E, 0, [999, 1])], "poll long, topic string, partition int, offsets array<long>")
    rows = poll_plan_missing(log, plan).collect()
    assert [(r.topic, r.partition, r.offset) for r in rows] == [(E, 0, 999)]


def test_consumer_accessors(spark):
    ranges = {(E, 0): (0, 100), (E, 1): (0, 100)}
    polls = [[msg(E, 0, 0, 1000), msg(E, 1, 0, 500), msg(E, 0, 1, 1500), msg(E, 1, 1, 800)],
             [msg(E, 1, 2, 1600)]]
    rp = replay_of(spark, ranges, polls, 10)
    first = rp.poll(0)
    assert first.columns[:6] == ["key", "value", "topic", "partition", "offset", "timestamp"]
    assert [(r.partition, r.offset) for r in first.orderBy("release_position").collect()] == [(1, 0), (1, 1)]
    assert rp.held_message_count(0) == 2 and rp.held_message_count(1) == 1
    assert rp.get_priming_watermark(0) == 800 and not rp.is_live(1)
    assert rp.paused_partition_count() == 0
