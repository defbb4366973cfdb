"""F1 (nested topic log), F2 (fixture ranges), F4 (compare with expectations)."""

import json
import tempfile

from tidemark.operators.checks import compare_expected, order_violations
from tidemark.operators.offsets import derive_ranges
from tidemark.plans.fixtures import apply_poll_plan, read_nested_log

DATA = {"orders": {"2": [{"offset": 7, "timestamp_ms": 40, "value": "first"}, {"offset": 9, "timestamp_ms": 20}],
                   "5": [{"offset": 0, "timestamp_ms": 33, "key": "k", "value": ""}]},
        "refunds": {"2": []}}


def _nested(spark):
    d = tempfile.mkdtemp(prefix="tidemark-fixture-")
    with open(f"{d}/data.json", "w") as f:
        json.dump(DATA, f)
    return read_nested_log(spark, f"{d}/data.json")


def test_flatten_nested_log(spark):
    rows = sorted((r.topic, r.partition, r.offset, r.timestamp_ms, r.key, r.value) for r in _nested(spark).collect())
    assert rows == [("orders", 2, 7, 40, None, "first"), ("orders", 2, 9, 20, None, None), ("orders", 5, 0, 33, "k", "")]


def test_derive_ranges_and_poll_plan(spark):
    log = _nested(spark)
    parts = spark.createDataFrame([("orders", 2), ("orders", 5), ("refunds", 2)], "topic string, partition int")
    ovr = spark.createDataFrame([("orders", 5, 30)], "topic string, partition int, end_offset long")
    r = {(x.topic, x.partition): (x.replay_start_offset, x.replay_end_offset, x.missing)
         for x in derive_ranges(log, parts, ovr).collect()}
    assert r == {("orders", 2): (7, 10, False), ("orders", 5): (0, 30, False), ("refunds", 2): (None, None, True)}
    plan = spark.createDataFrame([(3, "orders", 2, [9, 7])], "poll long, topic string, partition int, offsets array<long>")
    got = [(x.poll, x.position, x.offset) for x in apply_poll_plan(log, plan).orderBy("position").collect()]
    assert got == [(3, 0, 9), (3, 1, 7)]


def test_compare_expected(spark):
    kinds = "partition int, consumed long, released long, live boolean"
    actual = spark.createDataFrame([(0, 4, 3, False), (1, 6, 6, True), (2, 1, 1, True), (8, 0, 0, False)], kinds)
    expected = spark.createDataFrame([(0, 4, None, None), (1, 6, 5, True), (2, None, None, None), (9, 0, 0, False)], kinds)
    bad = compare_expected(actual, expected, ["partition"], ["consumed", "released", "live"])
    assert {(b.partition, b.problem) for b in bad.collect()} == {(1, "value"), (8, "extra"), (9, "absent")}
    loose = compare_expected(actual, expected, ["partition"], ["consumed", "released", "live"], complete=False)
    assert {(b.partition, b.problem) for b in loose.collect()} == {(1, "value"), (9, "absent")}


def test_order_check_skips_live_batches(spark):
    """While live, batches are not judged and do not set the bar."""
    rows = [(0, 10), (1, 50), (2, 20), (3, 15), (4, 90), (5, 16)]
    batches = spark.createDataFrame(rows, "b long, timestamp_ms long")
    live = spark.createDataFrame([(k, k in (1, 4)) for k in range(6)], "b long, is_live boolean")
    bad = {(r.b, r.prev_max_ts) for r in order_violations(batches, "b", live).collect()}
    assert bad == {(3, 20)}
    assert {r.b for r in order_violations(batches, "b").collect()} == {2, 3, 5}
