"""The mark / resume / pause-selection rules on partition-state tables."""

import pytest

from tidemark.operators.progress import partitions_ahead_of, should_resume_of
from tidemark.operators.watermark import low_water_mark_of, release_limit_of

SCHEMA = "topic string, partition int, timestamp_ms long, is_caught_up boolean, is_paused boolean"


def st(spark, rows):
    return spark.createDataFrame([("t1", p, ts, c, z) for p, ts, c, z in rows], SCHEMA)


# Golden state rows (partition, timestamp, caught up, paused) and decisions.
@pytest.mark.parametrize("rows,expected", [
    ([(0, 100, False, False), (1, 200, False, False), (2, 300, False, False)], 100),
    ([(0, 100, True, False), (1, 200, False, False), (2, 300, False, False)], 200),
    ([(0, 100, False, True), (1, 200, False, False), (2, 300, False, False)], 200),
    ([(0, 100, True, False), (1, 200, True, False)], None),
    ([(0, None, False, False), (1, None, False, False)], None),
])
def test_low_water_mark(spark, rows, expected):
    assert low_water_mark_of(st(spark, rows)).first()["low_water_mark"] == expected


@pytest.mark.parametrize("rows,held,batch,expected", [
    ([(0, 100, False, True), (1, 200, False, False)], 50, 100, True),
    ([(0, 100, False, True), (1, 200, False, False)], 150, 100, False),
    ([(0, 100, False, True), (1, 200, True, False)], 150, 100, True),
    ([(0, 1000, False, True), (1, 800, False, True), (2, 1000, True, False)], 500, 100, True),
])
def test_should_resume(spark, rows, held, batch, expected):
    assert should_resume_of(st(spark, rows), held, batch).first()["should_resume"] is expected


@pytest.mark.parametrize("rows,expected", [
    ([(0, 100, False, False), (1, 500, False, False), (2, 800, False, False)], [1, 2]),
    ([(0, 100, False, False), (1, 500, False, True), (2, 800, False, False)], [2]),
    ([(0, 100, False, False), (1, 100, False, False)], []),
    ([(0, None, False, False), (1, None, False, False)], []),
])
def test_partitions_ahead(spark, rows, expected):
    got = sorted(r.partition for r in partitions_ahead_of(st(spark, rows), 100).collect())
    assert got == expected


def test_release_limit(spark):
    r = release_limit_of(st(spark, [(0, 100, True, False), (1, 200, True, False)])).first()
    assert r["all_caught_up"] and r["release_limit"] == (1 << 63) - 1
    r = release_limit_of(st(spark, [(0, None, False, False)])).first()
    assert not r["all_caught_up"] and r["release_limit"] == (1 << 63) - 1
