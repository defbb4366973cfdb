"""Written tables: who keeps them, and for how long."""

import os

from tidemark.session import drop_tables, materialize, settle, written, written_since


def test_settle_keeps_the_result_alone(spark):
    mark = written()
    first = materialize(spark.range(10), "first")
    used = written_since(mark)
    out = settle(first.filter("id > 6"), mark, "result")
    assert written() == mark + 1 and not os.path.exists(used[0].replace("file:", ""))
    assert sorted(r.id for r in out.collect()) == [7, 8, 9]


def test_drop_tables_leaves_others(spark):
    mark = written()
    a, b = materialize(spark.range(3), "a"), materialize(spark.range(4), "b")
    assert drop_tables(spark, written_since(mark)[:1]) == 1
    assert b.count() == 4 and written() == mark + 1
    assert drop_tables(spark, ["/nowhere/at-all"]) == 0
