"""Every registered query against its DuckDB oracle (sf0.001; the driver's
gate runs the same comparison at sf0.01)."""

import pytest

import __spark_entry__ as entry
from compare import compare, duckdb_conn
from conftest import SF_SMALL
from tidemark.plans import catalog, oracle

QUERIES = catalog.QUERIES
ORACLES = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duckdb_conn(SF_SMALL)


def test_every_oracle_has_a_query():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLES[name], SF_SMALL)
    assert r["cols"], r
    assert r["rows"][0] == r["rows"][1], r
    assert r["values"], r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["topic", "partition", "offset", "timestamp_ms", "position", "batch_id"]


def test_capped_replay_consistent_with_counts(spark):
    """R7 rows per poll equal R6 counts (limits never decrease here)."""
    rel = QUERIES["paced_replay"](spark, SF_SMALL)
    per = {r.release_epoch: r["count"] for r in rel.groupBy("release_epoch").count().collect()}
    counts = {r.epoch: r.released for r in QUERIES["paced_counts"](spark, SF_SMALL).collect()}
    assert {k: v for k, v in counts.items() if v} == per
