"""Every query with a SQL oracle matches DuckDB on the smallest driver tables,
and the rows-only queries run; the entry point returns rows."""

from __future__ import annotations

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import rows_of  # noqa: E402
from conftest import SF_SMALL  # noqa: E402
from strata.plans.tables import TABLES  # noqa: E402

ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = [r.asDict(recursive=True) for r in df.collect()]
    rel = duck.sql(ORACLES[name])
    orows = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    assert sorted(df.columns) == sorted(rel.columns)
    cols = sorted(df.columns)
    assert rows_of(srows, cols) == rows_of(orows, cols)


def test_entry_returns_rows(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "order_share_pct" in df.columns


def test_every_registered_query_has_oracle_or_is_rows_only():
    rows_only = set(E.queries()) - set(ORACLES)
    text = {"pipeline"} | {q for q in E.queries() if q[:2] == "op" and q[2:].split("_")[0].isdigit()}  # tested in tests/llm
    assert rows_only <= text


def test_medallion_queries_run(spark):
    q = E.queries()
    ledger = q["ingest_files"](spark, SF_SMALL).collect()
    assert ledger and {r.status for r in ledger} <= {"loaded", "quarantined"}
    counts = q["telecom_validation"](spark, SF_SMALL).collect()
    assert [r.domain for r in counts] == ["subscribers", "traffic_voice", "traffic_sms", "traffic_internet", "qos", "revenue"]
    assert all(r.rows_processed == r.rows_validated + r.rows_rejected and r.rows_rejected > 0 for r in counts)
    sc = q["telecom_scorecard"](spark, SF_SMALL)
    bad = sc.filter("subscriber_market_share_pct < 0 OR subscriber_market_share_pct > 100").count()
    assert sc.count() > 0 and bad == 0
    for name in ("telecom_rejections", "telecom_open_events", "telecom_run_health"):
        assert q[name](spark, SF_SMALL).count() > 0
