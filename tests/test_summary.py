"""A summary stages only what it reads, so that no running sum is computed for it."""

import pytest

from tidemark.operators import metrics
from tidemark.plans import market


@pytest.mark.parametrize("query", ["lineitem_summary", "symbol_summary"])
def test_summary_stages_no_running_sums(spark, monkeypatch, query):
    staged = []
    table = market.staged_table
    monkeypatch.setattr(market, "staged_table", lambda df, name: (staged.append(df) if name == "series" else None, table(df, name))[1])
    assert market.QUERIES[query](spark, "/root/testdata/sf0.001").count() > 0
    [series] = staged
    assert set(series.columns) == set(metrics.SUMMARY_COLUMNS)
    plan = series._jdf.queryExecution().optimizedPlan().toString()
    assert "__4l" in plan and not any(f"__{i}l" in plan for i in range(4))  # the time before, but no volume, notional or side


def test_summary_takes_the_last_price_of_the_replay_order(spark):
    rows = [("e2", "A", "TRADE", 0, 5, "2", "1", "BUY"), ("e1", "A", "TRADE", 0, 5, "3", "1", "SELL"), ("e3", "A", "QUOTE", 1, 9, None, None, None), ("e0", "A", "TRADE", 0, 1, "7", "1", None), ("q", "B", "QUOTE", 1, 1, None, None, None)]
    e = spark.createDataFrame(rows, "event_id string, symbol string, event_type string, event_type_priority int, timestamp_ns bigint, p string, s string, side string")
    e = e.selectExpr("*", "CAST(p AS DECIMAL(18,6)) AS price", "CAST(s AS DECIMAL(18,6)) AS size", "CAST(NULL AS DECIMAL(18,6)) AS bid_price", "CAST(NULL AS DECIMAL(18,6)) AS ask_price")
    for bucket in (None, 3):
        got = {r.symbol: (r.last_price, r.n_gaps, r.gap_min, r.gap_max) for r in metrics.summary(metrics.series(e, bucket).select(*metrics.SUMMARY_COLUMNS)).collect()}
        assert got == {"A": (2.0, 3, 0, 4), "B": (0.0, 0, 0, 0)}
