"""The tables of a market report, for all symbols of a window at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import metrics, reorder
from ..sources.store import Store
from ..tables import staged_table

POINTS = 350


def display(summary: DataFrame) -> DataFrame:
    """The summary as it is shown: VWAP to 4 places, spread to 2 basis points, gaps in
    microseconds to 1 place, imbalance in percent."""
    gap = lambda n: F.round(F.col(n) / 1000.0, 1).alias(f"{n}_us")
    return summary.select("symbol", "total_events", "volume", F.round("vwap", 4).alias("vwap"), F.round(F.col("imbalance") * 100, 2).alias("imbalance_pct"), F.round("mean_spread_bps", 2).alias("mean_spread_bps"), *[gap(f"gap_{p}") for p in ("min", "p50", "p90", "p99", "max")])


def market_report(store: Store, symbol: str | None = None, start_ns: int = 0, end_ns: int = (1 << 63) - 1, event_types: tuple[str, ...] = ("TRADE", "QUOTE")) -> dict[str, DataFrame]:
    """summary, kpi, jitter_histogram and the three down-sampled series."""
    events = store.replay(symbol, start_ns, end_ns, event_types, ordered=False)
    s = staged_table(metrics.series(events), "series")
    trades, quotes = s.where("event_type = 'TRADE'"), s.where("event_type = 'QUOTE'")
    few = lambda rows, *cols: metrics.down_sample(rows.select("symbol", *reorder.REPLAY_ORDER, *cols), ["symbol"], reorder.REPLAY_ORDER, POINTS, F.floor(F.col("timestamp_ns") / metrics.HOUR_NS))
    summary = metrics.summary(s)
    return {
        "summary": summary,
        "kpi": display(summary),
        "jitter_histogram": metrics.gap_histogram(s),
        "price_vwap": few(trades, "price", "vwap"),
        "imbalance": few(trades, "imbalance"),
        "spread": few(quotes, "spread", "spread_bps"),
    }
