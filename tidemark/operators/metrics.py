"""Microstructure figures of a replay: running series, and one summary row a symbol."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions import scalars as S
from ..prefix import Running, prefix_scans
from ..tables import staged_table
from .reorder import REPLAY_ORDER

HOUR_NS = 3_600_000_000_000


def _ratio(a, b, otherwise):
    return F.when(b > 0, a.cast("double") / b.cast("double")).otherwise(otherwise)


def series(events: DataFrame, bucket_ns: int | None = HOUR_NS) -> DataFrame:
    """events with running volume, notional, VWAP and imbalance (trades; null-safe on quotes),
    spread figures (quotes) and the gap to the event before, by symbol in replay order.

    A symbol's windows hold bucket_ns of it each, so that a busy one is spread over tasks;
    sums are exact decimals, so the result is that of one window. All scans share one shuffle."""
    c = F.col
    zero = F.lit(0).cast("decimal(18,6)")
    sided = lambda s: F.coalesce(F.when(c("side") == s, c("size")), zero)
    wanted = {
        "cum_volume": Running(F.coalesce(c("size"), zero), "sum"),
        "cum_notional": Running(F.coalesce(c("price") * c("size"), F.lit(0).cast("decimal(37,12)")), "sum"),
        "__buy": Running(sided("BUY"), "sum"),
        "__sell": Running(sided("SELL"), "sum"),
        "__before": Running(c("timestamp_ns"), "max", True),  # the order begins with it
        "position": Running(F.lit(1), "count"),
    }
    bucket = None if bucket_ns is None else F.floor(c("timestamp_ns") / bucket_ns)
    df = prefix_scans(events, ["symbol"], REPLAY_ORDER, bucket, wanted)
    df = df.withColumn("gap_ns", F.when(c("position") > 1, F.greatest(F.lit(0), c("timestamp_ns") - c("__before"))))
    trade = c("event_type") == "TRADE"
    return (
        df.withColumn("vwap", F.when(trade, _ratio(c("cum_notional"), c("cum_volume"), c("price").cast("double"))))
        .withColumn("imbalance", F.when(trade, _ratio(c("__buy") - c("__sell"), c("__buy") + c("__sell"), F.lit(0.0))))
        .withColumn("spread", S.spread(c("bid_price"), c("ask_price")))
        .withColumn("spread_bps", F.when(~trade, S.relative_spread_bps(c("bid_price"), c("ask_price"))))
        .drop("__buy", "__sell", "__before")
    )


def order_statistics(counts: DataFrame, keys: list[str], value: str, points: dict[str, float], rounds: int = 2, parts: int = 1024, window: int = 100_000) -> DataFrame:
    """keys, total and, for each name, sorted[min(total - 1, floor(total * point))] of the integer
    values of a key that counts (keys, value, n) gives.

    Values are counted by buckets of equal width between the least and the greatest one, the
    bucket that holds a rank is found among at most `parts` of them and cut again; a window only
    ever sees one key's buckets, or the values of a last bucket, however many values a key has.
    Where no key has more than `window` values there is nothing to cut."""
    most = counts.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    rounds = rounds if most > window else 0
    total = counts.groupBy(*keys).agg(F.sum("n").alias("total"), F.min(value).alias("__lo"), F.max(value).alias("__hi"))
    ranks = F.explode(F.array(*[F.struct(F.lit(name).alias("point"), F.least(F.col("total") - 1, F.floor(F.col("total") * F.lit(float(p)))).alias("rank")) for name, p in points.items()])).alias("r")
    total = staged_table(total, "totals") if rounds else total
    wanted = total.select(*keys, "__lo", "__hi", ranks).select(*keys, "__lo", "__hi", "r.*")
    same = [*keys, "__lo", "__hi"]
    for _ in range(rounds):
        # decimals: a range of values times the parts is no bigint
        bucket = F.expr(f"CAST((CAST({value} - __lo AS DECIMAL(20,0)) * {parts}) DIV (CAST(__hi - __lo AS DECIMAL(20,0)) + 1) AS INT)")
        ranges = wanted.select(*same).distinct()
        inside = counts.join(ranges, keys).where(F.col(value).between(F.col("__lo"), F.col("__hi")))
        by = inside.groupBy(*same, bucket.alias("__b")).agg(F.sum("n").alias("n"), F.min(value).alias("low"), F.max(value).alias("high"))
        upto = F.sum("n").over(W.partitionBy(*same).orderBy("__b"))
        by = by.withColumn("upto", upto)
        hit = wanted.join(by, same).where((F.col("upto") > F.col("rank")) & (F.col("upto") - F.col("n") <= F.col("rank")))
        wanted = staged_table(hit.select(*keys, F.col("low").alias("__lo"), F.col("high").alias("__hi"), "point", (F.col("rank") - F.col("upto") + F.col("n")).alias("rank")), "ranks")
    ranges = wanted.select(*same).distinct()
    last = counts.join(ranges, keys).where(F.col(value).between(F.col("__lo"), F.col("__hi")))
    last = last.withColumn("upto", F.sum("n").over(W.partitionBy(*same).orderBy(value)))
    found = wanted.join(last, same).where((F.col("upto") > F.col("rank")) & (F.col("upto") - F.col("n") <= F.col("rank")))
    named = [F.max(F.when(F.col("point") == name, F.col(value))).alias(name) for name in points]
    return found.groupBy(*keys).agg(*named).join(total.drop("__lo", "__hi"), keys)


def gap_percentiles(events_with_gaps: DataFrame, points: tuple[float, ...] = (0.5, 0.9, 0.99)) -> DataFrame:
    """symbol, n_gaps, gap_min, gap_max and sorted[min(n - 1, floor(n * p))] for each point.
    Gaps are counted by value first, then the ranks are looked for in ever smaller buckets."""
    counts = staged_table(events_with_gaps.where("gap_ns is not null").groupBy("symbol", "gap_ns").agg(F.count("*").alias("n")), "gaps")
    names = {f"gap_p{round(p * 100)}": p for p in points}
    ends = counts.groupBy("symbol").agg(F.min("gap_ns").alias("gap_min"), F.max("gap_ns").alias("gap_max"))
    found = order_statistics(counts, ["symbol"], "gap_ns", names)
    return found.join(ends, "symbol").select("symbol", F.col("total").alias("n_gaps"), "gap_min", "gap_max", *names)


def gap_histogram(events_with_gaps: DataFrame, bins: int = 24) -> DataFrame:
    """symbol, bin, n: bins over [0, max(1.5 * p99, 10)) microseconds, the last takes the rest."""
    width = gap_percentiles(events_with_gaps).select("symbol", (F.greatest(F.col("gap_p99") / 1000.0 * 1.5, F.lit(10.0)) / bins).alias("width"))
    hit = events_with_gaps.where("gap_ns is not null").join(width, "symbol").withColumn("bin", F.least(F.lit(bins - 1), F.floor(F.col("gap_ns") / 1000.0 / F.col("width"))).cast("int"))
    counted = hit.groupBy("symbol", "bin").agg(F.count("*").alias("n"))
    every = width.select("symbol", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return every.join(counted, ["symbol", "bin"], "left").select("symbol", "bin", F.coalesce("n", F.lit(0)).alias("n"))


#: What a summary reads of a series. Staged without the rest, whose running sums are not computed then.
SUMMARY_COLUMNS = ["symbol", "event_type", "price", "size", "side", "bid_price", "ask_price", "spread", "spread_bps", "position", "gap_ns"]


def summary(with_series: DataFrame) -> DataFrame:
    """One row a symbol, of a series' SUMMARY_COLUMNS."""
    c, trade = F.col, F.col("event_type") == "TRADE"
    zero = F.lit(0)
    out = with_series.groupBy("symbol").agg(
        F.count("*").alias("total_events"),
        F.count_if(trade).alias("trade_count"),
        F.count_if(~trade).alias("quote_count"),
        F.count_if(c("ask_price") < c("bid_price")).alias("crossed_count"),
        F.coalesce(F.sum("size"), zero).cast("double").alias("volume"),
        F.coalesce(F.sum(c("price") * c("size")), zero).cast("double").alias("notional"),
        F.coalesce(F.min("price"), zero).cast("double").alias("min_price"),
        F.coalesce(F.max("price"), zero).cast("double").alias("max_price"),
        F.coalesce(F.max_by("price", F.when(trade, c("position"))), zero).cast("double").alias("last_price"),
        F.coalesce(F.sum(F.when(c("side") == "BUY", c("size"))), zero).cast("double").alias("buy_volume"),
        F.coalesce(F.sum(F.when(c("side") == "SELL", c("size"))), zero).cast("double").alias("sell_volume"),
        F.coalesce(F.sum("spread"), zero).cast("double").alias("__spread"),
        F.coalesce(F.avg(F.round("spread_bps", 6)), F.lit(0.0)).alias("__bps"),
    )
    out = out.withColumn("vwap", F.when(c("volume") > 0, c("notional") / c("volume")).otherwise(F.lit(0.0)))
    out = out.withColumn("imbalance", F.when(c("buy_volume") + c("sell_volume") > 0, (c("buy_volume") - c("sell_volume")) / (c("buy_volume") + c("sell_volume"))).otherwise(F.lit(0.0)))
    out = out.withColumn("mean_spread", F.when(c("quote_count") > 0, c("__spread") / c("quote_count")).otherwise(F.lit(0.0))).withColumn("mean_spread_bps", F.round("__bps", 2))
    gaps = gap_percentiles(with_series)
    return out.drop("__spread", "__bps").join(gaps, "symbol", "left").na.fill(0, ["n_gaps", "gap_min", "gap_max", "gap_p50", "gap_p90", "gap_p99"])


def down_sample(rows: DataFrame, keys: list[str], order: list[str], most: int = 350, bucket: Column | None = None) -> DataFrame:
    """At most `most` evenly spread rows a key, and the last again: rows floor(i * n / most).
    bucket (rising with the order) ranks and counts a busy key in two steps, so that no task gets
    all its rows; they are then read twice."""
    placed = prefix_scans(rows, keys, order, bucket, {"__i": Running(F.lit(1), "count"), "__n": Running(F.lit(1), "total")}).withColumn("__i", F.col("__i") - 1)
    step = F.col("__n") / F.lit(float(most))
    first = F.ceil(F.col("__i") / step).cast("int")
    # i is taken if some j < most has floor(j * step) = i; rounding may move that j by one
    taken = F.lit(False)
    for near in (-1, 0, 1):
        j = first + near
        taken = taken | ((j >= 0) & (j < most) & (F.floor(j * step) == F.col("__i")))
    last = F.col("__i") == F.col("__n") - 1
    copies = F.when(F.col("__n") <= most, F.lit(1)).otherwise(taken.cast("int") + last.cast("int"))
    return placed.withColumn("__copies", copies).where("__copies > 0").withColumn("point", F.explode(F.sequence(F.lit(1), F.col("__copies")))).drop("__i", "__n", "__copies")
