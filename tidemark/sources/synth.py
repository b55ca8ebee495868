"""A made-up feed of one symbol for load tests: trades and quotes, some out of order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..prefix import Running, prefix_scans

START_NS = 1_789_552_800_000_000_000
TICKS_FLOOR = 100  # the price never falls below 1.00


def synthetic_feed(spark: SparkSession, n: int, symbol: str = "AAPL", start_ns: int = START_NS, out_of_order: float = 0.05, jitter_ns: int = 500_000_000, seed: int = 42, bucket: int = 100_000) -> DataFrame:
    """n records in order of arrival (line_number from 1), fields as text.

    Draws are hashes of seed and place, so any task can make any row. Times rise by 0.1 to
    5 ms; the price is a walk of up to 5 cents a step held at its floor, by the reflection
    x = s - min(0, min of (s - floor) so far)."""

    def draw(name: str, low: int, high: int) -> Column:
        return F.lit(low) + F.pmod(F.xxhash64(F.lit(seed), F.lit(name), "id"), F.lit(high - low + 1))

    def choice(name: str, *values) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]), (draw(name, 1, len(values))).cast("int"))

    df = spark.range(n)
    at = F.floor(F.col("id") / bucket)
    df = prefix_scans(df, [], ["id"], at, {"__clock": Running(draw("step", 100_000, 5_000_000), "sum"), "__walk": Running(draw("tick", -5, 5), "sum")})
    free = F.col("__walk") + 15_000
    df = prefix_scans(df, [], ["id"], at, {"__low": Running(free - TICKS_FLOOR, "min")})
    ticks = free - F.least(F.lit(0), F.col("__low"))
    moved = F.when(draw("late", 0, 999_999) < int(out_of_order * 1_000_000), draw("jitter", -jitter_ns, jitter_ns)).otherwise(F.lit(0))
    trade = draw("kind", 0, 99) < 40
    cents = lambda c: c.cast("decimal(18,2)").cast("string")
    price = ticks / F.lit(100).cast("decimal(3,0)")
    half = draw("spread", 1, 5) / F.lit(200).cast("decimal(3,0)")
    only = lambda when, c: F.when(when, c)
    sizes = (100, 200, 500, 1000)
    return df.select(
        (F.col("id") + 1).alias("line_number"), F.when(trade, "TRADE").otherwise("QUOTE").alias("event_type"), F.greatest(F.lit(0), F.lit(start_ns) + F.col("__clock") + moved).alias("timestamp"), F.lit(symbol).alias("symbol"),
        only(trade, cents(price)).alias("price"), only(trade, choice("size", 10, 25, 50, 100, 200, 500, 1000).cast("string")).alias("size"), only(trade, choice("side", "BUY", "SELL")).alias("side"),
        only(~trade, cents(price - half)).alias("bid_price"), only(~trade, choice("bid", *sizes).cast("string")).alias("bid_size"), only(~trade, cents(price + half)).alias("ask_price"), only(~trade, choice("ask", *sizes).cast("string")).alias("ask_size"),
        F.lit("SYNTH_FEED").alias("source"), (F.col("id") + 1).alias("sequence_id"),
    )


def _in_order(feed: DataFrame) -> DataFrame:
    return feed.repartitionByRange("line_number").sortWithinPartitions("line_number")


def write_jsonl(feed: DataFrame, path: str) -> None:
    """JSON lines, the keys of each kind only; files in order of arrival."""
    _in_order(feed).drop("line_number").write.json(path)


def write_csv(feed: DataFrame, path: str) -> None:
    """The trades as CSV files with headers."""
    trades = _in_order(feed.where("event_type = 'TRADE'"))
    trades.select("timestamp", "symbol", "price", "size", "side", "source").write.option("header", True).csv(path)
