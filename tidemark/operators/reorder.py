"""Lateness by a running watermark over arrivals, and the orders of emission and replay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import parse_timestamp_ns
from ..prefix import Running, prefix_scans
from ..tables import staged_table

LAST_NS = (1 << 63) - 1


def priority() -> Column:
    return F.when(F.col("event_type") == "TRADE", F.lit(1)).otherwise(F.lit(2))


REPLAY_ORDER = ["timestamp_ns", "event_type_priority", "event_id"]


def with_watermark(events: DataFrame, feed: list[str], order: list[str], lateness_ns: int = 5_000_000_000, bucket: Column | None = None, carried: DataFrame | None = None) -> DataFrame:
    """events with watermark_ns and late. bucket (rising with the order) makes the running
    maximum a two-step scan; without it a feed is one window. carried (the feed columns and
    carried_ns) gives the latest time seen before the first row."""
    if lateness_ns < 0:
        raise ValueError("lateness must not be negative")
    seen = prefix_scans(events, feed, order, bucket, {"__seen": Running(F.col("timestamp_ns"), "max")})
    if carried is not None:
        seen = seen.join(carried, feed, "left").withColumn("__seen", F.greatest("__seen", "carried_ns")).drop("carried_ns")
    seen = seen.withColumn("watermark_ns", F.greatest(F.lit(0), F.col("__seen") - F.lit(lateness_ns))).drop("__seen")
    return seen.withColumn("late", (F.col("watermark_ns") > 0) & (F.col("timestamp_ns") < F.col("watermark_ns")))


def emission_key(arrival: Column) -> list[Column]:
    return [F.col("timestamp_ns"), priority(), F.coalesce(F.col("sequence_id"), arrival), F.col("event_id")]


def dedup(events: DataFrame) -> DataFrame:
    return events.dropDuplicates(["event_id"])


def not_stored(events: DataFrame, stored: DataFrame) -> DataFrame:
    """One row an event_id that the store does not hold."""
    return dedup(events).join(stored.select("event_id"), "event_id", "left_anti")


def bound_ns(at: int | str | None, otherwise: int) -> Column:
    """A bound of a window: nanoseconds, a time as text in any form that a feed may use, or open."""
    if at is None or isinstance(at, str) and not at.strip():
        return F.lit(otherwise).cast("bigint")
    return F.lit(at).cast("bigint") if isinstance(at, int) else F.coalesce(parse_timestamp_ns(F.lit(at)), F.raise_error(F.lit(f"no time: {at}")).cast("bigint"))


def replay(trades: DataFrame, quotes: DataFrame, symbol: str | None = None, start_ns: int | str | None = 0, end_ns: int | str | None = None, event_types: tuple[str, ...] = ("TRADE", "QUOTE"), ordered: bool = True, limit: int | None = None) -> DataFrame:
    """Both kinds in replay order for a symbol and a window, both ends included; with a limit the
    first so many of that order."""
    if isinstance(start_ns, int) and isinstance(end_ns, int) and start_ns > end_ns:
        raise ValueError("the window ends before it starts")
    both = trades.withColumn("event_type", F.lit("TRADE")).unionByName(quotes.withColumn("event_type", F.lit("QUOTE")), allowMissingColumns=True)
    both = both.where(F.col("timestamp_ns").between(bound_ns(start_ns, 0), bound_ns(end_ns, LAST_NS)) & F.col("event_type").isin(*[t.strip().upper() for t in event_types]))
    if symbol is not None:
        both = both.where(F.col("symbol") == symbol.strip().upper())
    both = both.withColumn("event_type_priority", priority())
    both = both.orderBy(*REPLAY_ORDER) if ordered or limit is not None else both
    return both if limit is None else both.limit(limit)


#: Cuts of a request's windows by time: their span by so many bins at least.
SPAN_BINS = 64
#: Rows of requests and bins up to which they go to every task.
BROADCAST_ROWS = 100_000


def replay_many(events: DataFrame, requests: DataFrame, salts: int = 8) -> DataFrame:
    """request_id with the events of its symbol and window; requests: request_id, symbol, start_ns,
    end_ns (both included; a window that ends before it starts is empty).

    Both sides meet by symbol and bin of time. Bins are as wide as the mean window, or a part of
    the requests' span if that is less, so windows fall into at most SPAN_BINS + 2 bins on average.
    Few requests go to every task; many are dealt by symbol, bin and a salt of the events, so that
    no task has all events or all requests of a busy symbol."""
    r = requests.select("request_id", F.col("symbol").alias("__symbol"), "start_ns", "end_ns").where("start_ns <= end_ns")
    length = F.col("end_ns").cast("decimal(38,0)") - F.col("start_ns")
    at = r.agg(F.avg(length), F.min("start_ns"), F.max("end_ns"), F.count("*")).first()
    if not at[3]:
        return events.join(r, F.lit(False)).drop("__symbol")
    width = max(1, min(int(at[0]) + 1, (at[2] - at[1]) // SPAN_BINS + 1))
    bin_ = lambda ns: F.floor(ns / F.lit(width).cast("decimal(20,0)")).cast("bigint")
    low, high = F.greatest("start_ns", F.lit(at[1])), F.least("end_ns", F.lit(at[2]))
    r = r.withColumn("__bin", F.explode(F.sequence(bin_(low), bin_(high))))
    n = int(at[3] * (float(at[0]) / width + 2))
    e = events.withColumn("__at", bin_(F.col("timestamp_ns")))
    same = (F.col("symbol") == F.col("__symbol")) & (F.col("__at") == F.col("__bin"))
    if n <= BROADCAST_ROWS:
        r = F.broadcast(r)
    else:
        r = r.withColumn("__r", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        e = e.withColumn("__salt", F.pmod(F.xxhash64("event_id"), F.lit(salts)).cast("int"))
        same = same & (F.col("__salt") == F.col("__r"))
    joined = e.join(r, same & F.col("timestamp_ns").between(F.col("start_ns"), F.col("end_ns")))
    return joined.drop("__symbol", "__bin", "__at", "__salt", "__r")


def count_many(events: DataFrame, requests: DataFrame, bucket_ns: int) -> DataFrame:
    """requests (as for replay_many) with n, the events that replay_many gives for each, without
    making them: the events up to a window's end less those before its start.

    Events of a time and equal bounds of a symbol are one row each, scanned in buckets of time, so
    the work grows with events and requests and not with what the windows hold."""
    r = requests.where("start_ns <= end_ns")
    bounds = lambda c, turn: r.select("symbol", F.col(c).alias("timestamp_ns"), F.lit(turn).alias("turn"), F.lit(0).cast("bigint").alias("k"))
    at = events.groupBy("symbol", "timestamp_ns").agg(F.count("*").alias("k")).select("symbol", "timestamp_ns", F.lit(0).alias("turn"), "k")
    # at one time starts come before the events and ends after them
    rows = at.unionByName(bounds("start_ns", -1).unionByName(bounds("end_ns", 1)).distinct())
    upto = staged_table(prefix_scans(rows, ["symbol"], ["timestamp_ns", "turn"], F.floor(F.col("timestamp_ns") / bucket_ns), {"upto": Running(F.col("k"), "sum")}), "upto")
    of = lambda turn, c, name: upto.where(F.col("turn") == turn).select("symbol", F.col("timestamp_ns").alias(c), F.col("upto").alias(name))
    r = r.join(of(-1, "start_ns", "__before"), ["symbol", "start_ns"]).join(of(1, "end_ns", "__upto"), ["symbol", "end_ns"])
    return r.withColumn("n", F.col("__upto") - F.col("__before")).select(*requests.columns, "n")


def positions(events: DataFrame, keys: list[str], order: list[Column], bucket: Column, name: str = "position") -> DataFrame:
    """events with their place (from 1) in the order of their key. bucket (rising with the order)
    splits a busy key: places are counted in buckets, and carried over them."""
    at = {f"__by{i}": c for i, c in enumerate(order)}
    placed = prefix_scans(events.withColumns(at), keys, list(at), bucket, {name: Running(F.lit(1), "count")})
    return placed.drop(*at)


def monotonicity(stream: DataFrame, keys: list[str], order: list[str], bucket: Column | None = None) -> DataFrame:
    """Rows and violations a key: events earlier than one before them in the stream."""
    seen = prefix_scans(stream, keys, order, bucket, {"__max": Running(F.col("timestamp_ns"), "max", True)})
    return seen.groupBy(*keys).agg(F.count("*").alias("n_events"), F.count_if(F.col("timestamp_ns") < F.col("__max")).alias("violations"))
