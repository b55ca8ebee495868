"""Hard and soft rules over canonical events; statuses, metrics and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import strip
from ..prefix import Running, prefix_scans

JUMP = 0.20


def _finding(when: Column, code: str, field: str, severity: str) -> Column:
    return F.when(when, F.struct(F.lit(code).alias("code"), F.lit(code.split("_", 1)[1].replace("_", " ").lower()).alias("message"), F.lit(field).alias("field"), F.lit(severity).alias("severity")))


def _no_symbol() -> Column:
    return F.coalesce(strip(F.col("symbol")), F.lit("")) == ""


def _no_time() -> Column:
    return F.coalesce(F.col("timestamp_ns"), F.lit(0)) <= 0


def hard_valid_trade() -> Column:
    return (F.col("event_type") == "TRADE") & ~(_no_symbol() | _no_time() | (F.col("price") <= 0) | (F.col("size") <= 0))


def validate(events: DataFrame, order: list[str] | None = None, feed: list[str] | None = None, jump: float = JUMP, allow_crossed: bool = True, bucket: Column | None = None, carried: DataFrame | None = None) -> DataFrame:
    """events with last_price, diagnostics (all rules that failed, in order) and status.

    A trade is compared with the last price that passed the hard rules before it, of its feed
    and symbol, in order of arrival (order). bucket (rising with the order) splits a busy
    symbol over tasks. carried (symbol, carried_price) gives the prices before the first row."""
    order, feed = order or ["line_number"], feed if feed is not None else ["source_file"]
    c, trade = F.col, F.col("event_type") == "TRADE"
    no_symbol, no_time = _no_symbol(), _no_time()
    events = prefix_scans(events, [*feed, "symbol"], order, bucket, {"last_price": Running(F.when(hard_valid_trade(), c("price")), "last", True)})
    if carried is not None:
        events = events.join(carried, "symbol", "left").withColumn("last_price", F.coalesce("last_price", "carried_price")).drop("carried_price")
    threshold = F.lit(jump).cast("decimal(6,4)")
    jumped = trade & (c("price") > 0) & (F.abs(c("price") - c("last_price")).cast("decimal(30,10)") >= (threshold * c("last_price")).cast("decimal(30,10)"))
    crossed = ~trade & (c("ask_price") < c("bid_price"))
    E, S = "HARD_INVALID", "SOFT_WARNING"
    rules = [
        _finding(no_symbol, "ERR_INVALID_SYMBOL", "symbol", E),
        _finding(no_time, "ERR_INVALID_TIMESTAMP", "timestamp_ns", E),
        _finding(trade & (c("price") <= 0), "ERR_NON_POSITIVE_PRICE", "price", E),
        _finding(trade & (c("size") <= 0), "ERR_NON_POSITIVE_SIZE", "size", E),
        _finding(~trade & (c("bid_price") < 0), "ERR_NEGATIVE_BID_PRICE", "bid_price", E),
        _finding(~trade & (c("ask_price") < 0), "ERR_NEGATIVE_ASK_PRICE", "ask_price", E),
        _finding(~trade & (c("bid_size") <= 0), "ERR_NON_POSITIVE_BID_SIZE", "bid_size", E),
        _finding(~trade & (c("ask_size") <= 0), "ERR_NON_POSITIVE_ASK_SIZE", "ask_size", E),
        _finding(jumped, "WARN_LARGE_PRICE_JUMP", "price", S),
        _finding(~trade & (c("bid_price") == 0), "WARN_ZERO_BID_PRICE", "bid_price", S),
        _finding(~trade & (c("ask_price") == c("bid_price")), "WARN_LOCKED_MARKET", "ask_price", S),
        _finding(crossed, "WARN_CROSSED_MARKET", "ask_price", S) if allow_crossed else _finding(crossed, "ERR_CROSSED_MARKET", "ask_price", E),
    ]
    events = events.withColumn("diagnostics", F.filter(F.array(*rules), lambda d: d.isNotNull()))
    return events.withColumn("status", F.when(F.exists("diagnostics", lambda d: d["severity"] == E), E).when(F.size("diagnostics") > 0, S).otherwise("ACCEPTED"))


def code_counts(validated: DataFrame) -> DataFrame:
    """status_class (errors, warnings), code, n; every finding of a hard-invalid row is an error."""
    kind = F.when(F.col("status") == "HARD_INVALID", "errors").otherwise("warnings")
    return validated.select(kind.alias("status_class"), F.explode("diagnostics.code").alias("code")).groupBy("status_class", "code").agg(F.count("*").alias("n"))


def report(validated: DataFrame, keys: list[str]) -> DataFrame:
    """Totals a key: rows that failed normalising have status REJECTED."""
    n = lambda *s: F.count_if(F.col("status").isin(*s))
    out = validated.groupBy(*keys).agg(F.count("*").alias("total"), n("ACCEPTED").alias("clean"), n("SOFT_WARNING").alias("with_warnings"), n("HARD_INVALID", "REJECTED").alias("hard_invalid"))
    return out.withColumn("acceptance_pct", (F.col("total") - F.col("hard_invalid")).cast("double") / F.col("total") * 100)


def listing(validated: DataFrame) -> DataFrame:
    """source_file, line_number, status and the first finding of every row that has one."""
    return validated.where(F.size("diagnostics") > 0).select("source_file", "line_number", "status", F.col("diagnostics")[0]["code"].alias("code"), F.col("diagnostics")[0]["message"].alias("message"), F.col("diagnostics")[0]["field"].alias("field"))
