"""Queries over the driver's tables: `events` read as a feed of trades and quotes.

Each event becomes a raw record of text fields (some spoiled on purpose), as a reader would
hand it over, and takes the library's path from there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions import scalars as S
from ..operators import manifest, metrics, quarantine, reorder, validate
from ..operators.normalize import ALIASES, event_kind, normalize
from ..sources.store import Store, write_replay
from ..sources.text import read_csv, read_files, read_json_array, read_json_lines
from ..streaming import ingest as streaming
from ..streaming import stateful
from ..streaming.ingest import FileStream
from ..tables import exists, new_path, spread, staged_table
from .ingest import Rules, ingest
from .report import display, market_report

LATENESS = 600_000_000_000
TRADES = ("purchase", "error", "signup")


def hour():
    return F.expr("arrival div 3600000000")


def _of_hour():
    return F.floor(F.col("timestamp_ns") / metrics.HOUR_NS)


def feed(spark: SparkSession, d: str, dirty: bool = False) -> DataFrame:
    """RAW rows of `events`, in order of arrival (line_number)."""
    e = spread(spark.read.parquet(f"{d}/events.parquet"))
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    k = F.get_json_object("props", "$.k").cast("bigint")
    price = F.col("value").cast("decimal(18,2)")
    trade = F.col("event_type").isin(*TRADES)
    spoilt = lambda prime, text, column: F.when(F.col("event_id") % prime == 0, F.lit(text)).otherwise(column) if dirty else column
    side = F.when(F.col("event_type") == "purchase", "BUY").when(F.col("event_type") == "error", "SELL").otherwise("")
    shared = {
        "symbol": spoilt(13, "", F.concat(F.lit("u"), F.col("user_id"))),
        "timestamp": spoilt(17, "INVALID", (us * 1000).cast("string")),
        "source": F.concat(F.lit("F"), F.col("event_id") % 3),
        "sequence_id": F.when(F.col("event_id") % 5 == 0, F.lit("")).otherwise(F.col("event_id").cast("string")),
    }
    bad_price = F.when(F.col("event_id") % 7 == 0, "NaN").when(F.col("event_id") % 11 == 0, "-10.00").when(F.col("event_id") % 19 == 0, "$1,250.75").otherwise(price.cast("string")) if dirty else price.cast("string")
    trades = shared | {"event_type": F.lit("TRADE"), "price": bad_price, "size": (k + 1).cast("string"), "side": side}
    ask = (price + ((k % 7) - 1).cast("decimal(10,0)") / 100).cast("decimal(18,2)")
    quotes = shared | {"event_type": F.lit("QUOTE"), "bid_price": price.cast("string"), "bid_size": (k + 1).cast("string"), "ask_price": ask.cast("string"), "ask_size": (k + 2).cast("string")}
    as_map = lambda m: F.create_map(*[x for n, c in m.items() for x in (F.lit(n), c)])
    arrival = us + ((F.col("event_id") * 7919) % 1801) * 1_000_000
    return e.select(F.lit("").alias("source_file"), F.col("event_id").alias("line_number"), arrival.alias("arrival"), F.col("props").alias("raw_text"), F.when(trade, as_map(trades)).otherwise(as_map(quotes)).alias("fields"), F.lit(None).cast("string").alias("parse_error"))


def canonical(spark: SparkSession, d: str, once: bool = True) -> DataFrame:
    """The feed's events. Parsing is what costs: queries that scan them more than once read them
    from a table that is written once."""
    e = normalize(feed(spark, d)).where("error_code is null").withColumn("event_type_priority", reorder.priority())
    return staged_table(e.drop("raw_text", "fields", "parse_error", "error_code", "error_field", "error_message", "severity"), "canonical") if once else e


def _double(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("double") for n in names})


def canonical_trades(spark, d):
    t = canonical(spark, d, once=False).where("event_type = 'TRADE'")
    return _double(t.select("event_id", "symbol", "timestamp_ns", "price", "size", "price_text", "size_text", "side", "source", "sequence_id"), "price", "size")


def canonical_quotes(spark, d):
    q = canonical(spark, d, once=False).where("event_type = 'QUOTE'")
    return q.select("event_id", "symbol", "timestamp_ns", "bid_price_text", "bid_size_text", "ask_price_text", "ask_size_text", "source", "sequence_id")


def epoch_unit_parse(spark, d):
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    text = F.when(F.col("event_id") % 4 == 0, us * 1000).when(F.col("event_id") % 4 == 1, us).when(F.col("event_id") % 4 == 2, F.floor(us / 1000)).otherwise(F.floor(us / 1_000_000)).cast("string")
    return spark.read.parquet(f"{d}/events.parquet").select(F.col("event_id"), S.parse_timestamp_ns(text).alias("ns"))


def iso_ns_parse(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet").select("event_id", F.col("ts").cast("timestamp").alias("t"))
    text = F.concat(F.date_format("t", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lpad(F.pmod("event_id", F.lit(1000)).cast("string"), 3, "0"), F.when(F.col("event_id") % 2 == 0, "Z").otherwise("+01:30"))
    ns = S.parse_timestamp_ns(text)
    return e.select("event_id", ns.alias("ns"), S.format_timestamp_ns(ns).alias("text"))


def decimal_parse(spark, d):
    price = F.col("value").cast("decimal(18,2)").cast("string")
    text = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("$"), price)).when(F.col("event_id") % 5 == 1, F.concat(F.lit(" "), price, F.lit("0 "))).when(F.col("event_id") % 5 == 2, F.concat(price, F.lit("e2"))).when(F.col("event_id") % 5 == 3, F.lit("NaN")).otherwise(price)
    out = S.format_decimal(S.lexeme(text))
    return spark.read.parquet(f"{d}/events.parquet").select("event_id", out.alias("canonical"), S.to_decimal(out).cast("double").alias("number"))


def side_normalize(spark, d):
    names = F.array(*[F.lit(x) for x in ("b", " Buy", "BID", "1", "s", "sell", "ask", "offer", "-1", "2", "x", "")])
    return spark.read.parquet(f"{d}/events.parquet").select("event_id", S.side(F.element_at(names, (F.col("event_id") % 12 + 1).cast("int"))).alias("side"))


def _validated(spark, d):
    n = staged_table(normalize(feed(spark, d, dirty=True)), "normalised")
    return n.where("error_code is not null"), validate.validate(n.where("error_code is null"), ["arrival", "line_number"], bucket=hour())


def validation_status(spark, d):
    return _validated(spark, d)[1].select(F.col("line_number").alias("event_no"), "status", F.concat_ws(",", "diagnostics.code").alias("codes"))


def validation_metrics(spark, d):
    return validate.code_counts(_validated(spark, d)[1])


def validation_report(spark, d):
    bad, good = _validated(spark, d)
    return validate.report(good.select("status").unionByName(bad.select(F.lit("REJECTED").alias("status"))).withColumn("feed", F.lit("events")), ["feed"])


def _rejects(spark, d):
    """Rows that fail normalising, hard-invalid ones and late ones, as the quarantine takes them."""
    bad, good = _validated(spark, d)
    good = staged_table(good, "validated")
    timed = reorder.with_watermark(good.where("status <> 'HARD_INVALID'").withColumn("feed", F.lit("events")), ["feed"], ["arrival", "line_number"], LATENESS, hour())
    return quarantine.from_normalising(bad), quarantine.from_rules(good), quarantine.from_lateness(timed)


def quarantine_union(spark, d):
    parts = _rejects(spark, d)
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return rows.groupBy("error_code", "severity", F.coalesce("field_name", F.lit("")).alias("field_name"), "timestamp_ns").agg(F.count("*").alias("n"), F.count_distinct("quarantine_id").alias("n_ids"))


def _timed(spark, d):
    events = canonical(spark, d).withColumn("feed", F.lit("events"))
    return reorder.with_watermark(events, ["feed"], ["arrival", "line_number"], LATENESS, hour())


def late_split(spark, d):
    return _timed(spark, d).select(F.col("line_number").alias("event_no"), "watermark_ns", "late")


def reorder_sequence(spark, d):
    kept = staged_table(_timed(spark, d).where("not late"), "timed")
    return reorder.positions(kept, ["symbol"], reorder.emission_key(F.col("arrival")), _of_hour()).select("symbol", F.col("position").cast("int").alias("position"), "event_id")


def dedup_events(spark, d):
    t = canonical(spark, d)
    return reorder.dedup(t.unionByName(t.where("line_number % 3 = 0"))).select("event_id", "symbol", "timestamp_ns")


def replay_window(spark, d):
    e = canonical(spark, d)
    at = e.agg(F.min("timestamp_ns"), F.max("timestamp_ns")).first()
    span = (at[1] - at[0]) // 4
    out = reorder.replay(e.where("event_type = 'TRADE'"), e.where("event_type = 'QUOTE'"), None, at[0] + span, at[1] - span, ordered=False)
    out = reorder.positions(out, ["symbol"], [F.col(c) for c in reorder.REPLAY_ORDER], _of_hour())
    return out.select("symbol", F.col("position").cast("int").alias("position"), "event_id", "timestamp_ns")


def replay_many_windows(spark, d):
    e = canonical(spark, d)
    r = e.groupBy("symbol").agg(F.min("timestamp_ns").alias("a"), F.max("timestamp_ns").alias("b"))
    span = F.expr("(b - a) div 4")
    r = r.select(F.concat(F.lit("R"), "symbol").alias("request_id"), "symbol", (F.col("a") + span).alias("start_ns"), (F.col("b") - span).alias("end_ns"))
    return reorder.replay_many(e, r).groupBy("request_id").agg(F.count("*").alias("n"), F.min("timestamp_ns").alias("first_ns"), F.max("timestamp_ns").alias("last_ns"))


def monotonicity_audit(spark, d):
    return reorder.monotonicity(canonical(spark, d), ["symbol"], ["arrival", "line_number"], hour())


def _series(spark, d, once: list[str] | None = None):
    """The series of the events; with `once` these columns of it, staged."""
    s = metrics.series(canonical(spark, d))
    return staged_table(s.select(*once), "series") if once else s


def running_vwap(spark, d):
    return _double(_series(spark, d).where("event_type = 'TRADE'").select("event_id", "cum_volume", "cum_notional", "vwap"), "cum_volume", "cum_notional")


def running_imbalance(spark, d):
    return _series(spark, d).where("event_type = 'TRADE'").select("event_id", "imbalance")


def spread_series(spark, d):
    return _double(_series(spark, d).where("event_type = 'QUOTE'").select("event_id", "spread", F.round("spread_bps", 6).alias("spread_bps")), "spread")


def inter_arrival(spark, d):
    return _series(spark, d).select("event_id", "position", "gap_ns")


def jitter_percentiles(spark, d):
    return metrics.gap_percentiles(_series(spark, d, once=["symbol", "gap_ns"]))


def jitter_histogram(spark, d):
    return metrics.gap_histogram(_series(spark, d, once=["symbol", "gap_ns"]))


def downsample_series(spark, d):
    t = _series(spark, d).where("event_type = 'TRADE'")
    return metrics.down_sample(t.select("symbol", "event_id", *reorder.REPLAY_ORDER[:2]), ["symbol"], reorder.REPLAY_ORDER, 20, _of_hour()).select("symbol", "event_id", "point")


def symbol_summary(spark, d):
    return metrics.summary(_series(spark, d, once=metrics.SUMMARY_COLUMNS))


def event_identity(spark, d):
    return canonical(spark, d, once=False).select(F.col("line_number").alias("event_no"), "event_id")


def detect_event_type(spark, d):
    none = F.lit(None).cast("string")
    shapes = [{"event_type": F.lit("my trade")}, {"type": F.lit("bbo")}, {"record_type": F.lit(" trd "), "bid": F.lit("1")}, {"Bid": F.col("value").cast("string")}, {"event_type": F.lit(""), "price": F.lit("1")}, {"ask_price": none}, {"a": F.lit("")}]
    as_map = lambda m: F.create_map(*[x for n, c in m.items() for x in (F.lit(n), c)]).cast("map<string,string>")
    fields = as_map(shapes[-1])
    for i, m in enumerate(shapes[:-1]):
        fields = F.when(F.col("event_id") % 7 == i, as_map(m)).otherwise(fields)
    lowered = F.transform_keys("f", lambda k, v: F.lower(k))
    return spark.read.parquet(f"{d}/events.parquet").select("event_id", fields.alias("f")).select("event_id", event_kind(F.col("f"), lowered).alias("kind"))


def csv_parse_route(spark, d):
    """Trades written as CSV files, some lines with a comma too many, and read again."""
    f, no = F.col("fields"), F.col("line_number")
    rows = feed(spark, d, dirty=True).where("fields['event_type'] = 'TRADE'")
    source = F.when(no % 23 == 0, F.concat(f["source"], F.lit(",more"))).when(no % 29 == 0, F.lit('"F, ""1"""')).otherwise(f["source"])
    price = F.when(F.contains(f["price"], F.lit(",")), F.concat(F.lit('"'), f["price"], F.lit('"'))).otherwise(f["price"])
    path = new_path(spark, "csv")
    names = ("timestamp", "symbol", "price", "size", "side", "source")
    cells = {n: f[n] for n in names} | {"price": price, "source": source}
    # one column whose name is the header, so that lines are written as they are
    rows.select(F.concat_ws(",", *[cells[n] for n in names]).alias(",".join(names))).write.options(header=True, sep="\x01", quote="").csv(path)
    n = normalize(read_csv(spark, path))
    return n.groupBy(F.coalesce("error_code", F.lit("")).alias("error_code"), F.when(F.col("error_code").isNull(), F.col("source")).otherwise("").alias("source")).agg(F.count("*").alias("n"))


def price_jump_warnings(spark, d):
    v = _validated(spark, d)[1].where(F.exists("diagnostics", lambda x: x["code"] == "WARN_LARGE_PRICE_JUMP"))
    return _double(v.select(F.col("line_number").alias("event_no"), "symbol", "last_price", "price"), "last_price", "price")


def diagnostics_listing(spark, d):
    return validate.listing(_validated(spark, d)[1]).select(F.col("line_number").alias("event_no"), "status", "code")


KEYS = ("event_type", "timestamp", "symbol", "source", "sequence_id", "price", "size", "side", "bid_price", "bid_size", "ask_price", "ask_size")


def _as_files(rows, path):
    """Raw records as JSON lines, in order of arrival."""
    order = ["arrival", "line_number"]
    rows.repartitionByRange(*order).sortWithinPartitions(*order).select(*[F.col("fields")[k].alias(k) for k in KEYS]).write.mode("append").json(path)


def ingest_manifest(spark, d):
    """The spoilt feed from JSON files to a new store, and what the manifests count."""
    path = new_path(spark, "feed")
    _as_files(feed(spark, d, dirty=True), path)
    files = [r.f for r in spark.read.format("binaryFile").load(path).select(F.col("path").alias("f")).collect()]  # names only
    m = ingest(spark, files, Store(spark, new_path(spark, "store")), Rules(lateness_ns=1 << 62), hint="jsonl")
    total = lambda n: F.sum(n).cast("bigint").alias(n)
    return m.agg(*[total(f"{n}_{k}") for n, k in (("total", "records"), ("trade", "count"), ("quote", "count"), ("quarantine", "count"))], F.min("min_timestamp_ns").alias("min_timestamp_ns"), F.max("max_timestamp_ns").alias("max_timestamp_ns"))


def store_upsert(spark, d):
    """Trades stored twice: what the store holds a day."""
    store, t = Store(spark, new_path(spark, "store")), canonical(spark, d).where("event_type = 'TRADE'")
    for _ in range(2):
        store.put_trades(t)
    return store.trades().groupBy("event_date").agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("n_ids"))


def stored_report(spark, d):
    store, e = Store(spark, new_path(spark, "store")), canonical(spark, d)
    store.put_trades(e.where("event_type = 'TRADE'"))
    store.put_quotes(e.where("event_type = 'QUOTE'"))
    return market_report(store)["summary"]


def stream_reorder(spark, d):
    """The feed as files that arrive in two parts, streamed one after the other; events that
    break the hard rules go to quarantine and move no watermark."""
    rows = feed(spark, d)
    half = rows.agg(F.percentile_approx("arrival", 0.5)).first()[0]
    source, state = new_path(spark, "arriving"), new_path(spark, "stream")
    s = FileStream(spark, source, Store(spark, f"{state}/store"), state, Rules(lateness_ns=LATENESS), hint="jsonl")
    for part in (rows.where(F.col("arrival") < half), rows.where(F.col("arrival") >= half)):
        _as_files(part, source)
        s.start().awaitTermination()
    s.flush()
    out = s.released().withColumn("rounds", F.col("v") * 2 + F.col("flushed").cast("int"))
    # releases of a later batch are later in time too, so hours are buckets of that order as well
    out = reorder.positions(out, ["symbol"], [F.col("rounds"), *reorder.emission_key(F.col("line_number"))], F.struct("rounds", _of_hour().alias("hour")))
    return out.select("symbol", F.col("position").cast("int").alias("position"), "event_id")


def manifest_rollup(spark, d):
    """Manifest counts a venue over the shipped operator."""
    e = canonical(spark, d).withColumn("route", F.lit("stored"))
    out = manifest.counts(e, ["source"])
    return out.select("source", "total_records", "trade_count", "quote_count", "min_timestamp_ns", "max_timestamp_ns", F.concat_ws(",", "symbols").alias("symbols"))


def _spoilt_quotes(spark, d):
    """The quotes with sides below zero, zero sizes and zero bids among them."""
    q, n = canonical(spark, d).where("event_type = 'QUOTE'"), F.col("line_number")
    bad = {"bid_price": (7, -1), "ask_price": (11, -1), "bid_size": (13, 0), "ask_size": (17, 0)}
    return q.withColumns({c: F.when(n % k == 0, F.lit(v)).otherwise(F.when(n % 19 == 0, F.lit(0)).otherwise(F.col(c)) if c == "bid_price" else F.col(c)).cast(dict(q.dtypes)[c]) for c, (k, v) in bad.items()})


def quote_rules(spark, d):
    """Hard and soft rules of quotes, every code in order."""
    return validate.validate(_spoilt_quotes(spark, d), ["line_number"], []).select(F.col("line_number").alias("event_no"), "status", F.concat_ws(",", "diagnostics.code").alias("codes"))


def crossed_policy(spark, d):
    """Crossed quotes as errors instead of warnings."""
    v = validate.validate(canonical(spark, d).where("event_type = 'QUOTE'"), ["line_number"], [], allow_crossed=False)
    return v.groupBy("status", F.concat_ws(",", "diagnostics.code").alias("codes")).agg(F.count("*").alias("n"))


def quarantine_normalising(spark, d):
    bad = normalize(feed(spark, d, dirty=True)).where("error_code is not null")
    return quarantine.from_normalising(bad).select("quarantine_id", "timestamp_ns", "source", "raw_record", "error_code", "severity", "field_name")


def quarantine_rules(spark, d):
    return _rejects(spark, d)[1].select("quarantine_id", "timestamp_ns", "source", "raw_record", "error_code", "severity", "field_name")


def quarantine_lateness(spark, d):
    return _rejects(spark, d)[2].select("quarantine_id", "timestamp_ns", "source", "raw_record", "error_code", "error_message", "severity", "field_name")


def quarantine_log(spark, d):
    """The rejects to a log of JSON lines and back."""
    path = new_path(spark, "log")
    for part in _rejects(spark, d):
        quarantine.write_log(part, path)
    return quarantine.read_log(spark, path).groupBy("error_code").agg(F.count("*").alias("n"), F.count_distinct("quarantine_id").alias("n_ids"), F.max("timestamp_ns").alias("last_ns"))


def quarantine_store(spark, d):
    """The rejects stored twice: the store holds each once."""
    store, parts = Store(spark, new_path(spark, "store")), _rejects(spark, d)
    for _ in range(2):
        for part in parts:
            store.put_quarantine(part)
    return store.quarantine().groupBy("error_code", "source").agg(F.count("*").alias("n"))


def own_aliases(spark, d):
    """A feed whose price is called amt, read by aliases of its own."""
    rows = feed(spark, d).withColumn("fields", F.transform_keys("fields", lambda k, v: F.when(k == "price", "amt").otherwise(k)))
    aliases = ALIASES | {"trade": ALIASES["trade"] | {"price": ["amt"]}}
    n = normalize(rows, aliases)
    return _double(n.where("event_type = 'TRADE'").select(F.col("line_number").alias("event_no"), "price", F.coalesce("error_code", F.lit("")).alias("error_code")), "price")


def replay_json(spark, d):
    """The replay as JSON lines, read again as a feed."""
    path = new_path(spark, "replay")
    store = canonical(spark, d)
    write_replay(reorder.replay(store.where("event_type = 'TRADE'"), store.where("event_type = 'QUOTE'"), ordered=False), path)
    n = normalize(read_json_lines(spark, path))
    return n.select("event_type", "event_id", "symbol", "timestamp_ns")


def replay_limited(spark, d):
    """The first 100 events of a replay between two times given as text."""
    e = canonical(spark, d)
    low, high = e.agg(F.min("timestamp_ns").cast("string"), S.format_timestamp_ns(F.max("timestamp_ns"))).first()
    out = reorder.replay(e.where("event_type = 'TRADE'"), e.where("event_type = 'QUOTE'"), None, low, high, limit=100)
    return out.select("event_id", "symbol", "timestamp_ns")


def _arrays(rows):
    """A writer of each day of a feed as one JSON array, in order of arrival.

    A window by day deals the days, and nothing follows it that asks for another dealing: a
    repartition by day behind a join by day may be left out by the engine, which may then read the
    join's rows as their tasks wrote them, a day in many files."""
    day, at = F.expr("arrival div 86400000000").alias("day"), F.struct("arrival", "line_number")
    rows = rows.select(day, at.alias("at"), F.to_json("fields").alias("value"))
    of_day = W.partitionBy("day").orderBy("at")
    first, last = F.row_number().over(of_day) == 1, F.lead("at").over(of_day).isNull()
    value = F.concat(F.when(first, "[").otherwise(","), "value", F.when(last, "]").otherwise(""))
    return rows.select("day", value.alias("value")).write.partitionBy("day")


def _as_lines(writer, path):
    """Lines of text in files whose extension tells nothing."""
    writer.options(extension="feed", sep="\u0001", quote="\u0000", escape="\u0000", emptyValue="").csv(path)


def json_array_read(spark, d):
    """Each day of the feed as one JSON array, read again in pieces."""
    path = new_path(spark, "arrays")
    _arrays(feed(spark, d)).text(path)
    n = normalize(read_json_array(spark, path))
    return n.groupBy("event_type", F.coalesce("error_code", F.lit("")).alias("error_code")).agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("n_ids"))


def choose_format(spark, d):
    """The feed in files that their extensions tell, and in files that only their first character
    tells, all read at once: what each kind of file holds."""
    path, rows = new_path(spark, "kinds"), feed(spark, d)
    part = lambda k: rows.where(F.col("line_number") % 5 == k)
    fields = [F.col("fields")[k].alias(k) for k in KEYS]
    part(0).select(fields).write.csv(f"{path}/named_table", header=True)
    part(1).select(fields).write.json(f"{path}/named_lines")
    part(2).select(fields).write.option("extension", "feed").csv(f"{path}/table", header=True)
    _as_lines(part(3).select(F.to_json("fields").alias("value")).write, f"{path}/lines")
    _as_lines(_arrays(part(4)), f"{path}/array")
    kinds = ("named_table", "named_lines", "table", "lines", "array")
    files = [r.f for k in kinds for r in spark.read.format("binaryFile").load(f"{path}/{k}").select(F.col("path").alias("f")).collect()]  # names only
    n = normalize(read_files(spark, files))
    kind = F.regexp_extract("source_file", "/(named_table|named_lines|table|lines|array)/", 1).alias("kind")
    return n.groupBy(kind, F.coalesce("error_code", F.lit("")).alias("error_code")).agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("n_ids"))


def broken_lines(spark, d):
    """The feed as JSON lines, some of which are halves of surrogate pairs, nested beyond any depth,
    cut short or no objects, and some symbols of which stand between tabs: what becomes of each."""
    path, n = new_path(spark, "broken"), F.col("line_number")
    value = F.to_json("fields")
    spoilt = {
        31: F.lit('{"symbol": "\\ud800", "price": "1"}'), 37: F.substring(value, F.lit(1), F.length(value) - 1), 41: F.lit("[1, 2]"), 43: F.concat(value, F.lit(" {}")),
        997: F.repeat(F.lit("["), F.lit(50_000)), 47: F.replace(value, F.lit('"symbol":"u'), F.lit('"symbol":"\\tu')), 53: F.replace(value, F.lit('"symbol":"u'), F.lit('"symbol":"\\t","user":"u')),
    }
    line = value
    for k, text in spoilt.items():
        line = F.when(n % k == 0, text).otherwise(line)
    feed(spark, d).select(line.alias("value")).write.text(path)
    got = normalize(read_json_lines(spark, path))
    return got.groupBy(F.coalesce("error_code", F.lit("")).alias("error_code"), F.coalesce("parse_error", F.lit("")).alias("parse_error")).agg(F.count("*").alias("n"), F.count_distinct(F.when(F.col("error_code").isNull(), F.col("symbol"))).alias("n_symbols"))


def _two_parts(spark, rows, source):
    """Writes the feed in two parts of equal size, arriving one after the other."""
    half = rows.agg(F.percentile_approx("arrival", 0.5)).first()[0]
    for part in (rows.where(F.col("arrival") < half), rows.where(F.col("arrival") >= half)):
        _as_files(part, source)
        yield


def stream_timers(spark, d):
    """The feed in two parts through keyed state; what is held at the end is released by timers."""
    rows, source, out = feed(spark, d), new_path(spark, "arriving"), new_path(spark, "released")
    for _ in _two_parts(spark, rows, source):
        # the first run stops while rows are held: the second goes on from its state
        released = stateful.reorder_stream(stateful.stream_json_lines(spark, source).withColumn("feed", F.lit("events")), LATENESS, salts=8, quiet_ms=3000)
        if not exists(spark, f"{out}/checkpoint"):
            stateful.run_batches(released, f"{out}/events", f"{out}/checkpoint", 1)
    stateful.run_until_quiet(released, f"{out}/events", f"{out}/checkpoint", 3000)
    got = spark.read.schema(stateful.RELEASED).parquet(f"{out}/events").where("route = 'stored'")
    got = got.withColumn("rounds", F.col("round") * 2 + F.col("flushed").cast("int"))
    got = reorder.positions(got, ["symbol"], [F.col("rounds"), *reorder.emission_key(F.col("arrival"))], F.struct("rounds", _of_hour().alias("hour")))
    return got.select("symbol", F.col("position").cast("int").alias("position"), "event_id")


def stream_lateness(spark, d):
    """Late rows of the feed as a stream finds them, with the watermark they missed."""
    rows, source, out = feed(spark, d), new_path(spark, "arriving"), new_path(spark, "released")
    for _ in _two_parts(spark, rows, source):
        released = stateful.reorder_stream(stateful.stream_json_lines(spark, source).withColumn("feed", F.lit("events")), LATENESS, salts=8)
        stateful.run_batches(released, f"{out}/events", f"{out}/checkpoint", 1)
    return spark.read.schema(stateful.RELEASED).parquet(f"{out}/events").where("route = 'late'").select("event_id", "timestamp_ns", "watermark_ns")


def stream_price_jumps(spark, d):
    """Price jumps of the spoilt feed, streamed in two parts."""
    rows, source, out = feed(spark, d, dirty=True), new_path(spark, "arriving"), new_path(spark, "jumps")
    for _ in _two_parts(spark, rows, source):
        jumps = stateful.price_jumps(stateful.stream_json_lines(spark, source), salts=8)
        stateful.to_table(jumps, f"{out}/events", f"{out}/checkpoint").awaitTermination()
    got = spark.read.schema(stateful.JUMPS).parquet(f"{out}/events")
    return _double(got.select("symbol", "last_price", "price", "event_id"), "last_price", "price")


def stream_repeats(spark, d):
    """Events that come again within five seconds and, after the bound has passed, a year later:
    the former go, the latter are new to a state that has forgotten them."""
    source, out, year = new_path(spark, "arriving"), new_path(spark, "distinct"), 365 * 86_400_000_000_000
    e = canonical(spark, d).select("event_id", "symbol", "timestamp_ns")
    # an event and its repeats are one row of the file: which of them comes first is no chance
    times = lambda *ns: F.array(*[F.col("timestamp_ns") + F.lit(x).cast("bigint") for x in ns]).alias("times")
    part = lambda *ns: e.select("event_id", "symbol", times(*ns))
    mark = part(year // 2).limit(1).withColumn("event_id", F.lit("mark"))  # moves the bound past all
    for rows in (part(0, 2_000_000_000), mark, part(year, year + 2_000_000_000, 0)):
        rows.write.mode("append").parquet(source)
        read = spark.readStream.schema(rows.schema).parquet(source).select("event_id", "symbol", F.explode("times").alias("timestamp_ns"))
        stream = streaming.drop_repeats(read, "5 seconds")
        stateful.to_table(stream.drop("event_ts"), f"{out}/events", f"{out}/checkpoint").awaitTermination()
    got = spark.read.schema(e.schema).parquet(f"{out}/events").where("event_id <> 'mark'")
    return got.groupBy("event_id").agg(F.count("*").alias("n"), (F.max("timestamp_ns") - F.min("timestamp_ns")).alias("apart"))


def report_display(spark, d):
    return display(metrics.summary(_series(spark, d, once=metrics.SUMMARY_COLUMNS)))


def run_differences(spark, d):
    """Two runs of which the second lacks every seventh event and repeats every eleventh."""
    one = canonical(spark, d).select("event_id", "symbol", "timestamp_ns", "line_number")
    other = one.where("line_number % 7 <> 0").unionByName(one.where("line_number % 11 = 0"))
    return manifest.differences(one, other).groupBy("only_in").agg(F.count("*").alias("n"))


def manifest_verify(spark, d):
    """Checksums of written files hold, and fail for one that is not there."""
    path = new_path(spark, "feed")
    _as_files(feed(spark, d), path)
    rows = spark.read.format("binaryFile").load(path).select(F.col("path").alias("source_file"))
    rows = manifest.with_checksum(rows.unionByName(rows.withColumn("source_file", F.concat("source_file", F.lit(".gone"))))).select(F.col("source_file").alias("dataset_id"), "source_file", F.coalesce("sha256", F.lit("x")).alias("sha256_checksum"))
    good = manifest.verify(rows)
    return good.agg((F.count_if("valid") > 0).alias("some_valid"), (F.count_if(F.endswith("source_file", F.lit(".gone")) == F.col("valid")) == 0).alias("only_those_there"))


def run_sequences(spark, d):
    """Two runs that have the same events, in the second of which some change places."""
    one = canonical(spark, d)
    at = F.col("timestamp_ns") + F.when(F.col("line_number") % 50 == 0, 1_000_000_000_000).otherwise(0)
    same = manifest.same_sequence(one, one.withColumn("timestamp_ns", at), ["symbol"], [F.col(c) for c in reorder.REPLAY_ORDER], _of_hour(), ["event_id"])
    return same


def manifest_checksums(spark, d):
    """Files of two runs, one an hour of the day: those of the second whose bytes are
    others do not verify."""
    e = canonical(spark, d).select(F.expr("timestamp_ns div 3600000000000 % 24").cast("int").alias("hour"), "event_id", "line_number")
    paths = [new_path(spark, "run") for _ in range(2)]
    changed = F.when(F.col("hour") % 5 == 0, F.concat("event_id", F.lit("!"))).otherwise(F.col("event_id"))
    for path, value in zip(paths, (F.col("event_id"), changed)):
        e.select("hour", value.alias("value")).repartition("hour").sortWithinPartitions("hour", "value").write.partitionBy("hour").text(path)
    files = [spark.read.format("binaryFile").load(p).select("hour", F.col("path").alias("source_file")) for p in paths]  # names only
    first = manifest.with_checksum(files[0])
    rows = first.select("hour", F.col("sha256").alias("sha256_checksum")).join(files[1], "hour").select(F.col("hour").cast("string").alias("dataset_id"), "source_file", "sha256_checksum")
    rows = staged_table(rows, "checksums")
    return rows.join(manifest.verify(rows), ["dataset_id", "source_file"]).select("dataset_id", "sha256_checksum", "valid")


def lineitem_many_windows(spark, d):
    """A request for every fifth line of the orders, most of them for one busy symbol: how many
    trades a week around it."""
    e, week = staged_table(_orders(spark, d), "orders"), 7 * 24 * metrics.HOUR_NS
    r = e.where(F.substring("event_id", 1, 12).cast("bigint") % 5 == 0).select(F.col("event_id").alias("request_id"), "symbol", (F.col("timestamp_ns") - week).alias("start_ns"), (F.col("timestamp_ns") + week).alias("end_ns"))
    got = reorder.count_many(e, r, week).where("n > 0")
    return got.groupBy(F.year(F.timestamp_seconds(F.expr("start_ns div 1000000000"))).alias("year")).agg(F.sum("n").alias("n"), F.count_distinct("request_id").alias("n_requests"))


def lineitem_gaps(spark, d):
    """Percentiles of a figure of the orders with hundreds of thousands of values, a third of them
    of one symbol."""
    rows = _orders(spark, d).select("symbol", F.expr("CAST(price * 1000 AS BIGINT) + CAST(size AS BIGINT)").alias("gap_ns"))
    return metrics.gap_percentiles(rows, (0.01, 0.5, 0.9, 0.999))


def stream_dedup(spark, d):
    """A stream whose second part repeats the first: each event that passes the hard rules is
    released once."""
    rows = feed(spark, d)
    source, state = new_path(spark, "arriving"), new_path(spark, "stream")
    s = FileStream(spark, source, Store(spark, f"{state}/store"), state, Rules(lateness_ns=1 << 62), hint="jsonl")
    for _ in range(2):
        _as_files(rows, source)
        s.start().awaitTermination()
    s.flush()
    out = s.store
    return out.trades().select("event_id", "symbol").unionByName(out.quotes().select("event_id", "symbol")).groupBy("symbol").agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("n_ids"))


def _orders(spark, d):
    """lineitem as trades: an order's lines tie in time, and one supplier in three is one symbol."""
    li = spark.read.parquet(f"{d}/lineitem.parquet")
    ns = F.unix_date(F.col("l_shipdate").cast("date")).cast("bigint") * 86_400_000_000_000
    symbol = F.when(F.col("l_suppkey") % 3 == 0, "HOT").otherwise(F.concat(F.lit("S"), F.col("l_suppkey").cast("string")))
    price = F.col("l_extendedprice").cast("decimal(18,2)").cast("decimal(18,6)")
    key = F.concat_ws("-", F.lpad(F.col("l_orderkey").cast("string"), 12, "0"), F.lpad(F.col("l_linenumber").cast("string"), 2, "0"), F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"))
    trade = {"event_type": F.lit("TRADE"), "event_id": key, "symbol": symbol, "timestamp_ns": ns, "price": price, "size": F.col("l_quantity").cast("decimal(18,6)"), "side": F.when(F.col("l_returnflag") == "R", "SELL").otherwise("BUY")}
    return li.select(*[c.alias(n) for n, c in trade.items()], F.lit(1).alias("event_type_priority"), *[F.lit(None).cast("decimal(18,6)").alias(n) for n in ("bid_price", "ask_price")])


def lineitem_series(spark, d):
    """Positions and running volume where thousands of trades tie in time and one symbol is a third."""
    s = metrics.series(_orders(spark, d), bucket_ns=24 * metrics.HOUR_NS)
    return _double(s.select("event_id", "symbol", "position", "cum_volume"), "cum_volume")


def lineitem_summary(spark, d):
    s = metrics.series(_orders(spark, d), bucket_ns=24 * metrics.HOUR_NS).select(*metrics.SUMMARY_COLUMNS)
    s = metrics.summary(staged_table(s, "series"))
    return s.select("symbol", "trade_count", "volume", "min_price", "max_price", "last_price", "buy_volume", "sell_volume", "n_gaps", "gap_p50", "gap_max")


def lineitem_downsample(spark, d):
    """At most 50 points a symbol, ranked in two steps so that the hot symbol is no one task's."""
    rows = _orders(spark, d).select("symbol", *reorder.REPLAY_ORDER)
    return metrics.down_sample(rows, ["symbol"], reorder.REPLAY_ORDER, 50, bucket=F.expr(f"timestamp_ns div {24 * metrics.HOUR_NS}")).select("symbol", "event_id", "point")


QUERIES = {f.__name__: f for f in (canonical_trades, canonical_quotes, epoch_unit_parse, iso_ns_parse, decimal_parse, side_normalize, validation_status, validation_metrics, validation_report, quarantine_union, late_split, reorder_sequence, dedup_events, replay_window, replay_many_windows, monotonicity_audit, running_vwap, running_imbalance, spread_series, inter_arrival, jitter_percentiles, jitter_histogram, downsample_series, symbol_summary, manifest_rollup, event_identity, detect_event_type, csv_parse_route, price_jump_warnings, diagnostics_listing, ingest_manifest, store_upsert, stored_report, stream_reorder, quote_rules, crossed_policy, quarantine_normalising, quarantine_rules, quarantine_lateness, quarantine_log, quarantine_store, own_aliases, replay_json, replay_limited, json_array_read, report_display, run_differences, manifest_verify, stream_dedup, stream_timers, stream_lateness, stream_price_jumps, stream_repeats, lineitem_series, lineitem_summary, lineitem_downsample, lineitem_many_windows, lineitem_gaps, run_sequences, manifest_checksums, broken_lines, choose_format)}

_BASE = """
raw AS (SELECT event_id AS n, 'U'||user_id AS symbol, epoch_us(ts)*1000 AS timestamp_ns, event_type IN ('purchase','error','signup') AS is_trade,
  CASE event_type WHEN 'purchase' THEN 'BUY' WHEN 'error' THEN 'SELL' ELSE 'UNKNOWN' END AS side,
  CAST(value AS DECIMAL(18,2)) AS px, CAST(json_extract_string(props,'$.k') AS BIGINT) AS k, 'F'||(event_id%3) AS source,
  CASE WHEN event_id%5=0 THEN NULL ELSE event_id END AS sequence_id, epoch_us(ts) + ((event_id*7919)%1801)*1000000 AS arrival FROM events),
priced AS (SELECT *, CAST(px + CAST((k%7)-1 AS DECIMAL(18,2))/100 AS DECIMAL(18,2)) AS ask FROM raw),
ev AS (SELECT *, CASE WHEN is_trade THEN 1 ELSE 2 END AS prio, CASE WHEN is_trade
  THEN sha256('TRADE|'||symbol||'|'||timestamp_ns||'|'||px||'|'||(k+1)||'|'||side||'|'||source||'|'||coalesce(CAST(sequence_id AS VARCHAR),'NONE'))
  ELSE sha256('QUOTE|'||symbol||'|'||timestamp_ns||'|'||px||'|'||(k+1)||'|'||ask||'|'||(k+2)||'|'||source||'|'||coalesce(CAST(sequence_id AS VARCHAR),'NONE')) END AS event_id FROM priced)"""
_SERIES = (
    _BASE
    + """,
ser AS (SELECT *, row_number() OVER w AS position, CASE WHEN lag(timestamp_ns) OVER w IS NOT NULL THEN greatest(0, timestamp_ns - lag(timestamp_ns) OVER w) END AS gap_ns,
  CAST(sum(CASE WHEN is_trade THEN k+1 ELSE 0 END) OVER w AS DOUBLE) AS vol, CAST(sum(CASE WHEN is_trade THEN px*(k+1) ELSE 0 END) OVER w AS DOUBLE) AS noti,
  CAST(sum(CASE WHEN is_trade AND side='BUY' THEN k+1 ELSE 0 END) OVER w AS DOUBLE) AS buy, CAST(sum(CASE WHEN is_trade AND side='SELL' THEN k+1 ELSE 0 END) OVER w AS DOUBLE) AS sell
  FROM ev WINDOW w AS (PARTITION BY symbol ORDER BY timestamp_ns, prio, event_id ROWS UNBOUNDED PRECEDING))"""
)
_GAPS = (
    _SERIES
    + """,
rk AS (SELECT symbol, gap_ns, row_number() OVER (PARTITION BY symbol ORDER BY gap_ns) - 1 AS i, count(*) OVER (PARTITION BY symbol) AS n FROM ser WHERE gap_ns IS NOT NULL),
pct AS (SELECT symbol, max(n) AS n_gaps, min(gap_ns) AS gap_min, max(gap_ns) AS gap_max, min(CASE WHEN i = least(n-1, CAST(floor(n*0.5::DOUBLE) AS BIGINT)) THEN gap_ns END) AS gap_p50,
  min(CASE WHEN i = least(n-1, CAST(floor(n*0.9::DOUBLE) AS BIGINT)) THEN gap_ns END) AS gap_p90, min(CASE WHEN i = least(n-1, CAST(floor(n*0.99::DOUBLE) AS BIGINT)) THEN gap_ns END) AS gap_p99 FROM rk GROUP BY symbol)"""
)
_DIRTY = (
    _BASE
    + """,
norm AS (SELECT *, CASE WHEN n%13=0 THEN 'ERR_MISSING_SYMBOL' WHEN n%17=0 THEN 'ERR_INVALID_TIMESTAMP' WHEN is_trade AND n%7=0 THEN 'ERR_INVALID_PRICE' END AS err,
  CASE WHEN is_trade AND n%11=0 THEN -10.00 WHEN is_trade AND n%19=0 THEN 1250.75 ELSE px END AS p FROM priced),
good AS (SELECT *, last_value(CASE WHEN is_trade AND p>0 THEN p END IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY arrival, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_p FROM norm WHERE err IS NULL),
val AS (SELECT *, concat_ws(',', CASE WHEN is_trade AND p<=0 THEN 'ERR_NON_POSITIVE_PRICE' END, CASE WHEN NOT is_trade AND ask<0 THEN 'ERR_NEGATIVE_ASK_PRICE' END,
  CASE WHEN is_trade AND p>0 AND abs(p-last_p) >= CAST(0.2 AS DECIMAL(6,4))*last_p THEN 'WARN_LARGE_PRICE_JUMP' END, CASE WHEN NOT is_trade AND p=0 THEN 'WARN_ZERO_BID_PRICE' END,
  CASE WHEN NOT is_trade AND ask=p THEN 'WARN_LOCKED_MARKET' END, CASE WHEN NOT is_trade AND ask<p THEN 'WARN_CROSSED_MARKET' END) AS codes FROM good),
st AS (SELECT *, CASE WHEN codes LIKE '%ERR_%' THEN 'HARD_INVALID' WHEN codes<>'' THEN 'SOFT_WARNING' ELSE 'ACCEPTED' END AS status FROM val)"""
)
#: Events that the hard rules of an ingest let pass; it quarantines the others.
_PASS = "CASE WHEN is_trade THEN px > 0 ELSE px >= 0 AND ask >= 0 END"
_WM = "greatest(0, max(timestamp_ns) OVER (ORDER BY arrival, n ROWS UNBOUNDED PRECEDING) - 600000000000)"

SQL = {
    "canonical_trades": f"WITH {_BASE} SELECT event_id, symbol, timestamp_ns, CAST(px AS DOUBLE) AS price, CAST(k+1 AS DOUBLE) AS size, CAST(px AS VARCHAR) AS price_text, CAST(k+1 AS VARCHAR) AS size_text, side, source, sequence_id FROM ev WHERE is_trade",
    "canonical_quotes": f"WITH {_BASE} SELECT event_id, symbol, timestamp_ns, CAST(px AS VARCHAR) AS bid_price_text, CAST(k+1 AS VARCHAR) AS bid_size_text, CAST(ask AS VARCHAR) AS ask_price_text, CAST(k+2 AS VARCHAR) AS ask_size_text, source, sequence_id FROM ev WHERE NOT is_trade",
    "epoch_unit_parse": "SELECT event_id, CASE event_id%4 WHEN 0 THEN epoch_us(ts)*1000 WHEN 1 THEN epoch_us(ts)*1000 WHEN 2 THEN (epoch_us(ts)//1000)*1000000 ELSE (epoch_us(ts)//1000000)*1000000000 END AS ns FROM events",
    "iso_ns_parse": "WITH x AS (SELECT event_id, epoch_us(ts)*1000 + event_id%1000 - CASE WHEN event_id%2=0 THEN 0 ELSE 5400000000000 END AS ns FROM events) SELECT event_id, ns, strftime(make_timestamp((ns//1000000000)*1000000), '%Y-%m-%d %H:%M:%S')||'.'||lpad(CAST(ns%1000000000 AS VARCHAR),9,'0')||'Z' AS text FROM x",
    "decimal_parse": "WITH x AS (SELECT event_id, CAST(value AS DECIMAL(18,2)) AS v FROM events), y AS (SELECT event_id, CASE event_id%5 WHEN 1 THEN CAST(v AS VARCHAR)||'0' WHEN 2 THEN CAST(CAST(v*100 AS BIGINT) AS VARCHAR) WHEN 3 THEN NULL ELSE CAST(v AS VARCHAR) END AS canonical FROM x) SELECT event_id, canonical, CAST(CAST(canonical AS DECIMAL(18,6)) AS DOUBLE) AS number FROM y",
    "side_normalize": "SELECT event_id, CASE WHEN event_id%12<4 THEN 'BUY' WHEN event_id%12<10 THEN 'SELL' ELSE 'UNKNOWN' END AS side FROM events",
    "validation_status": f"WITH {_DIRTY} SELECT n AS event_no, status, codes FROM st",
    "validation_metrics": f"WITH {_DIRTY} SELECT CASE WHEN status='HARD_INVALID' THEN 'errors' ELSE 'warnings' END AS status_class, code, count(*) AS n FROM (SELECT status, unnest(string_split(codes, ',')) AS code FROM st WHERE codes<>'') GROUP BY 1, 2",
    "validation_report": f"WITH {_DIRTY}, a AS (SELECT status FROM st UNION ALL SELECT 'REJECTED' FROM norm WHERE err IS NOT NULL) SELECT 'events' AS feed, count(*) AS total, count(*) FILTER (status='ACCEPTED') AS clean, count(*) FILTER (status='SOFT_WARNING') AS with_warnings, count(*) FILTER (status IN ('HARD_INVALID','REJECTED')) AS hard_invalid, CAST(count(*) FILTER (status NOT IN ('HARD_INVALID','REJECTED')) AS DOUBLE)/count(*)*100 AS acceptance_pct FROM a",
    "quarantine_union": f"WITH {_DIRTY}, wm AS (SELECT n, timestamp_ns, {_WM} AS w FROM st WHERE status<>'HARD_INVALID') SELECT n AS event_no, err AS error_code, CAST(0 AS BIGINT) AS timestamp_ns FROM norm WHERE err IS NOT NULL UNION ALL SELECT n, string_split(codes, ',')[1], timestamp_ns FROM st WHERE status='HARD_INVALID' UNION ALL SELECT n, 'ERR_EXCESSIVE_LATENESS', timestamp_ns FROM wm WHERE w>0 AND timestamp_ns<w",
    "late_split": f"WITH {_BASE}, wm AS (SELECT n, timestamp_ns, {_WM} AS watermark_ns FROM ev) SELECT n AS event_no, watermark_ns, watermark_ns>0 AND timestamp_ns<watermark_ns AS late FROM wm",
    "reorder_sequence": f"WITH {_BASE}, wm AS (SELECT *, {_WM} AS w FROM ev) SELECT symbol, row_number() OVER (PARTITION BY symbol ORDER BY timestamp_ns, prio, coalesce(sequence_id, arrival), event_id) AS position, event_id FROM wm WHERE NOT (w>0 AND timestamp_ns<w)",
    "dedup_events": f"WITH {_BASE} SELECT DISTINCT event_id, symbol, timestamp_ns FROM ev",
    "replay_window": f"WITH {_BASE}, b AS (SELECT min(timestamp_ns) a, max(timestamp_ns) z FROM ev) SELECT symbol, row_number() OVER (PARTITION BY symbol ORDER BY timestamp_ns, prio, event_id) AS position, event_id, timestamp_ns FROM ev, b WHERE timestamp_ns BETWEEN a+(z-a)//4 AND z-(z-a)//4",
    "replay_many_windows": f"WITH {_BASE}, b AS (SELECT symbol s, min(timestamp_ns) a, max(timestamp_ns) z FROM ev GROUP BY 1) SELECT 'R'||symbol AS request_id, count(*) AS n, min(timestamp_ns) AS first_ns, max(timestamp_ns) AS last_ns FROM ev JOIN b ON s=symbol AND timestamp_ns BETWEEN a+(z-a)//4 AND z-(z-a)//4 GROUP BY 1",
    "monotonicity_audit": f"WITH {_BASE}, m AS (SELECT symbol, timestamp_ns, max(timestamp_ns) OVER (PARTITION BY symbol ORDER BY arrival, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM ev) SELECT symbol, count(*) AS n_events, count(*) FILTER (timestamp_ns<b) AS violations FROM m GROUP BY 1",
    "running_vwap": f"WITH {_SERIES} SELECT event_id, vol AS cum_volume, noti AS cum_notional, CASE WHEN vol>0 THEN noti/vol ELSE CAST(px AS DOUBLE) END AS vwap FROM ser WHERE is_trade",
    "running_imbalance": f"WITH {_SERIES} SELECT event_id, CASE WHEN buy+sell>0 THEN (buy-sell)/(buy+sell) ELSE 0.0::DOUBLE END AS imbalance FROM ser WHERE is_trade",
    "spread_series": f"WITH {_BASE} SELECT event_id, CAST(ask-px AS DOUBLE) AS spread, round(CASE WHEN ask+px>0 THEN CAST(ask-px AS DOUBLE)/(CAST(ask+px AS DOUBLE)/2)*10000 ELSE 0.0::DOUBLE END, 6) AS spread_bps FROM ev WHERE NOT is_trade",
    "inter_arrival": f"WITH {_SERIES} SELECT event_id, position, gap_ns FROM ser",
    "jitter_percentiles": f"WITH {_GAPS} SELECT * FROM pct",
    "jitter_histogram": f"WITH {_GAPS}, wd AS (SELECT symbol, greatest(gap_p99/1000.0::DOUBLE*1.5::DOUBLE, 10.0::DOUBLE)/24 AS width FROM pct), h AS (SELECT symbol, least(23, CAST(floor(gap_ns/1000.0::DOUBLE/width) AS INTEGER)) AS bin, count(*) AS n FROM rk JOIN wd USING (symbol) GROUP BY 1, 2) SELECT symbol, CAST(b.bin AS INTEGER) AS bin, coalesce(h.n, 0) AS n FROM wd CROSS JOIN (SELECT unnest(range(24)) AS bin) b LEFT JOIN h USING (symbol, bin)",
    "downsample_series": f"WITH {_BASE}, t AS (SELECT symbol, event_id, row_number() OVER (PARTITION BY symbol ORDER BY timestamp_ns, prio, event_id)-1 AS i, count(*) OVER (PARTITION BY symbol) AS n FROM ev WHERE is_trade), pick AS (SELECT symbol, event_id FROM t WHERE n<=20 UNION ALL SELECT symbol, event_id FROM t WHERE n>20 AND i=n-1 UNION ALL SELECT t.symbol, event_id FROM t JOIN (SELECT unnest(range(20)) AS j) r ON n>20 AND CAST(floor(j*(n/20.0::DOUBLE)) AS BIGINT)=i) SELECT symbol, event_id, CAST(row_number() OVER (PARTITION BY symbol, event_id) AS INTEGER) AS point FROM pick",
    "symbol_summary": f"""WITH {_GAPS}, s AS (SELECT symbol, count(*) AS total_events, count(*) FILTER (is_trade) AS trade_count, count(*) FILTER (NOT is_trade) AS quote_count, count(*) FILTER (NOT is_trade AND ask<px) AS crossed_count,
  coalesce(CAST(sum(CASE WHEN is_trade THEN k+1 END) AS DOUBLE),0) AS volume, coalesce(CAST(sum(CASE WHEN is_trade THEN px*(k+1) END) AS DOUBLE),0) AS notional,
  coalesce(CAST(min(CASE WHEN is_trade THEN px END) AS DOUBLE),0) AS min_price, coalesce(CAST(max(CASE WHEN is_trade THEN px END) AS DOUBLE),0) AS max_price,
  coalesce(CAST(last(px ORDER BY timestamp_ns, prio, event_id) FILTER (is_trade) AS DOUBLE),0) AS last_price,
  coalesce(CAST(sum(CASE WHEN is_trade AND side='BUY' THEN k+1 END) AS DOUBLE),0) AS buy_volume, coalesce(CAST(sum(CASE WHEN is_trade AND side='SELL' THEN k+1 END) AS DOUBLE),0) AS sell_volume,
  CAST(coalesce(sum(CASE WHEN NOT is_trade THEN ask-px END),0) AS DOUBLE) AS sp, round(coalesce(avg(round(CASE WHEN NOT is_trade THEN CASE WHEN ask+px>0 THEN CAST(ask-px AS DOUBLE)/(CAST(ask+px AS DOUBLE)/2)*10000 ELSE 0.0::DOUBLE END END, 6)),0),2) AS mean_spread_bps FROM ev GROUP BY 1)
SELECT s.* EXCLUDE (sp), CASE WHEN volume>0 THEN notional/volume ELSE 0.0::DOUBLE END AS vwap, CASE WHEN buy_volume+sell_volume>0 THEN (buy_volume-sell_volume)/(buy_volume+sell_volume) ELSE 0.0::DOUBLE END AS imbalance, CASE WHEN quote_count>0 THEN sp/quote_count ELSE 0.0::DOUBLE END AS mean_spread,
  coalesce(n_gaps,0) AS n_gaps, coalesce(gap_min,0) AS gap_min, coalesce(gap_max,0) AS gap_max, coalesce(gap_p50,0) AS gap_p50, coalesce(gap_p90,0) AS gap_p90, coalesce(gap_p99,0) AS gap_p99 FROM s LEFT JOIN pct USING (symbol)""",
    "manifest_rollup": f"WITH {_BASE} SELECT source, count(*) AS total_records, count(*) FILTER (is_trade) AS trade_count, count(*) FILTER (NOT is_trade) AS quote_count, min(timestamp_ns) AS min_timestamp_ns, max(timestamp_ns) AS max_timestamp_ns, string_agg(DISTINCT symbol, ',' ORDER BY symbol) AS symbols FROM ev GROUP BY 1",
    "event_identity": f"WITH {_BASE} SELECT n AS event_no, event_id FROM ev",
    "detect_event_type": "SELECT event_id, CASE WHEN event_id%7 IN (1, 3, 6) THEN 'QUOTE' ELSE 'TRADE' END AS kind FROM events",
    "csv_parse_route": f"WITH {_DIRTY}, r AS (SELECT CASE WHEN n%23=0 THEN 'ERR_PARSE_FAILURE' ELSE coalesce(err, '') END AS error_code, CASE WHEN n%29=0 THEN 'F, \"1\"' ELSE source END AS s FROM norm WHERE is_trade) SELECT error_code, CASE WHEN error_code='' THEN s ELSE '' END AS source, count(*) AS n FROM r GROUP BY 1, 2",
    "price_jump_warnings": f"WITH {_DIRTY} SELECT n AS event_no, symbol, CAST(last_p AS DOUBLE) AS last_price, CAST(p AS DOUBLE) AS price FROM st WHERE codes LIKE '%WARN_LARGE_PRICE_JUMP%'",
    "diagnostics_listing": f"WITH {_DIRTY} SELECT n AS event_no, status, string_split(codes, ',')[1] AS code FROM st WHERE codes<>''",
    "ingest_manifest": f"WITH {_DIRTY}, ok AS (SELECT * FROM st WHERE status<>'HARD_INVALID') SELECT (SELECT count(*) FROM events) AS total_records, count(*) FILTER (is_trade) AS trade_count, count(*) FILTER (NOT is_trade) AS quote_count, (SELECT count(*) FROM events)-count(*) AS quarantine_count, min(timestamp_ns) AS min_timestamp_ns, max(timestamp_ns) AS max_timestamp_ns FROM ok",
    "store_upsert": f"WITH {_BASE} SELECT CAST(make_timestamp(timestamp_ns//1000) AS DATE) AS event_date, count(*) AS n, count(DISTINCT event_id) AS n_ids FROM ev WHERE is_trade GROUP BY 1",
}
_REJ = (
    _DIRTY
    + """,
wm AS (SELECT *, """
    + _WM
    + """ AS w FROM st WHERE status<>'HARD_INVALID'),
ids AS (SELECT *, CASE WHEN is_trade THEN sha256('TRADE|'||symbol||'|'||timestamp_ns||'|'||p||'|'||(k+1)||'|'||side||'|'||source||'|'||coalesce(CAST(sequence_id AS VARCHAR),'NONE'))
  ELSE sha256('QUOTE|'||symbol||'|'||timestamp_ns||'|'||px||'|'||(k+1)||'|'||ask||'|'||(k+2)||'|'||source||'|'||coalesce(CAST(sequence_id AS VARCHAR),'NONE')) END AS id FROM wm WHERE w>0 AND timestamp_ns<w),
rej0 AS (SELECT 'parse' AS kind, n, err AS error_code, CASE err WHEN 'ERR_MISSING_SYMBOL' THEN 'symbol' WHEN 'ERR_INVALID_TIMESTAMP' THEN 'timestamp' ELSE 'price' END AS field_name, CAST(0 AS BIGINT) AS timestamp_ns, 'UNKNOWN' AS source, 'QUAR-'||n AS head, '' AS error_message FROM norm WHERE err IS NOT NULL
  UNION ALL SELECT 'invalid', n, string_split(codes, ',')[1], CASE string_split(codes, ',')[1] WHEN 'ERR_NEGATIVE_ASK_PRICE' THEN 'ask_price' ELSE 'price' END, timestamp_ns, 'UNKNOWN', 'QUAR-'||n, '' FROM st WHERE status='HARD_INVALID'
  UNION ALL SELECT 'late', n, 'ERR_EXCESSIVE_LATENESS', 'timestamp_ns', timestamp_ns, source, 'QUAR-LATE-'||substr(id, 1, 8), 'time '||timestamp_ns||' is '||(w-timestamp_ns)||' ns behind the watermark '||w FROM ids),
rej AS (SELECT r.*, head||'-'||substr(sha256('|'||n||'|'||error_code), 1, 16) AS quarantine_id, 'HARD_INVALID' AS severity, e.props AS raw_record FROM rej0 r JOIN events e ON e.event_id = n)"""
)
_QUARANTINE = "quarantine_id, timestamp_ns, source, raw_record, error_code, severity, field_name"
_ORDERS = """
ev AS (SELECT CASE WHEN l_suppkey%3=0 THEN 'HOT' ELSE 'S'||l_suppkey END AS symbol, CAST(epoch_us(CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP)) AS BIGINT)*1000 AS timestamp_ns, CAST(l_extendedprice AS DECIMAL(18,2)) AS px,
  CAST(l_quantity AS DECIMAL(18,2)) AS q, l_returnflag='R' AS sold, lpad(CAST(l_orderkey AS VARCHAR), 12, '0')||'-'||lpad(CAST(l_linenumber AS VARCHAR), 2, '0')||'-'||l_partkey||'-'||l_suppkey AS event_id FROM lineitem),
ser AS (SELECT *, row_number() OVER w AS position, CAST(sum(q) OVER w AS DOUBLE) AS cum_volume, timestamp_ns - lag(timestamp_ns) OVER w AS gap_ns FROM ev WINDOW w AS (PARTITION BY symbol ORDER BY timestamp_ns, event_id ROWS UNBOUNDED PRECEDING))"""
_POINTS = "{0} AS (SELECT symbol, event_id, row_number() OVER (PARTITION BY symbol ORDER BY timestamp_ns, event_id)-1 AS i, count(*) OVER (PARTITION BY symbol) AS n FROM ev)"

SQL |= {
    "quarantine_union": f"WITH {_REJ} SELECT error_code, severity, field_name, timestamp_ns, count(*) AS n, count(DISTINCT quarantine_id) AS n_ids FROM rej GROUP BY ALL",
    "quarantine_normalising": f"WITH {_REJ} SELECT {_QUARANTINE} FROM rej WHERE kind='parse'",
    "quarantine_rules": f"WITH {_REJ} SELECT {_QUARANTINE} FROM rej WHERE kind='invalid'",
    "quarantine_lateness": f"WITH {_REJ} SELECT {_QUARANTINE}, error_message FROM rej WHERE kind='late'",
    "quarantine_log": f"WITH {_REJ} SELECT error_code, count(*) AS n, count(DISTINCT quarantine_id) AS n_ids, max(timestamp_ns) AS last_ns FROM rej GROUP BY 1",
    "quarantine_store": f"WITH {_REJ} SELECT error_code, source, count(DISTINCT quarantine_id) AS n FROM rej GROUP BY 1, 2",
    "quote_rules": f"""WITH {_BASE}, q AS (SELECT n, CASE WHEN n%7=0 THEN -1 WHEN n%19=0 THEN 0 ELSE px END AS b, CASE WHEN n%11=0 THEN -1 ELSE ask END AS a, CASE WHEN n%13=0 THEN 0 ELSE k+1 END AS bs, CASE WHEN n%17=0 THEN 0 ELSE k+2 END AS sz FROM ev WHERE NOT is_trade),
  c AS (SELECT n, concat_ws(',', CASE WHEN b<0 THEN 'ERR_NEGATIVE_BID_PRICE' END, CASE WHEN a<0 THEN 'ERR_NEGATIVE_ASK_PRICE' END, CASE WHEN bs<=0 THEN 'ERR_NON_POSITIVE_BID_SIZE' END, CASE WHEN sz<=0 THEN 'ERR_NON_POSITIVE_ASK_SIZE' END,
    CASE WHEN b=0 THEN 'WARN_ZERO_BID_PRICE' END, CASE WHEN a=b THEN 'WARN_LOCKED_MARKET' END, CASE WHEN a<b THEN 'WARN_CROSSED_MARKET' END) AS codes FROM q)
  SELECT n AS event_no, CASE WHEN codes LIKE '%ERR_%' THEN 'HARD_INVALID' WHEN codes<>'' THEN 'SOFT_WARNING' ELSE 'ACCEPTED' END AS status, codes FROM c""",
    "crossed_policy": f"WITH {_BASE}, c AS (SELECT concat_ws(',', CASE WHEN ask<0 THEN 'ERR_NEGATIVE_ASK_PRICE' END, CASE WHEN px=0 THEN 'WARN_ZERO_BID_PRICE' END, CASE WHEN ask=px THEN 'WARN_LOCKED_MARKET' END, CASE WHEN ask<px THEN 'ERR_CROSSED_MARKET' END) AS codes FROM ev WHERE NOT is_trade) SELECT CASE WHEN codes LIKE '%ERR_%' THEN 'HARD_INVALID' WHEN codes<>'' THEN 'SOFT_WARNING' ELSE 'ACCEPTED' END AS status, codes, count(*) AS n FROM c GROUP BY 1, 2",
    "own_aliases": f"WITH {_BASE} SELECT n AS event_no, CAST(px AS DOUBLE) AS price, '' AS error_code FROM ev WHERE is_trade",
    "replay_json": f"WITH {_BASE} SELECT CASE WHEN is_trade THEN 'TRADE' ELSE 'QUOTE' END AS event_type, event_id, symbol, timestamp_ns FROM ev",
    "replay_limited": f"WITH {_BASE} SELECT event_id, symbol, timestamp_ns FROM ev ORDER BY timestamp_ns, prio, event_id LIMIT 100",
    "choose_format": f"WITH {_BASE} SELECT CASE n%5 WHEN 0 THEN 'named_table' WHEN 1 THEN 'named_lines' WHEN 2 THEN 'table' WHEN 3 THEN 'lines' ELSE 'array' END AS kind, '' AS error_code, count(*) AS n, count(DISTINCT event_id) AS n_ids FROM ev GROUP BY 1",
    "json_array_read": f"WITH {_BASE} SELECT CASE WHEN is_trade THEN 'TRADE' ELSE 'QUOTE' END AS event_type, '' AS error_code, count(*) AS n, count(DISTINCT event_id) AS n_ids FROM ev GROUP BY 1",
    "report_display": f"WITH full_summary AS ({SQL['symbol_summary']}) SELECT symbol, total_events, volume, round(vwap, 4) AS vwap, round(imbalance*100, 2) AS imbalance_pct, round(mean_spread_bps, 2) AS mean_spread_bps, {', '.join(f'round(gap_{p}/1000.0::DOUBLE, 1) AS gap_{p}_us' for p in ('min', 'p50', 'p90', 'p99', 'max'))} FROM full_summary",
    "run_differences": f"WITH {_BASE} SELECT CASE WHEN n%7=0 THEN 'first' ELSE 'second' END AS only_in, count(*) AS n FROM ev WHERE (n%7=0) <> (n%11=0) GROUP BY 1",
    "manifest_verify": "SELECT count(*) > 0 AS some_valid, count(*) > 0 AS only_those_there FROM events",
    "stream_dedup": f"WITH {_BASE} SELECT symbol, count(DISTINCT event_id) AS n, count(DISTINCT event_id) AS n_ids FROM ev WHERE {_PASS} GROUP BY 1",
    "lineitem_series": f"WITH {_ORDERS} SELECT event_id, symbol, position, cum_volume FROM ser",
    "lineitem_summary": f"""WITH {_ORDERS}, rk AS (SELECT symbol, gap_ns, row_number() OVER (PARTITION BY symbol ORDER BY gap_ns)-1 AS i, count(*) OVER (PARTITION BY symbol) AS n FROM ser WHERE gap_ns IS NOT NULL),
  pct AS (SELECT symbol, max(n) AS n_gaps, max(gap_ns) AS gap_max, min(CASE WHEN i = least(n-1, CAST(floor(n*0.5::DOUBLE) AS BIGINT)) THEN gap_ns END) AS gap_p50 FROM rk GROUP BY symbol),
  s AS (SELECT symbol, count(*) AS trade_count, CAST(sum(q) AS DOUBLE) AS volume, CAST(min(px) AS DOUBLE) AS min_price, CAST(max(px) AS DOUBLE) AS max_price, CAST(last(px ORDER BY timestamp_ns, event_id) AS DOUBLE) AS last_price,
    coalesce(CAST(sum(q) FILTER (NOT sold) AS DOUBLE), 0) AS buy_volume, coalesce(CAST(sum(q) FILTER (sold) AS DOUBLE), 0) AS sell_volume FROM ev GROUP BY 1)
  SELECT s.*, coalesce(n_gaps, 0) AS n_gaps, coalesce(gap_p50, 0) AS gap_p50, coalesce(gap_max, 0) AS gap_max FROM s LEFT JOIN pct USING (symbol)""",
    "lineitem_downsample": f"WITH {_ORDERS}, {_POINTS.format('t')}, pick AS (SELECT symbol, event_id FROM t WHERE n<=50 UNION ALL SELECT symbol, event_id FROM t WHERE n>50 AND i=n-1 UNION ALL SELECT t.symbol, event_id FROM t JOIN (SELECT unnest(range(50)) AS j) r ON n>50 AND CAST(floor(j*(n/50.0::DOUBLE)) AS BIGINT)=i) SELECT symbol, event_id, CAST(row_number() OVER (PARTITION BY symbol, event_id) AS INTEGER) AS point FROM pick",
}
SQL["stored_report"] = SQL["symbol_summary"]
SQL["stream_reorder"] = f"WITH {_BASE}, wm AS (SELECT *, {_WM} AS w FROM ev WHERE {_PASS}) SELECT symbol, row_number() OVER (PARTITION BY symbol ORDER BY timestamp_ns, prio, coalesce(sequence_id, arrival), event_id) AS position, event_id FROM wm WHERE NOT (w>0 AND timestamp_ns<w)"
SQL["stream_timers"] = SQL["reorder_sequence"]
SQL["stream_lateness"] = f"WITH {_BASE}, wm AS (SELECT event_id, timestamp_ns, {_WM} AS watermark_ns FROM ev) SELECT * FROM wm WHERE watermark_ns>0 AND timestamp_ns<watermark_ns"
SQL["stream_price_jumps"] = f"""WITH {_DIRTY} SELECT symbol, CAST(last_p AS DOUBLE) AS last_price, CAST(p AS DOUBLE) AS price,
  sha256('TRADE|'||symbol||'|'||timestamp_ns||'|'||p||'|'||(k+1)||'|'||side||'|'||source||'|'||coalesce(CAST(sequence_id AS VARCHAR),'NONE')) AS event_id FROM st WHERE codes LIKE '%WARN_LARGE_PRICE_JUMP%'"""
SQL["stream_repeats"] = f"WITH {_BASE} SELECT event_id, CAST(2 AS BIGINT) AS n, 365*86400000000000 AS apart FROM ev GROUP BY event_id"
SQL["run_sequences"] = f"""WITH {_BASE}, one AS (SELECT symbol, string_agg(event_id, ',' ORDER BY timestamp_ns, prio, event_id) AS s FROM ev GROUP BY 1),
  other AS (SELECT symbol, string_agg(event_id, ',' ORDER BY timestamp_ns + CASE WHEN n%50=0 THEN 1000000000000 ELSE 0 END, prio, event_id) AS s FROM ev GROUP BY 1) SELECT symbol, one.s = other.s AS same FROM one JOIN other USING (symbol)"""
SQL["manifest_checksums"] = f"WITH {_BASE} SELECT CAST(timestamp_ns // 3600000000000 % 24 AS VARCHAR) AS dataset_id, sha256(string_agg(event_id, chr(10) ORDER BY event_id) || chr(10)) AS sha256_checksum, timestamp_ns // 3600000000000 % 24 % 5 <> 0 AS valid FROM ev GROUP BY timestamp_ns // 3600000000000 % 24"
SQL["lineitem_gaps"] = f"""WITH {_ORDERS}, g AS (SELECT symbol, CAST(px * 1000 AS BIGINT) + CAST(q AS BIGINT) AS gap FROM ev), rk AS (SELECT symbol, gap, row_number() OVER (PARTITION BY symbol ORDER BY gap)-1 AS i, count(*) OVER (PARTITION BY symbol) AS n FROM g)
  SELECT symbol, max(n) AS n_gaps, min(gap) AS gap_min, max(gap) AS gap_max, {", ".join(f"min(CASE WHEN i = least(n-1, CAST(floor(n*{p}::DOUBLE) AS BIGINT)) THEN gap END) AS gap_p{round(p * 100)}" for p in (0.01, 0.5, 0.9, 0.999))} FROM rk GROUP BY symbol"""
SQL["lineitem_many_windows"] = f"""WITH {_ORDERS}, r AS (SELECT event_id AS request_id, symbol, timestamp_ns - 604800000000000 AS a, timestamp_ns + 604800000000000 AS b FROM ev WHERE CAST(substr(event_id, 1, 12) AS BIGINT) % 5 = 0)
  SELECT CAST(year(make_timestamp(a // 1000)) AS INTEGER) AS year, count(*) AS n, count(DISTINCT request_id) AS n_requests FROM r JOIN ev ON ev.symbol = r.symbol AND ev.timestamp_ns BETWEEN a AND b GROUP BY 1"""
SQL["broken_lines"] = f"""WITH {_BASE}, r AS (SELECT symbol, CASE WHEN n%53=0 THEN 'blank' WHEN n%47=0 THEN '' WHEN n%997=0 THEN 'JSON parse error' WHEN n%43=0 THEN 'JSON parse error' WHEN n%41=0 THEN 'Expected JSON object, got list' WHEN n%37=0 OR n%31=0 THEN 'JSON parse error' ELSE '' END AS e FROM ev)
  SELECT CASE e WHEN '' THEN '' WHEN 'blank' THEN 'ERR_MISSING_SYMBOL' ELSE 'ERR_PARSE_FAILURE' END AS error_code, CASE e WHEN 'blank' THEN '' ELSE e END AS parse_error, count(*) AS n, count(DISTINCT CASE WHEN e='' THEN symbol END) AS n_symbols FROM r GROUP BY 1, 2"""
