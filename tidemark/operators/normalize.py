"""Raw records to canonical trades and quotes, or one error code."""

from __future__ import annotations

import json
from functools import lru_cache

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..schemas import QUOTE_SIDES, SPEC, DecimalSpec

# The names by which feeds call a field, in the order they are tried.
ALIASES = {
    "trade": {
        "symbol": ["symbol", "ticker", "sym", "instrument", "s"],
        "timestamp": ["timestamp", "timestamp_ns", "ts", "time", "datetime", "transact_time", "t"],
        "price": ["price", "px", "last_price", "p", "trade_price"],
        "size": ["size", "qty", "volume", "vol", "sz", "quantity", "trade_size", "v", "q"],
        "side": ["side", "direction", "aggressor_side", "action"],
        "source": ["source", "exchange", "venue", "feed", "src"],
    },
    "quote": {
        "symbol": ["symbol", "ticker", "sym", "instrument", "s"],
        "timestamp": ["timestamp", "timestamp_ns", "ts", "time", "datetime", "quote_time", "t"],
        "bid_price": ["bid_price", "bid_px", "bid", "bidprice", "bp", "best_bid_price", "b"],
        "bid_size": ["bid_size", "bid_sz", "bid_qty", "bidsize", "bs", "best_bid_size", "bq"],
        "ask_price": ["ask_price", "ask_px", "ask", "askprice", "ap", "offer", "best_ask_price", "a"],
        "ask_size": ["ask_size", "ask_sz", "ask_qty", "asksize", "as", "offer_size", "best_ask_size", "aq"],
        "source": ["source", "exchange", "venue", "feed", "src"],
    },
}


def pick(fields: Column, names: list[str]) -> Column:
    """The value of the first name whose key is present, null values included.

    Mostly the first name is there with a value, which one look tells. The others are looked for
    in an array: a branch for each would make methods too long for the JVM to compile."""
    held = F.filter(F.array(*[F.lit(n) for n in names]), lambda n: F.map_contains_key(fields, n))
    return F.coalesce(fields[names[0]], fields[F.get(held, F.lit(0))])


def plain_names(fields: Column) -> Column:
    """Whether all names are such that lower-casing and stripping, which cost more than all else
    here where they are done a name, would leave them as they are."""
    return ~F.array_join(F.map_keys(fields), "").rlike("[^a-z0-9_]")


def staged(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """df with columns that later steps refer to many times: a generator of one row stands
    between, through which the optimizer does not copy their expressions."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def event_kind(fields: Column, lowered: Column, aliases: dict[str, dict[str, list[str]]] = ALIASES) -> Column:
    said = F.coalesce(*[F.when(fields[k] != "", fields[k]) for k in ("event_type", "type", "record_type")])
    said = F.upper(S.strip(F.coalesce(said, F.lit(""))))
    quotes = aliases["quote"]
    quoted = F.lit(False)
    for names in (quotes["bid_price"], quotes["ask_price"], ["bid"], ["ask"]):
        quoted = quoted | F.coalesce(pick(lowered, names).isNotNull(), F.lit(False))
    return (
        F.when(said.contains("TRADE") | said.isin("T", "TRD"), "TRADE")
        .when(said.contains("QUOTE") | said.isin("Q", "BBO", "NBBO"), "QUOTE")
        .when(quoted, "QUOTE")
        .otherwise("TRADE")
    )


@lru_cache(maxsize=16)
def _steps(aliases_text: str, spec: DecimalSpec, context: int) -> tuple[list[dict[str, Column]], dict[str, Column]]:
    """The columns that normalize() adds, step by step, and those at its end. They are the same for
    every input, and building them takes thousands of calls of the engine: once a context."""
    aliases = json.loads(aliases_text)
    f, low, c = F.col("__f"), F.col("__l"), F.col
    trade = c("event_type") == "TRADE"
    fields = list({**aliases["trade"], **aliases["quote"]})
    picked = {}
    for name in fields:
        by = [aliases[kind].get(name) for kind in ("trade", "quote")]
        values = [pick(low, names) if names else F.lit(None).cast("string") for names in by]
        picked[f"__{name}"] = F.when(trade, values[0]).otherwise(values[1])
    amounts = ["price", "size", *QUOTE_SIDES]
    own = {n: trade if n in ("price", "size") else ~trade for n in amounts}
    written = F.array(*[F.when(own[n], c(f"__{n}")) for n in amounts])
    steps = [
        {"__l": F.when(plain_names(f), f).otherwise(F.transform_keys("__f", lambda k, v: F.lower(S.strip(k))))},
        {"event_type": event_kind(f, low, aliases)},
        picked,
        {"symbol": F.upper(S.strip(c("__symbol"))), "timestamp_ns": S.parse_timestamp_ns(c("__timestamp")), "__texts": F.transform(written, S.canonical_decimal)},
        {f"{n}_text": F.get("__texts", F.lit(i)) for i, n in enumerate(amounts)} | {"__numbers": F.transform("__texts", lambda x: S.to_decimal(x, spec))},
        {n: F.get("__numbers", F.lit(i)) for i, n in enumerate(amounts)},
    ]
    missing = lambda x: x.isNull() | (S.strip(x) == "")
    checks: list[tuple[Column, str, str]] = [
        (missing(c("__symbol")), "ERR_MISSING_SYMBOL", "symbol"),
        (missing(c("__timestamp")), "ERR_MISSING_TIMESTAMP", "timestamp"),
        (c("timestamp_ns").isNull(), "ERR_INVALID_TIMESTAMP", "timestamp"),
    ]
    for n in amounts:
        checks += [(own[n] & missing(c(f"__{n}")), f"ERR_MISSING_{n.upper()}", n), (own[n] & c(f"{n}_text").isNull(), f"ERR_INVALID_{n.upper()}", n)]
    checks += [(own[n] & c(n).isNull(), "ERR_DECIMAL_RANGE", n) for n in amounts]
    code = F.when(c("parse_error").isNotNull(), F.struct(F.lit("ERR_PARSE_FAILURE").alias("code"), F.lit("").alias("field")))
    for when, name, field in checks:
        code = code.when(when, F.struct(F.lit(name).alias("code"), F.lit(field).alias("field")))
    seq = F.when(F.map_contains_key(f, "sequence_id"), f["sequence_id"]).otherwise(f["seq"])
    venue = S.strip(c("__source"))
    steps += [
        {"__failed": code},
        {
            "error_code": c("__failed.code"), "error_field": F.nullif(c("__failed.field"), F.lit("")), "side": F.when(trade, S.side(c("__side"))),
            "source": F.coalesce(F.when(venue != "", venue), F.when(c("source_file") != "", c("source_file")), F.lit("DEFAULT")),
            "sequence_id": F.when(seq.rlike("^[0-9]+$"), seq.try_cast("bigint")),
        },
    ]
    parse = c("error_code") == "ERR_PARSE_FAILURE"
    last = {
        "error_message": F.when(parse, c("parse_error")).when(c("error_code").isNotNull(), F.concat(F.lit("field "), c("error_field"), F.lit(" is missing or invalid"))),
        "severity": F.when(parse, "FATAL_SYNTAX").when(c("error_code").isNotNull(), "HARD_INVALID"),
        "event_id": F.when(trade, S.trade_id(c("symbol"), c("timestamp_ns"), c("price_text"), c("size_text"), c("side"), c("source"), c("sequence_id"))).otherwise(
            S.quote_id(c("symbol"), c("timestamp_ns"), *[c(f"{n}_text") for n in QUOTE_SIDES], c("source"), c("sequence_id"))
        ),
    }
    return steps, last


def normalize(raw: DataFrame, aliases: dict[str, dict[str, list[str]]] = ALIASES, spec: DecimalSpec = SPEC) -> DataFrame:
    """raw (source_file, line_number, raw_text, fields, parse_error) with event_type, the
    canonical columns of both kinds (null on the other), and error_code, error_field,
    error_message, severity of the first check that failed."""
    steps, last = _steps(json.dumps(aliases), spec, id(SparkContext._active_spark_context))
    df = raw.withColumn("__f", F.coalesce("fields", F.expr("map()").cast("map<string,string>")))
    for columns in steps:
        df = staged(df, columns)
    made = [n for columns in steps for n in columns if n.startswith("__")]
    return df.withColumns(last).drop("__f", *made)
