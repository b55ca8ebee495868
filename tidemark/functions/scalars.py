"""Column functions: times to nanoseconds, exact decimals and their text, sides, identities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import SPEC, DecimalSpec

LAST_SECOND = 4_102_444_800  # 2100-01-01, the last instant that is accepted
NS = 1_000_000_000

# Spellings of the sides.
BUY = ("B", "BUY", "BID", "1")
SELL = ("S", "SELL", "ASK", "OFFER", "-1", "2")


def _big(x: int) -> Column:
    return F.lit(x).cast("bigint")


def let(value: Column, use) -> Column:
    """use(value) with the value computed once, however often use refers to it."""
    return F.element_at(F.transform(F.array(value), use), 1)


#: The characters that count as white space at a text's ends.
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip(text: Column) -> Column:
    """Text without white space of any kind at its ends."""
    return F.btrim(text, F.lit(BLANKS))


def in_range(ns: Column) -> Column:
    return let(ns, lambda v: F.when((v >= 0) & (v <= _big(LAST_SECOND * NS)), v))


def epoch_to_ns(text: Column) -> Column:
    """Digits as ns, us, ms or s by magnitude; null if negative, not digits or out of range."""

    def scale(n: Column) -> Column:
        ladder = [(10**17, 1), (10**14, 1000), (10**11, 1_000_000)]
        out = n * NS
        for least, by in reversed(ladder):
            out = F.when(n >= F.lit(least).cast("decimal(38,0)"), (n * by).cast("decimal(38,0)")).otherwise(out.cast("decimal(38,0)"))
        return F.when((n >= 0) & (n <= F.lit(LAST_SECOND * NS).cast("decimal(38,0)")), out)

    def short(n: Column) -> Column:
        """The same of up to 19 digits, in whole numbers: those that are no bigint are out of range."""
        out = F.when(n >= _big(10**17), F.when(n <= _big(LAST_SECOND * NS), n))
        for next_, by in ((10**14, 1000), (10**11, 1_000_000), (0, NS)):
            out = out.when(n >= _big(next_), F.when(n <= _big(LAST_SECOND * NS // by), n * _big(by)))
        return out

    long = in_range(let(text.try_cast("decimal(20,0)"), scale).try_cast("bigint"))
    return F.when(text.rlike(r"^[0-9]{1,19}\z"), let(text.try_cast("bigint"), short)).otherwise(long)


def epoch_seconds_double_to_ns(seconds: Column) -> Column:
    """Floating seconds: whole seconds and the fraction scaled apart."""
    whole = F.floor(seconds)
    fine = ~F.isnan(seconds) & (seconds >= 0) & (seconds <= LAST_SECOND)
    return in_range(F.when(fine, whole.cast("bigint") * NS + F.round((seconds - whole) * NS).cast("bigint")))


ISO = r"^(\d{4})-(\d{2})-(\d{2})(?:[T ](\d{2}):(\d{2})(?::(\d{2})(?:\.(\d+))?)?)?\s*(Z|[+-]\d{2}(?::?\d{2})?)?$"


def iso_to_ns(text: Column) -> Column:
    """ISO date, or date and time with an optional fraction (cut to nanoseconds) and zone
    (UTC if none); null if the text has another shape or names no real instant."""
    return let(text, _iso_to_ns)


def _iso_to_ns(text: Column) -> Column:
    part = lambda i: F.regexp_extract(text, ISO, i)
    number = lambda i: F.when(part(i) == "", F.lit(0)).otherwise(part(i).try_cast("int"))
    zone = part(8)
    digits = F.regexp_replace(zone, "[:+-]", "")
    minutes = F.coalesce(F.substring(digits, 1, 2).try_cast("int"), F.lit(0)) * 60 + F.coalesce(F.substring(digits, 3, 2).try_cast("int"), F.lit(0))
    offset = F.when(F.startswith(zone, F.lit("-")), -minutes).when(F.startswith(zone, F.lit("+")), minutes).otherwise(F.lit(0))
    # a day counted in UTC needs no session zone
    day = F.try_make_timestamp(number(1), number(2), number(3), number(4), number(5), number(6).cast("decimal(16,6)"), F.lit("UTC"))
    nanos = F.rpad(F.substring(part(7), 1, 9), 9, "0").try_cast("bigint")
    ns = F.unix_seconds(day) * NS + F.coalesce(nanos, F.lit(0)) - offset.cast("bigint") * 60 * NS
    return in_range(F.when(text.rlike(ISO) & (number(6) < 60), ns))


BASIC = r"^(\d{4})-?(\d{2})-?(\d{2})(?:[T ](\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d{1,6})\d*)?)?)?)?(Z|[+-]\d{2}(?::?\d{2})?)?$"
WEEK = r"^(\d{4})-?W(\d{2})(?:-?([1-7]))?(?:[T ](.*))?$"


def _extended(text: Column) -> Column:
    """Times in ISO's basic format, with hours alone, a decimal comma or a week's day, written as
    ISO extended; any other text as it is."""
    part = lambda p, i: F.regexp_extract(text, p, i)
    two = lambda i: F.when(part(BASIC, i) == "", F.lit("00")).otherwise(part(BASIC, i))
    basic = F.concat(part(BASIC, 1), F.lit("-"), part(BASIC, 2), F.lit("-"), part(BASIC, 3), F.lit("T"), two(4), F.lit(":"), two(5), F.lit(":"), two(6), F.when(part(BASIC, 7) == "", F.lit("")).otherwise(F.concat(F.lit("."), part(BASIC, 7))), part(BASIC, 8))
    year, week = part(WEEK, 1).try_cast("int"), part(WEEK, 2).try_cast("int")
    first = lambda y: F.trunc(F.make_date(y, F.lit(1), F.lit(4)), "week")
    day = F.date_add(first(year), (week - 1) * 7 + F.coalesce(part(WEEK, 3).try_cast("int"), F.lit(1)) - 1)
    real = (week >= 1) & (day < first(year + 1))
    rest = F.when(part(WEEK, 4) == "", F.lit("")).otherwise(F.concat(F.lit("T"), part(WEEK, 4)))
    weekly = F.when(real, F.concat(day.cast("string"), rest))
    return F.when(text.rlike(WEEK), weekly).when(text.rlike(BASIC), basic).otherwise(text)


def parse_timestamp_ns(value: Column) -> Column:
    """Text of either kind to nanoseconds; null if neither. What is no plain ISO time is tried in
    ISO's other formats, whose fractions are cut to microseconds."""
    other = lambda t: let(_extended(t), lambda x: let(F.when(x.rlike(ISO), x).otherwise(_extended(x)), iso_to_ns))
    kinds = lambda t: F.when(t.rlike(r"^-?[0-9]+$"), epoch_to_ns(t)).when(t.rlike(ISO), iso_to_ns(t)).otherwise(other(t))
    return let(strip(value), kinds)


def format_timestamp_ns(ns: Column) -> Column:
    seconds = (ns - F.pmod(ns, _big(NS))) / NS
    whole = F.timestamp_seconds(seconds.cast("bigint"))
    return F.when(ns >= 0, F.concat(F.date_format(whole, "yyyy-MM-dd HH:mm:ss"), F.lit("."), F.lpad(F.pmod(ns, _big(NS)).cast("string"), 9, "0"), F.lit("Z")))


NUMBER = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"


def lexeme(value: Column) -> Column:
    """A number's text without space, thousands separators and currency signs; null if it is
    no finite number, longer than 64 characters, or scaled by more than 50 powers of ten."""
    said = lambda c: F.regexp_extract(c, r"[eE]([+-]?[0-9]+)$", 1)
    power = lambda c: F.when(said(c) == "", 0).otherwise(F.coalesce(F.abs(said(c).try_cast("int")), F.lit(999)))
    cleaned = F.when(F.length(strip(value)) <= 64, strip(F.translate(strip(value), ",$€£", "")))
    return let(cleaned, lambda c: F.when(c.rlike(NUMBER) & (power(c) <= 50), c))


#: Numbers whose canonical text is the one they have.
CANONICAL = r"^-?(?:0|[1-9][0-9]{0,40})(?:\.[0-9]{1,20})?\z"


def canonical_decimal(value: Column) -> Column:
    """Canonical text of a number's text, null if it is none: what is written so already is not
    taken apart."""
    return F.when(value.isNull() | value.rlike(CANONICAL), value).otherwise(format_decimal(lexeme(value)))


def format_decimal(lex: Column) -> Column:
    """Canonical text of a lexeme: plain digits, the exponent expanded, trailing zeros kept."""

    def split(x: Column) -> Column:
        body = F.regexp_replace(x, r"^[+-]|[eE].*$", "")
        power = F.coalesce(F.regexp_extract(x, r"[eE]([+-]?[0-9]+)$", 1).try_cast("int"), F.lit(0))
        whole = F.regexp_extract(body, r"^([0-9]*)", 1)
        return F.struct(F.when(F.startswith(x, F.lit("-")), "-").otherwise("").alias("sign"), F.concat(whole, F.regexp_extract(body, r"\.([0-9]*)$", 1)).alias("digits"), (F.length(whole) + power).alias("point"))

    def pad(n: Column) -> Column:
        longer = F.concat(F.repeat(F.lit("0"), F.greatest(-n["point"], F.lit(0))), n["digits"], F.repeat(F.lit("0"), F.greatest(n["point"] - F.length(n["digits"]), F.lit(0))))
        return F.struct(n["sign"].alias("sign"), longer.alias("digits"), F.greatest(n["point"], F.lit(0)).alias("point"))

    def join(n: Column) -> Column:
        left = F.regexp_replace(F.concat(F.lit("0"), F.substring(n["digits"], F.lit(1), n["point"])), r"^0+(?=[0-9])", "")
        right = F.substring(n["digits"], n["point"] + 1, F.length(n["digits"]))
        return F.concat(n["sign"], left, F.when(F.length(n["digits"]) > n["point"], F.concat(F.lit("."), right)).otherwise(""))

    return let(lex, lambda x: F.when(x.isNotNull(), let(let(split(x), pad), join)))


def to_decimal(canonical: Column, spec: DecimalSpec = SPEC) -> Column:
    """The exact value of a canonical text; null if it has more digits than the spec holds."""
    whole = F.length(F.regexp_extract(canonical, r"^-?([0-9]*)", 1))
    used = F.length(F.regexp_replace(F.regexp_extract(canonical, r"\.([0-9]+)$", 1), r"0+$", ""))
    fits = (whole <= spec.precision - spec.scale) & (used <= spec.scale)
    short = canonical.rlike(rf"^-?[0-9]{{1,{spec.precision - spec.scale}}}(?:\.[0-9]{{1,{spec.scale}}})?\z") if spec.scale and spec.precision > spec.scale else F.lit(False)
    return F.when(short | fits, canonical.try_cast(spec.ddl))


def side(value: Column) -> Column:
    return let(F.upper(strip(F.coalesce(value, F.lit("")))), lambda s: F.when(s.isin(*BUY), "BUY").when(s.isin(*SELL), "SELL").otherwise("UNKNOWN"))


def _identity(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", *parts), 256)


def _sequence(sequence_id: Column) -> Column:
    return F.coalesce(sequence_id.cast("string"), F.lit("NONE"))


def trade_id(symbol, timestamp_ns, price_text, size_text, side_, source, sequence_id) -> Column:
    return _identity(F.lit("TRADE"), F.upper(symbol), timestamp_ns.cast("string"), price_text, size_text, F.upper(side_), source, _sequence(sequence_id))


def quote_id(symbol, timestamp_ns, bid_price, bid_size, ask_price, ask_size, source, sequence_id) -> Column:
    return _identity(F.lit("QUOTE"), F.upper(symbol), timestamp_ns.cast("string"), bid_price, bid_size, ask_price, ask_size, source, _sequence(sequence_id))


def spread(bid: Column, ask: Column) -> Column:
    return ask - bid


def mid(bid: Column, ask: Column) -> Column:
    return (bid + ask) / 2


def relative_spread_bps(bid: Column, ask: Column) -> Column:
    """(ask - bid) / mid * 10000 as a double, 0 where mid is not positive."""
    total = (bid + ask).cast("double")
    return F.when(total > 0, (ask - bid).cast("double") / (total / 2) * 10000).otherwise(F.lit(0.0))
