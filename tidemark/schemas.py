"""Fixed schemas. Prices and sizes are exact decimals beside their text; times are integer nanoseconds."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class DecimalSpec:
    """Precision and scale of prices and sizes; products and sums stay exact up to (18, 6)."""

    precision: int = 18
    scale: int = 6

    @property
    def ddl(self) -> str:
        return f"decimal({self.precision},{self.scale})"


SPEC = DecimalSpec()
DIAGNOSTICS = "array<struct<code:string,message:string,field:string,severity:string>>"
RAW = "source_file string, line_number bigint, raw_text string, fields map<string,string>, parse_error string"
TRADE_COLUMNS = ["event_id", "symbol", "timestamp_ns", "price", "size", "price_text", "size_text", "side", "source", "sequence_id"]
QUOTE_SIDES = ["bid_price", "bid_size", "ask_price", "ask_size"]
QUOTE_COLUMNS = ["event_id", "symbol", "timestamp_ns", *QUOTE_SIDES, *[f"{c}_text" for c in QUOTE_SIDES], "source", "sequence_id"]
QUARANTINE_COLUMNS = ["quarantine_id", "timestamp_ns", "source", "raw_record", "error_code", "error_message", "severity", "field_name"]
QUARANTINE = "quarantine_id string, timestamp_ns bigint, source string, raw_record string, error_code string, error_message string, severity string, field_name string"
MANIFEST = "dataset_id string, schema_version string, created_at_utc string, source_file string, total_records bigint, trade_count bigint, quote_count bigint, quarantine_count bigint, stored_count bigint, min_timestamp_ns bigint, max_timestamp_ns bigint, sha256_checksum string, config_hash string, symbols array<string>"
TYPES = {n: "bigint" if n in ("timestamp_ns", "sequence_id", "line_number") else SPEC.ddl if n in ("price", "size", *QUOTE_SIDES) else "string" for n in [*TRADE_COLUMNS, *QUOTE_COLUMNS, "event_type", "source_file", "line_number"]}


def ddl(names: list[str]) -> str:
    return ", ".join(f"{n} {TYPES[n]}" for n in names)


TRADES, QUOTES = ddl(TRADE_COLUMNS), ddl(QUOTE_COLUMNS)
