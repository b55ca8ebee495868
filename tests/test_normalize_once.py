from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators.normalize import normalize, pick
from tidemark.plans import market

SMALL = "/root/testdata/sf0.001"


def test_rejects_are_worked_out_once(spark, monkeypatch):
    calls = []
    whole = market.normalize
    monkeypatch.setattr(market, "normalize", lambda *a, **k: calls.append(1) or whole(*a, **k))
    market.quarantine_store(spark, SMALL)
    assert len(calls) == 1


def test_normalising_rejects_need_no_validation(spark, monkeypatch):
    monkeypatch.setattr(market.validate, "validate", lambda *a, **k: 1 / 0)
    assert market.quarantine_normalising(spark, SMALL).count() > 0


def test_pick_takes_the_first_name_there(spark):
    rows = [({"b": "2", "a": "1"}, "1"), ({"b": "2"}, "2"), ({"a": None, "b": "2"}, None), ({"c": "3"}, None)]
    got = spark.createDataFrame([(m, w) for m, w in rows], "m map<string,string>, w string").select(pick(F.col("m"), ["a", "b"]).alias("g"), "w").collect()
    assert [r.g for r in got] == [r.w for r in got]


def test_names_that_are_not_plain_are_lowered(spark):
    raw = spark.createDataFrame([("", 1, "x", {" Symbol ": "a", "TS": "1789552800", "Price": "1.5", "size": "2"}, None)], "source_file string, line_number bigint, raw_text string, fields map<string,string>, parse_error string")
    r = normalize(raw).first()
    assert (r.symbol, r.timestamp_ns, r.price_text, r.error_code) == ("A", 1789552800 * 10**9, "1.5", None)


def test_nineteen_digits(spark):
    cases = {"1704067211172425000": 1704067211172425000, "4102444800000000000": 4102444800000000000, "4102444800000000001": None, "9999999999999999999": None, "0000000000000000017": 17 * 10**9}
    df = spark.createDataFrame([(t,) for t in cases], "t string").select("t", S.epoch_to_ns(F.col("t")).alias("n"))
    assert {r.t: r.n for r in df.collect()} == cases
