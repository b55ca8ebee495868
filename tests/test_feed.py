from pyspark.sql import functions as F

from tidemark.operators import validate
from tidemark.operators.normalize import normalize
from tidemark.prefix import prefix_scan
from tidemark.sources.text import read_raw


def test_malformed_csv(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text(
        "timestamp,symbol,price,size,side,source\n2026-09-16T10:00:00Z,AAPL,150.25,100,BUY,N\nnever,AAPL,1,1,BUY,N\n2026-09-16T10:00:01Z,,1,1,BUY,N\n"
        "2026-09-16T10:00:02Z,AAPL,-5,1,BUY,N\n\n2026-09-16T10:00:03Z,AAPL\n2026-09-16T10:00:04Z,AAPL,151,7,X,N\n"
    )
    n = normalize(read_raw(spark, str(path)))
    errors = {r.line_number: r.error_code for r in n.collect()}
    assert errors == {2: None, 3: "ERR_INVALID_TIMESTAMP", 4: "ERR_MISSING_SYMBOL", 5: None, 7: "ERR_PARSE_FAILURE", 8: None}
    status = {r.line_number: r.status for r in validate.validate(n.where("error_code is null")).collect()}
    assert status == {2: "ACCEPTED", 5: "HARD_INVALID", 8: "ACCEPTED"}


def test_json_digits_kept(spark, tmp_path):
    path = tmp_path / "x.jsonl"
    path.write_text('{"symbol":"A","ts":1789552800,"price":150.20,"size":1e2}\n[1]\nnot json\n')
    rows = {r.line_number: r for r in normalize(read_raw(spark, str(path))).collect()}
    assert (rows[1].price_text, rows[1].size_text) == ("150.20", "100")
    assert rows[2].parse_error == "Expected JSON object, got list" and rows[3].error_code == "ERR_PARSE_FAILURE"


def test_prefix_scan_is_the_window(spark):
    df = spark.range(500).select("id", ((F.col("id") * 7919) % 101).alias("v"))
    got = prefix_scan(df, [], ["id"], F.floor(F.col("id") / 37), F.col("v"), "max", "m").orderBy("id").collect()
    best = -1
    for r in got:
        best = max(best, r.v)
        assert r.m == best
