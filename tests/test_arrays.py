import duckdb
import pytest

from tidemark.plans import market


@pytest.fixture
def joins_turn_broadcast(spark):
    """Plans as large tables get them: joins are planned as shuffled ones and turn into broadcasts
    once the sizes are known."""
    names = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "10m"}
    before = {n: spark.conf.get(n, None) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.set(n, v) if v is not None else spark.conf.unset(n)


def test_a_day_is_one_array_file(spark, tmp_path, joins_turn_broadcast):
    market._arrays(market.feed(spark, "/root/testdata/sf0.01")).text(str(tmp_path / "arrays"))
    texts = [[p.read_text() for p in day.glob("*.txt")] for day in (tmp_path / "arrays").glob("day=*")]
    assert len(texts) > 1
    assert all(len(files) == 1 and files[0].startswith("[") and files[0].rstrip().endswith("]") for files in texts)


def test_arrays_read_what_the_sql_counts(spark, joins_turn_broadcast):
    d = "/root/testdata/sf0.001"
    events = duckdb.connect()
    events.sql(f"CREATE VIEW events AS SELECT * FROM '{d}/events.parquet'")
    got = [tuple(r) for r in market.json_array_read(spark, d).collect()]
    assert sorted(got) == sorted(events.sql(market.SQL["json_array_read"]).fetchall())
