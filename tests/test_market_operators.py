"""Selection, windows, places and digests against brute force; manifests of files without records."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import manifest, metrics, reorder
from tidemark.plans.ingest import ingest
from tidemark.sources.store import Store


@pytest.mark.parametrize("parts, window", [(2, 0), (1024, 0), (1024, 100_000)])
def test_order_statistics(spark, parts, window):
    rng = random.Random(2)
    values = {"one": [5], "equal": [7] * 20, "wide": [0, 1, 2**63 - 1] + [rng.randint(0, 2**62) for _ in range(50)], "many": [rng.randint(0, 400) for _ in range(900)], None: [-3, -2**62, 4]}
    rows = [(k, v) for k, vs in values.items() if k for v in vs]
    counts = spark.createDataFrame(rows, "symbol string, v bigint").groupBy("symbol", "v").agg(F.count("*").alias("n"))
    points = {"p0": 0.0, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    got = {r.symbol: r for r in metrics.order_statistics(counts, ["symbol"], "v", points, parts=parts, window=window).collect()}
    for k, vs in values.items():
        if k:
            vs = sorted(vs)
            assert [got[k][n] for n in points] == [vs[min(len(vs) - 1, int(len(vs) * p))] for p in points.values()] and got[k].total == len(vs)
    assert metrics.order_statistics(counts.where("false"), ["symbol"], "v", points).collect() == []


@pytest.mark.parametrize("few", [100_000, 0])
def test_many_windows(spark, monkeypatch, few):
    monkeypatch.setattr(reorder, "BROADCAST_ROWS", few)
    rng = random.Random(6)
    events = [(f"e{i}", "HOT" if i % 3 else "S", rng.randint(0, 5000)) for i in range(600)]
    asked = [(f"r{i}", rng.choice(["HOT", "S", "NONE"]), a := rng.randint(0, 5000), a + rng.choice([-5, 0, 10, 800, 2**60])) for i in range(150)] + [("all", "HOT", 0, 2**63 - 1)]
    e = spark.createDataFrame(events, "event_id string, symbol string, timestamp_ns bigint")
    r = spark.createDataFrame(asked, "request_id string, symbol string, start_ns bigint, end_ns bigint")
    got = sorted((x.request_id, x.event_id) for x in reorder.replay_many(e, r).collect())
    assert got == sorted((q, i) for q, s, a, b in asked for i, t, ns in events if t == s and a <= ns <= b)
    none = reorder.replay_many(e, r.where("false"))
    assert none.collect() == [] and set(none.columns) == set(reorder.replay_many(e, r).columns)


def test_places_and_sequences(spark):
    rng = random.Random(7)
    rows = [(f"e{i:03d}", "HOT" if i % 4 else "S", rng.randint(0, 60)) for i in range(300)]
    e = spark.createDataFrame(rows, "event_id string, symbol string, t bigint").repartition(4)
    order, bucket = [F.col("t"), F.col("event_id")], F.floor(F.col("t") / 10)
    got = {r.event_id: r.position for r in reorder.positions(e, ["symbol"], order, bucket).collect()}
    for s in ("HOT", "S"):
        assert [got[i] for i, x, t in sorted(rows, key=lambda r: (r[2], r[0])) if x == s] == list(range(1, sum(x == s for _, x, _ in rows) + 1))
    swapped = e.withColumn("t", F.when(F.col("event_id") == "e001", 61).otherwise(F.col("t")))
    same = lambda other: {r.symbol: r.same for r in manifest.same_sequence(e, other, ["symbol"], order, bucket, ["event_id"]).collect()}
    assert same(e.repartition(3)) == {"HOT": True, "S": True}
    assert same(swapped) == {"HOT": False, "S": True}
    assert same(e.where("symbol = 'HOT'")) == {"HOT": True, "S": False}
    assert same(e.unionByName(e.where("event_id = 'e000'"))) == {"HOT": True, "S": False}


def test_files_without_records_have_manifests(spark, tmp_path):
    (tmp_path / "empty.jsonl").write_text("")
    (tmp_path / "blank.jsonl").write_text("\n\n")
    (tmp_path / "head.csv").write_text("symbol,timestamp,price,size\n")
    (tmp_path / "one.csv").write_text("symbol,timestamp,price,size\nA,1700000000,1,1\n")
    store = Store(spark, str(tmp_path / "store"))
    ingest(spark, [str(tmp_path / n) for n in ("empty.jsonl", "blank.jsonl", "head.csv", "one.csv")], store)
    got = {r.source_file.rsplit("/", 1)[-1]: r for r in store.manifests().collect()}
    assert {n: (r.total_records, r.stored_count, r.symbols) for n, r in got.items()} == {"empty.jsonl": (0, 0, []), "blank.jsonl": (0, 0, []), "head.csv": (0, 0, []), "one.csv": (1, 1, ["A"])}
    assert all(len(r.sha256_checksum) == 64 for r in got.values())


def test_quarantine_reads_only_what_it_touches(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    row = lambda i: (f"QUAR-{i}", 0, "s", "raw", "E", "m", "HARD_INVALID", None)
    from tidemark.schemas import QUARANTINE

    rows = spark.createDataFrame([row(i) for i in range(200)], QUARANTINE)
    store.put_quarantine(rows)
    store.put_quarantine(spark.createDataFrame([row(5), row(5), row(777)], QUARANTINE))
    store.put_quarantine(rows.where("false"))
    assert sorted(r.quarantine_id for r in store.quarantine().collect()) == sorted(f"QUAR-{i}" for i in [*range(200), 777])
    plan = store._quarantine().where(F.col("bucket").isin(["b01"]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [(bucket" in plan


def test_windows_are_counted_as_the_replay_gives_them(spark):
    """Repeated and empty requests, ends that tie with events, windows over several buckets."""
    from tidemark.operators import reorder

    e = spark.createDataFrame([(f"e{i}", "A" if i % 3 else "B", 10 * (i // 4)) for i in range(200)], "event_id string, symbol string, timestamp_ns bigint")
    asked = [(f"r{i}", "A" if i % 2 else "B", 7 * i - 40, 7 * i + 10 * (i % 9) - 40) for i in range(90)]
    r = spark.createDataFrame([*asked, *asked[:5], ("x", "A", 9, 5), ("y", "none", 0, 900)], "request_id string, symbol string, start_ns bigint, end_ns bigint")
    want = {x.request_id: x["count"] for x in reorder.replay_many(e, r).groupBy("request_id").count().collect()}
    got = {x.request_id: x.n for x in reorder.count_many(e, r, 50).groupBy("request_id").agg({"n": "sum"}).toDF("request_id", "n").collect() if x.n}
    assert got == want and len(got) > 60


def test_totals_of_a_key_in_every_row(spark):
    from pyspark.sql import functions as F

    from tidemark.prefix import Running, prefix_scans

    rows = spark.range(100).select((F.col("id") % 2).alias("k"), "id")
    for bucket in (None, F.floor(F.col("id") / 10)):
        got = prefix_scans(rows, ["k"], ["id"], bucket, {"n": Running(F.lit(1), "total")})
        assert {(r.k, r.n) for r in got.collect()} == {(0, 50), (1, 50)} and got.count() == 100


def test_down_sampling_deals_no_rows_by_key_alone(spark):
    from pyspark.sql import functions as F

    from tidemark.operators import metrics

    rows = spark.range(1000).select(F.lit("HOT").alias("symbol"), "id")
    plan = metrics.down_sample(rows, ["symbol"], ["id"], 50, F.floor(F.col("id") / 10))._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert joins and all("__bucket" in line for line in joins)
