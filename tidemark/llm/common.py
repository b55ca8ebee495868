"""Shared pieces: scratch tables on the shared folder, byte columns, components of a graph."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..tables import new_path

#: Words are runs of anything but these six ASCII white-space bytes (fixed by the contracts).
WORD = r"[^\x20\x09-\x0D]+"


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back: later plans start
    from files that outlive any executor."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def drop_cut(df: DataFrame) -> None:
    """Delete the files of a table made by cut() that no plan needs any more."""
    path = getattr(df, "_scratch_path", None)
    if path:
        jvm = df.sparkSession._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration() if hasattr(df.sparkSession, "_jsc") else df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def utf8(column: str = "text"):
    """A text column as bytes; null is empty."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))


def sets_aside(*own: str):
    """For functions of documents that return them with their columns: all columns but own ones
    have other names meanwhile, so that none meets a name that the function makes for itself."""

    def wrap(function):
        @wraps(function)
        def call(docs: DataFrame, *args, **options) -> DataFrame:
            aside = {f"__column{i}": c for i, c in enumerate(docs.columns) if c not in own}
            back = {c: name for name, c in aside.items()}
            out = function(docs.toDF(*[back.get(c, c) for c in docs.columns]), *args, **options)
            return out.toDF(*[aside.get(c, c) for c in out.columns])

        return call

    return wrap


def row_hash(docs: DataFrame):
    """128 bits of all columns of a row, of any types."""
    cells = [F.to_json(F.struct(f.name)) if "map<" in f.dataType.simpleString() else F.col(f.name) for f in docs.schema]
    return F.struct(F.xxhash64(*cells).alias("a"), F.xxhash64(F.lit("b"), *cells).alias("b"))


def running_sums(df: DataFrame, order: list, sums: dict) -> DataFrame:
    """df with, for each name in sums, the sum of its column over the rows before it in order
    (which must name a row). Rows are dealt by ranges; a task sums its own, and the totals of the
    tasks, one row each, are scanned after it."""
    names = {f"_o{i}": c for i, c in enumerate(order)} | {f"_v{i}": c for i, c in enumerate(sums.values())}
    by = [f"_o{i}" for i in range(len(order))]
    df = cut(df.withColumns(names).repartitionByRange(*by).withColumn("_part", F.spark_partition_id()), "ordered")
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    totals = df.groupBy("_part").agg(*[F.sum(f"_v{i}").alias(f"_t{i}") for i in range(len(sums))])
    totals = totals.select("_part", *[F.coalesce(F.sum(f"_t{i}").over(before), F.lit(0)).alias(f"_t{i}") for i in range(len(sums))])
    within = W.partitionBy("_part").orderBy(*by).rowsBetween(W.unboundedPreceding, -1)
    df = df.withColumns({f"_s{i}": F.coalesce(F.sum(f"_v{i}").over(within), F.lit(0)) for i in range(len(sums))})
    out = df.join(totals, "_part")
    return out.withColumns({n: F.col(f"_s{i}") + F.col(f"_t{i}") for i, n in enumerate(sums)}).drop("_part", *names, *[f"_{x}{i}" for x in "st" for i in range(len(sums))])


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of an undirected graph with columns a, b (of any type with an order).

    Returns node, root (the least node of its component) for every node with an edge to
    another. Alternating large-star and small-star steps; each round only needs the least
    neighbour of every node, which is aggregated before the shuffle; a hub's own edges still meet
    it in one task. It ends as soon as every node has either one edge, to a lesser node, or only greater neighbours, which is
    a forest of stars around least nodes. Self loops and repeated edges are harmless; no edges give
    no rows.
    """
    edges = cut(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    ends = lambda t: t.select(F.col("u").alias("n"), F.lit(1).alias("lower"), F.lit(0).alias("higher")).union(t.select("v", F.lit(0), F.lit(1)))
    stars = lambda t: ends(t).groupBy("n").agg(F.sum("lower").alias("lower"), F.max("higher").alias("higher")).where("lower + higher > 1 AND lower > 0").isEmpty()
    settled = stars(edges)
    for _ in range(max_rounds):
        if settled:
            break
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # every u > v now: the small star links v and u itself to u's least neighbour
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
            .union(low.select("u", F.col("m").alias("v")))
            .distinct()
        )
        new = cut(small, "edges")
        drop_cut(edges)
        edges, settled = new, stars(new)
    if not settled:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.groupBy("v").agg(F.lit(1).alias("one")).select(F.col("v").alias("node"), F.col("v").alias("root"))
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root")).unionByName(roots)
