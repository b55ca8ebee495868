"""Tables on the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; where it is unset, a temporary one
    on a single machine, and an error on a cluster, whose machines would not share it."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/tidemark"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def staged_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """df written once and read back, so that several sinks need not compute it again."""
    path = path or new_path(df.sparkSession, name)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def drop_path(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def drop_staged(*tables: DataFrame) -> None:
    """Delete the files of tables made by staged_table() that no plan needs any more."""
    for table in tables:
        drop_path(table.sparkSession, table._staged_path)


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet table, empty where nothing has been written yet."""
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the finished versions of a table, least first: folders v=0, v=1, ..."""
    if not exists(spark, path):
        return []
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in system.listStatus(root)]
    return sorted(int(n[2:]) for n in names if n.startswith("v=") and exists(spark, f"{path}/{n}/_SUCCESS"))


#: Rows of a part that costly parsing gets.
PART_ROWS = 25_000


def spread(df: DataFrame, rows: int = PART_ROWS) -> DataFrame:
    """df of files in even parts, over all cores at least and of about so many rows each: files
    are split by row groups, whose number and size have nothing to do with what parsing costs."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows)))
