from pyspark.sql import functions as F

from tidemark.tables import spread


def test_parts_are_even_whatever_the_files_row_groups(spark, tmp_path):
    """Files of very different sizes, more of them than cores: no part holds most rows."""
    rows = spark.range(20_000)
    for i in range(12):
        rows.where(F.col("id") < (20_000 if i == 5 else 10)).coalesce(1).write.parquet(str(tmp_path / f"t{i}"))
    read = spark.read.option("recursiveFileLookup", True).parquet(str(tmp_path))
    sizes = [r["count"] for r in spread(read, rows=1000).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == read.count() and len(sizes) > 15 and max(sizes) < 1500
