"""What is written once leaves no shuffle files behind for the rest of the query."""

import pytest
from pyspark.sql import functions as F

from parley import session
from parley.sources.tables import write_clustered, write_table


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [files.apply(i).getName() for i in range(files.size())]
    return {name for name in names if name.startswith("shuffle_")}


def written(spark, how, rows, path):
    if how == "checkpoint":
        return session.cut_lineage(rows)
    if how == "clustered":
        return write_clustered(rows, path, ["key"], 3)
    write_table(rows, path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("how", ["checkpoint", "clustered", "table"])
def test_no_shuffle_files_stay(spark, tmp_path, how):
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("key")).agg(F.sum("id").alias("total"))
    before, setting = shuffle_files(spark), spark.conf.get(session._CLEANUP)
    table = written(spark, how, rows, str(tmp_path / "table"))
    assert not shuffle_files(spark) - before
    assert spark.conf.get(session._CLEANUP) == setting
    # The rows that were written can be computed again, and the written ones are the same.
    assert sorted(map(tuple, table.select("key", "total").collect())) == sorted(map(tuple, rows.collect()))
