"""Tables in and out."""

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.session import shuffles_dropped
from parley.sources import schemas


def conform(df: DataFrame, table: str) -> DataFrame:
    """Check a source against its declaration.

    Column names match without regard to case. Declared columns get their declared type, absent
    optional ones become typed nulls, columns beyond the declaration are kept as they are.
    """
    present = {name.lower(): name for name in df.columns}
    missing = [name for name in schemas.required(table) if name not in present]
    if missing:
        raise ValueError(f"{table} lacks the columns {', '.join(missing)}")
    declared = {**schemas.required(table), **schemas.optional(table)}
    actual = dict(df.dtypes)

    def typed(name: str, kind: str) -> Column:
        if name not in present:
            return F.lit(None).cast(kind).alias(name)
        column = F.col(f"`{present[name]}`")
        return (column if actual[present[name]] == kind else column.cast(kind)).alias(name)

    beyond = [F.col(f"`{name}`") for low, name in present.items() if low not in declared]
    return df.select(*[typed(name, kind) for name, kind in declared.items()], *beyond)


def read_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Landed Parquet copy of a source table."""
    return conform(spark.read.parquet(path), table)


def read_sql_table(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    key: str,
    lowest: int,
    highest: int,
    partitions: int,
    relation: str | None = None,
    **options: str,
) -> DataFrame:
    """Source table of an external SQL store, read by key ranges in parallel.

    The store's JDBC driver must be on the class path.
    """
    ranges = {
        "url": url,
        "dbtable": relation or table,
        "partitionColumn": key,
        "lowerBound": str(lowest),
        "upperBound": str(highest),
        "numPartitions": str(partitions),
    }
    return conform(spark.read.format("jdbc").options(**ranges, **options).load(), table)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a model table. A table has no row order, so nothing is sorted for it."""
    with shuffles_dropped(df.sparkSession):
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_clustered(
    df: DataFrame, path: str, by: Sequence[str], buckets: int | None = None, table: str | None = None
) -> DataFrame:
    """Replace a model table in a layout that its readers can use, and return it.

    Rows lie in buckets by a hash of ``by`` and in its order within a bucket. A join on exactly these columns needs no
    exchange of this side; pages and row groups hold neighbours, so their statistics answer filters on what goes with
    ``by``. ``by`` should tell rows apart: then no bucket is larger than the others. Buckets are as many as the session's
    shuffle partitions, so that a side which is shuffled meets them as it is.

    A layout is known through a catalog entry. With ``table`` it stays under that name; otherwise it only serves the
    DataFrame returned here, and later readers find plain Parquet files in ``path``.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = table or f"clustered_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, *by)
    with shuffles_dropped(spark):
        dealt.write.mode("overwrite").format("parquet").bucketBy(buckets, *by).sortBy(*by).option("path", path).saveAsTable(name)
    written = spark.table(name)
    if table is None:
        spark.sql(f"DROP TABLE {name}")  # the entry; the files are elsewhere and stay
    return written


def preview(spark: SparkSession, path: str, rows: int = 5) -> DataFrame:
    """The first few rows of a written table."""
    return spark.read.parquet(path).limit(rows)
