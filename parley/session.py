"""Where lineage is cut: the folder that all executors share."""

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is written meanwhile leaves no shuffle files, as its readers go to the written files.

    Otherwise they stay until the driver happens to collect its garbage. The setting of the session returns afterwards.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; without the setting, one in the warehouse.

    Both are shared by the executors, so behaviour is the same on any master.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir() or context.getConf().get("spark.checkpoint.dir")
    folder = folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints"
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder, written now; a lost executor re-reads files.

    Spark removes the files with the last reference where
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set.
    """
    shared_folder(df.sparkSession)
    with shuffles_dropped(df.sparkSession):
        return df.select("*").checkpoint(eager=True)


def new_table_path(spark: SparkSession) -> str:
    """A place for a table that lives as long as its readers need it, below the shared folder, in one folder per application."""
    return f"{shared_folder(spark)}/tables-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def drop_tables(spark: SparkSession) -> None:
    """Delete the tables that this application wrote through ``new_table_path``; call it when their readers are done."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/tables-{spark.sparkContext.applicationId}")
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
