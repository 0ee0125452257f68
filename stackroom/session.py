"""Session defaults and lineage cutting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; on a cluster the submitter configures it."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("stackroom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.maxConcurrentOutputFileWriters", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` with a reliable checkpoint.

    The folder is the one the cluster names in ``spark.checkpoint.dir``, else one in the
    warehouse, which executors share as well. What is written there goes when the
    application ends.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or f"{warehouse}/_checkpoints")
        folder = spark._jvm.org.apache.hadoop.fs.Path(context.getCheckpointDir())
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return df.checkpoint(eager=True)
