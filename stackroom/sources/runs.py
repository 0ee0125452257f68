"""Run reports and progress logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stackroom.functions.paths import relative_path
from stackroom.schemas import REPORT
from stackroom.sources.corpus import dataset_folders, listing


#: Folders beside those of the datasets.
NO_DATASETS = ("archived", "reports", "download", "reports-failures")


def read_reports(spark: SparkSession, folder: str) -> DataFrame:
    """Reports named ``<command>-<number>.json`` with ``path`` and ``file_stamp``.

    Files of other names are passed over unread; a report that does not parse
    is an error.
    """
    files = spark.read.text(folder, wholetext=True)
    stamp = F.regexp_extract("_metadata.file_name", r"\A.+-([0-9]+)\.json\z", 1).try_cast("bigint")
    report = F.from_json("value", REPORT, {"mode": "FAILFAST"})
    return (
        files.where(stamp.isNotNull())
        .select(
            F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B"))).alias("path"),
            stamp.alias("file_stamp"),
            report.alias("report"),
        )
        .select("path", "file_stamp", "report.*")
        .withColumn(
            "command",
            F.coalesce("command", F.raise_error(F.concat(F.lit("invalid report JSON "), "path"))),
        )
    )


def _file(root: str, path) -> Column:
    return relative_path(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), root)


def _of_dataset(file: Column) -> Column:
    return F.substring_index(file, "/", 1)


def read_logs(spark: SparkSession, root: str, command: str) -> DataFrame:
    """Log lines ``<root>/<dataset>/<step>/<command>.log``: dataset, file, block, row, value.

    A large log is read in blocks by several tasks. ``block`` (file and first byte) orders the
    blocks of a dataset, ``row`` the lines of a block, all of which one task reads in turn. A
    ``row`` has a meaning inside one scan only.
    """
    lines = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"{command}.log")
        .text(root)
    )
    file = _file(root, "_metadata.file_path")
    return lines.where(~_of_dataset(file).isin(*NO_DATASETS)).select(
        _of_dataset(file).alias("dataset"),
        file.alias("file"),
        F.struct(file.alias("file"), F.col("_metadata.file_block_start").alias("start")).alias("block"),
        F.monotonically_increasing_id().alias("row"),
        "value",
    )


def log_times(spark: SparkSession, root: str) -> DataFrame:
    """command, dataset, touched_unix: when each log ``<root>/<dataset>/<step>/<command>.log`` was
    last written, from a listing alone."""
    found = listing(spark, root, "*.log")
    if found is None:
        return spark.createDataFrame([], "command string, dataset string, touched_unix bigint")
    file = relative_path(F.col("path"), root)
    command = F.regexp_extract(file, r"([^/]+)\.log\z", 1)
    touched = F.unix_seconds("modificationTime")
    logs = found.where(~_of_dataset(file).isin(*NO_DATASETS)).select(
        command.alias("command"), _of_dataset(file).alias("dataset"), touched.alias("touched_unix")
    )
    return logs.groupBy("command", "dataset").agg(F.max("touched_unix").alias("touched_unix"))


def run_datasets(spark: SparkSession, root: str) -> list[str]:
    """Names of the dataset folders of a metadata folder, sorted."""
    return [name for name in dataset_folders(spark, root) if name not in NO_DATASETS]
