"""Writers. Everything goes through Spark's commit protocol."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _located(spark: SparkSession, path: str):
    """The path and its file system, as Spark itself finds them."""
    located = spark._jvm.org.apache.hadoop.fs.Path(path)
    return located, located.getFileSystem(spark._jsc.hadoopConfiguration())


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` came to its end: its committer has left ``_SUCCESS``."""
    mark, files = _located(spark, f"{whole_version(spark, path)}/_SUCCESS")
    return files.exists(mark)


def remove(spark: SparkSession, path: str) -> None:
    gone, files = _located(spark, path)
    files.delete(gone, True)


# Names that begin with a dot are passed over by every listing of Spark, also with a "=" in them.
_OLD = ".old-"
_NEW = ".new-"


def _beside(path: str, mark: str) -> str:
    folder, slash, name = path.rstrip("/").rpartition("/")
    return f"{folder}{slash}{mark}{name}"


def whole_version(spark: SparkSession, path: str) -> str:
    """Where the whole version of ``path`` is: there or, between two steps of a swap, aside."""
    place, files = _located(spark, path)
    old = _beside(path, _OLD)
    return old if not files.exists(place) and files.exists(_located(spark, old)[0]) else path


def recover(spark: SparkSession, path: str) -> None:
    """Finish or take back a swap of ``path`` that was cut short. With a new version in place the
    old one goes; with none the old one returns."""
    place, files = _located(spark, path)
    old = _located(spark, _beside(path, _OLD))[0]
    if not files.exists(old):
        return
    if files.exists(place):
        files.delete(old, True)
    elif not files.rename(old, place):
        raise OSError(f"cannot take back {old.toString()}")


def recover_below(spark: SparkSession, folder: str) -> None:
    """``recover`` for everything in ``folder`` that has an old version aside."""
    place, files = _located(spark, folder)
    if not files.exists(place):
        return
    names = [entry.getPath().getName() for entry in files.listStatus(place)]
    for name in names:
        if name.startswith(_OLD):
            recover(spark, f"{folder}/{name.removeprefix(_OLD)}")


def swap(spark: SparkSession, source: str, target: str) -> None:
    """Put the folder ``source`` in the place of ``target``, which may exist.

    Old aside, new in, old away: two renames and a delete, and at each moment one whole version
    is at ``target`` or aside, where ``whole_version`` finds it. What a crash leaves is settled by
    ``recover``, with which each swap begins.
    """
    recover(spark, target)
    place, files = _located(spark, target)
    old = _located(spark, _beside(target, _OLD))[0]
    files.mkdirs(place.getParent())
    if files.exists(place) and not files.rename(place, old):
        raise OSError(f"cannot set {target} aside")
    if not files.rename(_located(spark, source)[0], place):
        recover(spark, target)
        raise OSError(f"cannot move {source} to {target}")
    files.delete(old, True)


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file in one step, over what is there: whoever reads ``path`` sees the text
    before or the text after."""
    place, files = _located(spark, path)
    beside = _located(spark, _beside(path, f"{_NEW}{uuid.uuid4().hex}-"))[0]
    files.mkdirs(place.getParent())
    out = files.create(beside)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    kinds = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    over = spark.sparkContext._gateway.new_array(kinds, 1)
    over[0] = kinds.OVERWRITE
    where = spark._jvm.org.apache.hadoop.fs.FileContext
    qualified = files.makeQualified(place)
    context = where.getFileContext(qualified.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(files.makeQualified(beside), qualified, over)


def write_parquet(rows: DataFrame, path: str, overwrite: bool = False) -> None:
    """Write ``path`` as a whole. What an overwrite replaces stays until the new rows are
    written beside it."""
    spark = rows.sparkSession
    if not overwrite:
        rows.write.option("compression", "snappy").parquet(path)
        return
    beside = _beside(path, f"{_NEW}{uuid.uuid4().hex}-")
    try:
        rows.write.option("compression", "snappy").parquet(beside)
        swap(spark, beside, path)
    finally:
        remove(spark, beside)


#: The key that partitions are staged by: no column of the data, so none is lost.
STAGED_KEY = "_staged_partition"


def _staged_name(value: str) -> str:
    """A folder name for any partition value: its bytes in hex, which no writer escapes."""
    return f"v{value.encode().hex().upper()}"


def staged_value(name: Column) -> Column:
    """The partition value of a staged folder's name."""
    return F.unhex(F.substring(name, 2, 1 << 20)).cast("string")


def stage_partitions(rows: DataFrame, path: str, value: Column) -> None:
    """Write ``rows`` below ``path`` in one folder per ``value``, all columns in the files.

    A task reads whole files, so it meets few partitions: with
    ``spark.sql.maxConcurrentOutputFileWriters`` set, it need not sort its rows first.
    """
    staged = rows.withColumn(STAGED_KEY, F.concat(F.lit("v"), F.hex(F.encode(value, "UTF-8"))))
    staged.write.option("compression", "snappy").partitionBy(STAGED_KEY).parquet(path)


def publish_partition(spark: SparkSession, staged: str, path: str, column: str, value: str) -> None:
    """Move one staged partition to its place in ``path``, as folder ``column=value``; ``value`` is
    the text of the source folder, as its writer escaped it."""
    folder = value or "__HIVE_DEFAULT_PARTITION__"
    swap(spark, f"{staged}/{STAGED_KEY}={_staged_name(value)}", f"{path}/{column}={folder}")


def write_csv_if_any(rows: DataFrame, path: str) -> bool:
    """Write a side output; nothing is written when there are no rows."""
    if rows.isEmpty():
        return False
    rows.write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)
    return True


def output_path(base: str, dataset: str) -> str:
    """``<folder>/<stem>_<dataset>.parquet`` next to the base path."""
    folder, slash, name = base.rpartition("/")
    stem = name.rsplit(".", 1)[0] if "." in name.lstrip(".") else name
    return f"{folder}{slash}{stem or 'extract'}_{dataset}.parquet"


def append_report(report: DataFrame, failures: DataFrame, folder: str, nonce: int) -> str:
    """Write one run's report to ``folder`` as ``<command>-<nonce>.json``, as ``read_reports``
    reads it, and its failures to the table ``<folder>-failures``.

    A run may have very many failures, so they stay rows of their own; the report holds the
    first of each dataset and phase, by which it can be found.
    """
    spark = report.sparkSession
    rows = failures.withColumn("report_nonce", F.lit(nonce).cast("bigint"))
    rows.write.mode("append").parquet(f"{folder}-failures")
    whole = F.struct(*failures.columns)
    firsts = failures.groupBy("dataset", "phase").agg(F.min_by(whole, F.coalesce("rel_path", F.lit(""))).alias("one"))
    shown = firsts.agg(F.array_sort(F.collect_list("one")).alias("failures"))
    full = report.drop("failures").join(shown)  # one row each
    row = full.select("command", F.to_json(F.struct(*report.columns)).alias("text")).first()
    path = f"{folder}/{row['command']}-{nonce}.json"
    write_small(spark, path, row["text"])
    return path
