"""Works with abstract and citation, rebuilt where the source is newer."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stackroom.functions.abstracts import abstract_from_json
from stackroom.functions.citations import citation
from stackroom.functions.paths import RAW_WORKS, WORKS, scanned_file
from stackroom.plans.outcome import Outcome, dataset_summary, failure_rows, failures_of
from stackroom.plans.recording import SILENT, RunLog, leaves_report
from stackroom.session import checkpointed
from stackroom.sinks.outputs import STAGED_KEY, publish_partition, recover_below, remove, stage_partitions, staged_value
from stackroom.sources.corpus import (
    LISTING_TASKS,
    decoded_row_counts,
    file_inventory,
    file_row_counts,
    path_exists,
    read_corpus,
    unreadable_files,
)

PARTITION = "updated_date"
_NO_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def enrich(raw: DataFrame) -> DataFrame:
    """All columns of ``raw`` plus the derived columns its columns allow."""
    derived = {}
    if "abstract_inverted_index" in raw.columns:
        derived["abstract"] = abstract_from_json(F.col("abstract_inverted_index"))
    if {"authorships", "publication_year"} <= set(raw.columns):
        derived["citation"] = citation(F.col("authorships"), F.col("publication_year"))
    if not derived:
        raise ValueError(
            "source works have neither abstract_inverted_index nor authorships and publication_year"
        )
    return raw.withColumns(derived)


def stale(source: DataFrame, output: DataFrame, key: str = "rel_path") -> DataFrame:
    """Source entries (``key``, ``modified``) whose output is absent or older.

    An unknown time counts as fresh.
    """
    made = output.select(key, F.col("modified").alias("made"), F.lit(True).alias("present"))
    return (
        source.join(made, key, "left")
        .where(F.col("present").isNull() | (F.col("made") < F.col("modified")))
        .drop("made", "present")
    )


def partition_of(rel_path: Column) -> Column:
    """Value of the partition folder in a path, empty when there is none."""
    value = F.regexp_extract(rel_path, rf"(?:\A|/){PARTITION}=([^/]*)/", 1)
    return F.when(value == _NO_PARTITION, "").otherwise(value)


def stale_partitions(source: DataFrame, output: DataFrame) -> DataFrame:
    """Partitions to rebuild: the newest source file against the oldest output file."""
    key = partition_of(F.col("rel_path")).alias(PARTITION)
    wanted = source.groupBy(key).agg(F.max("modified").alias("modified"))
    made = output.groupBy(key).agg(F.min("modified").alias("modified"))
    return stale(wanted, made, PARTITION)


def row_parity(source: DataFrame, output: DataFrame, key: str) -> DataFrame:
    """Full outer comparison of two row counts (``key``, ``n_rows``)."""
    zero = F.lit(0).cast("bigint")
    both = source.select(key, F.col("n_rows").alias("source_rows")).join(
        output.select(key, F.col("n_rows").alias("output_rows")), key, "full_outer"
    )
    return both.select(
        key,
        F.coalesce("source_rows", zero).alias("source_rows"),
        F.coalesce("output_rows", zero).alias("output_rows"),
    )


def _per_partition(counts: DataFrame) -> DataFrame:
    key = partition_of(F.col("rel_path")).alias(PARTITION)
    return counts.groupBy(key).agg(F.sum("n_rows").alias("n_rows"))


def _unreadable(spark: SparkSession, root: str, files: DataFrame, counts: DataFrame) -> dict[str, str]:
    """Errors of files that have no rows because they cannot be read: a footer that cannot be
    read and a file without rows look alike in the counts."""
    without = files.join(counts, "rel_path", "left_anti").select("rel_path").orderBy("rel_path")
    return unreadable_files(spark, root, [row["rel_path"] for row in without.collect()])


@leaves_report("enrich")
def run_enrich(
    spark: SparkSession, parquet_dir: str, overwrite: bool = False, log: RunLog = SILENT
) -> Outcome:
    """Enrich raw works below ``parquet_dir``, partition by partition.

    No shuffle: each task writes the rows of the files it read, to a staging folder whose
    key is no column of the data. A partition is rebuilt whole when one of its files is
    newer than its output, and published when it has as many rows as its source; else what
    was there before stays, and the next run takes it up again.
    """
    source_dir, output_dir = f"{parquet_dir}/{RAW_WORKS}", f"{parquet_dir}/{WORKS}"
    source = checkpointed(file_inventory(spark, source_dir).coalesce(LISTING_TASKS))
    if source.isEmpty():
        raise FileNotFoundError(f"no parquet files under {source_dir}: nothing to enrich")
    recover_below(spark, output_dir)
    by_partition = source.withColumn(PARTITION, partition_of(F.col("rel_path")))
    todo = (
        by_partition.select(PARTITION).distinct()
        if overwrite
        else stale_partitions(source, file_inventory(spark, output_dir)).select(PARTITION)
    )
    todo = checkpointed(todo)
    # One name per partition folder: as many as the listing the driver holds anyway.
    names = [row[PARTITION] for row in todo.collect()]
    scanned = by_partition.join(todo.withColumn("redone", F.lit(True)), PARTITION, "left").select(
        F.lit(WORKS).alias("dataset"), F.col("redone").isNull().alias("skipped")
    )
    n_files = scanned.count()
    if not names:
        log.idle(WORKS, n_files, "converted")
        none = failures_of(spark, [])
        return Outcome(checkpointed(dataset_summary(scanned, none)), none)
    # Files outside any partition folder lie at the root, so the root is read then.
    folders = [] if "" in names else [f"{PARTITION}={name}" for name in names]
    counts = checkpointed(file_row_counts(spark, source_dir, *folders, skip_damaged=True))
    files = by_partition.join(todo, PARTITION, "left_semi")
    log.start(WORKS, n_files, len(names))
    broken = _unreadable(spark, source_dir, files, counts)
    staged = f"{output_dir}/_staged-{uuid.uuid4().hex}"
    try:
        if not counts.isEmpty():
            raw = read_corpus(spark, *[f"{source_dir}/{folder}" for folder in folders or [""]], skip_damaged=True)
            value = partition_of(scanned_file(source_dir))
            stage_partitions(enrich(raw).where(value.isin(names)), staged, value)
        made = file_row_counts(spark, staged, skip_damaged=True) if path_exists(spark, staged) else counts.limit(0)
        key = staged_value(F.regexp_extract("rel_path", rf"(?:\A|/){STAGED_KEY}=([^/]*)/", 1)).alias(PARTITION)
        made = made.groupBy(key).agg(F.sum("n_rows").alias("n_rows"))
        both = row_parity(_per_partition(counts), made, PARTITION)
        both = checkpointed(both.join(todo, PARTITION, "left_semi"))
        unequal = both.where("source_rows <> output_rows")
        short = _cut_short(spark, source_dir, unequal, counts)
        held = {row[PARTITION] for row in unequal.select(PARTITION).collect()}
        held |= {row[PARTITION] for row in files.where(F.col("rel_path").isin(list(broken))).select(PARTITION).collect()}
        for row in both.where("output_rows > 0").select(PARTITION).collect():
            if row[PARTITION] not in held:
                publish_partition(spark, staged, output_dir, PARTITION, row[PARTITION])
                log.item(WORKS, "converted", f"{PARTITION}={row[PARTITION]}")
    finally:
        remove(spark, staged)
    damaged = spark.createDataFrame([*broken.items(), *short.items()], "rel_path string, error string")
    place = F.concat(F.lit(f"{source_dir}/"), F.col("rel_path"))
    target = F.concat(F.lit(f"{output_dir}/{PARTITION}="), F.col(PARTITION))
    of_files = failure_rows(
        files.join(damaged, "rel_path"),
        dataset=WORKS,
        phase="enrich",
        rel_path=F.col("rel_path"),
        source_path=place,
        output_path=target,
        error_message=F.col("error"),
        suggested_recovery="get the file anew, then enrich again",
    )
    with_damage = files.join(damaged, "rel_path", "left_semi").select(PARTITION).distinct()
    of_partitions = failure_rows(
        # One failure per source file of a partition that lost rows for no reason a file gives.
        files.join(unequal.join(with_damage, PARTITION, "left_anti"), PARTITION),
        dataset=WORKS,
        phase="enrich_rowcount",
        rel_path=F.col("rel_path"),
        source_path=place,
        output_path=target,
        error_message=F.format_string("%d rows in the source, %d enriched", "source_rows", "output_rows"),
        suggested_recovery="enrich again",
    )
    failures = checkpointed(of_files.unionByName(of_partitions))
    kept_back = files.where(F.col(PARTITION).isin(list(held))).select(F.lit(WORKS).alias("dataset"))
    summary = checkpointed(dataset_summary(scanned, kept_back))
    for row in summary.collect():
        log.summary(row["dataset"], row["items_scanned"], row["succeeded"], row["failed"])
    return Outcome(summary, failures)


def _cut_short(spark: SparkSession, root: str, unequal: DataFrame, counts: DataFrame) -> dict[str, str]:
    """Files of unequal partitions that end before the rows their footers promise."""
    names = [row[PARTITION] for row in unequal.select(PARTITION).collect()]
    if not names:
        return {}
    folders = [] if "" in names else [f"{PARTITION}={name}" for name in names]
    decoded = decoded_row_counts(spark, root, *folders).withColumnRenamed("n_rows", "n_decoded")
    promised = counts.where(partition_of(F.col("rel_path")).isin(names))
    short = promised.join(decoded, "rel_path", "left").where(
        F.col("n_decoded").isNull() | (F.col("n_decoded") < F.col("n_rows")) | F.col("content_hash").isNull()
    )
    found = short.select("rel_path", "n_rows", F.coalesce("n_decoded", F.lit(0)).alias("n_decoded")).collect()
    return {r["rel_path"]: f"{r['n_decoded']} of {r['n_rows']} rows can be read" for r in found}
