"""What a job hands back: per-dataset counts and the common failure rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stackroom.schemas import DATASET_SUMMARY, FAILURE


#: The phases of failures, by which reports are searched.
PHASES = (
    "enrich",
    "enrich_rowcount",
    "extract_index_read",
    "extract_write_output",
    "index_stage1",
    "validate_file_presence",
    "validate_file_size",
    "validate_manifest_url",
    "validate_parquet_rowcount",
    "verify_index_block",
    "verify_index_corpus",
    "verify_index_count",
    "verify_index_exists",
    "verify_index_path",
    "verify_index_schema",
)


@dataclass(frozen=True)
class Outcome:
    summary: DataFrame
    failures: DataFrame
    report_path: str | None = None  # where the run was asked to leave a report


def failure_rows(rows: DataFrame, **columns: Column | str) -> DataFrame:
    """Shape ``rows`` as failures; columns not given are null, plain text is literal."""
    picked = []
    for field in FAILURE.fields:
        value = columns.get(field.name)
        column = value if isinstance(value, Column) else F.lit(value)
        picked.append(column.cast("string").alias(field.name))
    return rows.select(*picked)


def failures_of(spark: SparkSession, entries: list[dict[str, str]]) -> DataFrame:
    """Failures the driver itself found, such as a missing index."""
    rows = [tuple(entry.get(name) for name in FAILURE.fieldNames()) for entry in entries]
    return spark.createDataFrame(rows, FAILURE)


def summary_of(spark: SparkSession, entries: list[dict]) -> DataFrame:
    rows = [
        (
            entry["dataset"],
            entry.get("items_scanned", 0),
            entry.get("succeeded", 0),
            entry.get("failed", 0),
            entry.get("skipped", 0),
        )
        for entry in entries
    ]
    return spark.createDataFrame(rows, DATASET_SUMMARY)


def dataset_summary(scanned: DataFrame, failures: DataFrame) -> DataFrame:
    """Per dataset: items scanned, skipped, failed, and succeeded as the rest, never below 0.

    ``scanned`` has one row per item with ``dataset`` and ``skipped`` (boolean).
    """
    items = scanned.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("items_scanned"), F.count_if("skipped").alias("skipped")
    )
    failed = failures.groupBy("dataset").agg(F.count(F.lit(1)).alias("failed"))
    counts = items.join(failed, "dataset", "left").withColumn(
        "failed", F.coalesce("failed", F.lit(0).cast("bigint"))
    )
    rest = F.col("items_scanned") - F.col("failed") - F.col("skipped")
    return counts.select(
        "dataset",
        "items_scanned",
        F.greatest(rest, F.lit(0).cast("bigint")).alias("succeeded"),
        "failed",
        "skipped",
    )
