"""The published manifest: files with their exact size and row count."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stackroom.schemas import MANIFEST


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per manifest document; unknown keys are ignored, bad JSON is an error."""
    manifest = (
        spark.read.schema(MANIFEST).option("multiLine", "true").option("mode", "FAILFAST").json(path)
    )
    entities = F.when(
        F.col("meta").isNotNull() & F.col("entities").isNotNull(), F.col("entities")
    ).otherwise(F.raise_error(F.lit("not a manifest: meta or entities missing")))
    return manifest.withColumn("entities", entities)


def manifest_entities(manifest: DataFrame, dataset: str = "all") -> DataFrame:
    """One row per entity: dataset, content_length, files."""
    entities = manifest.select(F.inline("entities")).withColumnRenamed("entity", "dataset")
    return entities if dataset == "all" else entities.where(F.col("dataset") == dataset)


def manifest_total(manifest: DataFrame) -> DataFrame:
    """One row: the record_count and content_length that the manifest states for the whole."""
    return manifest.select("meta.record_count", "meta.content_length")


def manifest_files(entities: DataFrame) -> DataFrame:
    """One row per file: dataset, url, content_length, record_count."""
    return entities.select("dataset", F.inline("files")).select(
        "dataset", "url", "meta.content_length", "meta.record_count"
    )
