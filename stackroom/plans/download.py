"""Manifest against local files, and what a download needs."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stackroom.functions.paths import dataset_in, manifest_url_to_local
from stackroom.functions.runs import whole_gib, with_headroom
from stackroom.plans.outcome import Outcome, dataset_summary, failure_rows
from stackroom.plans.recording import SILENT, RunLog, leaves_report
from stackroom.session import checkpointed
from stackroom.sources.corpus import LISTING_TASKS, decoded_row_counts, file_inventory, file_row_counts
from stackroom.sources.manifest import manifest_entities, manifest_files, read_manifest

DOWNLOAD_TENTHS = 11


def plan_download(entities: DataFrame, files: DataFrame, whole: DataFrame | None = None) -> DataFrame:
    """Per dataset: files, rows, bytes, and the space to have (10 % above the bytes).

    With ``whole``, one row that holds the manifest's own ``content_length``, a line ``all`` comes
    beside the datasets: files and rows are their sums, from the same aggregate, and the bytes
    are what the manifest says of itself.
    """
    measures = [F.count(F.lit(1)).alias("n_files"), F.sum("record_count").alias("record_count")]
    sizes = entities.groupBy("dataset").agg(F.sum("content_length").alias("content_length"))
    if whole is None:
        rows = files.groupBy("dataset").agg(*measures)
    else:
        in_sum = F.grouping_id() == 1
        rows = files.rollup("dataset").agg(*measures, in_sum.alias("is_sum"))
        rows = rows.select(F.when(F.col("is_sum"), "all").otherwise(F.col("dataset")).alias("dataset"), "n_files", "record_count")
        sizes = sizes.unionByName(whole.select(F.lit("all").alias("dataset"), F.col("content_length").cast("bigint").alias("content_length")))
    required = with_headroom(F.col("content_length"), DOWNLOAD_TENTHS)
    zero = F.lit(0).cast("bigint")
    return sizes.join(rows, "dataset", "left").select(
        "dataset",
        F.coalesce("n_files", zero).alias("n_files"),
        F.coalesce("record_count", zero).alias("record_count"),
        "content_length",
        required.alias("required_bytes"),
        whole_gib(required).alias("required_gib"),
    )


def check_files(files: DataFrame, inventory: DataFrame, counts: DataFrame | None) -> DataFrame:
    """Each manifest file with the first check it fails (``phase``), null if none.

    Order: URL, presence, size, rows. ``counts`` (rel_path, n_rows and perhaps
    content_hash) is None when rows are not checked. A file that holds rows by the
    manifest but has no count could not be read.
    """
    checked = files.withColumn("rel_path", manifest_url_to_local(F.col("url"))).join(
        inventory.select("rel_path", "length"), "rel_path", "left"
    )
    url_ok, present = F.col("rel_path").isNotNull(), F.col("length").isNotNull()
    size_ok = F.col("length") == F.col("content_length")
    failed = (
        F.when(~url_ok, "validate_manifest_url")
        .when(~present, "validate_file_presence")
        .when(~size_ok, "validate_file_size")
    )
    message = (
        F.when(~url_ok, "the manifest url names no local file")
        .when(~present, "no such local file")
        .when(
            ~size_ok,
            F.format_string("%d bytes, the manifest says %d", "length", "content_length"),
        )
    )
    if counts is not None:
        checked = checked.join(counts, "rel_path", "left")
        n = F.coalesce("n_rows", F.lit(0).cast("bigint"))
        rows_ok = n == F.col("record_count")
        if "content_hash" in counts.columns:
            rows_ok = rows_ok & (F.col("content_hash").isNotNull() | (F.col("record_count") == 0))
        failed = failed.when(~rows_ok, "validate_parquet_rowcount")
        message = message.when(
            ~rows_ok, F.format_string("%d rows, the manifest says %d", n, "record_count")
        )
    return checked.withColumns({"phase": failed, "error_message": message})


def file_failures(checked: DataFrame, root: str = "") -> DataFrame:
    bad = checked.where(F.col("phase").isNotNull())
    phase = F.col("phase")
    recovery = (
        F.when(phase == "validate_parquet_rowcount", "get this file anew")
        .when(phase != "validate_manifest_url", "get the dataset's files anew")
    )
    return failure_rows(
        bad,
        dataset=F.col("dataset"),
        phase=phase,
        rel_path=F.col("rel_path"),
        source_path=F.when(phase != "validate_parquet_rowcount", F.col("url")),
        output_path=F.concat(F.lit(root), F.col("rel_path")),
        error_message=F.col("error_message"),
        suggested_recovery=recovery,
    )


def extra_failures(files: DataFrame, inventory: DataFrame, root: str = "") -> DataFrame:
    """Local files in the folders of the manifest's datasets that it does not list."""
    expected = files.withColumn("rel_path", manifest_url_to_local(F.col("url"))).where(
        F.col("rel_path").isNotNull()
    )
    folder = F.substring_index("rel_path", "/", 1)
    local = inventory.select("rel_path", dataset_in(folder).alias("dataset"))
    # Paths are unique, so the large join has no heavy key; what remains is then
    # held against the few datasets.
    extra = local.join(expected.select("dataset", "rel_path"), ["dataset", "rel_path"], "left_anti").join(
        expected.select("dataset").distinct(), "dataset", "left_semi"
    )
    return failure_rows(
        extra,
        dataset=F.col("dataset"),
        phase="validate_file_presence",
        rel_path=F.col("rel_path"),
        output_path=F.concat(F.lit(root), F.col("rel_path")),
        error_message="the manifest does not list this file",
        suggested_recovery="remove the file",
    )


def verify_files(
    files: DataFrame,
    inventory: DataFrame,
    counts: DataFrame | None = None,
    check_extra: bool = False,
    root: str = "",
) -> DataFrame:
    """All failures of a manifest check."""
    failures = file_failures(check_files(files, inventory, counts), root)
    if check_extra:
        failures = failures.unionByName(extra_failures(files, inventory, root))
    return failures


def summarize_files(entities: DataFrame, files: DataFrame, failures: DataFrame) -> DataFrame:
    """Per dataset counts; a dataset without files is listed with zeros."""
    scanned = files.select("dataset", F.lit(False).alias("skipped"))
    counted = dataset_summary(scanned, failures)
    zero = F.lit(0).cast("bigint")
    names = entities.select("dataset").distinct()
    return names.join(counted, "dataset", "left").select(
        "dataset",
        *[F.coalesce(c, zero).alias(c) for c in ("items_scanned", "succeeded", "failed", "skipped")],
    )


@leaves_report("verify_download")
def run_verify_download(
    spark: SparkSession,
    manifest_path: str,
    parquet_dir: str,
    dataset: str = "all",
    mode: str = "meta",
    check_extra: bool = False,
    log: RunLog = SILENT,  # leaves no log: its report says it all
) -> Outcome:
    """Check the local files: ``quick`` presence and size, ``meta`` also the row counts
    of the footers, ``full`` also decodes every column."""
    if mode not in ("quick", "meta", "full"):
        raise ValueError(f"unknown mode {mode}")
    entities = manifest_entities(read_manifest(spark, manifest_path), dataset)
    if entities.isEmpty():
        raise ValueError(f"dataset '{dataset}' not found in manifest")
    files = checkpointed(manifest_files(entities))
    inventory = checkpointed(file_inventory(spark, parquet_dir).coalesce(LISTING_TASKS))
    counts = None
    if mode != "quick" and not inventory.isEmpty():
        counts = _row_counts(spark, parquet_dir, files, inventory, mode == "full")
    failures = verify_files(files, inventory, counts, check_extra, f"{parquet_dir.rstrip('/')}/")
    failures = checkpointed(failures)
    return Outcome(summarize_files(entities, files, failures), failures)


def _row_counts(
    spark: SparkSession, parquet_dir: str, files: DataFrame, inventory: DataFrame, full: bool
) -> DataFrame | None:
    """Counts of the files that passed presence and size, each folder with its own schema.

    The driver collects the names, as any scan of the files makes it hold them.
    """
    wanted = files.select(manifest_url_to_local(F.col("url")).alias("rel_path"), "content_length")
    sound = wanted.join(inventory, "rel_path").where("length = content_length").select("rel_path").distinct()
    paths: dict[str, list[str]] = {}
    for row in sound.orderBy("rel_path").collect():
        paths.setdefault(row["rel_path"].partition("/")[0], []).append(row["rel_path"])
    read = decoded_row_counts if full else partial(file_row_counts, skip_damaged=True)
    counts = None
    for names in paths.values():
        one = read(spark, parquet_dir, *names)
        counts = one if counts is None else counts.unionByName(one)
    return counts
