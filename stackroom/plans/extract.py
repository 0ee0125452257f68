"""Records for a list of ids, through the id index."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stackroom.functions.ids import (
    IdScheme,
    dataset_of,
    full_form,
    id_block,
    short_form,
    unquoted,
)
from stackroom.operators.keyed import (
    BROADCAST_BYTES,
    fits_broadcast,
    measured_bytes,
    might_be_among,
    parts_for,
    semi_join,
)
from stackroom.plans.index import index_path
from stackroom.plans.outcome import Outcome, failures_of, summary_of
from stackroom.plans.recording import SILENT, RunLog, leaves_report
from stackroom.session import checkpointed
from stackroom.sinks.outputs import is_complete, output_path, whole_version, write_csv_if_any, write_parquet
from stackroom.sources.corpus import read_corpus
from stackroom.sources.idlist import read_id_list

# Beyond this the plan changes, not the result: the whole index is read.
MAX_BLOCKS = 1_000


@dataclass(frozen=True)
class Requests:
    accepted: DataFrame  # dataset, id (canonical), distinct
    unknown: DataFrame  # raw_id, normalized_id, reason


def split_requests(raw: DataFrame, scheme: IdScheme, only: str = "all") -> Requests:
    """Route each ``raw`` id to its dataset; what has none (or another) is unknown."""
    # Column by column, so the parsing of one is not repeated in the next. The last
    # step generates: a filter on its columns reads them, where Catalyst would copy
    # the parsing of projected ones into the filter and run it twice.
    routed = F.struct(
        "normalized",
        full_form(F.col("text"), scheme).alias("canonical"),
        dataset_of(F.col("normalized")).alias("dataset"),
    )
    ids = (
        raw.withColumn("text", unquoted(F.col("raw")))
        .withColumn("normalized", short_form(F.col("text"), scheme))
        .select("raw", F.inline(F.array(routed)))
    )
    # The two reasons.
    reason = F.when(F.col("dataset").isNull(), "unmapped id format/prefix")
    if only != "all":
        reason = reason.when(F.col("dataset") != only, f"filtered by --dataset={only}")
    ids = ids.withColumn("reason", reason)
    return Requests(
        ids.where("reason IS NULL").select("dataset", F.col("canonical").alias("id")).distinct(),
        ids.where("reason IS NOT NULL").select(
            F.col("raw").alias("raw_id"), F.col("normalized").alias("normalized_id"), "reason"
        ),
    )


def in_requested_blocks(index: DataFrame, requested: DataFrame) -> DataFrame:
    """Skip index row groups by ``id_block`` when the requests touch few blocks.

    The index was built by ``run_index`` with the same ``id_block``, which
    ``run_verify_index`` checks; an index without that column is read whole.
    """
    if "id_block" not in index.columns:
        return index
    blocks = requested.select(id_block(F.col("id")).alias("b")).distinct().limit(MAX_BLOCKS + 1)
    touched = [row["b"] for row in blocks.collect()]
    if len(touched) > MAX_BLOCKS:
        return index
    keep = F.col("id_block").isin([b for b in touched if b is not None])
    return index.where(keep | F.col("id_block").isNull() if None in touched else keep)


def lookup(index: DataFrame, requested: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """id, parquet_file, n_rows for the requested ids the index holds.

    Within the bound the requests are broadcast and the index does not move until it is
    counted. Beyond it a Bloom filter of the requests, of bounded size, goes to the index scan;
    what passes is counted per id and file, so that a heavy id is a row per file, and the counts
    meet the requests. What shuffles follows the requests and not the index. The requests are
    dealt to as many partitions as their bytes ask for, so a task's memory does not follow them.
    """
    keys = requested.select("id").distinct()
    rows = index.select("id", "parquet_file")
    counted = F.count(F.lit(1)).alias("n_rows")
    if fits_broadcast(keys, max_bytes):
        # Catalyst moves the semi-join below the count.
        return rows.join(F.broadcast(keys), "id", "left_semi").groupBy("id", "parquet_file").agg(counted)
    n_parts = parts_for(keys.sparkSession, measured_bytes(keys))
    keys = requested.select("id").repartition(n_parts, "id").distinct()
    found = might_be_among(rows, keys).groupBy("id", "parquet_file").agg(counted)
    # Not a semi-join: Catalyst would move that below the count and into each part of a union,
    # and every part would gather and sort all requests again.
    return found.join(keys.hint("merge"), "id").select("id", "parquet_file", "n_rows")


def matched_ids(hits: DataFrame) -> DataFrame:
    return hits.groupBy("id").agg(F.sum("n_rows").alias("n_rows"))


def missing_ids(accepted: DataFrame, matched: DataFrame) -> DataFrame:
    """dataset, id of the accepted requests that no index holds."""
    return accepted.join(matched.select("id"), "id", "left_anti").select("dataset", "id")


def extract_summary(accepted: DataFrame, matched: DataFrame) -> DataFrame:
    """Per dataset: ids requested, found (succeeded) and not found (skipped)."""
    found = accepted.join(matched.select("id", F.lit(1).alias("hit")), "id", "left")
    return found.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("items_scanned"),
        F.count("hit").alias("succeeded"),
        F.lit(0).cast("bigint").alias("failed"),
        F.count_if(F.col("hit").isNull()).alias("skipped"),
    )


def matching_rows(rows: DataFrame, matched: DataFrame) -> DataFrame:
    """Corpus rows, all columns, whose id is matched."""
    return semi_join(rows, matched, "id")


def _rows_of(spark: SparkSession, parquet_dir: str, hits: DataFrame) -> DataFrame:
    """Rows of the files the hits name; a file that is gone is an error.

    The driver collects the names. They are no more than the listing of the dataset that
    any scan of it makes the driver hold.
    """
    files = [row["parquet_file"] for row in hits.select("parquet_file").distinct().collect()]
    return read_corpus(spark, *[f"{parquet_dir}/{f}" for f in sorted(files)])


@dataclass(frozen=True)
class Extraction:
    outcome: Outcome
    outputs: dict[str, str]  # dataset -> path written
    unknown: DataFrame
    missing: DataFrame


@leaves_report("extract")
def run_extract(
    spark: SparkSession,
    parquet_dir: str,
    ids_csv: str,
    output: str,
    scheme: IdScheme,
    dataset: str = "all",
    side_outputs: str | None = None,
    log: RunLog = SILENT,
) -> Extraction:
    """Write ``<stem>_<dataset>.parquet`` per dataset with matches, overwriting it.

    A dataset without index fails and the others go on. With ``side_outputs`` the
    unknown and missing ids are written there as CSV.
    """
    requests = split_requests(read_id_list(spark, ids_csv, scheme), scheme, dataset)
    accepted = checkpointed(requests.accepted)
    # One row per dataset, a closed list of names.
    wanted = {row["dataset"]: row["count"] for row in accepted.groupBy("dataset").count().collect()}
    counts, failed, outputs = [], [], {}
    missing = [accepted.limit(0)]
    for name in sorted(wanted):
        target = index_path(parquet_dir, name)
        count = {"dataset": name, "items_scanned": wanted[name]}
        counts.append(count)
        log.start(name, wanted[name], wanted[name])
        if not is_complete(spark, target):
            count["failed"] = wanted[name]
            failed.append(
                {
                    "dataset": name,
                    "phase": "extract_index_read",
                    "source_path": target,
                    "error_message": "index file missing",
                    "suggested_recovery": f"index {name} first",
                }
            )
            continue
        requested = accepted.where(F.col("dataset") == name)
        try:
            index = in_requested_blocks(spark.read.parquet(whole_version(spark, target)), requested)
            hits = checkpointed(lookup(index, requested))
            matched = checkpointed(matched_ids(hits))
            n_matched = matched.count()
        except Exception as error:  # go on with the next dataset
            count["failed"] = wanted[name]
            failed.append(
                {
                    "dataset": name,
                    "phase": "extract_index_read",
                    "source_path": target,
                    "error_message": str(error),
                    "suggested_recovery": "build the index anew, then extract again",
                }
            )
            continue
        missing.append(missing_ids(requested, matched).select(*accepted.columns))
        count["skipped"] = wanted[name] - n_matched
        if n_matched == 0:
            continue
        path = output_path(output, name)
        try:
            rows = matching_rows(_rows_of(spark, parquet_dir, hits), matched)
            write_parquet(rows, path, overwrite=True)
            count["succeeded"], outputs[name] = n_matched, path
        except Exception as error:  # go on with the next dataset
            count["failed"] = n_matched
            failed.append(
                {
                    "dataset": name,
                    "phase": "extract_write_output",
                    "source_path": target,
                    "output_path": path,
                    "error_message": str(error),
                    "suggested_recovery": "check the corpus files and the index, then extract again",
                }
            )
    for count in counts:
        log.summary(count["dataset"], count["items_scanned"], count.get("succeeded", 0), count.get("failed", 0))
    all_missing = reduce(DataFrame.unionByName, missing).select("dataset", "id")
    if side_outputs is not None:
        write_csv_if_any(requests.unknown, f"{side_outputs}/extract-unknown-ids")
        write_csv_if_any(all_missing, f"{side_outputs}/extract-missing-ids")
    outcome = Outcome(summary_of(spark, counts), failures_of(spark, failed))
    return Extraction(outcome, outputs, requests.unknown, all_missing)
