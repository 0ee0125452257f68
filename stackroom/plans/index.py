"""The id index of a dataset: building and checking it."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stackroom.functions.ids import id_block
from stackroom.plans.outcome import Outcome, failure_rows, failures_of, summary_of
from stackroom.plans.recording import SILENT, RunLog, leaves_report
from stackroom.schemas import ID_INDEX
from stackroom.session import checkpointed
from stackroom.sinks.outputs import is_complete, recover, remove, swap, whole_version, write_parquet
from stackroom.sources.corpus import (
    INDEX_SUFFIX,
    LISTING_TASKS,
    dataset_folders,
    distinct_strings,
    file_inventory,
    file_row_counts,
    read_corpus,
    unreadable_files,
    with_file_position,
)

ROWS_PER_RANGE = 4_000_000

_REBUILD = "build the index anew, with overwrite"


def index_path(parquet_dir: str, dataset: str) -> str:
    return f"{parquet_dir}/{dataset}{INDEX_SUFFIX}"


def index_rows(rows: DataFrame, root: str, record_id: Column | None = None) -> DataFrame:
    """id, id_block, parquet_file, file_row_number for every scanned row."""
    key = F.col("id") if record_id is None else record_id
    return with_file_position(rows, root).select(
        key.alias("id"), id_block(key).alias("id_block"), "parquet_file", "file_row_number"
    )


def in_id_order(index: DataFrame, n_rows: int | None = None) -> DataFrame:
    """Range-partition the index by id, so row-group statistics prune lookups.

    File and row number take part in the ranges: they split an id that very many
    rows share. With ``n_rows`` a range has about ``ROWS_PER_RANGE``, whatever the session's
    number of shuffle partitions.
    """
    order = ["id", "parquet_file", "file_row_number"]
    ranges = [] if n_rows is None else [max(1, -(-n_rows // ROWS_PER_RANGE))]
    return index.repartitionByRange(*ranges, *order).sortWithinPartitions(*order)


def _sound_files(spark: SparkSession, parquet_dir: str, name: str) -> tuple[DataFrame, int, dict[str, str]]:
    """A footer pass over a dataset: ``rel_path, n_rows`` of the files that hold rows, the number
    of all files, and the errors of those that cannot be read."""
    files = checkpointed(file_inventory(spark, parquet_dir, name).select("rel_path").coalesce(LISTING_TASKS))
    if files.isEmpty():
        return files.selectExpr("rel_path", "0L AS n_rows"), 0, {}
    counts = checkpointed(file_row_counts(spark, parquet_dir, name, skip_damaged=True))
    without = files.join(counts, "rel_path", "left_anti").orderBy("rel_path")
    broken = unreadable_files(spark, parquet_dir, [row["rel_path"] for row in without.collect()])
    return counts, files.count(), broken


def _short_files(index: DataFrame, counts: DataFrame) -> dict[str, str]:
    """Files of which the index holds fewer rows than their footers promise."""
    indexed = index.groupBy(F.col("parquet_file").alias("rel_path")).agg(F.count(F.lit(1)).alias("n_indexed"))
    n_indexed = F.coalesce("n_indexed", F.lit(0))
    short = counts.join(indexed, "rel_path", "left").where(n_indexed < F.col("n_rows"))
    found = short.select("rel_path", "n_rows", n_indexed.alias("n_indexed")).collect()
    return {row["rel_path"]: f"{row['n_indexed']} of {row['n_rows']} rows can be read" for row in found}


def _write_index(spark: SparkSession, parquet_dir: str, name: str, counts: DataFrame) -> dict[str, str]:
    """Write the index of the files in ``counts``, and the errors of those that turn out damaged.

    What can be read is written beside the old index and counted per file. If a file falls short
    of its footer, its rows are left out in a second write; the index holds whole files only.
    """
    target = index_path(parquet_dir, name)
    # The names of the files, as any scan of the folder makes the driver hold them.
    names = [row["rel_path"] for row in counts.orderBy("rel_path").collect()]
    n_rows = counts.agg(F.sum("n_rows").alias("n")).first()["n"] or 0
    if names:
        rows = read_corpus(spark, *[f"{parquet_dir}/{n}" for n in names], merge_schema=False, skip_damaged=True)
        index = index_rows(rows, parquet_dir)
    else:
        index = spark.createDataFrame([], ID_INDEX)
    draft = f"{parquet_dir}/.draft-{uuid.uuid4().hex}"
    try:
        write_parquet(in_id_order(index, n_rows), draft)
        written = spark.read.parquet(draft)
        short = _short_files(written, counts)
        if short and len(short) == len(names):
            return short  # nothing to publish: an old index stays
        if short:
            gone = spark.createDataFrame([(n,) for n in short], "parquet_file string")
            whole = written.join(F.broadcast(gone), "parquet_file", "left_anti").select(*written.columns)
            write_parquet(in_id_order(whole, n_rows), target, overwrite=True)
        else:
            swap(spark, draft, target)
    finally:
        remove(spark, draft)
    return short


@leaves_report("index")
def run_index(
    spark: SparkSession, parquet_dir: str, dataset: str = "all", overwrite: bool = False, log: RunLog = SILENT
) -> Outcome:
    """Write ``<dataset>_id_idx.parquet``; an index that exists is left unless ``overwrite``.

    A file that cannot be read is a failure, and the others are indexed without it. A dataset
    folder without files is passed over.
    """
    names = dataset_folders(spark, parquet_dir) if dataset == "all" else [dataset]
    counts, failed = [], []
    for name in names:
        target = index_path(parquet_dir, name)
        entry = {"dataset": name, "phase": "index_stage1", "output_path": target}
        recovery = "get the damaged file anew, then build the index again"
        recover(spark, target)
        if not overwrite and is_complete(spark, target):
            counts.append({"dataset": name, "skipped": 1})
            log.idle(name, 1, "indexed")
            continue
        sound, n_files, broken = _sound_files(spark, parquet_dir, name)
        if not n_files:
            continue
        log.start(name, n_files, n_files)
        count = {"dataset": name, "items_scanned": n_files}
        try:
            if len(broken) < n_files:  # else an old index stays
                broken |= _write_index(spark, parquet_dir, name, sound)
            count |= {"succeeded": n_files - len(broken), "failed": len(broken)}
            failed += [
                entry | {"rel_path": n, "source_path": f"{parquet_dir}/{n}", "error_message": e, "suggested_recovery": recovery}
                for n, e in sorted(broken.items())
            ]
            log.item(name, "indexed", f"files={n_files - len(broken)}")
        except Exception as error:  # the next dataset is still to be indexed
            count |= {"succeeded": 0, "failed": n_files}
            failed.append(entry | {"source_path": f"{parquet_dir}/{name}", "error_message": str(error), "suggested_recovery": recovery})
        log.summary(name, n_files, count["succeeded"], count["failed"])
        counts.append(count)
    if not counts:
        raise FileNotFoundError(f"no parquet files in {parquet_dir}/{'' if dataset == 'all' else dataset}")
    return Outcome(summary_of(spark, counts), failures_of(spark, failed))


def count_mismatch(index: DataFrame, corpus: DataFrame) -> DataFrame:
    """One row (index_rows, corpus_rows) when the totals differ, none when they agree."""
    n = F.count(F.lit(1))
    sides = index.agg(n.alias("n")).select(F.lit("index").alias("side"), "n").unionByName(
        corpus.agg(n.alias("n")).select(F.lit("corpus").alias("side"), "n")
    )
    totals = sides.agg(
        F.max(F.when(F.col("side") == "index", F.col("n"))).alias("index_rows"),
        F.max(F.when(F.col("side") == "corpus", F.col("n"))).alias("corpus_rows"),
    )
    return totals.where("index_rows <> corpus_rows")


def dangling_files(index: DataFrame, inventory: DataFrame) -> DataFrame:
    """Files the index names that are not there. Distinct first: one row per file."""
    named = distinct_strings(index, "parquet_file").withColumnRenamed("parquet_file", "rel_path")
    return named.join(inventory.select("rel_path"), "rel_path", "left_anti")


def count_failures(
    index: DataFrame, corpus: DataFrame, dataset: str, target: str, corpus_dir: str
) -> DataFrame:
    return failure_rows(
        count_mismatch(index, corpus),
        dataset=dataset,
        phase="verify_index_count",
        source_path=target,
        output_path=corpus_dir,
        error_message=F.format_string(
            "the index holds %d rows, the corpus %d", "index_rows", "corpus_rows"
        ),
        suggested_recovery=_REBUILD,
    )


def path_failures(
    index: DataFrame, inventory: DataFrame, dataset: str, target: str, parquet_dir: str
) -> DataFrame:
    return failure_rows(
        dangling_files(index, inventory),
        dataset=dataset,
        phase="verify_index_path",
        rel_path=F.col("rel_path"),
        source_path=target,
        output_path=F.concat(F.lit(f"{parquet_dir}/"), F.col("rel_path")),
        error_message="index references missing parquet file",
        suggested_recovery=_REBUILD,
    )


def block_failures(index: DataFrame, dataset: str, target: str) -> DataFrame:
    """One failure when lookups by block would miss ids: blocks that are not those of the ids."""
    wrong = index.where(~F.col("id_block").eqNullSafe(id_block(F.col("id")))).agg(F.count(F.lit(1)).alias("n"))
    return failure_rows(
        wrong.where("n > 0"),
        dataset=dataset,
        phase="verify_index_block",
        source_path=target,
        error_message=F.format_string("%d rows with the wrong id_block", "n"),
        suggested_recovery=_REBUILD,
    )


def _verify_one(spark: SparkSession, parquet_dir: str, dataset: str) -> DataFrame:
    """The checks in order; each runs only while none before it failed."""
    target, corpus_dir = index_path(parquet_dir, dataset), f"{parquet_dir}/{dataset}"
    entry = {"dataset": dataset, "source_path": target}
    found = []
    index = None
    if not is_complete(spark, target):
        found.append(
            entry
            | {
                "phase": "verify_index_exists",
                "error_message": "index file missing",
                "suggested_recovery": "build the index first",
            }
        )
    else:
        try:
            index = spark.read.parquet(whole_version(spark, target))
            columns = index.columns
        except AnalysisException as error:
            columns = []
            found.append(
                entry
                | {
                    "phase": "verify_index_schema",
                    "error_message": str(error),
                    "suggested_recovery": _REBUILD,
                }
            )
        for name in ID_INDEX.fieldNames():
            if columns and name not in columns:
                found.append(
                    entry
                    | {
                        "phase": "verify_index_schema",
                        "error_message": f"required column missing: {name}",
                        "suggested_recovery": _REBUILD,
                    }
                )
    inventory = file_inventory(spark, parquet_dir, dataset)
    if inventory.isEmpty():
        found.append(
            {
                "dataset": dataset,
                "phase": "verify_index_corpus",
                "source_path": corpus_dir,
                "error_message": "no parquet files found in corpus",
            }
        )
    if found:
        return failures_of(spark, found)
    corpus = read_corpus(spark, corpus_dir, merge_schema=False)
    counted = checkpointed(count_failures(index, corpus, dataset, target, corpus_dir))
    if not counted.isEmpty():
        return counted
    paths = path_failures(index, inventory, dataset, target, parquet_dir)
    return checkpointed(paths.unionByName(block_failures(index, dataset, target)))


@leaves_report("verify_index")
def run_verify_index(
    spark: SparkSession, parquet_dir: str, dataset: str = "all", log: RunLog = SILENT
) -> Outcome:
    """Check the index of each dataset folder, also of those without a single file."""
    names = dataset_folders(spark, parquet_dir) if dataset == "all" else [dataset]
    if not names:
        raise FileNotFoundError(f"no dataset folders in {parquet_dir}")
    counts, found = [], []
    for name in names:
        log.start(name, 1, 1)
        failures = _verify_one(spark, parquet_dir, name)
        n_failed = failures.count()
        found.append(failures)
        log.item(name, "verified", name)
        log.summary(name, 1, int(n_failed == 0), n_failed)
        counts.append(
            {
                "dataset": name,
                "items_scanned": 1,
                "succeeded": int(n_failed == 0),
                "failed": n_failed,
            }
        )
    return Outcome(summary_of(spark, counts), reduce(DataFrame.unionByName, found))
