"""How far a run has come, from its logs and reports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stackroom.functions.runs import canonical_command, format_duration, parse_counter
from stackroom.operators.ranking import last_lines
from stackroom.plans.reports import for_dataset, report_stamp
from stackroom.session import checkpointed
from stackroom.sources.runs import log_times, read_logs, read_reports, run_datasets

RECENT_SECONDS = 300

# What the log lines of a finished item and of an idle run say.
_ITEM_DONE = (" converted ", " indexed ", " verified ")
_ALL_DONE = (
    "all files already converted",
    "all files already indexed",
    "all files already verified",
)


def _says_any(line: Column, phrases: tuple[str, ...]) -> Column:
    said = line.contains(phrases[0])
    for phrase in phrases[1:]:
        said = said | line.contains(phrase)
    return said


def _marks(lines: DataFrame) -> DataFrame:
    """What each log line tells."""
    line = F.col("value")
    is_summary = line.contains(" summary ")
    scanned = parse_counter(line, "source_files")
    return lines.withColumns(
        {
            "is_summary": is_summary,
            "all_done": _says_any(line, _ALL_DONE),
            "item_done": _says_any(line, _ITEM_DONE),
            "scanned_mark": F.coalesce(F.when(is_summary, parse_counter(line, "scanned")), scanned),
            "todo_mark": parse_counter(line, "todo_files"),
            "ok_mark": F.when(is_summary, parse_counter(line, "ok")),
            "failed_mark": F.when(is_summary, parse_counter(line, "failed")),
        }
    )


def _last(mark: str, order: str) -> Column:
    """Last value of a mark: an aggregate, combined map-side."""
    return F.max_by(F.col(mark), F.when(F.col(mark).isNotNull(), F.col(order)))


_MARKS = ("scanned", "todo", "ok", "failed")


def _block_states(lines: DataFrame) -> DataFrame:
    """What each block of a log tells by itself.

    A block is read by one task, so it is folded before anything moves. ``at_idle`` is what was
    scanned as of the block's last line that says all files are done, null if no line before it
    in the block told.
    """
    told = F.struct("row", F.col("scanned_mark").alias("scanned"), F.col("all_done").alias("idle"))
    states = _marks(lines).groupBy("dataset", "block").agg(
        *[_last(f"{mark}_mark", "row").alias(mark) for mark in _MARKS],
        F.count_if("item_done").alias("converted"),
        F.bool_or(F.col("is_summary") | F.col("all_done")).alias("done"),
        F.bool_or("all_done").alias("idle"),
        F.coalesce(F.bool_or(F.col("failed_mark") > 0), F.lit(False)).alias("errored"),
        F.max_by("value", "row").alias("last_log"),
        F.collect_list(F.when(F.col("scanned_mark").isNotNull() | F.col("all_done"), told)).alias("told"),
    )
    nothing = F.lit(None).cast("bigint")

    def told_next(state: Column, line: Column) -> Column:
        scanned = F.coalesce(line["scanned"], state["scanned"])
        at_idle = F.when(line["idle"], scanned).otherwise(state["at_idle"])
        return F.struct(scanned.alias("scanned"), at_idle.alias("at_idle"))

    start = F.struct(nothing.alias("scanned"), nothing.alias("at_idle"))
    at_idle = F.aggregate(F.array_sort("told"), start, told_next)["at_idle"]
    return states.withColumn("at_idle", at_idle).drop("told")


def dataset_status(lines: DataFrame) -> DataFrame:
    """Per dataset: status, counts and last log line (dataset, block, row, value -> one row).

    One scan: lines become a state per block, and states merge in the order of blocks, one row
    for each block of a log (128 MB of it, say). No line is ever sorted or gathered.
    """
    zero = F.lit(0).cast("bigint")
    part = F.struct("block", "scanned", "idle", "at_idle")
    merged = _block_states(lines).groupBy("dataset").agg(
        *[F.coalesce(_last(mark, "block"), zero).alias(mark) for mark in _MARKS],
        F.sum("converted").alias("converted"),
        F.bool_or("done").alias("done"),
        F.bool_or("errored").alias("errored"),
        F.max_by("last_log", "block").alias("last_log"),
        F.array_sort(F.collect_list(part)).alias("blocks"),
    )

    def block_next(state: Column, block: Column) -> Column:
        scanned = F.coalesce(block["scanned"], state["scanned"])
        skipped = F.when(block["idle"], F.coalesce(block["at_idle"], state["scanned"])).otherwise(state["skipped"])
        return F.struct(scanned.alias("scanned"), skipped.alias("skipped"))

    # Skipped is what was scanned as of the last "all files already" line.
    start = F.struct(zero.alias("scanned"), zero.alias("skipped"))
    skipped = F.aggregate("blocks", start, block_next)["skipped"]
    status = (
        F.when(F.col("errored"), "error")
        .when(F.col("done"), "done")
        .when((F.col("scanned") > 0) | (F.col("converted") > 0), "in-progress")
        .otherwise("pending")
    )
    return merged.select(
        "dataset",
        status.alias("status"),
        "scanned",
        "todo",
        "converted",
        "ok",
        "failed",
        skipped.alias("skipped"),
        "last_log",
    )


def with_pending(datasets: DataFrame, status: DataFrame) -> DataFrame:
    """Add the datasets that have no log yet."""
    zero = F.lit(0).cast("bigint")
    counts = ("scanned", "todo", "converted", "ok", "failed", "skipped")
    return datasets.join(status, "dataset", "left").select(
        "dataset",
        F.coalesce("status", F.lit("pending")).alias("status"),
        *[F.coalesce(c, zero).alias(c) for c in counts],
        F.coalesce("last_log", F.lit("")).alias("last_log"),
    )


def _eta(todo: Column, converted: Column, runtime: Column) -> Column:
    left = F.greatest(todo - converted, F.lit(0)).cast("double")
    known = (todo > 0) & (converted > 0) & (runtime > 0)
    return F.when(known, left / (converted.cast("double") / runtime))


def with_eta(status: DataFrame, runtime_seconds: Column) -> DataFrame:
    """Remaining seconds per dataset, and the last line without its time stamp and tag."""
    eta = _eta(F.col("todo"), F.col("converted"), runtime_seconds)
    message = F.regexp_extract("last_log", r"(?s)\A[^ ]* [^ ]* (.*)\z", 1)
    has_message = F.col("last_log").rlike(r"(?s)\A[^ ]* [^ ]* ")
    return status.withColumns(
        {
            "eta": format_duration(eta),
            "message": F.when(has_message, message).otherwise(F.col("last_log")),
        }
    )


def progress_totals(status: DataFrame, runtime_seconds: Column) -> DataFrame:
    """One row over all datasets: counts by status, converted, todo and time left."""
    by_status = [
        F.count_if(F.col("status") == name).alias(name.replace("-", "_"))
        for name in ("done", "in-progress", "pending", "error")
    ]
    zero = F.lit(0).cast("bigint")
    totals = status.agg(
        *by_status,
        F.coalesce(F.sum("converted"), zero).alias("converted"),
        F.coalesce(F.sum("todo"), zero).alias("todo"),
    )
    eta = _eta(F.col("todo"), F.col("converted"), runtime_seconds)
    return totals.withColumn("eta", format_duration(eta))


def pick_run(
    reports: DataFrame,
    touched: DataFrame,
    now_unix: Column,
    command: str | None = None,
    dataset: str = "all",
) -> DataFrame:
    """The newest run still open, else the newest whose log was touched lately.

    ``touched`` is (command, dataset, touched_unix). Only the newest report of each
    (command, dataset) can win, so the reports are cut to those before the join.
    """
    chosen = for_dataset(reports, dataset)
    if command is not None:
        same = canonical_command(F.col("command")) == canonical_command(F.lit(command))
        chosen = chosen.where(same)
    newest = F.struct(-report_stamp(), F.col("path"))
    # The whole rows stay out of the ranking; the winner is fetched at the end.
    active = (
        chosen.where("finished_at_unix IS NULL").agg(F.min(newest).alias("run"))
        .select(F.lit(0).alias("tier"), "run")
    )
    logged = chosen.where(
        F.col("finished_at_unix").isNotNull()
        & ~F.col("command").isin("download", "verify_download")
    )
    per_log = (
        logged.select("command", newest.alias("run"), F.explode("datasets.dataset").alias("dataset"))
        .groupBy("command", "dataset")
        .agg(F.min("run").alias("run"))
    )
    lately = touched.where(now_unix - F.col("touched_unix") <= RECENT_SECONDS).select(
        "command", "dataset"
    )
    recent = (
        per_log.join(lately, ["command", "dataset"], "left_semi")
        .agg(F.min("run").alias("run"))
        .select(F.lit(1).alias("tier"), "run")
    )
    winner = (
        active.unionByName(recent).where("run IS NOT NULL")
        .agg(F.min_by("run", "tier").alias("run"))
        .select(F.col("run.path").alias("path"))
    )
    # One row at most.
    return chosen.join(F.broadcast(winner), "path", "left_semi")


def progress_snapshot(run: DataFrame, now_unix: Column) -> DataFrame:
    """The picked run with its running time so far."""
    so_far = F.greatest(now_unix - F.col("started_at_unix"), F.lit(0)).cast("double")
    return run.select(
        "command",
        F.col("path").alias("report_path"),
        "started_at_unix",
        "finished_at_unix",
        F.coalesce("duration_seconds", so_far).alias("runtime_seconds"),
        "totals_items_scanned",
        "totals_succeeded",
        "totals_failed",
        "totals_skipped",
        "datasets",
    )


def log_tail(lines: DataFrame, keep: int = 2) -> DataFrame:
    """Last lines of each log file, newest first by ``from_end``."""
    return last_lines(lines, keep).select("file", "from_end", "value")


@dataclass(frozen=True)
class Progress:
    """A picked run: its report, its datasets as their logs tell, and the ends of those logs."""

    snapshot: DataFrame
    datasets: DataFrame
    totals: DataFrame
    last_lines: DataFrame


def run_progress(
    spark: SparkSession,
    metadata_dir: str,
    now_unix: int,
    command: str | None = None,
    dataset: str = "all",
    keep: int = 2,
) -> Progress:
    """How far the newest run is that is open or has written to a log within five minutes.

    Reports and logs are those that jobs leave with ``metadata_dir``. A dataset folder without
    a log of the run's command is pending.
    """
    root, now = metadata_dir.rstrip("/"), F.lit(now_unix).cast("bigint")
    reports = read_reports(spark, f"{root}/reports")
    run = checkpointed(pick_run(reports, log_times(spark, root), now, command, dataset))
    picked = run.select("command", "report_nonce", "started_at_unix", "duration_seconds").first()
    if picked is None:
        raise LookupError(f"no open or recent run in {root}")
    runtime = picked["duration_seconds"]
    if runtime is None:
        runtime = max(now_unix - picked["started_at_unix"], 0)
    lines = read_logs(spark, root, picked["command"])
    names = spark.createDataFrame([(name,) for name in run_datasets(spark, root)], "dataset string")
    status = checkpointed(with_pending(names, dataset_status(lines)))
    seconds = F.lit(float(runtime))
    of_run = run.select(F.explode("datasets.dataset").alias("dataset"))
    ends = log_tail(lines.join(of_run, "dataset", "left_semi"), keep)
    return Progress(progress_snapshot(run, now), with_eta(status, seconds), progress_totals(status, seconds), ends)
