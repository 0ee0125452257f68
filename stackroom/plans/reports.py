"""Queries over run reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stackroom.functions.runs import (
    canonical_command,
    command_flow_rank,
    format_duration,
    started_local,
)
from stackroom.operators.ranking import beyond_first, first_per, with_ordinal
from stackroom.plans.outcome import Outcome
from stackroom.schemas import REPORT
from stackroom.sinks.outputs import remove
from stackroom.sources.runs import read_reports


def report_stamp() -> Column:
    """Age of a report in milliseconds; old reports only know their start in seconds."""
    nonce = F.nullif(F.col("report_nonce"), F.lit(0).cast("bigint"))
    return F.coalesce(nonce, F.col("started_at_unix") * 1000)


def _newest_first() -> list[Column]:
    return [-report_stamp(), F.col("path")]


def status() -> Column:
    return F.when(F.col("totals_failed") == 0, "ok").otherwise("FAILED")


def for_command(reports: DataFrame, command: str | None) -> DataFrame:
    return reports if command is None else reports.where(F.col("command") == command)


def for_dataset(reports: DataFrame, dataset: str) -> DataFrame:
    """Reports that count the dataset or list a failure of it."""
    if dataset == "all":
        return reports
    named = [F.coalesce(F.exists(c, lambda e: e["dataset"] == dataset), F.lit(False)) for c in ("datasets", "failures")]
    return reports.where(named[0] | named[1])


def latest_per_command(reports: DataFrame) -> DataFrame:
    return first_per(reports, "command", _newest_first())


def in_report_order(reports: DataFrame) -> DataFrame:
    """Order of work, newest first within a command, then path."""
    return reports.orderBy(command_flow_rank(F.col("command")), *_newest_first())


def with_report_position(reports: DataFrame) -> DataFrame:
    """``reports`` with their ``position`` (from 1) in that order."""
    order = [command_flow_rank(F.col("command")), *_newest_first()]
    return with_ordinal(reports, order, "position")


def select_reports(reports: DataFrame, command: str | None = None, latest: bool = False) -> DataFrame:
    chosen = for_command(reports, command)
    return latest_per_command(chosen) if latest else chosen


def report_summary(reports: DataFrame, zone: str | None = None) -> DataFrame:
    """One line per report; times are in ``zone``, or the session's."""
    return reports.select(
        "command",
        command_flow_rank(F.col("command")).alias("flow_rank"),
        status().alias("status"),
        "totals_failed",
        "totals_succeeded",
        "totals_skipped",
        started_local(F.col("started_at_unix"), zone).alias("started_local"),
        F.coalesce(format_duration(F.col("duration_seconds")), F.lit("-")).alias("runtime"),
        "path",
    )


def report_breakdown(reports: DataFrame) -> DataFrame:
    """One line per dataset of a report; its steps, or else its totals, when it has none."""
    none = F.lit(None).cast("bigint")

    def line(kind, name, scanned, ok, failed, skipped, state):
        return F.struct(
            F.lit(kind).alias("kind"),
            name.alias("name"),
            scanned.alias("scanned"),
            ok.alias("ok"),
            failed.alias("failed"),
            skipped.alias("skipped"),
            state.alias("line_status"),
        )

    def of_dataset(d):
        state = F.when(d["failed"] > 0, "!").otherwise("")
        return line(
            "dataset", d["dataset"], d["items_scanned"], d["succeeded"], d["failed"], d["skipped"], state
        )

    totals = line(
        "totals",
        F.lit(None).cast("string"),
        F.col("totals_items_scanned"),
        F.col("totals_succeeded"),
        F.col("totals_failed"),
        F.col("totals_skipped"),
        F.lit(""),
    )
    lines = (
        F.when(F.size("datasets") > 0, F.transform("datasets", of_dataset))
        .when(
            F.size("step_runs") > 0,
            F.transform("step_runs", lambda s: line("step", s["step"], none, none, none, none, s["status"])),
        )
        .otherwise(F.array(totals))
    )
    return reports.select("path", "command", status().alias("status"), F.inline(lines))


def with_totals(reports: DataFrame) -> DataFrame:
    """Totals of each run as the sums over its datasets."""
    zero = F.lit(0).cast("bigint")

    def total(part: str) -> Column:
        counts = F.transform("datasets", lambda d: F.coalesce(d[part], zero))
        return F.coalesce(F.aggregate(counts, zero, lambda acc, n: acc + n), zero)

    sums = {
        "totals_items_scanned": total("items_scanned"),
        "totals_succeeded": total("succeeded"),
        "totals_failed": total("failed"),
        "totals_skipped": total("skipped"),
    }
    return reports.withColumns(sums)


def prunable_reports(reports: DataFrame, keep: int, command: str | None = None) -> DataFrame:
    """Reports beyond the ``keep`` (at least 1) newest of their command. Deletes nothing."""
    return beyond_first(
        for_command(reports, command), "command", _newest_first(), max(keep, 1), F.col("path")
    )


def latest_report_path(reports: DataFrame) -> DataFrame:
    """Newest report per command, other spellings of a command folded in."""
    folded = reports.withColumn("command", canonical_command(F.col("command")))
    return folded.groupBy("command").agg(
        F.min_by("path", F.struct(*_newest_first())).alias("path")
    )


def step_rollup(reports: DataFrame) -> DataFrame:
    """Per run with steps: how many ran and failed, and the overall status."""
    failed = F.size(F.filter("step_runs", lambda s: s["status"] == "failed"))
    return reports.where(F.size("step_runs") > 0).select(
        "path",
        F.size("step_runs").alias("steps"),
        failed.alias("failed_steps"),
        F.when(failed > 0, "failed").otherwise("ok").alias("status"),
    )


def step_failures(reports: DataFrame) -> DataFrame:
    """Failed steps as failures, phase ``all_<step>``."""
    steps = reports.select("path", F.inline("step_runs")).where("status = 'failed'")
    return steps.select(
        "path",
        F.lit("all").alias("dataset"),
        F.concat(F.lit("all_"), "step").alias("phase"),
        F.col("report_path").alias("output_path"),
        F.col("message").alias("error_message"),
    )


def run_prune_reports(spark: SparkSession, folder: str, keep: int, command: str | None = None) -> list[str]:
    """Delete the reports beyond the ``keep`` newest of their command; their paths."""
    gone = prunable_reports(read_reports(spark, folder), keep, command).select("path").orderBy("path")
    paths = [row["path"] for row in gone.collect()]
    for path in paths:
        remove(spark, path)
    return paths


def new_report(
    outcome: Outcome, command: str, args: dict[str, str], started_ms: int, finished_ms: int
) -> DataFrame:
    """The report row of a finished run; its failures are kept apart, as rows."""
    arg_items = [F.lit(item) for pair in args.items() for item in pair]
    # One row per dataset, a closed list of names.
    datasets = outcome.summary.agg(F.array_sort(F.collect_list(F.struct("*"))).alias("datasets"))
    row = datasets.withColumns(
        {
            "command": F.lit(command),
            "cli_version": F.lit(""),
            "report_nonce": F.lit(started_ms).cast("bigint"),
            "started_at_unix": F.lit(started_ms // 1000).cast("bigint"),
            "finished_at_unix": F.lit(finished_ms // 1000).cast("bigint"),
            "duration_seconds": F.lit(float(finished_ms // 1000 - started_ms // 1000)),
            "args": F.create_map(*arg_items).cast("map<string,string>"),
            "failures": F.array().cast(REPORT["failures"].dataType),
            "step_runs": F.array().cast(REPORT["step_runs"].dataType),
        }
    )
    return with_totals(row).select(*[F.col(f.name).cast(f.dataType) for f in REPORT.fields])
