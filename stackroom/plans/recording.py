"""Runs that leave reports and logs.

A job given a ``metadata_dir`` writes there, as files that change in one step:

* ``reports/<command>-<start in ms>.json``: without an end while the job runs, then with its
  totals, failures and datasets; also when the job breaks, with the error as its failure;
* ``<dataset>/<command>/<command>.log``: what the job tells of each dataset as it goes.

``plans/reports.py`` and ``plans/progress.py`` read them.
"""

from __future__ import annotations

import functools
import inspect
import json
import time
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from stackroom.plans.outcome import Outcome
from stackroom.plans.reports import new_report
from stackroom.schemas import STEP_RUN
from stackroom.sinks.outputs import append_report, write_small


class RunLog:
    """What a run tells of its datasets; this one keeps it to itself."""

    def say(self, dataset: str, text: str) -> None:
        pass

    def start(self, dataset: str, source_files: int, todo_files: int) -> None:
        self.say(dataset, f"start source_files={source_files} todo_files={todo_files}")

    def idle(self, dataset: str, source_files: int, done: str) -> None:
        self.say(dataset, f"all files already {done} source_files={source_files}")

    def item(self, dataset: str, done: str, name: str) -> None:
        self.say(dataset, f"file {done} {name}")

    def summary(self, dataset: str, scanned: int, ok: int, failed: int) -> None:
        self.say(dataset, f"run summary scanned={scanned} ok={ok} failed={failed}")


SILENT = RunLog()


class Recording(RunLog):
    """The report and the logs of one run."""

    def __init__(self, spark: SparkSession, metadata_dir: str, command: str, args: dict[str, str]):
        self.spark, self.metadata_dir, self.command, self.args = spark, metadata_dir.rstrip("/"), command, args
        self.started_ms = time.time_ns() // 1_000_000
        self.lines: dict[str, list[str]] = {}

    @property
    def reports(self) -> str:
        return f"{self.metadata_dir}/reports"

    @property
    def report_path(self) -> str:
        return f"{self.reports}/{self.command}-{self.started_ms}.json"

    def say(self, dataset: str, text: str) -> None:
        # An object store cannot append: the few lines of a run are written whole each time.
        told = self.lines.setdefault(dataset, [])
        told.append(f"{int(time.time())} [{self.command}] {text}\n")
        write_small(self.spark, f"{self.metadata_dir}/{dataset}/{self.command}/{self.command}.log", "".join(told))

    def _write(self, **fields) -> None:
        totals = {f"totals_{part}": 0 for part in ("items_scanned", "succeeded", "failed", "skipped")}
        report = {
            "command": self.command,
            "cli_version": "",
            "report_nonce": self.started_ms,
            "started_at_unix": self.started_ms // 1000,
            "args": self.args,
            **totals,
            "datasets": [],
            "failures": [],
            "step_runs": [],
            **fields,
        }
        write_small(self.spark, self.report_path, json.dumps(report))

    def opened(self) -> None:
        self._write()

    def _end(self) -> dict:
        finished = time.time_ns() // 1_000_000_000
        return {"finished_at_unix": finished, "duration_seconds": float(finished - self.started_ms // 1000)}

    def broke(self, error: BaseException) -> None:
        """The job ended with an error: that is its one failure, of all it was asked for."""
        dataset = self.args.get("dataset", "all")
        failure = {"dataset": dataset, "phase": self.command, "error_message": str(error) or type(error).__name__}
        counts = {"dataset": dataset, "items_scanned": 0, "succeeded": 0, "failed": 1, "skipped": 0}
        self._write(datasets=[counts], failures=[failure], totals_failed=1, **self._end())

    def closed(self, outcome: Outcome) -> Outcome:
        finished_ms = time.time_ns() // 1_000_000
        report = new_report(outcome, self.command, self.args, self.started_ms, finished_ms)
        append_report(report, outcome.failures, self.reports, self.started_ms)
        return replace(outcome, report_path=self.report_path)

    def steps(self, rows: list[tuple]) -> None:
        """The roll-up of runs done in turn: one dataset, ``all``, and a line per step."""
        names = ("step", "status", "report_path", "message")
        failed = int(any(status == "failed" for _, status, *_ in rows))
        failures = [
            {"dataset": "all", "phase": f"all_{step}", "output_path": path, "error_message": message}
            for step, status, path, message in rows
            if status == "failed"
        ]
        counts = {"items_scanned": 1, "succeeded": 1 - failed, "failed": failed, "skipped": 0}
        self._write(
            datasets=[{"dataset": "all", **counts}],
            failures=failures,
            step_runs=[dict(zip(names, row)) for row in rows],
            **{f"totals_{part}": n for part, n in counts.items()},
            **self._end(),
        )


def leaves_report(command: str) -> Callable:
    """Give a job the option ``metadata_dir``. It gets a ``log`` to tell its progress to, and
    returns an ``Outcome`` or something that holds one."""

    def wrap(job: Callable) -> Callable:
        names = inspect.signature(job)

        @functools.wraps(job)
        def run(spark: SparkSession, *args, metadata_dir: str | None = None, **options):
            if metadata_dir is None:
                return job(spark, *args, **options)
            given = names.bind(spark, *args, **options)
            given.apply_defaults()
            told = {k: str(v) for k, v in given.arguments.items() if k not in ("spark", "log") and v is not None}
            recording = Recording(spark, metadata_dir, command, told)
            recording.opened()
            try:
                result = job(spark, *args, log=recording, **options)
                if isinstance(result, Outcome):
                    return recording.closed(result)
                return replace(result, outcome=recording.closed(result.outcome))
            except BaseException as error:
                recording.broke(error)
                raise

        return run

    return wrap


def run_steps(
    spark: SparkSession, steps: dict[str, Callable[[], Outcome]], metadata_dir: str | None = None
) -> DataFrame:
    """Run the jobs in turn and stop after the first that fails; one row per step run.

    With ``metadata_dir`` the roll-up is left there as the report of a run ``all``. Steps that leave
    reports of their own are named in it.
    """
    recording = None if metadata_dir is None else Recording(spark, metadata_dir, "all", {})
    if recording:
        recording.opened()
    done = []
    for name, job in steps.items():
        path = None
        try:
            result = job()
            outcome = result if isinstance(result, Outcome) else result.outcome
            path = outcome.report_path
            n_failed = outcome.failures.count()
            message = f"failures detected: {n_failed}" if n_failed else None
        except Exception as error:  # a step that breaks is a failed step
            message = str(error)
        done.append((name, "ok" if message is None else "failed", path, message))
        if message is not None:
            break
    if recording:
        recording.steps(done)
    return spark.createDataFrame(done, STEP_RUN)
