import json

import pytest
from pyspark.sql import functions as F

from stackroom.plans.progress import (
    dataset_status,
    log_tail,
    pick_run,
    progress_snapshot,
    progress_totals,
    with_eta,
    with_pending,
)
from stackroom.plans.reports import (
    for_dataset,
    in_report_order,
    latest_per_command,
    latest_report_path,
    prunable_reports,
    report_breakdown,
    report_summary,
    step_failures,
    step_rollup,
)
from stackroom.sources.runs import read_logs, read_reports


def report(command, nonce=0, started=100, finished=200, failed=0, datasets=("works",), steps=(), failures=()):
    return {
        "command": command,
        "report_nonce": nonce,
        "started_at_unix": started,
        "finished_at_unix": finished,
        "duration_seconds": None if finished is None else float(finished - started),
        "args": {"dataset": "all"},
        "totals_items_scanned": 5,
        "totals_succeeded": 5 - failed,
        "totals_failed": failed,
        "totals_skipped": 0,
        "datasets": [
            {"dataset": d, "items_scanned": 5, "succeeded": 5 - failed, "failed": failed, "skipped": 0} for d in datasets
        ],
        "failures": [{"dataset": d, "phase": "p", "error_message": "m"} for d in failures],
        "step_runs": [{"step": s, "status": v} for s, v in steps],
    }


@pytest.fixture
def reports(spark, tmp_path):
    folder = tmp_path / "reports"
    folder.mkdir()

    def load(**named):
        for name, content in named.items():
            (folder / f"{name.replace('__', '-')}.json").write_text(json.dumps(content, indent=1))
        return read_reports(spark, str(folder))

    load.folder = folder
    return load


def names(rows):
    return [r["path"].rsplit("/", 1)[1] for r in rows.collect()]


def test_other_files_are_passed_over(reports):
    (reports.folder / "notes.json").write_text("{broken")
    (reports.folder / "index-x.json").write_text("{broken")
    (reports.folder / "index-5.txt").write_text("{broken")
    rows = reports(verify__100=report("verify"))
    assert [(r["command"], r["file_stamp"]) for r in rows.collect()] == [("verify", 100)]


def test_bad_report_is_an_error(reports):
    (reports.folder / "index-5.json").write_text("{broken")
    with pytest.raises(Exception):
        reports().collect()


def test_latest_order_and_prune(reports):
    rows = reports(
        verify__100=report("verify", started=100, failed=1),
        verify__200=report("verify", started=200),
        convert__150=report("convert", started=150),
        convert__90__7000000=report("convert", nonce=7_000_000, started=90),
        all__10=report("all", started=10),
    )
    assert sorted(names(latest_per_command(rows))) == ["all-10.json", "convert-90-7000000.json", "verify-200.json"]
    assert names(in_report_order(rows)) == [
        "all-10.json", "convert-90-7000000.json", "convert-150.json", "verify-200.json", "verify-100.json",
    ]
    assert sorted(names(prunable_reports(rows, 1))) == ["convert-150.json", "verify-100.json"]
    assert sorted(names(prunable_reports(rows, 0, "verify"))) == ["verify-100.json"]
    assert prunable_reports(rows, 2).count() == 0
    lines = {r["path"].rsplit("/", 1)[1]: r for r in report_summary(rows).collect()}
    assert lines["verify-100.json"]["status"] == "FAILED" and lines["verify-200.json"]["runtime"] == "0s"
    assert lines["all-10.json"]["started_local"] == "1970-01-01 00:00:10"


def test_latest_path_folds_spellings(reports):
    rows = reports(
        a__1=report("verify_index", started=1), b__2=report("verify-index", started=2), c__3=report("verify_convert", started=3)
    )
    got = {r["command"]: r["path"].rsplit("/", 1)[1] for r in latest_report_path(rows).collect()}
    assert got == {"verify-index": "b-2.json", "verify": "c-3.json"}


def test_dataset_filter_breakdown_and_steps(reports):
    rows = reports(
        index__1=report("index", datasets=("works", "authors"), failed=1),
        all__2=report("all", datasets=(), steps=(("download", "ok"), ("index", "failed"))),
        check__3=report("check", datasets=(), failures=("topics",)),
    )
    assert names(for_dataset(rows, "authors")) == ["index-1.json"]
    assert names(for_dataset(rows, "topics")) == ["check-3.json"]
    assert for_dataset(rows, "all").count() == 3
    lines = {(r["command"], r["kind"], r["name"], r["ok"], r["line_status"]) for r in report_breakdown(rows).collect()}
    assert lines == {
        ("index", "dataset", "works", 4, "!"),
        ("index", "dataset", "authors", 4, "!"),
        ("all", "step", "download", None, "ok"),
        ("all", "step", "index", None, "failed"),
        ("check", "totals", None, 5, ""),
    }
    rolled = [(r["steps"], r["failed_steps"], r["status"]) for r in step_rollup(rows).collect()]
    assert rolled == [(2, 1, "failed")]
    assert [r["phase"] for r in step_failures(rows).collect()] == ["all_index"]


LOG = """100 [index] start source_files=10 todo_files=4
101 [index] file indexed a
102 [index] file indexed b
"""


@pytest.fixture
def logs(tmp_path):
    root = tmp_path / "meta"
    texts = {
        "works": LOG,
        "authors": LOG + "103 [index] run summary scanned=12 ok=11 failed=1\n104 [index] run summary ok=12 failed=0\n",
        "topics": "100 [index] start source_files=6\n101 [index] all files already indexed\n102 [index] again source_files=9\n",
        "fields": LOG + "103 [index] run summary scanned=10 ok=10 failed=0\n",
        "sources": "100 [index] hello\n",
    }
    for name, text in texts.items():
        folder = root / name / "index"
        folder.mkdir(parents=True)
        (folder / "index.log").write_text(text)
    (root / "works/convert").mkdir()
    (root / "works/convert/convert.log").write_text("1 [convert] other\n")
    return str(root)


def test_progress(spark, logs):
    lines = read_logs(spark, logs, "index")
    datasets = spark.createDataFrame([(d,) for d in ("works", "authors", "topics", "fields", "sources", "sdgs")], "dataset string")
    status = with_pending(datasets, dataset_status(lines))
    got = {r["dataset"]: tuple(r)[1:8] for r in status.collect()}
    assert got == {
        "works": ("in-progress", 10, 4, 2, 0, 0, 0),
        "authors": ("error", 12, 4, 2, 12, 0, 0),
        "topics": ("done", 9, 0, 0, 0, 0, 6),
        "fields": ("done", 10, 4, 2, 10, 0, 0),
        "sources": ("pending", 0, 0, 0, 0, 0, 0),
        "sdgs": ("pending", 0, 0, 0, 0, 0, 0),
    }
    eta = {r["dataset"]: (r["eta"], r["message"]) for r in with_eta(status, F.lit(60.0)).collect()}
    assert eta["works"] == ("1m00s", "file indexed b") and eta["sources"] == (None, "hello")
    totals = progress_totals(status, F.lit(60.0)).first()
    assert tuple(totals) == (2, 1, 2, 1, 6, 12, "1m00s")


def test_status_is_one_scan(spark, logs):
    plan = dataset_status(read_logs(spark, logs, "index"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1 and "Join" not in plan and "Window" not in plan


def test_status_merges_blocks_in_order(spark):
    """What was scanned as of the last idle line, wherever block ends fall."""
    lines = [" start source_files=4", " x", " all files already indexed", " again source_files=9", " all files already indexed", " y"]
    for size in (1, 2, 3, 6):
        rows = [("d", k // size, -k if size == 1 else k, f"1{line}") for k, line in enumerate(lines)]
        status = dataset_status(spark.createDataFrame(rows, "dataset string, block int, row int, value string").repartition(3)).first()
        assert (status["scanned"], status["skipped"], status["last_log"]) == (9, 9, "1 y")
        cut = dataset_status(spark.createDataFrame(rows[:4], "dataset string, block int, row int, value string")).first()
        assert (cut["scanned"], cut["skipped"]) == (9, 4)


def test_log_order_across_blocks(spark, tmp_path):
    folder = tmp_path / "meta/works/index"
    folder.mkdir(parents=True)
    (folder / "index.log").write_text("".join(f"{i} [index] todo_files={i}\n" for i in range(3000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        lines = read_logs(spark, f"{tmp_path}/meta", "index")
        assert lines.select("block").distinct().count() > 3
        tail = {r["from_end"]: r["value"] for r in log_tail(lines, 2).collect()}
        assert dataset_status(lines).first()["todo"] == 2999
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert tail == {1: "2999 [index] todo_files=2999", 2: "2998 [index] todo_files=2998"}


def test_pick_run(spark, reports):
    rows = reports(
        index__1=report("index", started=1000, finished=1100),
        index__2=report("index", started=1050, finished=1060, datasets=("authors",)),
        convert__3=report("convert", started=1200, finished=1300),
        download__4=report("download", started=1500, finished=1600),
    )
    touched = spark.createDataFrame(
        [("index", "works", 1900), ("index", "authors", 1500), ("convert", "works", 1699), ("download", "works", 2000)],
        "command string, dataset string, touched_unix bigint",
    )
    now = F.lit(2000).cast("bigint")
    assert names(pick_run(rows, touched, now)) == ["index-1.json"]
    assert names(pick_run(rows, touched, now, dataset="authors")) == []
    assert names(pick_run(rows, touched, now, command="convert")) == []
    active = reports(
        index__5=report("index", started=10, finished=None), index__6=report("index", started=20, finished=None)
    )
    picked = pick_run(active, touched, now)
    assert names(picked) == ["index-6.json"]
    assert progress_snapshot(picked, now).first()["runtime_seconds"] == 1980.0
