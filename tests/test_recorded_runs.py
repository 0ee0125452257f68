"""Jobs that leave reports and logs, progress over what they left, and swaps that are cut short."""

import json
import os
import time
from pathlib import Path

import pytest
from test_jobs import URL, put, raw_works

from stackroom.plans.download import run_verify_download
from stackroom.plans.enrich import run_enrich
from stackroom.plans.extract import run_extract
from stackroom.plans.index import index_path, run_index, run_verify_index
from stackroom.plans.progress import run_progress
from stackroom.plans.recording import Recording, run_steps
from stackroom.plans.reports import latest_per_command, run_prune_reports, step_rollup
from stackroom.sinks import outputs
from stackroom.sources.runs import log_times, read_reports


@pytest.fixture
def corpus(tmp_path):
    root = tmp_path / "parquet"
    put(root / "works/updated_date=2020-01-01/a.parquet", id=[f"{URL}W1", f"{URL}W2"])
    put(root / "works/updated_date=2020-01-02/b.parquet", id=[f"{URL}W3"])
    put(root / "authors/a.parquet", id=[f"{URL}A1"])
    return str(root)


def reports(spark, meta):
    return read_reports(spark, f"{meta}/reports")


def test_jobs_leave_reports(spark, scheme, corpus, tmp_path):
    meta = f"{tmp_path}/meta"
    outcome = run_index(spark, corpus, metadata_dir=meta)
    assert Path(outcome.report_path).exists()
    row = reports(spark, meta).first()
    assert row["command"] == "index" and row["args"]["parquet_dir"] == corpus and row["finished_at_unix"] is not None
    assert {(d["dataset"], d["items_scanned"], d["succeeded"]) for d in row["datasets"]} == {("works", 2, 2), ("authors", 1, 1)}
    assert (row["totals_items_scanned"], row["totals_failed"]) == (3, 0)
    assert Path(f"{meta}/works/index/index.log").read_text().splitlines()[-1].endswith("run summary scanned=2 ok=2 failed=0")

    (tmp_path / "ids.csv").write_text(f"id\n{URL}W1\n{URL}W9\n")
    out = run_extract(spark, corpus, f"{tmp_path}/ids.csv", f"{tmp_path}/out.parquet", scheme, metadata_dir=meta)
    assert out.outcome.report_path.startswith(f"{meta}/reports/extract-") and out.outputs
    put(f"{corpus}/works/updated_date=2020-01-03/c.parquet", id=[f"{URL}W4"])
    run_verify_index(spark, corpus, metadata_dir=meta)
    found = {r["command"]: r for r in reports(spark, meta).collect()}
    assert set(found) == {"index", "extract", "verify_index"}
    assert found["verify_index"]["totals_failed"] == 1
    assert [f["phase"] for f in found["verify_index"]["failures"]] == ["verify_index_count"]
    assert found["extract"]["totals_skipped"] == 1

    time.sleep(0.01)
    run_index(spark, corpus, metadata_dir=meta)
    newest = {r["command"]: r["totals_skipped"] for r in latest_per_command(reports(spark, meta)).collect()}
    assert newest["index"] == 2
    gone = run_prune_reports(spark, f"{meta}/reports", keep=1)
    assert gone and not any(Path(p.removeprefix("file:")).exists() for p in gone)
    assert reports(spark, meta).where("command = 'index'").count() == 1


def test_a_job_that_breaks_leaves_a_report(spark, tmp_path):
    meta = f"{tmp_path}/meta"
    with pytest.raises(FileNotFoundError):
        run_index(spark, f"{tmp_path}/nothing", metadata_dir=meta)
    with pytest.raises(Exception):
        run_verify_download(spark, f"{tmp_path}/no.json", f"{tmp_path}", metadata_dir=meta)
    found = {r["command"]: r for r in reports(spark, meta).collect()}
    assert found["index"]["totals_failed"] == 1 and found["index"]["finished_at_unix"] is not None
    assert "nothing" in found["index"]["failures"][0]["error_message"]
    assert found["verify_download"]["failures"][0]["phase"] == "verify_download"


def test_steps_roll_up(spark, corpus, tmp_path):
    meta = f"{tmp_path}/meta"
    calls = {
        "index": lambda: run_index(spark, corpus, metadata_dir=meta),
        "verify_index": lambda: run_verify_index(spark, corpus, dataset="nowhere", metadata_dir=meta),
        "never": lambda: 1 / 0,
    }
    assert [r["status"] for r in run_steps(spark, calls, meta).collect()] == ["ok", "failed"]
    whole = reports(spark, meta).where("command = 'all'")
    row = whole.first()
    assert [(s["step"], s["status"]) for s in row["step_runs"]] == [("index", "ok"), ("verify_index", "failed")]
    assert all(Path(s["report_path"]).exists() for s in row["step_runs"]) and row["totals_failed"] == 1
    assert step_rollup(whole).first()["status"] == "failed"
    assert [f["phase"] for f in row["failures"]] == ["all_verify_index"]


def test_progress_over_a_folder(spark, corpus, tmp_path):
    """Finished runs count for five minutes after the last line of a log, an open one always."""
    meta = f"{tmp_path}/meta"
    run_index(spark, corpus, metadata_dir=meta)
    (tmp_path / "meta/topics").mkdir()
    now = 2_000_000_000
    logs = [Path(meta, name, "index/index.log") for name in ("works", "authors")]
    for log, age in zip(logs, (300, 4000)):
        os.utime(log, (now - age, now - age))
    times = {r["dataset"]: r["touched_unix"] for r in log_times(spark, meta).collect()}
    assert times == {"works": now - 300, "authors": now - 4000}

    seen = run_progress(spark, meta, now)
    assert seen.snapshot.first()["command"] == "index"
    status = {r["dataset"]: (r["status"], r["scanned"], r["converted"], r["ok"]) for r in seen.datasets.collect()}
    assert status == {"works": ("done", 2, 1, 2), "authors": ("done", 1, 1, 1), "topics": ("pending", 0, 0, 0)}
    assert seen.totals.first()["done"] == 2
    lines = {(r["file"].split("/")[0], r["from_end"]): r["value"] for r in seen.last_lines.collect()}
    assert len(lines) == 4 and " summary " in lines["works", 1] and " indexed " in lines["works", 2]

    os.utime(logs[0], (now - 301, now - 301))
    with pytest.raises(LookupError):
        run_progress(spark, meta, now)

    open_run = Recording(spark, meta, "verify_index", {})
    open_run.opened()
    open_run.start("works", 5, 5)
    seen = run_progress(spark, meta, open_run.started_ms // 1000 + 60)
    assert seen.snapshot.first()["command"] == "verify_index" and seen.snapshot.first()["runtime_seconds"] == 60.0
    status = {r["dataset"]: r["status"] for r in seen.datasets.collect()}
    assert status == {"works": "in-progress", "authors": "pending", "topics": "pending"}


def test_enrich_tells_its_partitions(spark, tmp_path):
    root, meta = f"{tmp_path}/parquet", f"{tmp_path}/meta"
    raw_works(f"{root}/works_aws/updated_date=2020-01-01/a.parquet", ["W1"])
    run_enrich(spark, root, metadata_dir=meta)
    run_enrich(spark, root, metadata_dir=meta)
    log = Path(meta, "works/enrich/enrich.log").read_text()
    assert "all files already converted source_files=1" in log
    totals = [(r["totals_succeeded"], r["totals_skipped"]) for r in reports(spark, meta).orderBy("report_nonce").collect()]
    assert totals == [(1, 0), (0, 1)]


def test_partition_values_that_writers_escape(spark, tmp_path):
    """A folder of any name is staged and published under that very name."""
    root = f"{tmp_path}/parquet"
    for k, value in enumerate(["2020-01-01 10%3A00", "a%25b", "x y", "é"]):
        raw_works(f"{root}/works_aws/updated_date={value}/a.parquet", [f"W{k}"])
    raw_works(f"{root}/works_aws/plain.parquet", ["W9"])
    outcome = run_enrich(spark, root)
    assert outcome.failures.count() == 0
    made = {p.name for p in Path(root, "works").iterdir() if p.is_dir()}
    assert made == {f"updated_date={v}" for v in ["2020-01-01 10%3A00", "a%25b", "x y", "é", "__HIVE_DEFAULT_PARTITION__"]}
    read = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/works")
    assert sorted(r["id"] for r in read.collect()) == [f"{URL}W{k}" for k in (0, 1, 2, 3, 9)]


class Crash(Exception):
    pass


@pytest.mark.parametrize("step", [1, 2, 3])
def test_a_swap_that_is_cut_short(spark, corpus, tmp_path, monkeypatch, scheme, step):
    """Stopped before any of its steps, one whole version is there to be read, and the next run mends."""
    target = index_path(corpus, "works")
    run_index(spark, corpus, "works")
    put(f"{corpus}/works/updated_date=2020-01-03/c.parquet", id=[f"{URL}W4"])
    real, n = outputs._located, 0

    class Files:
        def __init__(self, files):
            self.files = files

        def __getattr__(self, name):
            return getattr(self.files, name)

        def _count(self):
            nonlocal n
            n += 1
            if n == step:
                raise Crash

        def rename(self, *args):
            self._count()
            return self.files.rename(*args)

        def delete(self, path, deep):
            if outputs._OLD in path.toString():
                self._count()
            return self.files.delete(path, deep)

    def located(session, path):
        place, files = real(session, path)
        return place, Files(files)

    with monkeypatch.context() as patch:
        patch.setattr(outputs, "_located", located)
        with pytest.raises(Crash):
            outputs.write_parquet(spark.read.parquet(target).limit(1), target, overwrite=True)
    whole = outputs.whole_version(spark, target)
    assert spark.read.parquet(whole).count() == (1 if step == 3 else 3)
    assert outputs.is_complete(spark, target)
    (tmp_path / "ids.csv").write_text(f"id\n{URL}W1\n")
    run_extract(spark, corpus, f"{tmp_path}/ids.csv", f"{tmp_path}/out.parquet", scheme)
    run_index(spark, corpus, "works", overwrite=True)
    assert spark.read.parquet(target).count() == 4
    assert not [p for p in Path(corpus).iterdir() if p.name.startswith(".") and not p.name.endswith(".crc")]


def test_enrich_takes_back_a_partition_set_aside(spark, tmp_path):
    root = f"{tmp_path}/parquet"
    raw_works(f"{root}/works_aws/updated_date=2020-01-01/a.parquet", ["W1"])
    run_enrich(spark, root)
    place = Path(root, "works/updated_date=2020-01-01")
    place.rename(place.with_name(f".old-{place.name}"))
    outcome = run_enrich(spark, root)
    assert outcome.summary.first()["skipped"] == 1 and place.exists()


def test_small_files_change_in_one_step(spark, tmp_path):
    path = f"{tmp_path}/new folder/a.json"
    for text in ("one", json.dumps({"two": "é"})):
        outputs.write_small(spark, path, text)
        assert Path(path).read_text() == text
    assert [p.name for p in Path(path).parent.iterdir() if not p.name.endswith(".crc")] == ["a.json"]
