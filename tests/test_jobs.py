"""The jobs end to end on small corpora."""

import json
import os
import time
from collections import Counter
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from stackroom.plans.download import plan_download, run_verify_download
from stackroom.plans.enrich import enrich, run_enrich, stale
from stackroom.plans.extract import run_extract
from stackroom.plans.index import index_path, run_index, run_verify_index
from stackroom.plans.recording import run_steps
from stackroom.plans.reports import latest_per_command, new_report, prunable_reports
from stackroom.sinks.outputs import append_report, output_path
from stackroom.sources import corpus
from stackroom.sources.runs import read_reports
from stackroom.sources.idlist import read_id_list
from stackroom.sources.manifest import manifest_entities, manifest_files, read_manifest

URL = "https://example.org/"


def put(path, **columns):
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    pq.write_table(pa.table(columns), path)
    return path


def counts(outcome):
    return {
        r["dataset"]: (r["items_scanned"], r["succeeded"], r["failed"], r["skipped"])
        for r in outcome.summary.collect()
    }


def phases(outcome):
    return Counter(r["phase"] for r in outcome.failures.collect())


# --- sources -----------------------------------------------------------------


def test_inventory_and_counts(spark, tmp_path):
    root = tmp_path / "parquet"
    put(root / "works/updated_date=2020-01-01/a b+c%.parquet", id=["W1", "W2"])
    put(root / "works/updated_date=2020-01-02/empty.parquet", id=pa.array([], pa.string()))
    put(root / "works_aws/x.parquet", id=["W1"])
    (root / "authors").mkdir()
    (root / "works/readme.txt").write_text("no")
    found = corpus.file_inventory(spark, str(root))
    names = {r["rel_path"]: r["length"] for r in found.collect()}
    assert set(names) == {
        "works/updated_date=2020-01-01/a b+c%.parquet",
        "works/updated_date=2020-01-02/empty.parquet",
        "works_aws/x.parquet",
    }
    assert names["works_aws/x.parquet"] == os.path.getsize(root / "works_aws/x.parquet")
    assert [r["dataset"] for r in corpus.datasets_in(found).collect()] == ["works"]
    expected = {("works/updated_date=2020-01-01/a b+c%.parquet", 2), ("works_aws/x.parquet", 1)}
    n = corpus.file_row_counts(spark, str(root))
    assert {(r["rel_path"], r["n_rows"]) for r in n.collect()} == expected
    decoded = corpus.decoded_row_counts(spark, str(root))
    assert {(r["rel_path"], r["n_rows"]) for r in decoded.collect()} == expected
    plan = n._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan
    assert corpus.file_inventory(spark, f"{tmp_path}/nowhere").count() == 0


def test_rows_keep_the_columns_of_the_files(spark, tmp_path):
    put(tmp_path / "c/updated_date=2020-01-01/a.parquet", id=["W1"], title=["T"])
    put(tmp_path / "c/updated_date=2020-01-02/b.parquet", id=["W2"], title=["U"], doi=["d"])
    rows = corpus.read_corpus(spark, f"{tmp_path}/c")
    assert set(rows.columns) == {"id", "title", "doi"}
    assert {(r["id"], r["doi"]) for r in rows.collect()} == {("W1", None), ("W2", "d")}


def test_maps_are_decoded(spark, tmp_path):
    maps = pa.array([[("a", 1)], None], pa.map_(pa.string(), pa.int64()))
    put(tmp_path / "c/a.parquet", id=["W1", "W2"], m=maps, l=pa.array([[[("b", 2)]], []], pa.list_(pa.map_(pa.string(), pa.int64()))))
    row = corpus.decoded_row_counts(spark, f"{tmp_path}/c").first()
    assert row["n_rows"] == 2 and row["content_hash"] is not None


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("id,x\nW1,a\n W2 ,b\n,c\n", ["W1", "W2"]),
        ("x,example_id\na,W1\n", ["W1"]),
        ("x,work_id,id\na,W1,W2\n", ["W1"]),
        ("x,y\nW1,a\n", ["W1"]),
        ('id\n"""W1"""\n', ['"W1"']),
    ],
)
def test_id_list(spark, scheme, tmp_path, text, expected):
    (tmp_path / "ids.csv").write_text(text)
    rows = read_id_list(spark, f"{tmp_path}/ids.csv", scheme)
    assert sorted(r["raw"] for r in rows.collect()) == sorted(expected)


def test_ragged_id_list_is_an_error(spark, scheme, tmp_path):
    (tmp_path / "ids.csv").write_text("id,x\nW1,a\nW2,b,c\n")
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        read_id_list(spark, f"{tmp_path}/ids.csv", scheme).collect()


# --- enrich ------------------------------------------------------------------

AUTHORS = pa.list_(pa.struct([("author", pa.struct([("display_name", pa.string())]))]))


def raw_works(path, ids):
    names = [[{"author": {"display_name": f"N{i}"}}] for i in ids]
    return put(
        path,
        id=pa.array([f"{URL}{i}" for i in ids], pa.string()),
        abstract_inverted_index=pa.array(['{"Hello":[0],"world":[1]}'] * len(ids), pa.string()),
        authorships=pa.array(names, AUTHORS),
        publication_year=pa.array([2020] * len(ids), pa.int32()),
    )


def test_enrich_needs_a_source_column(spark):
    only_abstract = enrich(spark.createDataFrame([("{}",)], "abstract_inverted_index string"))
    assert only_abstract.columns == ["abstract_inverted_index", "abstract"]
    with pytest.raises(ValueError):
        enrich(spark.createDataFrame([("a",)], "title string"))


def test_enrich_is_incremental(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        run_enrich(spark, root)
    first = raw_works(f"{root}/works_aws/updated_date=2020-01-01/p.parquet", ["W1", "W2"])
    raw_works(f"{root}/works_aws/updated_date=2020-01-02/p.parquet", ["W3"])
    raw_works(f"{root}/works_aws/updated_date=2020-01-02/q.parquet", ["W4"])
    outcome = run_enrich(spark, root)
    assert counts(outcome) == {"works": (3, 3, 0, 0)} and outcome.failures.count() == 0
    works = spark.read.parquet(f"{root}/works")
    assert {(r["id"], r["abstract"], r["citation"], str(r["updated_date"])) for r in works.collect()} == {
        (f"{URL}W1", "Hello world", "NW1 (2020)", "2020-01-01"),
        (f"{URL}W2", "Hello world", "NW2 (2020)", "2020-01-01"),
        (f"{URL}W3", "Hello world", "NW3 (2020)", "2020-01-02"),
        (f"{URL}W4", "Hello world", "NW4 (2020)", "2020-01-02"),
    }
    untouched = sorted(Path(f"{root}/works/updated_date=2020-01-02").glob("*.parquet"))
    assert counts(run_enrich(spark, root)) == {"works": (3, 0, 0, 3)}
    raw_works(first, ["W1", "W5", "W6"])
    later = time.time() + 60
    os.utime(first, (later, later))
    assert counts(run_enrich(spark, root)) == {"works": (3, 1, 0, 2)}
    ids = [r["id"] for r in spark.read.parquet(f"{root}/works").collect()]
    assert sorted(ids) == [f"{URL}W{n}" for n in (1, 3, 4, 5, 6)]
    assert sorted(Path(f"{root}/works/updated_date=2020-01-02").glob("*.parquet")) == untouched
    assert counts(run_enrich(spark, root, overwrite=True)) == {"works": (3, 3, 0, 0)}


def test_enrich_without_partition_folder(spark, tmp_path):
    raw_works(f"{tmp_path}/works_aws/p.parquet", ["W1"])
    raw_works(f"{tmp_path}/works_aws/updated_date=2020-01-02/p.parquet", ["W2"])
    assert counts(run_enrich(spark, str(tmp_path))) == {"works": (2, 2, 0, 0)}
    assert counts(run_enrich(spark, str(tmp_path))) == {"works": (2, 0, 0, 2)}
    assert corpus.read_corpus(spark, f"{tmp_path}/works").count() == 2


def test_enrich_of_a_partition_without_rows(spark, tmp_path):
    raw_works(f"{tmp_path}/works_aws/updated_date=2020-01-01/p.parquet", ["W1"])
    assert counts(run_enrich(spark, str(tmp_path))) == {"works": (1, 1, 0, 0)}
    raw_works(f"{tmp_path}/works_aws/updated_date=2020-01-02/p.parquet", [])
    assert counts(run_enrich(spark, str(tmp_path))) == {"works": (2, 1, 0, 1)}


def test_enrich_reports_lost_rows(spark, tmp_path, monkeypatch):
    from stackroom.plans import enrich as job

    raw_works(f"{tmp_path}/works_aws/updated_date=2020-01-01/p.parquet", ["W1", "W2"])
    monkeypatch.setattr(job, "enrich", lambda raw: enrich(raw).where(~F.col("id").endswith("W2")))
    lossy = run_enrich(spark, str(tmp_path))
    assert phases(lossy) == {"enrich_rowcount": 1} and counts(lossy) == {"works": (1, 0, 1, 0)}
    assert lossy.failures.first()["error_message"] == "2 rows in the source, 1 enriched"
    assert not Path(f"{tmp_path}/works/updated_date=2020-01-01").exists()
    monkeypatch.setattr(job, "enrich", enrich)
    assert counts(run_enrich(spark, str(tmp_path))) == {"works": (1, 1, 0, 0)}
    assert spark.read.parquet(f"{tmp_path}/works").count() == 2


def test_enrich_keeps_a_column_named_like_the_partition(spark, tmp_path):
    day = f"{tmp_path}/works_aws/updated_date=2020-01-02/p.parquet"
    put(day, id=["W1"], abstract_inverted_index=['{"a":[0]}'], updated_date=["2020-01-01T10:11:12"])
    for _ in range(2):
        run_enrich(spark, str(tmp_path))
        rows = corpus.read_corpus(spark, f"{tmp_path}/works")
        assert [tuple(r) for r in rows.select("id", "updated_date", "abstract").collect()] == [("W1", "2020-01-01T10:11:12", "a")]
        os.utime(day, (time.time() + 60, time.time() + 60))
    assert not list(Path(f"{tmp_path}/works").glob("_staged*"))


def test_enrich_with_damaged_files(spark, tmp_path):
    """A damaged footer and a damaged page are a failure each; the other partitions are done."""
    days = [raw_works(f"{tmp_path}/works_aws/updated_date=2020-01-0{k}/p.parquet", [f"W{k}0", f"W{k}1"]) for k in range(1, 5)]
    raw_works(f"{tmp_path}/works_aws/updated_date=2020-01-04/empty.parquet", [])
    whole = Path(days[0]).read_bytes()
    Path(days[0]).write_bytes(whole[:-20])
    page = bytearray(Path(days[1]).read_bytes())
    page[4:60] = bytes(56)
    Path(days[1]).write_bytes(bytes(page))
    outcome = run_enrich(spark, str(tmp_path))
    failed = {(r["phase"], r["rel_path"]) for r in outcome.failures.collect()}
    assert failed == {("enrich", "updated_date=2020-01-01/p.parquet"), ("enrich", "updated_date=2020-01-02/p.parquet")}
    assert sorted(r["id"] for r in spark.read.parquet(f"{tmp_path}/works").collect()) == [f"{URL}W{n}" for n in (30, 31, 40, 41)]
    Path(days[0]).write_bytes(whole)
    assert phases(run_enrich(spark, str(tmp_path))) == {"enrich": 1}
    assert spark.read.parquet(f"{tmp_path}/works").count() == 6


def test_stale(spark):
    source = spark.createDataFrame([("a", 5), ("b", 5), ("c", 5), ("d", 5), ("e", 5)], "rel_path string, modified int")
    output = spark.createDataFrame([("a", 4), ("b", 5), ("c", 6), ("e", None)], "rel_path string, modified int")
    assert {r["rel_path"] for r in stale(source, output).collect()} == {"a", "d"}


# --- index and its check ------------------------------------------------------


@pytest.fixture
def indexed(spark, tmp_path):
    root = tmp_path / "parquet"
    put(root / "works/updated_date=2020-01-01/a.parquet", id=[f"{URL}W1000000001", f"{URL}domains/2", None], title=["Alpha", "D", "N"])
    put(root / "works/updated_date=2020-01-02/b.parquet", id=[f"{URL}W1000000002", f"{URL}W1000000001"], title=["Beta", "Again"])
    put(root / "authors/a.parquet", id=[f"{URL}A123456789"], display_name=["A"])
    put(root / "works_aws/a.parquet", id=["raw"])
    return str(root), run_index(spark, str(root))


def test_index(spark, indexed):
    root, outcome = indexed
    assert counts(outcome) == {"authors": (1, 1, 0, 0), "works": (2, 2, 0, 0)}
    index = spark.read.parquet(index_path(root, "works"))
    assert index.schema.simpleString() == (
        "struct<id:string,id_block:int,parquet_file:string,file_row_number:bigint>"
    )
    assert {tuple(r) for r in index.collect()} == {
        (f"{URL}W1000000001", 100000, "works/updated_date=2020-01-01/a.parquet", 0),
        (f"{URL}domains/2", 0, "works/updated_date=2020-01-01/a.parquet", 1),
        (None, None, "works/updated_date=2020-01-01/a.parquet", 2),
        (f"{URL}W1000000002", 100000, "works/updated_date=2020-01-02/b.parquet", 0),
        (f"{URL}W1000000001", 100000, "works/updated_date=2020-01-02/b.parquet", 1),
    }
    assert counts(run_index(spark, root)) == {"authors": (0, 0, 0, 1), "works": (0, 0, 0, 1)}
    assert counts(run_index(spark, root, "authors", overwrite=True)) == {"authors": (1, 1, 0, 0)}


def test_row_numbers_across_row_groups_and_splits(spark, tmp_path):
    path = tmp_path / "works/a.parquet"
    path.parent.mkdir()
    pq.write_table(pa.table({"id": [f"W{i}" for i in range(5000)]}), path, row_group_size=300)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        run_index(spark, str(tmp_path), "works")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    rows = spark.read.parquet(index_path(str(tmp_path), "works")).collect()
    assert {(r["id"], r["file_row_number"]) for r in rows} == {(f"W{i}", i) for i in range(5000)}


def test_verify_index(spark, indexed):
    root, _ = indexed
    good = run_verify_index(spark, root)
    assert counts(good) == {"authors": (1, 1, 0, 0), "works": (1, 1, 0, 0)} and not phases(good)
    put(f"{root}/works/updated_date=2020-01-03/c.parquet", id=["W9"])
    more = run_verify_index(spark, root, "works")
    assert phases(more) == {"verify_index_count": 1}
    assert more.failures.first()["error_message"] == "the index holds 5 rows, the corpus 6"
    # Same number of rows, but under another name.
    os.rename(f"{root}/works/updated_date=2020-01-03", f"{root}/works/updated_date=2020-01-04")
    run_index(spark, root, "works", overwrite=True)
    os.rename(f"{root}/works/updated_date=2020-01-04", f"{root}/works/updated_date=2020-01-05")
    lost = run_verify_index(spark, root, "works")
    assert phases(lost) == {"verify_index_path": 1}
    assert lost.failures.first()["rel_path"] == "works/updated_date=2020-01-04/c.parquet"


def test_verify_index_missing_or_incomplete(spark, tmp_path):
    put(tmp_path / "works/a.parquet", id=["W1"])
    assert phases(run_verify_index(spark, str(tmp_path), "works")) == {"verify_index_exists": 1}
    spark.range(1).select(F.lit("W1").alias("id")).write.parquet(index_path(str(tmp_path), "works"))
    assert phases(run_verify_index(spark, str(tmp_path))) == {"verify_index_schema": 3}


def test_killed_index_write(spark, tmp_path):
    """An index without its success mark is none; a failed overwrite leaves the old one."""
    root = str(tmp_path)
    put(f"{root}/works/a.parquet", id=[f"{URL}W1"])
    put(f"{root}/authors/a.parquet", id=[f"{URL}A1"])
    os.makedirs(f"{index_path(root, 'works')}/_temporary/0")
    assert phases(run_verify_index(spark, root)) == {"verify_index_exists": 2}
    assert counts(run_index(spark, root)) == {"authors": (1, 1, 0, 0), "works": (1, 1, 0, 0)}
    assert not phases(run_verify_index(spark, root))
    Path(f"{root}/works/a.parquet").write_bytes(b"PAR1 damaged")
    assert phases(run_index(spark, root, "works", overwrite=True)) == {"index_stage1": 1}
    assert spark.read.parquet(index_path(root, "works")).count() == 1
    wrong = spark.read.parquet(index_path(root, "authors")).withColumn("id_block", F.lit(7)).toPandas()
    spark.createDataFrame(wrong).write.mode("overwrite").parquet(index_path(root, "authors"))
    assert phases(run_verify_index(spark, root, "authors")) == {"verify_index_block": 1}


def test_a_damaged_file_fails_alone(spark, tmp_path):
    """A broken footer and a broken page keep their files out of the index, and no other."""
    root = str(tmp_path)
    for k in range(5):
        put(f"{root}/works/updated_date=2020-01-0{k + 1}/f.parquet", id=[f"{URL}W{k}{i}" for i in range(300)])
    put(f"{root}/works/updated_date=2020-01-09/empty.parquet", id=pa.array([], pa.string()))
    Path(f"{root}/works/updated_date=2020-01-02/f.parquet").write_bytes(b"PAR1 damaged")
    page = Path(f"{root}/works/updated_date=2020-01-04/f.parquet")
    held = bytearray(page.read_bytes())
    held[4:200] = b"\xff" * 196
    page.write_bytes(bytes(held))
    outcome = run_index(spark, root)
    assert counts(outcome) == {"works": (6, 4, 2, 0)}
    failed = {r["rel_path"]: r["error_message"] for r in outcome.failures.collect()}
    assert set(failed) == {f"works/updated_date=2020-01-0{k}/f.parquet" for k in (2, 4)}
    assert "of 300 rows can be read" in failed["works/updated_date=2020-01-04/f.parquet"]
    index = spark.read.parquet(index_path(root, "works"))
    assert index.count() == 900 and not index.where("parquet_file like '%-02/%' or parquet_file like '%-04/%'").count()
    assert not [p for p in Path(root).iterdir() if p.name.startswith(".draft")]


def test_datasets_are_folders(spark, tmp_path):
    """A dataset folder without files has no index to build, and fails the check of all indexes."""
    root = str(tmp_path)
    put(f"{root}/works/a.parquet", id=[f"{URL}W1"])
    for name in ("topics", "works_aws", "_meta", ".git"):
        os.makedirs(f"{root}/{name}")
    assert corpus.dataset_folders(spark, root) == ["topics", "works"]
    assert counts(run_index(spark, root)) == {"works": (1, 1, 0, 0)}
    outcome = run_verify_index(spark, root)
    assert counts(outcome) == {"topics": (1, 0, 2, 0), "works": (1, 1, 0, 0)}
    assert phases(outcome) == {"verify_index_exists": 1, "verify_index_corpus": 1}


def test_index_ranges_follow_the_rows(spark, tmp_path, monkeypatch):
    from stackroom.plans import index

    monkeypatch.setattr(index, "ROWS_PER_RANGE", 100)
    put(f"{tmp_path}/works/a.parquet", id=[f"{URL}W{k}" for k in range(950)])
    run_index(spark, str(tmp_path))
    made = [p for p in os.listdir(index_path(str(tmp_path), "works")) if p.endswith(".parquet")]
    assert 8 <= len(made) <= 10


# --- extract -----------------------------------------------------------------


def test_extract(spark, scheme, indexed, tmp_path):
    root, _ = indexed
    (tmp_path / "ids.csv").write_text(
        "id\nW1000000001\nW1000000001\nhttps://example.org/A123456789\nW7\nhttp://example.org/W1000000002\n"
        "X1\nS5\nS6\n"
    )
    done = run_extract(spark, root, f"{tmp_path}/ids.csv", f"{tmp_path}/out/sel.parquet", scheme, side_outputs=f"{tmp_path}/side")
    assert counts(done.outcome) == {"authors": (1, 1, 0, 0), "sources": (2, 0, 2, 0), "works": (3, 1, 0, 2)}
    assert phases(done.outcome) == {"extract_index_read": 1}
    assert done.outputs == {name: f"{tmp_path}/out/sel_{name}.parquet" for name in ("authors", "works")}
    works = spark.read.parquet(done.outputs["works"])
    assert works.columns == ["id", "title"]
    assert sorted(r["title"] for r in works.collect()) == ["Again", "Alpha"]
    missing = spark.read.option("header", "true").csv(f"{tmp_path}/side/extract-missing-ids")
    assert {tuple(r) for r in missing.collect()} == {
        ("works", f"{URL}W7"),
        ("works", "http://example.org/W1000000002"),
    }
    unknown = spark.read.option("header", "true").csv(f"{tmp_path}/side/extract-unknown-ids")
    assert {tuple(r) for r in unknown.collect()} == {("X1", "X1", "unmapped id format/prefix")}


def test_extract_one_dataset(spark, scheme, indexed, tmp_path):
    root, _ = indexed
    (tmp_path / "ids.csv").write_text("id\nA123456789\nW1000000002\n")
    done = run_extract(spark, root, f"{tmp_path}/ids.csv", f"{tmp_path}/out/sel.parquet", scheme, "works")
    assert counts(done.outcome) == {"works": (1, 1, 0, 0)}
    assert [r["reason"] for r in done.unknown.collect()] == ["filtered by --dataset=works"]
    assert done.missing.count() == 0


@pytest.mark.parametrize("large", [False, True])
def test_extract_is_the_same_beyond_its_bounds(spark, scheme, indexed, tmp_path, monkeypatch, large):
    """Schema drift and a missing file give the same columns, rows and failures either way."""
    from stackroom.operators import keyed
    from stackroom.plans import extract

    root, _ = indexed
    put(f"{root}/works/updated_date=2020-01-03/c.parquet", id=[f"{URL}W1000000003"], extra=["e"])
    run_index(spark, root, "works", overwrite=True)
    (tmp_path / "ids.csv").write_text("id\nW1000000001\nW1000000002\ndomains/2\n")
    if large:
        monkeypatch.setattr(extract, "MAX_BLOCKS", 0)
        monkeypatch.setattr(extract, "fits_broadcast", lambda keys, size: False)
        monkeypatch.setattr(keyed, "fits_broadcast", lambda keys, size: False)
    done = run_extract(spark, root, f"{tmp_path}/ids.csv", f"{tmp_path}/out/sel.parquet", scheme)
    rows = spark.read.parquet(done.outputs["works"])
    assert rows.columns == ["id", "title"]
    assert sorted(r["title"] for r in rows.collect()) == ["Again", "Alpha", "Beta"]
    assert counts(done.outcome)["works"] == (2, 2, 0, 0)
    (tmp_path / "more.csv").write_text("id\nW1000000001\nW1000000003\n")
    os.remove(f"{root}/works/updated_date=2020-01-03/c.parquet")
    gone = run_extract(spark, root, f"{tmp_path}/more.csv", f"{tmp_path}/out/gone.parquet", scheme)
    assert phases(gone.outcome) == {"extract_write_output": 1} and counts(gone.outcome)["works"] == (2, 0, 2, 0)


def test_output_path():
    assert output_path("/a/b/sel.parquet", "works") == "/a/b/sel_works.parquet"
    assert output_path("sel", "works") == "sel_works.parquet"


# --- manifest ----------------------------------------------------------------


@pytest.fixture
def mirrored(tmp_path):
    """A local mirror and its manifest: authors (two files, one without rows), works."""
    root = tmp_path / "parquet"
    files = {
        "authors": [
            put(root / "authors/updated_date=2020-01-01/p.parquet", id=["A1", "A2"], display_name=["Alice", "Bob"]),
            put(root / "authors/updated_date=2020-01-02/p.parquet", id=pa.array([], pa.string()), display_name=pa.array([], pa.string())),
        ],
        "works": [put(root / "works_aws/updated_date=2020-01-01/p.parquet", id=[f"W{i}" for i in range(2000)])],
    }
    entities = []
    for name, paths in files.items():
        listed = []
        for path in paths:
            rel = str(path.relative_to(root)).replace("works_aws/", "works/")
            meta = {"content_length": path.stat().st_size, "record_count": pq.read_metadata(path).num_rows}
            listed.append({"url": f"s3://b/data/parquet/{rel}", "meta": meta})
        size = sum(f["meta"]["content_length"] for f in listed)
        entities.append({"entity": name, "content_length": size, "files": listed, "extra": 1})
    total = {"record_count": 2002, "content_length": sum(e["content_length"] for e in entities)}
    manifest = {"date": "2020-01-03", "format": "parquet", "meta": total, "entities": entities}
    return root, manifest, tmp_path / "manifest.json"


def verify(spark, mirrored, dataset="all", mode="meta", check_extra=False):
    root, manifest, path = mirrored
    path.write_text(json.dumps(manifest, indent=1))
    return run_verify_download(spark, str(path), str(root), dataset, mode, check_extra)


@pytest.mark.parametrize("mode", ["quick", "meta", "full"])
def test_verify_download_good(spark, mirrored, mode):
    good = verify(spark, mirrored, mode=mode, check_extra=True)
    assert counts(good) == {"authors": (2, 2, 0, 0), "works": (1, 1, 0, 0)} and not phases(good)


def test_verify_download_failures(spark, mirrored):
    root, manifest, _ = mirrored
    with open(root / "works_aws/updated_date=2020-01-01/p.parquet", "ab") as file:
        file.write(b"junk")
    authors = manifest["entities"][0]["files"]
    authors[0]["meta"]["record_count"] = 3
    authors.append({"url": "s3://b/elsewhere/x.parquet", "meta": {"content_length": 1, "record_count": 1}})
    authors.append({"url": "s3://b/data/parquet/authors/gone.parquet", "meta": {"content_length": 1, "record_count": 1}})
    put(root / "authors/extra.parquet", id=["A9"])
    manifest["entities"].append({"entity": "topics", "content_length": 0, "files": []})
    bad = verify(spark, mirrored, check_extra=True)
    assert phases(bad) == {
        "validate_file_size": 1,
        "validate_parquet_rowcount": 1,
        "validate_manifest_url": 1,
        "validate_file_presence": 2,
    }
    assert counts(bad) == {"authors": (4, 0, 4, 0), "works": (1, 0, 1, 0), "topics": (0, 0, 0, 0)}
    messages = {r["error_message"] for r in bad.failures.collect()}
    assert "2 rows, the manifest says 3" in messages and "the manifest does not list this file" in messages
    assert phases(verify(spark, mirrored, mode="quick")) == {
        "validate_file_size": 1, "validate_manifest_url": 1, "validate_file_presence": 1,
    }
    assert counts(verify(spark, mirrored, dataset="works")) == {"works": (1, 0, 1, 0)}
    with pytest.raises(ValueError):
        verify(spark, mirrored, dataset="nothing")


def test_full_mode_finds_a_damaged_page(spark, mirrored):
    root, _, _ = mirrored
    path = root / "works_aws/updated_date=2020-01-01/p.parquet"
    content = bytearray(path.read_bytes())
    content[100:2000] = b"\xff" * 1900
    path.write_bytes(content)
    assert not phases(verify(spark, mirrored, mode="meta"))
    assert phases(verify(spark, mirrored, mode="full")) == {"validate_parquet_rowcount": 1}


def test_full_mode_leaves_extra_files_alone(spark, mirrored):
    """A file that the manifest does not list is not decoded, whatever is in it."""
    root, _, _ = mirrored
    (root / "works_aws/updated_date=2020-01-01/extra.parquet").write_bytes(b"PAR1 nothing")
    assert not phases(verify(spark, mirrored, mode="full"))


def test_damaged_footer_is_a_failure_row(spark, mirrored):
    root, _, _ = mirrored
    path = root / "works_aws/updated_date=2020-01-01/p.parquet"
    content = bytearray(path.read_bytes())
    content[-60:-8] = b"\xff" * 52
    path.write_bytes(content)
    assert phases(verify(spark, mirrored, mode="meta")) == {"validate_parquet_rowcount": 1}


def test_plan_download(spark, mirrored):
    _, manifest, path = mirrored
    path.write_text(json.dumps(manifest))
    entities = manifest_entities(read_manifest(spark, str(path)))
    plan = {r["dataset"]: r for r in plan_download(entities, manifest_files(entities)).collect()}
    assert plan["authors"]["n_files"] == 2 and plan["authors"]["record_count"] == 2
    size = manifest["entities"][0]["content_length"]
    assert plan["authors"]["required_bytes"] == size * 11 // 10


def test_bad_manifest_is_an_error(spark, tmp_path):
    (tmp_path / "m.json").write_text("{broken")
    with pytest.raises(Exception):
        read_manifest(spark, f"{tmp_path}/m.json").collect()
    (tmp_path / "n.json").write_text('{"date": "x"}')
    with pytest.raises(Exception, match="not a manifest"):
        read_manifest(spark, f"{tmp_path}/n.json").collect()


# --- runs --------------------------------------------------------------------


def test_steps_and_report(spark, indexed, tmp_path):
    root, outcome = indexed
    report = new_report(outcome, "index", {"root_dir": root}, 1_700_000_000_500, 1_700_000_003_000)
    append_report(report, outcome.failures, f"{tmp_path}/meta", 1_700_000_000_500)
    row = read_reports(spark, f"{tmp_path}/meta").first()
    assert (row["totals_items_scanned"], row["totals_succeeded"], row["duration_seconds"]) == (3, 3, 3.0)
    assert row["args"] == {"root_dir": root} and len(row["datasets"]) == 2

    later = new_report(outcome, "index", {}, 1_700_000_100_000, 1_700_000_101_000)
    append_report(later, outcome.failures, f"{tmp_path}/meta", 1_700_000_100_000)
    os.remove(f"{root}/works/updated_date=2020-01-02/b.parquet")
    bad = run_verify_index(spark, root)
    append_report(new_report(bad, "verify_index", {}, 1_700_000_200_000, 1_700_000_201_000), bad.failures, f"{tmp_path}/meta", 1_700_000_200_000)
    reports = read_reports(spark, f"{tmp_path}/meta")
    assert {(r["command"], r["file_stamp"]) for r in latest_per_command(reports).collect()} == {
        ("index", 1_700_000_100_000), ("verify_index", 1_700_000_200_000),
    }
    assert [r["file_stamp"] for r in prunable_reports(reports, 1, "index").collect()] == [1_700_000_000_500]
    found = reports.where("command = 'verify_index'").first()
    assert {f["phase"] for f in found["failures"]} == {"verify_index_count"} and found["totals_failed"] == 1
    assert spark.read.parquet(f"{tmp_path}/meta-failures").count() == 1
    put(f"{root}/works/updated_date=2020-01-02/b.parquet", id=[f"{URL}W1000000002", f"{URL}W1000000001"], title=["Beta", "Again"])

    def broken():
        raise RuntimeError("no index")

    calls = {"verify_index": lambda: run_verify_index(spark, root), "extract": broken, "index": lambda: outcome}
    steps = [(r["step"], r["status"], r["message"]) for r in run_steps(spark, calls).collect()]
    assert steps == [("verify_index", "ok", None), ("extract", "failed", "no index")]
