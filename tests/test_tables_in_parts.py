"""Queries over files where a table is a folder of several, one of them without rows."""

import os

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from oracle import _rows

from __spark_entry__ import oracle_sql, queries
from stackroom.sources.corpus import file_row_counts
from workload.tables import TABLES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def in_parts(tmp_path_factory):
    """labels in three files, one of them empty; region a folder without a row; the rest as given."""
    root, con = tmp_path_factory.mktemp("parts"), duckdb.connect()
    for name in TABLES:
        given, here = f"{SF_DIR}/{name}.parquet", f"{root}/{name}.parquet"
        cuts = {"labels": ["doc_id % 2 = 0", "doc_id % 2 = 1", "false"], "region": ["false"]}.get(name)
        if cuts is None:
            os.symlink(given, here)
        else:
            os.mkdir(here)
        for k, cut in enumerate(cuts or []):
            con.execute(f"COPY (SELECT * FROM '{given}' WHERE {cut}) TO '{here}/part-{k}.parquet'")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{here}{'/*.parquet' if cuts else ''}')")
    return str(root), con


@pytest.mark.parametrize("name", ["file_counts", "file_counts_decoded", "corpus_files"])
def test_a_table_is_a_file_or_a_folder(spark, in_parts, name):
    root, con = in_parts
    got, want = queries()[name](spark, root).toArrow(), con.execute(oracle_sql()[name]).to_arrow_table()
    assert sorted(got.column_names) == sorted(want.column_names)
    assert _rows(got) == _rows(want) and got.num_rows == len(TABLES)


def test_a_damaged_part_is_not_decoded(spark, in_parts, tmp_path):
    root, _ = in_parts
    for name in os.listdir(root):
        os.symlink(f"{root}/{name}", tmp_path / name) if name != "region.parquet" else os.mkdir(tmp_path / name)
    (tmp_path / "region.parquet" / "part-0.parquet").write_bytes(b"no parquet")
    os.symlink(f"{SF_DIR}/region.parquet", tmp_path / "region.parquet" / "part-1.parquet")
    got = queries()["file_counts_decoded"](spark, str(tmp_path))
    assert "xxhash64" in got._jdf.queryExecution().optimizedPlan().toString()
    assert [r["rel_path"] for r in got.where("NOT decoded").collect()] == ["region.parquet"]


@pytest.fixture
def own_tables(tmp_path):
    """Every table of two rows; orders a folder of three files. Beside them lies what is no table."""
    rows = pa.table({"id": [1, 2]})
    for name in TABLES:
        if name == "orders":
            (tmp_path / "orders.parquet/day=1").mkdir(parents=True)
            for k, cut in enumerate([rows[:1], rows[1:], rows[:0]]):
                pq.write_table(cut, tmp_path / f"orders.parquet/day=1/a b+c%{k}.parquet")
        else:
            pq.write_table(rows, tmp_path / f"{name}.parquet")
    (tmp_path / "beside.parquet").write_bytes(b"PAR1 damaged")
    (tmp_path / "none.parquet").write_bytes(b"")
    return tmp_path


@pytest.mark.parametrize("name", ["file_counts", "corpus_files"])
def test_a_part_that_cannot_be_read_is_no_count(spark, own_tables, name):
    def counted():
        return {r["rel_path"]: r["n_rows"] for r in queries()[name](spark, str(own_tables)).collect()}

    assert counted() == {f"{table}.parquet": 2 for table in TABLES}
    part = own_tables / "orders.parquet/day=1/a b+c%1.parquet"
    whole = part.read_bytes()
    for damaged in (whole[:-20], b"PAR1 damaged", b""):
        part.write_bytes(damaged)
        with pytest.raises(Exception, match="a%20b\\+c%251.parquet|a b\\+c%1.parquet"):
            counted()
    part.write_bytes(whole)
    (own_tables / "region.parquet").write_bytes(b"")
    with pytest.raises(Exception, match="region.parquet"):
        counted()


@pytest.mark.parametrize("left", ["nothing", "a folder"])
def test_a_table_without_files_is_no_count(spark, own_tables, left):
    (own_tables / "region.parquet").unlink()
    if left == "a folder":
        (own_tables / "region.parquet").mkdir()
    with pytest.raises(Exception, match="no parquet file of table region.parquet"):
        queries()["file_counts"](spark, str(own_tables)).collect()


def test_damaged_files_are_skipped_when_asked(spark, own_tables):
    got = file_row_counts(spark, str(own_tables), skip_damaged=True).collect()
    assert sum(r["n_rows"] for r in got) == 2 * len(TABLES)
    with pytest.raises(ValueError, match="they hold no bytes: none.parquet"):
        file_row_counts(spark, str(own_tables))
