"""Ids, the id index, and extraction by id."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stackroom.functions.ids import canonical_id, dataset_of, id_block, normalize_id
from stackroom.operators.keyed import semi_join
from stackroom.plans.extract import (
    extract_summary,
    in_requested_blocks,
    lookup,
    matched_ids,
    matching_rows,
    missing_ids,
    split_requests,
)
from stackroom.plans.index import index_rows
from stackroom.session import checkpointed
from workload.tables import SCHEME, full_id, table


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested ids (``raw``) in every form: short, full, quoted, slashed, unknown."""

    def raw(name: str, value: Column) -> DataFrame:
        return table(spark, sf_dir, name).select(value.alias("raw"))

    customer, priority = _text("o_custkey"), F.col("o_orderpriority")
    authors = (
        F.when(priority == "1-URGENT", F.concat(F.lit("A"), customer))
        .when(priority == "2-HIGH", F.concat(F.lit("\t\"'A"), customer, F.lit("'\" ")))
        .when(priority == "3-MEDIUM", F.concat(F.lit("http://example.org/A"), customer))
        .when(priority == "4-NOT SPECIFIED", F.concat(F.lit(" /A"), customer, F.lit("// ")))
        .otherwise(F.concat(F.lit("a"), customer))
    )
    parts = [
        raw("labels", F.concat(F.lit("W"), _text("doc_id"))),
        raw("orders", full_id("W", F.col("o_orderkey"))),
        raw("orders", authors),
        raw("lineitem", F.concat(F.lit("S"), _text("l_suppkey"))),
        raw("part", F.col("p_name")),
        raw("nation", F.concat(F.lit("Countries/"), F.col("n_name"))),
        raw("customer", F.concat(F.lit("https://example.org/"), F.col("c_mktsegment"), F.lit("/"))),
        raw("pages", F.col("url")),
    ]
    return reduce(DataFrame.unionByName, parts)


def _corpora(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    works = table(spark, sf_dir, "documents").select(
        full_id("W", F.col("doc_id")).alias("id"), "text", "lang", "source", "n_chars"
    )
    authors = table(spark, sf_dir, "customer").select(
        full_id("A", F.col("c_custkey")).alias("id"), "c_name", "c_acctbal"
    )
    sources = table(spark, sf_dir, "supplier").select(
        full_id("S", F.col("s_suppkey")).alias("id"), "s_name", "s_acctbal"
    )
    return {"works": works, "authors": authors, "sources": sources}


def _index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index of the three corpora, one file per language and source for the works."""
    corpora = _corpora(spark, sf_dir)
    files = {
        "works": F.concat(F.lit("works/"), "lang", F.lit("/"), "source", F.lit(".parquet")),
        "authors": F.lit("authors/part.parquet"),
        "sources": F.lit("sources/part.parquet"),
    }
    parts = [rows.select("id", files[name].alias("parquet_file")) for name, rows in corpora.items()]
    return reduce(DataFrame.unionByName, parts)


def _hits(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Requests and index hits; both are used several times, so their lineage is cut."""
    accepted = checkpointed(split_requests(_requests(spark, sf_dir), SCHEME).accepted)
    return accepted, checkpointed(lookup(_index(spark, sf_dir), accepted))


def id_blocks(spark, sf_dir):
    """Ids whose numbers reach beyond 32 and 64 bits, and ids without one."""
    digits = F.concat(_text("l_orderkey"), F.lpad(_text("l_partkey"), 9, "0"), F.lpad(_text("l_suppkey"), 6, "0"))
    ids = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("https://example.org/"), F.col("l_returnflag"), digits).alias("id")
    ).unionByName(table(spark, sf_dir, "documents").select(F.col("text").alias("id")))
    return ids.select("id", id_block(F.col("id")).alias("id_block"))


def id_normalize(spark, sf_dir):
    raw = F.col("raw")
    return _requests(spark, sf_dir).select(
        "raw",
        normalize_id(raw, SCHEME).alias("normalized"),
        canonical_id(raw, SCHEME).alias("canonical"),
    )


def id_route(spark, sf_dir):
    normalized = normalize_id(F.col("raw"), SCHEME)
    routed = _requests(spark, sf_dir).select(dataset_of(normalized).alias("dataset"))
    return routed.groupBy("dataset").agg(F.count(F.lit(1)).alias("n"))


def index_build(spark, sf_dir):
    """Index of the line items as they lie in their file."""
    number = F.col("l_orderkey") * 100_000 + F.col("l_partkey")
    return index_rows(table(spark, sf_dir, "lineitem"), sf_dir, full_id("W", number))


def index_datasets(spark, sf_dir):
    """Per dataset: entries, blocks and the range of row numbers."""
    parts = [
        index_rows(table(spark, sf_dir, name), sf_dir, full_id(letter, F.col(key)))
        for name, letter, key in (
            ("orders", "W", "o_orderkey"),
            ("customer", "A", "c_custkey"),
            ("supplier", "S", "s_suppkey"),
            ("part", "T", "p_partkey"),
        )
    ]
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy("parquet_file")
        .agg(
            F.count("id").alias("ids"),
            F.countDistinct("id_block").alias("blocks"),
            F.min("file_row_number").alias("first_row"),
            F.max("file_row_number").alias("last_row"),
        )
    )


def request_counts(spark, sf_dir):
    accepted = split_requests(_requests(spark, sf_dir), SCHEME).accepted
    return accepted.groupBy("dataset").agg(F.count(F.lit(1)).alias("n"))


def lookup_files(spark, sf_dir):
    _, hits = _hits(spark, sf_dir)
    return hits.groupBy("parquet_file").agg(F.sum("n_rows").alias("n"))


def _rows_of(dataset: str):
    def query(spark, sf_dir):
        _, hits = _hits(spark, sf_dir)
        return matching_rows(_corpora(spark, sf_dir)[dataset], matched_ids(hits))

    return query


def extract_missing(spark, sf_dir):
    accepted, hits = _hits(spark, sf_dir)
    return missing_ids(accepted, matched_ids(hits))


def extract_unknown(spark, sf_dir):
    return split_requests(_requests(spark, sf_dir), SCHEME).unknown


def extract_filtered(spark, sf_dir):
    return split_requests(_requests(spark, sf_dir), SCHEME, only="authors").unknown


def extract_counts(spark, sf_dir):
    accepted, hits = _hits(spark, sf_dir)
    return extract_summary(accepted, matched_ids(hits))


def lookup_beyond_bound(spark, sf_dir):
    """The lookup as it runs when the requests are too large to broadcast."""
    accepted = split_requests(_requests(spark, sf_dir), SCHEME).accepted
    hits = lookup(_index(spark, sf_dir), accepted, max_bytes=0)
    return hits.groupBy("parquet_file").agg(F.sum("n_rows").alias("n"))


def extract_beyond_bound(spark, sf_dir):
    """Row extraction with both sides shuffled and every id that is there twice salted."""
    _, hits = _hits(spark, sf_dir)
    return semi_join(_corpora(spark, sf_dir)["works"], matched_ids(hits), "id", max_bytes=0, hot_rows=2)


def lookup_in_blocks(spark, sf_dir):
    """Sources found in an index that is filtered by the blocks of the requests."""
    accepted = split_requests(_requests(spark, sf_dir), SCHEME).accepted.where(F.col("dataset") == "sources")
    index = _index(spark, sf_dir).withColumn("id_block", id_block(F.col("id")))
    return lookup(in_requested_blocks(index, accepted), accepted)


QUERIES = {
    "id_block": id_blocks,
    "id_normalize": id_normalize,
    "id_route": id_route,
    "index_build": index_build,
    "index_datasets": index_datasets,
    "request_counts": request_counts,
    "lookup_files": lookup_files,
    "extract_rows": _rows_of("works"),
    "extract_rows_authors": _rows_of("authors"),
    "extract_rows_sources": _rows_of("sources"),
    "extract_missing": extract_missing,
    "extract_unknown": extract_unknown,
    "extract_filtered": extract_filtered,
    "extract_summary": extract_counts,
    "lookup_beyond_bound": lookup_beyond_bound,
    "extract_beyond_bound": extract_beyond_bound,
    "lookup_in_blocks": lookup_in_blocks,
}

_BLOCK = """
CAST((TRY_CAST(regexp_extract(id, '([0-9]+)$', 1) AS BIGINT) // 10000 + 2147483648) % 4294967296 - 2147483648 AS INTEGER)
"""

_REQUESTS = """
requests AS (
  SELECT 'W' || doc_id AS raw FROM labels
  UNION ALL SELECT 'https://example.org/W' || o_orderkey FROM orders
  UNION ALL SELECT CASE o_orderpriority
      WHEN '1-URGENT' THEN 'A' || o_custkey
      WHEN '2-HIGH' THEN chr(9) || '"''A' || o_custkey || '''" '
      WHEN '3-MEDIUM' THEN 'http://example.org/A' || o_custkey
      WHEN '4-NOT SPECIFIED' THEN ' /A' || o_custkey || '// '
      ELSE 'a' || o_custkey END FROM orders
  UNION ALL SELECT 'S' || l_suppkey FROM lineitem
  UNION ALL SELECT p_name FROM part
  UNION ALL SELECT 'Countries/' || n_name FROM nation
  UNION ALL SELECT 'https://example.org/' || c_mktsegment || '/' FROM customer
  UNION ALL SELECT url FROM pages),
bare AS (
  SELECT raw, trim(trim(regexp_replace(raw, '^\\s+|\\s+$', '', 'g'), '"'), '''') AS t FROM requests),
ids AS (
  SELECT raw, trim(regexp_replace(t, '^https?://example[.]org/', ''), '/') AS normalized,
         CASE WHEN regexp_matches(t, '^https?://example[.]org/') THEN t
              ELSE 'https://example.org/' || trim(t, '/') END AS canonical
  FROM bare),
routed AS (
  SELECT *, CASE
    WHEN contains(normalized, '/') THEN CASE
      WHEN lower(split_part(normalized, '/', 1)) IN ('institution-types', 'work-types', 'source-types',
           'licenses', 'countries', 'continents', 'languages', 'domains', 'fields', 'subfields', 'sdgs')
      THEN lower(split_part(normalized, '/', 1)) END
    ELSE CASE upper(left(normalized, 1))
      WHEN 'W' THEN 'works' WHEN 'A' THEN 'authors' WHEN 'S' THEN 'sources' WHEN 'I' THEN 'institutions'
      WHEN 'T' THEN 'topics' WHEN 'K' THEN 'keywords' WHEN 'P' THEN 'publishers' WHEN 'F' THEN 'funders'
      WHEN 'G' THEN 'awards' WHEN 'C' THEN 'concepts' END END AS dataset
  FROM ids),
accepted AS (SELECT DISTINCT dataset, canonical AS id FROM routed WHERE dataset IS NOT NULL),
works AS (SELECT 'https://example.org/W' || doc_id AS id, text, lang, source, n_chars FROM documents),
authors AS (SELECT 'https://example.org/A' || c_custkey AS id, c_name, c_acctbal FROM customer),
sources AS (SELECT 'https://example.org/S' || s_suppkey AS id, s_name, s_acctbal FROM supplier),
idx AS (
  SELECT id, 'works/' || lang || '/' || source || '.parquet' AS parquet_file FROM works
  UNION ALL SELECT id, 'authors/part.parquet' FROM authors
  UNION ALL SELECT id, 'sources/part.parquet' FROM sources)
"""


def _requested(dataset: str) -> str:
    return f"WITH {_REQUESTS} SELECT * FROM {dataset} WHERE id IN (SELECT id FROM accepted)"


def _positions(name: str, letter: str, key: str) -> str:
    return f"""SELECT 'https://example.org/{letter}' || {key} AS id, '{name}.parquet' AS parquet_file,
                      row_number() OVER () - 1 AS file_row_number FROM {name}"""


SQL = {
    "id_block": f"""
        WITH ids AS (
          SELECT 'https://example.org/' || l_returnflag || l_orderkey || lpad(CAST(l_partkey AS VARCHAR), 9, '0')
                 || lpad(CAST(l_suppkey AS VARCHAR), 6, '0') AS id FROM lineitem
          UNION ALL SELECT text FROM documents)
        SELECT id, {_BLOCK} AS id_block FROM ids""",
    "id_normalize": f"WITH {_REQUESTS} SELECT raw, normalized, canonical FROM ids",
    "id_route": f"WITH {_REQUESTS} SELECT dataset, count(*) AS n FROM routed GROUP BY dataset",
    "index_build": f"""
        WITH rows AS ({_positions('lineitem', 'W', '(l_orderkey * 100000 + l_partkey)')})
        SELECT id, {_BLOCK} AS id_block, parquet_file, file_row_number FROM rows""",
    "index_datasets": f"""
        WITH rows AS ({_positions('orders', 'W', 'o_orderkey')} UNION ALL {_positions('customer', 'A', 'c_custkey')}
          UNION ALL {_positions('supplier', 'S', 's_suppkey')} UNION ALL {_positions('part', 'T', 'p_partkey')})
        SELECT parquet_file, count(id) AS ids, count(DISTINCT {_BLOCK}) AS blocks,
               min(file_row_number) AS first_row, max(file_row_number) AS last_row
        FROM rows GROUP BY parquet_file""",
    "request_counts": f"WITH {_REQUESTS} SELECT dataset, count(*) AS n FROM accepted GROUP BY dataset",
    "lookup_files": f"""
        WITH {_REQUESTS} SELECT parquet_file, count(*) AS n FROM idx
        WHERE id IN (SELECT id FROM accepted) GROUP BY parquet_file""",
    "lookup_beyond_bound": f"""
        WITH {_REQUESTS} SELECT parquet_file, count(*) AS n FROM idx
        WHERE id IN (SELECT id FROM accepted) GROUP BY parquet_file""",
    "lookup_in_blocks": f"""
        WITH {_REQUESTS} SELECT id, parquet_file, count(*) AS n_rows FROM idx
        WHERE id IN (SELECT id FROM accepted WHERE dataset = 'sources') GROUP BY id, parquet_file""",
    "extract_beyond_bound": _requested("works"),
    "extract_rows": _requested("works"),
    "extract_rows_authors": _requested("authors"),
    "extract_rows_sources": _requested("sources"),
    "extract_missing": f"""
        WITH {_REQUESTS} SELECT dataset, id FROM accepted WHERE id NOT IN (SELECT id FROM idx)""",
    "extract_unknown": f"""
        WITH {_REQUESTS} SELECT raw AS raw_id, normalized AS normalized_id,
               'unmapped id format/prefix' AS reason
        FROM routed WHERE dataset IS NULL""",
    "extract_filtered": f"""
        WITH {_REQUESTS} SELECT raw AS raw_id, normalized AS normalized_id,
               CASE WHEN dataset IS NULL THEN 'unmapped id format/prefix'
                    ELSE 'filtered by --dataset=authors' END AS reason
        FROM routed WHERE dataset IS NULL OR dataset <> 'authors'""",
    "extract_summary": f"""
        WITH {_REQUESTS} SELECT dataset, count(*) AS items_scanned,
               count(*) FILTER (id IN (SELECT id FROM idx)) AS succeeded, CAST(0 AS BIGINT) AS failed,
               count(*) FILTER (id NOT IN (SELECT id FROM idx)) AS skipped
        FROM accepted GROUP BY dataset""",
}
