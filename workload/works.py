"""Abstracts and citations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stackroom.functions.abstracts import (
    _bind,
    abstract_from_json,
    abstract_from_map,
    parse_inverted_index,
)
from stackroom.functions.citations import author_display_name, citation
from stackroom.plans.enrich import enrich
from workload.tables import full_id, table


def _words(text: Column) -> Column:
    return F.filter(F.split(text, " "), lambda word: word != "")


def inverted_map(text: Column) -> Column:
    """word -> positions of a text, within the row: sort by word, then cut at each new word."""
    located = F.sort_array(
        F.transform(_words(text), lambda w, i: F.struct(w.alias("word"), i.cast("bigint").alias("pos")))
    )

    def grouped(words: Column, positions: Column) -> Column:
        n = F.size(words)
        starts = F.filter(
            F.sequence(F.lit(0), n - 1),
            lambda i: (i == 0) | (F.get(words, i) != F.get(words, i - 1)),
        )

        def entries(firsts: Column) -> Column:
            ends = F.concat(F.slice(firsts, F.lit(2), n), F.array(n))
            of_word = F.zip_with(
                firsts, ends, lambda first, end: F.slice(positions, first + 1, end - first)
            )
            return F.map_from_arrays(F.array_distinct(words), of_word)

        return F.when(n > 0, _bind(starts, entries)).otherwise(
            F.create_map().cast("map<string,array<bigint>>")
        )

    return _bind(
        located,
        lambda pairs: _bind(
            pairs["word"],
            lambda words: _bind(pairs["pos"], lambda positions: grouped(words, positions)),
        ),
    )


def _entry_per_word(text: Column) -> Column:
    """Inverted index that repeats the key for every occurrence of a word."""
    entry = F.transform(
        _words(text), lambda w, i: F.to_json(F.create_map(w, F.array(i.cast("bigint"))))
    )
    bare = F.transform(entry, lambda e: F.substring(e, F.lit(2), F.length(e) - 2))
    return F.concat(F.lit("{"), F.array_join(bare, ","), F.lit("}"))


def derived_works(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as works. Authors are the first words of the lines, null where the
    word ends a sentence; Spanish works have no author list, German ones no year."""
    name = F.transform(F.split("text", "\n"), lambda line: F.substring_index(line, " ", 1))
    authorships = F.transform(
        name, lambda n: F.struct(F.struct(F.when(~n.contains("."), n).alias("display_name")).alias("author"))
    )
    return table(spark, sf_dir, "documents").select(
        full_id("W", F.col("doc_id")).alias("id"),
        F.to_json(inverted_map(F.col("text"))).alias("abstract_inverted_index"),
        F.when(F.col("lang") != "es", authorships).alias("authorships"),
        F.when(F.col("lang") != "de", F.col("n_chars").cast("int")).alias("publication_year"),
    )


def abstract_roundtrip(spark, sf_dir):
    index = F.to_json(inverted_map(F.col("text")))
    return table(spark, sf_dir, "documents").select("doc_id", abstract_from_json(index).alias("abstract"))


def abstract_native_map(spark, sf_dir):
    index = inverted_map(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", abstract_from_map(index).alias("abstract"))


def abstract_repeated_keys(spark, sf_dir):
    index = _entry_per_word(F.col("text"))
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", abstract_from_json(index).alias("abstract")
    )


def abstract_malformed(spark, sf_dir):
    """Event properties such as {"k": 69} in forms that are, and are not, an index."""
    props, kind = F.col("props"), F.col("event_type")
    as_list = F.regexp_replace(props, "([0-9]+)", "[$1]")
    text = (
        F.when(kind == "view", props)
        .when(kind == "click", as_list)
        .when(kind == "error", F.regexp_replace(as_list, r"\}", ""))
        .when(kind == "signup", "{}")
        .when(kind == "purchase", F.concat(as_list, F.lit(" and more")))
    )
    return table(spark, sf_dir, "events").select("event_id", abstract_from_json(text).alias("abstract"))


def inverted_index_entries(spark, sf_dir):
    entries = parse_inverted_index(F.to_json(inverted_map(F.col("text"))))
    positions = F.aggregate(
        entries, F.lit(0).cast("bigint"), lambda acc, e: acc + F.size(e["value"]).cast("bigint")
    )
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.size(entries).cast("bigint").alias("words"), positions.alias("positions")
    )


def citations(spark, sf_dir):
    works = derived_works(spark, sf_dir)
    return works.select("id", citation(F.col("authorships"), F.col("publication_year")).alias("citation"))


def author_names(spark, sf_dir):
    works = derived_works(spark, sf_dir)
    authors = F.col("authorships")
    return works.select(
        "id",
        author_display_name(authors, 0).alias("first_author"),
        author_display_name(authors, 1).alias("second_author"),
    )


def enrich_works(spark, sf_dir):
    return enrich(derived_works(spark, sf_dir)).select("id", "publication_year", "abstract", "citation")


def enrich_abstract_only(spark, sf_dir):
    """Works without authors get an abstract and no citation."""
    return enrich(derived_works(spark, sf_dir).drop("authorships")).select("id", "publication_year", "abstract")


def enrich_citation_only(spark, sf_dir):
    """Works without an inverted index get a citation and no abstract."""
    return enrich(derived_works(spark, sf_dir).drop("abstract_inverted_index")).select("id", "publication_year", "citation")


QUERIES = {
    "abstract_roundtrip": abstract_roundtrip,
    "abstract_native_map": abstract_native_map,
    "abstract_repeated_keys": abstract_repeated_keys,
    "abstract_malformed": abstract_malformed,
    "inverted_index_entries": inverted_index_entries,
    "citation": citations,
    "author_names": author_names,
    "enrich_works": enrich_works,
    "enrich_abstract_only": enrich_abstract_only,
    "enrich_citation_only": enrich_citation_only,
}

_JOINED = "array_to_string(list_filter(string_split(text, ' '), lambda w: w <> ''), ' ')"

_AUTHORS = """
works AS (
  SELECT 'https://example.org/W' || doc_id AS id, text,
         CASE WHEN lang <> 'de' THEN CAST(n_chars AS INTEGER) END AS publication_year,
         CASE WHEN lang <> 'es' THEN list_transform(string_split(text, chr(10)),
           lambda line: CASE WHEN NOT contains(split_part(line, ' ', 1), '.')
                             THEN split_part(line, ' ', 1) END) END AS names
  FROM documents)
"""

_CITATION = """
CASE WHEN names IS NULL OR len(names) = 0 THEN NULL
     WHEN len(names) = 1 THEN names[1] || ' (' || coalesce(CAST(publication_year AS VARCHAR), 'n.d.') || ')'
     WHEN len(names) = 2 THEN names[1] || ' & ' || names[2] || ' ('
          || coalesce(CAST(publication_year AS VARCHAR), 'n.d.') || ')'
     ELSE names[1] || ' et al. (' || coalesce(CAST(publication_year AS VARCHAR), 'n.d.') || ')' END
"""

SQL = {
    "abstract_roundtrip": f"SELECT doc_id, {_JOINED} AS abstract FROM documents",
    "abstract_native_map": f"SELECT doc_id, {_JOINED} AS abstract FROM documents",
    "abstract_repeated_keys": f"SELECT conv_id, turn, {_JOINED} AS abstract FROM conversations",
    "abstract_malformed": """
        SELECT event_id, CASE WHEN event_type IN ('click', 'purchase') THEN 'k'
                              WHEN event_type = 'signup' THEN '' END AS abstract
        FROM events""",
    "inverted_index_entries": """
        SELECT doc_id, CAST(len(list_distinct(list_filter(string_split(text, ' '), lambda w: w <> ''))) AS BIGINT) AS words,
               CAST(len(list_filter(string_split(text, ' '), lambda w: w <> '')) AS BIGINT) AS positions
        FROM documents""",
    "citation": f"WITH {_AUTHORS} SELECT id, {_CITATION} AS citation FROM works",
    "author_names": f"WITH {_AUTHORS} SELECT id, names[1] AS first_author, names[2] AS second_author FROM works",
    "enrich_abstract_only": f"WITH {_AUTHORS} SELECT id, publication_year, {_JOINED} AS abstract FROM works",
    "enrich_citation_only": f"WITH {_AUTHORS} SELECT id, publication_year, {_CITATION} AS citation FROM works",
    "enrich_works": f"""
        WITH {_AUTHORS}
        SELECT id, publication_year, {_JOINED} AS abstract, {_CITATION} AS citation FROM works""",
}
