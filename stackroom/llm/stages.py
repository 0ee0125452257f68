"""Stages of a corpus pipeline: each applies one operator to all documents it is given.

A stage takes ``docs`` and, but for the last, returns its columns; extra columns travel along
whatever their names, for a row stays one value inside each stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stackroom.llm import cuckoo, line_rules, packing, simhash, suffix_index
from stackroom.llm.common import kept_table, one_space
from stackroom.operators.keyed import fits_broadcast


def _replaced(docs: DataFrame, text: Column) -> list[Column]:
    """The fields of ``row`` with another text, and its length where ``n_chars`` tells it."""
    new = {"text": text.alias("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length(text).cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return [new.get(c, F.col("row")[c].alias(c)) for c in docs.columns]


def _rows(docs: DataFrame) -> list[Column]:
    return [F.col("row")[c].alias(c) for c in docs.columns]


def clean(docs: DataFrame) -> DataFrame:
    """Failing lines go, and documents that the quality rules reject."""
    rows = docs.select(F.struct("*").alias("row"), F.col("text"))
    judged = line_rules.with_verdict(rows)
    # Not a filter: it would be pushed below the measures and make each of them anew.
    stay = judged.select(F.inline(F.when(F.col("kept"), F.array(F.struct("row", "clean_text")))))
    return stay.select(*_replaced(docs, F.col("clean_text")))


def _but(rows: DataFrame, gone: DataFrame, on: list[str]) -> DataFrame:
    """``rows`` without those ``gone``. These are narrow, and few where copies are few: rows stay
    where they are if the measured size of what goes can be sent to them."""
    return rows.join(F.broadcast(gone) if fits_broadcast(gone) else gone, on, "left_anti")


def distinct(docs: DataFrame) -> DataFrame:
    """Of documents with equal texts (up to white space) the one with the smallest id stays.

    What goes is found on ids and digests alone. Rows that repeat an id and a text become one;
    only these few meet as whole rows.
    """
    id_ = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    named = cuckoo.exact_groups(docs).select(id_.alias("_id"), "digest", "kept")
    named = named.groupBy("_id", "digest").agg(F.bool_and("kept").alias("kept"), F.count("*").alias("n"))
    named = kept_table(named.where("not kept or n > 1"), "copies")
    digest = F.sha2(one_space(F.col("text")).cast("binary"), 256)
    rows = docs.select(F.struct("*").alias("row"), id_.alias("_id"), F.unhex(digest).alias("digest"))
    single = _but(rows, named.select("_id", "digest"), ["_id", "digest"]).select(*_rows(docs))
    again = named.where("kept")
    if again.isEmpty():
        return single
    repeated = rows.join(again.select("_id", "digest"), ["_id", "digest"], "left_semi").dropDuplicates(["_id", "digest"])
    return single.unionByName(repeated.select(*_rows(docs)))


def not_near(docs: DataFrame) -> DataFrame:
    """Of documents linked by their fingerprints (three-word shingles, two bits or fewer) one stays:
    the one with the smallest id, a null id being larger than any other. Rows that repeat an id
    are told apart by their texts."""
    groups = simhash.near_groups(docs, keyed=True)
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "k1", "k2")
    first = groups.groupBy("component").agg(F.min(rank).alias("first"), F.count("*").alias("n")).where("n > 1")
    gone = groups.join(kept_table(first.drop("n"), "firsts"), "component").where(rank != F.col("first"))
    id_ = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    gone = kept_table(gone.select(id_.alias("_id"), F.col("k1").alias("_k1"), F.col("k2").alias("_k2")).distinct(), "near-copies")
    k1, k2 = suffix_index.text_key(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    rows = docs.select(F.struct("*").alias("row"), id_.alias("_id"), k1.alias("_k1"), k2.alias("_k2"))
    return _but(rows, gone, ["_id", "_k1", "_k2"]).select(*_rows(docs))


def without_passages(docs: DataFrame) -> DataFrame:
    """Passages of over 50 words, or of 400 bytes or more (which may hold fewer words, or be
    written without spaces), that occur elsewhere are cut out; documents of which no word is left
    go."""
    cut = suffix_index.with_texts_cut(docs, by_words=True).where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return cut.select(F.struct("*").alias("row")).select(*_replaced(docs, F.col("row")["text"]))


def packed(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens, with their ids."""
    return packing.packed(docs, vocabulary)
