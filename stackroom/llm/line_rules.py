"""Line-first quality rules, in built-in expressions only.

Every line is judged alone: a line fails when symbols or exclamations crowd it or a long
line has no punctuation at all, when it is a menu, or when it is boilerplate. Failing lines
are removed, and a document that loses more than ``MAX_LOSS`` percent of its characters is
rejected, as is one that fails the base rules (too few words, or mostly repeated words).

Results for odd input: a null or empty text has no words and fails the base rules; an empty
table gives an empty table; rows that repeat an id are judged one by one. All work is inside
the row and linear in the text but for one sort of three-word windows, made only for texts in
which a window occurs twice.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stackroom.llm.common import words

MIN_WORDS = 50
MAX_REPEATED = 50
MAX_LOSS = 30

#: Fixed values of the rules.
SYMBOLS = "#*$%&|<>"
SEPARATORS = "|»›•·"
MENU = (
    r"(?i)^[\s|>/»›•·-]*(home|menu|login|log in|sign in|sign up|register|search|contact|contact us|about|about us|help|faq"
    r"|next|previous|back|top|share|print|sitemap|skip to content|read more|subscribe)"
    r"([\s|>/»›•·-]+(home|menu|login|log in|sign in|sign up|register|search|contact|contact us|about|about us|help|faq"
    r"|next|previous|back|top|share|print|sitemap|skip to content|read more|subscribe))*[\s|>/»›•·-]*$"
)
BOILERPLATE = (
    "all rights reserved",
    "cookie policy",
    "privacy policy",
    "terms of use",
    "terms of service",
    "accept cookies",
    "accept all cookies",
    "enable javascript",
    "click here to",
    "subscribe to our newsletter",
    "follow us on",
    "lorem ipsum",
    "page not found",
    "powered by wordpress",
)
MAX_BOILERPLATE_CHARS = 200
LONG_LINE = 80


def count_of(text: Column, characters: str) -> Column:
    return F.length(F.regexp_replace(text, f"[^{characters}]+", ""))


def line_fails(line: Column) -> Column:
    n = F.length(line)
    short = n <= MAX_BOILERPLATE_CHARS
    shouts = n - F.length(F.replace(line, F.lit("!!"), F.lit("")))
    # A cheap look spares most lines the counts; a class of ASCII characters alone is the cheapest.
    marked = line.rlike(f"[{SYMBOLS}!]") | reduce(or_, [line.contains(c) for c in SEPARATORS])
    crowded = marked & ((20 * count_of(line, SYMBOLS) > n) | (20 * shouts > n))
    punctuation = crowded | ((n > LONG_LINE) & ~line.rlike("[.,;:!?…。、！？।؟]"))
    separators = count_of(line, SEPARATORS)
    navigation = (marked & (separators >= 3) & (30 * separators > n)) | (short & line.rlike(MENU))
    any_phrase = F.exists(F.array(F.lower(line)), lambda low: reduce(or_, [low.contains(p) for p in BOILERPLATE]))
    boilerplate = short & any_phrase
    return punctuation | navigation | boilerplate


def clean_lines(text: Column) -> Column:
    """The text without its failing lines."""
    return F.array_join(F.filter(F.split(text, "\n"), lambda line: ~line_fails(line)), "\n")


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    clean_text, kept`` for every row."""
    whole = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), whole.alias("text"))
    return with_verdict(rows).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "clean_text", "kept"
    )


def with_verdict(rows: DataFrame, text_col: str = "text") -> DataFrame:
    """``rows`` with the measures and the verdict beside its own columns."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.select(
        "*",
        words(text).alias("_words"),
        lines.alias("_lines"),
        count_of(text, SYMBOLS).cast("bigint").alias("n_symbols"),
        clean_lines(text).alias("clean_text"),
    )
    at_each = F.transform("_words", lambda w, i: F.xxhash64(w, F.get("_words", i + 1), F.get("_words", i + 2)))
    windows = F.slice(at_each, F.lit(1), F.greatest(F.size("_words") - 2, F.lit(0)))
    rows = rows.select(
        "*",
        windows.alias("_windows"),
        F.size("_words").cast("bigint").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("bigint").alias("word_chars"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
    )
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    ordered = F.when(
        repeats, F.sort_array(F.arrays_zip("_windows", F.sequence(F.lit(0), F.size("_windows") - 1).alias("at")))
    )
    rows = rows.select("*", ordered.alias("_ordered"))
    same = lambda j, k: F.get("_ordered", j)["_windows"] == F.get("_ordered", k)["_windows"]
    twice = F.filter(
        F.sequence(F.lit(0), F.size("_ordered") - 1),
        lambda j: F.coalesce(same(j, j - 1), F.lit(False)) | F.coalesce(same(j, j + 1), F.lit(False)),
    )
    covered = F.array_distinct(
        F.flatten(F.transform(twice, lambda j: F.sequence(F.get("_ordered", j)["at"], F.get("_ordered", j)["at"] + 2)))
    )
    rows = rows.select(
        "*", F.when(F.col("_ordered").isNull(), 0).otherwise(F.size(covered)).cast("bigint").alias("n_repeat_words")
    ).drop("_words", "_lines", "_windows", "_ordered")
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    enough = 100 * F.length("clean_text") >= (100 - MAX_LOSS) * F.length(text)
    rows = rows.select("*", base_failed.alias("base_failed"))
    return rows.select("*", (~F.col("base_failed") & enough).alias("kept"))
