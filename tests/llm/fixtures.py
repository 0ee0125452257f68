"""Small tables that hold every odd case: nulls, empty and long texts, ties, repeated rows,
extra columns whose names the operators use themselves."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SYLLABLES = "an be con da der el en er es ge ha he in is la le men no on or pa ra re sa ta te ti tion to ver".split()
CLASHES = "row digest keep_id shard size key node fp label k1 k2 z1 spans window ids text_sha256 clean_text kept".split()
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"{c} string" for c in CLASHES)
PAGES = "page_id bigint, url string, html string, digest string, keep_id string, host string, grams string, prediction string"


def prose(n_words: int, seed: int) -> str:
    rng = random.Random(seed)
    words = ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 3))) for _ in range(n_words)]
    words = [w + "." if k % 11 == 10 else w for k, w in enumerate(words)]
    return "\n".join(" ".join(words[k : k + 40]) for k in range(0, n_words, 40)) + "."


def edited(text: str, every: int) -> str:
    words = text.split(" ")
    return " ".join("changed" if k % every == every - 1 else w for k, w in enumerate(words))


PASSAGE = prose(90, 1000)


def documents() -> list[tuple[int | None, str | None]]:
    long = prose(400, 1)
    rows = [
        (1, long),
        (2, long.replace(" ", " \t ").replace("\n", "\r\n ")),
        (3, None),
        (4, ""),
        (5, " \n\t "),
        (6, edited(long, 200)),
        (7, prose(30_000, 2)),
        (8, prose(120, 3) + "\n" + PASSAGE + "\n" + prose(100, 4)),
        (9, prose(80, 5) + "\n" + PASSAGE),
        (10, prose(70, 6)),
        (10, prose(70, 6)),
        (11, "one two"),
        (12, "Ünïcode ’quoted’ 日本語 \U0001f600 don't <|endoftext|> end\u00a0."),
        (13, "a | b | c | d " * 30),
        (14, "Shout!! it!! out!! now!! " * 20),
        (15, "All rights reserved.\n" + prose(150, 7) + "\nhome | about | contact"),
        (16, "x" * 3000),
        (None, long),
        (None, prose(60, 8)),
        (None, None),
    ]
    return rows + [(100 + k, prose(65, 9)) for k in range(15)]  # one text has a third of the rows


def table(spark: SparkSession, rows: list[tuple] | None = None, n_partitions: int = 5) -> DataFrame:
    rows = documents() if rows is None else rows
    full = [(i, t, "en", "s", len(t or ""), *["x"] * len(CLASHES)) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(n_partitions)


def pages(spark: SparkSession, rows: list[tuple] | None = None) -> DataFrame:
    if rows is None:
        rows = [
            (1, "http://A.Example.COM/de/x?q=1", "<p>same</p>"),
            (2, "https://blog.example.net/en/7#top", "<p>same</p>"),
            (3, "http://free-casino.example.org/en/1", None),
            (4, None, ""),
            (5, "no scheme", "<p>é\n</p>"),
            (6, "http://x.net", "tail " * 5000),
            (7, "http://x.net/", "<p>same</p>"),
            (7, "http://x.net/", "<p>same</p>"),
            (None, "ftp://host.org/fr/\r\nX: y", "<p>same</p>"),
            (None, "http://host.org?x://y/net/", "alone"),
            (8, "http://notexample.com/de/", "b"),
            (9, "http://example.com/de", "c"),
        ]
    return spark.createDataFrame([(*r, "d", "k", "h", "g", "p") for r in rows], PAGES)
