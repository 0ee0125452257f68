"""Reading the given tables, and small expressions the queries share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stackroom.functions.ids import IdScheme

SCHEME = IdScheme("example.org")

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def full_id(letter: str, number: Column) -> Column:
    return F.concat(F.lit(SCHEME.prefix + letter), number.cast("string"))


def derived(rows: DataFrame) -> DataFrame:
    """The same rows, each derived once: filters on generated columns read them, where
    Catalyst would copy a long derivation into every filter above it."""
    return rows.select(F.inline(F.array(F.struct("*"))))


def micros(stamp: str) -> Column:
    """Microseconds since 1970, whatever the session time zone."""
    return F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', {stamp})")


def seconds(stamp: str) -> Column:
    return F.call_function("div", micros(stamp), F.lit(1_000_000))
