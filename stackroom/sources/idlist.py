"""Lists of requested ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stackroom.functions.ids import IdScheme, trim_space


def read_id_list(spark: SparkSession, path: str, scheme: IdScheme) -> DataFrame:
    """Column ``raw`` of a CSV with header: trimmed, blanks dropped.

    The first header that names an id column is read, else the first column. A
    row of another width is an error: without column pruning the reader sees
    every cell and FAILFAST refuses it.
    """
    rows = (
        spark.read.option("header", "true")
        .option("mode", "FAILFAST")
        .option("columnPruning", "false")
        .option("escape", '"')
        .csv(path)
    )
    named = [name for name in rows.columns if name in scheme.column_names]
    column = named[0] if named else rows.columns[0]
    raw = rows.select(trim_space(F.col(f"`{column}`")).alias("raw"))
    return raw.where(F.col("raw") != "")
