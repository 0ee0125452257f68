"""Newest per group and what lies beyond, without one task per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stackroom.session import checkpointed

SALTS = 64


def first_per(rows: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """The first row of each group in ``order``: an aggregate, combined map-side."""
    whole = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    picked = rows.groupBy(group).agg(F.min_by(whole, F.struct(*order)).alias("_row"))
    return picked.select("_row.*")


def beyond_first(
    rows: DataFrame, group: str, order: list[Column], keep: int, spread_by: Column
) -> DataFrame:
    """All rows of each group after its first ``keep`` in ``order``.

    A row beyond ``keep`` in a slice of its group is beyond it in the whole group.
    So each group is ranked in ``SALTS`` slices, and only the ``keep`` leaders of
    each slice meet in one task.
    """
    salt = F.pmod(F.xxhash64(spread_by), F.lit(SALTS)).alias("_salt")
    in_slice = Window.partitionBy(group, "_salt").orderBy(*order)
    sliced = rows.select("*", salt).withColumn("_rank", F.row_number().over(in_slice))
    late = sliced.where(F.col("_rank") > keep)
    leaders = sliced.where(F.col("_rank") <= keep).withColumn(
        "_rank", F.row_number().over(Window.partitionBy(group).orderBy(*order))
    )
    return late.unionByName(leaders.where(F.col("_rank") > keep)).drop("_salt", "_rank")


def last_lines(lines: DataFrame, keep: int) -> DataFrame:
    """The last ``keep`` lines of each file (``file, block, row``), with their rank from the end.

    Blocks are counted first, so only those at the end of a file that hold the lines asked for
    are ranked, each by itself, and a block's rank is moved on by what comes after it. No task
    meets more than a block of a file, for any ``keep``.
    """
    after = Window.partitionBy("file").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    sizes = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"))  # one row per block
    ends = sizes.withColumn("_later", F.coalesce(F.sum("n").over(after), F.lit(0))).where(F.col("_later") < keep)
    in_block = Window.partitionBy("file", "block").orderBy(F.desc("row"))
    ranked = lines.join(ends.drop("n"), ["file", "block"]).withColumn("_rank", F.row_number().over(in_block))
    # The first condition is the one that Spark can apply before the shuffle.
    ranked = ranked.where(F.col("_rank") <= keep).withColumn("from_end", (F.col("_rank") + F.col("_later")).cast("int"))
    return ranked.where(F.col("from_end") <= keep).drop("_rank", "_later")


_PLACE_BITS = 33


def with_ordinal(rows: DataFrame, order: list[Column], name: str = "ordinal") -> DataFrame:
    """``rows`` with their position (from 1) in ``order``, which must leave no ties.

    The rows are sorted by ranges, so no task meets more than its range; the ranges are counted,
    and a row's position is its place in its range moved on by the ranges before it. The sorted
    rows are kept in between: both steps have to see the same ranges.
    """
    keys = [f"_key{k}" for k in range(len(order))]
    keyed = rows.select("*", *[column.alias(key) for column, key in zip(order, keys)])
    placed = keyed.repartitionByRange(*keys).sortWithinPartitions(*keys).drop(*keys)
    placed = checkpointed(placed.withColumn("_at", F.monotonically_increasing_id()))
    # That number is the partition's above 33 bits, and the row's place in it below.
    part = F.shiftright("_at", _PLACE_BITS).alias("_part")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy(part).agg(F.count(F.lit(1)).alias("n"))  # one row per partition
    starts = starts.select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))
    place = F.col("_at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    found = placed.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return found.withColumn(name, F.col("_start") + place + 1).drop("_part", "_at", "_start")
