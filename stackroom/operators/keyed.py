"""Semi-joins of a large side with a set of keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024
ROW_OVERHEAD = 64
PART_BYTES = 32 * 1024 * 1024

HOT_KEYS = 1_000
HOT_ROWS = 1_000_000
SALTS = 64


def measured_bytes(keys: DataFrame) -> int:
    """What the keys would take in memory, by one aggregate over them."""
    width = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in keys.columns), F.lit(ROW_OVERHEAD))
    return keys.agg(F.sum(width.cast("bigint")).alias("size")).first()["size"] or 0


def fits_broadcast(keys: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure the keys against the broadcast bound."""
    return measured_bytes(keys) <= max_bytes


def parts_for(spark: SparkSession, n_bytes: int) -> int:
    """Partitions for keys of so many bytes: ``PART_BYTES`` each at most, however many keys.

    Never fewer than the session's shuffle partitions, or a join would deal them out anew.
    """
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // PART_BYTES))


#: A filter's bits: as many a key, up to a bound that holds for any number of keys. Its words lie in
#: 64-bit integers of 32 bits each, so a broadcast filter has at most 64 MB.
BLOOM_BITS = 16
BLOOM_MAX_BITS = 1 << 28
_BITMAP = 1 << 15  # bits of one bitmap of Spark's bitmap aggregate


def _bloom_places(on: str, n_bitmaps: int) -> tuple[Column, list[Column]]:
    """The bitmap of a key, and its two bits in there."""
    first, second = F.xxhash64(F.col(on)), F.xxhash64(F.col(on), F.lit(1))
    places = [F.shiftrightunsigned(second, shift).bitwiseAND(F.lit(_BITMAP - 1)) for shift in (0, 15)]
    return F.pmod(first, F.lit(n_bitmaps)), places


def bloom_filter(keys: DataFrame, on: str, n_bitmaps: int, n_parts: int) -> DataFrame:
    """``bitmap, words``: a Bloom filter over the keys. The places of a key's bits shuffle, not bitmaps:
    each task would send nearly all of those."""
    bitmap, places = _bloom_places(on, n_bitmaps)
    dealt = keys.select(bitmap.alias("bitmap"), F.array(*places).alias("places")).repartition(n_parts, "bitmap")
    bits = dealt.select("bitmap", F.explode("places").alias("place"))
    built = bits.groupBy("bitmap").agg(F.bitmap_construct_agg("place").alias("bits"))

    def word(k: Column) -> Column:
        return F.conv(F.hex(F.substring("bits", 4 * k + 1, F.lit(4))), 16, 10).cast("bigint")

    return built.select("bitmap", F.transform(F.sequence(F.lit(0), F.lit(_BITMAP // 32 - 1)), word).alias("words"))


def might_be_among(rows: DataFrame, keys: DataFrame, on: str = "id") -> DataFrame:
    """The rows whose ``on`` is among ``keys``, and a few more (about one in a hundred of the
    others, while the filter is within its bound). ``rows`` do not move; only the filter does,
    and it is of bounded size."""
    n_keys = keys.count()
    n_bitmaps = min(BLOOM_MAX_BITS, max(_BITMAP, BLOOM_BITS * n_keys)) // _BITMAP
    built = bloom_filter(keys, on, n_bitmaps, parts_for(keys.sparkSession, 2 * ROW_OVERHEAD * n_keys))
    bitmap, places = _bloom_places(on, n_bitmaps)
    # A word holds four bytes of the bitmap, the first one highest.
    in_word = [F.getbit(F.col("words")[(p / 32).cast("int")], ((3 - (p / 8).cast("int") % 4) * 8 + p % 8).cast("int")) for p in places]
    both = (F.col("_bitmap") == F.col("bitmap")) & (in_word[0] + in_word[1] == 2)
    marked = rows.withColumn("_bitmap", bitmap)
    return marked.join(F.broadcast(built), both, "left_semi").drop("_bitmap")


def semi_join(
    rows: DataFrame,
    keys: DataFrame,
    on: str = "id",
    max_bytes: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Rows whose ``on`` is among ``keys`` (distinct; ``n_rows`` tells rows per key).

    Keys within the bound are broadcast and ``rows`` does not move. Beyond it both
    sides shuffle on the key, and the rows of the heaviest keys are spread over
    ``SALTS`` tasks. At most ``HOT_KEYS`` keys count as heavy, so their list is
    always small; all other keys take the plain way.
    """
    if fits_broadcast(keys.select(on), max_bytes):
        return rows.join(F.broadcast(keys.select(on)), on, "left_semi")
    hot = F.broadcast(
        keys.orderBy(F.desc("n_rows"))
        .limit(HOT_KEYS)
        .where(F.col("n_rows") >= hot_rows)
        .select(on, F.lit(True).alias("_hot"))
    )
    spread = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")
    salted_rows = rows.join(hot, on, "left").withColumn(
        "_salt", F.when(F.col("_hot"), spread).otherwise(0)
    )
    every_salt = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(
        F.array(F.lit(0))
    )
    salted_keys = (
        keys.select(on).join(hot, on, "left").select(on, F.explode(every_salt).alias("_salt"))
    )
    return salted_rows.join(salted_keys, [on, "_salt"], "left_semi").drop("_hot", "_salt")
