"""Exact dedup on a cuckoo-filter index of live digests.

The index is split into shards by digest. A shard holds a cuckoo filter (four 16-bit
fingerprints per bucket) and, bucketed alike, the stored keys: digest, smallest id,
number of rows. A digest that the filter does not know is new, without a look at the
keys. A hit is verified against the keys of the digest's two buckets, so a fingerprint
met by chance is never taken for a copy. When an insertion finds no place, the shard's
filter doubles and is filled again from the stored keys.

Rows of a batch are combined per Arrow batch before they move, so a text that a third
of all rows share arrives at its shard as one row per batch. A shard is bounded by
``SHARD_KEYS``: the number of shards follows the number of rows.

Results for odd input: a null text is an empty text; an empty table gives an empty
index; rows that repeat an id and its text are counted, and share one verdict; rows
with a null id never become ``keep_id`` unless their group has no other, then it is null.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stackroom.llm.common import kept_table, one_space, partitions

SHARD_KEYS = 100_000
SLOTS = 4
MAX_KICKS = 200

STATE = "shard int, kind int, digest binary, keep_id bigint, n_rows bigint, slots binary"
_FILTER, _KEY, _ADD, _REMOVE = range(4)


class CuckooFilter:
    """Fingerprints in buckets of four; every fingerprint can live in two buckets."""

    def __init__(self, n_buckets: int, slots: bytes | None = None):
        self.n_buckets = n_buckets
        self.slots = bytearray(slots) if slots else bytearray(2 * SLOTS * n_buckets)

    def home(self, digest: bytes) -> tuple[bytes, int]:
        """Fingerprint and first bucket, from bytes of the digest that sharding leaves alone."""
        mark = digest[8:10] if digest[8:10] != b"\0\0" else b"\0\1"
        return mark, int.from_bytes(digest[10:16], "little") % self.n_buckets

    def other(self, mark: bytes, bucket: int) -> int:
        """Of the two buckets of a fingerprint, the one that ``bucket`` is not (an involution)."""
        return bucket ^ (int.from_bytes(mark, "little") * 0x5BD1E995 & (self.n_buckets - 1))

    def _bucket(self, bucket: int) -> list[bytes]:
        at = 2 * SLOTS * bucket
        return [bytes(self.slots[i : i + 2]) for i in range(at, at + 2 * SLOTS, 2)]

    def _put(self, bucket: int, slot: int, mark: bytes) -> None:
        at = 2 * (SLOTS * bucket + slot)
        self.slots[at : at + 2] = mark

    def _swap(self, bucket: int, old: bytes, new: bytes) -> bool:
        held = self._bucket(bucket)
        if old not in held:
            return False
        self._put(bucket, held.index(old), new)
        return True

    def __contains__(self, digest: bytes) -> bool:
        mark, bucket = self.home(digest)
        return mark in self._bucket(bucket) or mark in self._bucket(self.other(mark, bucket))

    def insert(self, digest: bytes) -> bool:
        """False when no place was found; the filter then has to be built anew, larger."""
        mark, bucket = self.home(digest)
        for place in (bucket, self.other(mark, bucket)):
            if self._swap(place, b"\0\0", mark):
                return True
        for kick in range(MAX_KICKS):
            slot = kick % SLOTS
            evicted = self._bucket(bucket)[slot]
            self._put(bucket, slot, mark)
            mark, bucket = evicted, self.other(evicted, bucket)
            if self._swap(bucket, b"\0\0", mark):
                return True
        return False

    def delete(self, digest: bytes) -> bool:
        mark, bucket = self.home(digest)
        return self._swap(bucket, mark, b"\0\0") or self._swap(self.other(mark, bucket), mark, b"\0\0")


class Shard:
    """One shard: the filter, and the stored keys by bucket."""

    def __init__(self, slots: bytes | None = None, n_buckets: int = 64):
        self.filter = CuckooFilter(len(slots) // (2 * SLOTS) if slots else n_buckets, slots)
        self.keys: dict[int, dict[bytes, list]] = {}

    def _places(self, digest: bytes) -> tuple[int, int]:
        mark, bucket = self.filter.home(digest)
        return bucket, self.filter.other(mark, bucket)

    def store(self, digest: bytes, keep_id: int | None, n_rows: int) -> None:
        self.keys.setdefault(self._places(digest)[0], {})[digest] = [keep_id, n_rows]

    def find(self, digest: bytes) -> list | None:
        """The stored key, if the filter lets the digest through and the content is equal."""
        if digest not in self.filter:
            return None
        return self.keys.get(self._places(digest)[0], {}).get(digest)

    def add(self, digest: bytes, keep_id: int | None, n_rows: int) -> None:
        known = self.find(digest)
        if known:
            known[0] = keep_id if known[0] is None else known[0] if keep_id is None else min(known[0], keep_id)
            known[1] += n_rows
            return
        self.store(digest, keep_id, n_rows)
        if not self.filter.insert(digest):
            self.resize()

    def remove(self, digest: bytes) -> None:
        if self.find(digest):
            del self.keys[self._places(digest)[0]][digest]
            self.filter.delete(digest)

    def items(self) -> Iterator[tuple[bytes, list]]:
        return (item for bucket in self.keys.values() for item in bucket.items())

    def resize(self) -> None:
        """Double until every stored key has a place."""
        stored, n_buckets, full = list(self.items()), self.filter.n_buckets, True
        while full:
            n_buckets *= 2
            self.filter = CuckooFilter(n_buckets)
            full = not all(self.filter.insert(digest) for digest, _ in stored)
        self.keys = {}
        for digest, (keep_id, n_rows) in stored:
            self.store(digest, keep_id, n_rows)


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per digest and Arrow batch."""
    for batch in batches:
        groups = pa.table(batch).group_by(["shard", "kind", "digest"]).aggregate([("keep_id", "min"), ("n_rows", "sum")])
        groups = groups.append_column("slots", pa.nulls(groups.num_rows, pa.binary()))
        groups = groups.rename_columns(["shard", "kind", "digest", "keep_id", "n_rows", "slots"])
        yield from groups.combine_chunks().to_batches()


def _state_rows(number: int, shard: Shard) -> pa.RecordBatch:
    items = list(shard.items())
    rows = [(number, _FILTER, None, None, None, bytes(shard.filter.slots))]
    rows += [(number, _KEY, digest, keep_id, n_rows, None) for digest, (keep_id, n_rows) in items]
    types = [pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.binary()]
    names = ["shard", "kind", "digest", "keep_id", "n_rows", "slots"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def _applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (shard, kind): a shard's filter, its keys, additions, removals."""
    number, shard = None, Shard()
    for batch in batches:
        for n, kind, digest, keep_id, n_rows, slots in zip(*(c.to_pylist() for c in batch.columns)):
            if n != number:
                if number is not None:
                    yield _state_rows(number, shard)
                number, shard = n, Shard(slots)
            if kind == _KEY:
                shard.store(digest, keep_id, n_rows)
            elif kind == _ADD:
                shard.add(digest, keep_id, n_rows)
            elif kind == _REMOVE:
                shard.remove(digest)
    if number is not None:
        yield _state_rows(number, shard)


class CuckooIndex:
    """Live digests of all batches so far. Every change writes a new state table."""

    def __init__(self, spark: SparkSession, n_shards: int | None = None, state: DataFrame | None = None):
        self.spark = spark
        self.n_shards = n_shards or 4 * partitions(spark)
        self.state = state if state is not None else spark.createDataFrame([], STATE)

    @staticmethod
    def for_rows(spark: SparkSession, n_rows: int) -> CuckooIndex:
        """An empty index with shards enough for so many digests."""
        return CuckooIndex(spark, max(4 * partitions(spark), -(-n_rows // SHARD_KEYS)))

    def _change(self, rows: DataFrame, kind: int) -> CuckooIndex:
        shard = F.pmod(F.conv(F.hex(F.substring("digest", 1, 7)), 16, 10).cast("bigint"), F.lit(self.n_shards))
        rows = rows.select(shard.cast("int").alias("shard"), F.lit(kind).alias("kind"), "digest", "keep_id", "n_rows")
        moved = self.state.unionByName(rows.mapInArrow(_combined, STATE))
        moved = moved.repartition(partitions(self.spark), "shard").sortWithinPartitions("shard", "kind")
        return CuckooIndex(self.spark, self.n_shards, kept_table(moved.mapInArrow(_applied, STATE), "cuckoo"))

    def insert(self, rows: DataFrame) -> CuckooIndex:
        """Add rows ``(digest binary, doc_id)``; equal digests join one group."""
        return self._change(rows.select("digest", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("n_rows")), _ADD)

    def delete(self, digests: DataFrame) -> CuckooIndex:
        """Forget digests ``(digest binary)``; one inserted later starts a new group."""
        gone = digests.select("digest", F.lit(None).cast("bigint").alias("keep_id"), F.lit(0).cast("bigint").alias("n_rows"))
        return self._change(gone, _REMOVE)

    def entries(self) -> DataFrame:
        """Live digests: ``digest, keep_id, n_rows``."""
        return self.state.where(F.col("kind") == _KEY).select("digest", "keep_id", "n_rows")


def text_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, digest``: SHA-256 of the text with runs of white space as one space."""
    digest = F.unhex(F.sha2(one_space(F.col(f"`{text_col}`")).cast("binary"), 256))
    return docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), digest.alias("digest"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, digest, keep_id, group_size, kept`` for every row of ``docs``."""
    spark = docs.sparkSession
    rows = kept_table(text_digests(docs, id_col, text_col), "digests")
    index = CuckooIndex.for_rows(spark, rows.count()).insert(rows)
    return rows.join(index.entries(), "digest").select(
        "doc_id",
        "digest",
        "keep_id",
        F.col("n_rows").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
    )
