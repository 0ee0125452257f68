"""Sharding by histogram sort.

Rows are ordered by (hash of the text, id), so equal texts stand together. Splitters between
partitions are found by counting: every round sends candidate keys to all tasks, which count
the exact bytes below each; the interval in which a splitter must lie shrinks until the bytes
below it are within tolerance of what they should be, or no key lies between its ends. Rounds
read a narrow table of (hash, id, size), never the texts, and the driver gets one count per
candidate. Then rows are exchanged once.

There are more partitions than shards, each shard being ``SPLIT`` neighbouring partitions:
slots are numbered inside a partition and shifted by the rows of the shard's partitions
before it, so no task orders a whole shard. A group of equal texts is cut by id only where it
is itself larger than what the tolerance allows.

Results for odd input: a null text has no bytes and size 1; a null id sorts first; rows that
repeat an id and its text get slots of their own, in any order; an empty table gives an empty
table; with fewer rows than shards some shards stay empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stackroom.llm.common import kept_table, partitions

SHARDS = 16
SPLIT = 8
PROBES = 32
TOLERANCE = 0.001

_LOW = -(1 << 63)
Key = tuple[int, int]  # hash, id


def _counts(rows: DataFrame, probes: list[Key]) -> tuple[np.ndarray, int]:
    """Exact bytes of the rows whose key is below each probe (sorted), and of all rows."""
    hashes = np.array([p[0] for p in probes], np.int64)
    ids = np.array([p[1] for p in probes], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(len(hashes) + 1, np.int64)
        for batch in batches:
            h, i, size = (c.to_numpy() for c in batch.columns)
            low = np.searchsorted(hashes, h, "left")
            high = np.searchsorted(hashes, h, "right")
            # How many probes are at or below the key: those of a smaller hash, and among
            # those of the same hash the ones whose id is not larger.
            place = low.copy()
            for k in np.flatnonzero(high > low):
                place[k] += np.searchsorted(ids[low[k] : high[k]], i[k], "right")
            np.add.at(sums, place, size)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(sums)), pa.int32()), pa.array(sums)], names=["place", "size"])

    found = rows.select("hash", "id", "size").mapInArrow(run, "place int, size bigint")
    sums = np.zeros(len(probes) + 1, np.int64)
    for place, size in found.groupBy("place").agg(F.sum("size")).collect():  # one row per probe
        sums[place] = size
    return np.cumsum(sums)[:-1], int(sums.sum())


def _between(low: Key, high: Key, n: int) -> list[Key]:
    """Up to ``n`` keys strictly between two keys: by hash while hashes differ, then by id."""
    if high[0] - low[0] > 1:
        a, b = low[0], high[0]
        return [(a + (b - a) * (k + 1) // (n + 1), _LOW) for k in range(n) if a < a + (b - a) * (k + 1) // (n + 1) < b]
    if high[0] > low[0]:
        # Neighbouring hashes: first the edge between them, then ids of the lower hash.
        edge = (high[0], _LOW)
        if edge < high:
            return [edge]
        a, b = low[1], (1 << 63) - 1
    else:
        a, b = low[1], high[1]
    steps = {a + (b - a) * (k + 1) // (n + 1) for k in range(n)}
    return [(low[0], s) for s in sorted(steps) if a < s < b or (s == b and high[0] > low[0])]


def splitters(rows: DataFrame, n: int, tolerance: float = TOLERANCE) -> list[Key]:
    """``n - 1`` keys that cut ``rows`` (``hash, id, size``) into ``n`` ranges of equal bytes.

    The bytes below a splitter are within ``tolerance`` of a range's share of the right
    number, or as near as a cut between two keys can come.
    """
    total = _counts(rows, [])[1]
    wanted = [total * (k + 1) / n for k in range(n - 1)]
    slack = tolerance * total / n
    ends = [[(_LOW, _LOW), 0, (1 << 63, _LOW), total] for _ in wanted]
    chosen: list[Key | None] = [None] * len(wanted)
    while None in chosen:
        probes: set[Key] = set()
        for k, (low, _, high, _) in enumerate(ends):
            if chosen[k] is None:
                probes.update(_between(low, high, PROBES))
        ordered = sorted(probes)
        below, _ = _counts(rows, ordered) if ordered else (np.zeros(0, np.int64), 0)
        for k, target in enumerate(wanted):
            if chosen[k] is not None:
                continue
            low, under, high, over = ends[k]
            inside = [(p, int(b)) for p, b in zip(ordered, below) if low < p < high]
            for p, b in inside:
                if b <= target and p > low:
                    low, under = p, b
            for p, b in reversed(inside):
                if b > target and p < high:
                    high, over = p, b
            ends[k] = [low, under, high, over]
            at, off = min(((low, target - under), (high, over - target)), key=lambda x: x[1])
            if off <= slack or not inside:
                chosen[k] = at
    return sorted(chosen)


def sharded(
    docs: DataFrame,
    n_shards: int = SHARDS,
    tolerance: float = TOLERANCE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every row: shards of near-equal bytes."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary")
    number = F.col(f"`{id_col}`").cast("bigint")
    rows = docs.select(
        number.alias("doc_id"),
        F.xxhash64(text).alias("hash"),
        F.coalesce(number, F.lit(_LOW)).alias("id"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    rows = kept_table(rows, "sizes")
    split = max(SPLIT, -(-partitions(docs.sparkSession) // n_shards))
    cuts = splitters(rows, n_shards * split, tolerance)
    hashes = np.array([min(c[0], (1 << 63) - 1) for c in cuts], np.int64)
    last = np.array([c[0] >= 1 << 63 for c in cuts])
    ids = np.array([c[1] for c in cuts], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, i = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            low = np.searchsorted(hashes[~last], h, "left")
            high = np.searchsorted(hashes[~last], h, "right")
            for k in np.flatnonzero(high > low):
                low[k] += np.searchsorted(ids[low[k] : high[k]], i[k], "right")
            part = pa.array(low.astype(np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, part], names=[*batch.schema.names, "part"])

    schema = "doc_id bigint, hash bigint, id bigint, size bigint, text_crc32 bigint, part int"
    placed = rows.mapInArrow(run, schema)
    held = placed.groupBy("part").agg(F.count("*").alias("n"))
    by_shard = Window.partitionBy(F.floor(F.col("part") / split)).orderBy("part")  # ``split`` rows a shard
    before = held.select("part", (F.sum("n").over(by_shard) - F.col("n")).alias("before"))
    in_part = Window.partitionBy("part").orderBy("hash", "id")
    slots = placed.withColumn("_at", F.row_number().over(in_part) - 1)
    return slots.join(F.broadcast(before), "part").select(  # at most ``n_shards * split`` rows
        "doc_id",
        "size",
        "text_crc32",
        F.floor(F.col("part") / split).cast("int").alias("shard"),
        (F.col("_at") + F.col("before")).cast("bigint").alias("slot"),
    )
