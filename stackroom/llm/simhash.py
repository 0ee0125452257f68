"""Near-duplicates by SimHash, found with multi-index hashing.

A fingerprint is cut into segments. Every distinct fingerprint stands in one table bucket
per segment, and probes the buckets of the small Hamming ball around each of its segments;
whole distances are verified for what it meets. With ``m`` segments and ball radius 1, every
pair at distance below ``2 m`` is met (pigeonhole).

Buckets of more than ``BUCKET`` fingerprints, as large groups of near copies make them, are
left out of the join, for it would make pairs by the square. What meets there goes another
way that loses no link:
- up to distance 2, fingerprints enter the 65 points of the ball of radius 1 around the whole
  fingerprint; two share a point if and only if they are at distance 2 or less, and a point
  holds 65 fingerprints at most;
- beyond, all that meet in the bucket are compared with its smallest member. Those linked to
  it are one component already; the others are compared with all.

Texts with one fingerprint are one node. Nodes have numbers of their own, for ids may be null or
repeat; a component is named by its smallest id. Components come from label propagation with
pointer jumping over tables in the shared folder.

Results for odd input: null and empty texts, and those of white space only, have fingerprint
zero and are linked to each other like any others; texts of fewer words than a shingle are one
shingle; rows that repeat an id are nodes by their texts; a row with a null id links others like
any row, and its component is null if no row of it has an id; an empty table gives an empty table.
Long texts are hashed in slices, so a task holds one text and its words at a time. Repeated
shingles count in a fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stackroom.llm.common import kept_table
from stackroom.llm.suffix_index import text_key

SEED = 42
BUCKET = 64
SLICE = 1 << 18


@dataclass(frozen=True)
class Scheme:
    """Which pairs are linked, and how they are found."""

    shingle: int = 3
    n_words: int = 1  # 64-bit words of a fingerprint
    width: int = 32  # bits of a segment, probed with a ball of radius 1
    n_segments: int = 2
    max_distance: int = 2

    def segments(self) -> list[tuple[int, int]]:
        """(word, first bit) of each segment; segments do not cross words."""
        per_word = 64 // self.width
        return [(i // per_word, self.width * (i % per_word)) for i in range(self.n_segments)]


_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_LANES = (np.arange(8) * 256).astype(np.int64)
_MIX = 0x9E3779B97F4A7C15


def shingle_hashes(text: bytes, shingle: int) -> Iterator[np.ndarray]:
    """XXH64 of the shingles of the lower-cased words, repeats included, in slices.

    ``bytes`` methods change and split at ASCII only, as the contract asks.
    """
    found = text.lower().split()
    if not found:
        return
    if len(found) < shingle:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(found), SEED)], np.uint64)
        return
    for at in range(0, len(found) - shingle + 1, SLICE):
        part = found[at : at + SLICE + shingle - 1]
        tuples = zip(*(part[k:] for k in range(shingle)))
        yield np.array([xxhash.xxh64_intdigest(b" ".join(t), SEED) for t in tuples], np.uint64)


def _majority(parts: Iterable[np.ndarray], n_words: int) -> list[int]:
    """Signed 64-bit words; a bit is set if more than half of the hashes have it."""
    counts, total = np.zeros((n_words, 8, 8), np.int64), 0
    for hashes in parts:
        total += len(hashes)
        for k in range(n_words):
            if k:  # further words come from the same hashes, mixed again
                hashes = hashes * np.uint64(_MIX)
                hashes ^= hashes >> np.uint64(29)
            lanes = hashes.astype("<u8").view(np.uint8).reshape(-1, 8) + _LANES
            counts[k] += np.bincount(lanes.ravel(), minlength=2048).reshape(8, 256) @ _BITS
    bits = (2 * counts > total).reshape(n_words, 64).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view("<i8").ravel().tolist()


def fingerprint(text: bytes, shingle: int, n_words: int = 1) -> list[int]:
    """The fingerprint of the shingles, repeats included."""
    return _majority(shingle_hashes(text, shingle), n_words)


def fingerprints(
    docs: DataFrame, scheme: Scheme, id_col: str = "doc_id", text_col: str = "text", keyed: bool = False
) -> DataFrame:
    """``doc_id, fp`` for every row; ``fp`` is an array of 64-bit words. ``keyed`` adds the key of
    the text, ``k1, k2``, which tells rows that repeat an id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py(), scheme.shingle, scheme.n_words) for t in batch.column("text")]
            rest = batch.drop_columns(["text"])
            yield rest.append_column("fp", pa.array(found, pa.list_(pa.int64())))

    text = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary")
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), text.alias("text"))
    if keyed:
        rows = rows.select("doc_id", *text_key(F.col("text")), "text")
    return rows.mapInArrow(run, f"doc_id bigint, {'k1 bigint, k2 bigint, ' if keyed else ''}fp array<bigint>")


def _keys(scheme: Scheme) -> list[Column]:
    """The bucket of each segment: its number above 32 bits, its value below."""
    mask = (1 << scheme.width) - 1
    return [
        F.shiftrightunsigned(F.col("fp")[word], bit).bitwiseAND(F.lit(mask)).bitwiseOR(F.lit(i << 32))
        for i, (word, bit) in enumerate(scheme.segments())
    ]


def _bits(n_words: int, mark: str = "") -> list[Column]:
    return [F.col("fp")[k].alias(f"w{k}{mark}") for k in range(n_words)]


def _near(scheme: Scheme) -> Column:
    words = [F.bit_count(F.col(f"w{k}").bitwiseXOR(F.col(f"w{k}_b"))) for k in range(scheme.n_words)]
    return reduce(lambda x, y: x + y, words) <= scheme.max_distance


def links(nodes: DataFrame, scheme: Scheme) -> DataFrame:
    """``a, b``: enough links by distance between ``nodes`` (``node, fp``) for their components.

    Of two segments that differ in one bit, one has the bit set: it is enough that a probe
    clears the set bits of its segment in turn, which is half of the ball.
    """
    keyed = nodes.select("node", *_bits(scheme.n_words), F.explode(F.array(*_keys(scheme))).alias("key"))
    tables = keyed.select("key", F.col("node").alias("node_b"), *[F.col(f"w{k}").alias(f"w{k}_b") for k in range(scheme.n_words)])
    flips = [F.lit(1 << bit).cast("bigint") for bit in range(scheme.width)]
    cleared = [F.when(F.col("key").bitwiseAND(f) != 0, F.col("key").bitwiseXOR(f)) for f in flips]
    probes = keyed.withColumn("key", F.explode(F.array_compact(F.array(F.col("key"), *cleared))))
    heavy = tables.groupBy("key").agg(F.count("*").alias("n"), F.min("node_b").alias("leader")).where(F.col("n") > BUCKET)
    heavy = kept_table(heavy, "heavy")
    found = probes.join(tables.join(heavy, "key", "left_anti"), "key").where((F.col("node") != F.col("node_b")) & _near(scheme))
    found = found.select(F.least("node", "node_b").alias("a"), F.greatest("node", "node_b").alias("b"))
    if heavy.isEmpty():
        return found
    crowd = kept_table(probes.join(heavy.select("key", "leader"), "key"), "crowd")
    if scheme.max_distance <= 2 and scheme.n_words == 1:
        return found.unionByName(_through_points(crowd))
    return found.unionByName(_through_leaders(crowd, nodes, scheme))


def _through_points(crowd: DataFrame) -> DataFrame:
    flips = [F.lit(1 << bit if bit < 63 else -(1 << 63)).cast("bigint") for bit in range(64)]
    points = crowd.groupBy("node").agg(F.first("w0").alias("w0"))
    ball = F.array(F.col("w0"), *[F.col("w0").bitwiseXOR(f) for f in flips])
    points = points.select("node", F.explode(ball).alias("point"))
    stars = points.groupBy("point").agg(F.min("node").alias("a"), F.collect_set("node").alias("others"))
    stars = stars.where(F.size("others") > 1)
    return stars.select("a", F.explode("others").alias("b")).where("a < b")


def _through_leaders(crowd: DataFrame, nodes: DataFrame, scheme: Scheme) -> DataFrame:
    words = [f"w{k}" for k in range(scheme.n_words)]
    leaders = crowd.select("leader").distinct().join(nodes.withColumnRenamed("node", "leader"), "leader")
    leaders = leaders.select("leader", *_bits(scheme.n_words, "_b"))
    judged = crowd.join(leaders, "leader").select("key", "node", *words, "leader", _near(scheme).alias("near"))
    judged = kept_table(judged, "judged")
    to_leader = judged.where("near and node != leader")
    to_leader = to_leader.select(F.least("leader", "node").alias("a"), F.greatest("leader", "node").alias("b"))
    rest = judged.where("not near").select("key", "node", *words)
    every = judged.select("key", F.col("node").alias("node_b"), *[F.col(w).alias(f"{w}_b") for w in words])
    among = rest.join(every, "key").where((F.col("node") != F.col("node_b")) & _near(scheme))
    among = among.select(F.least("node", "node_b").alias("a"), F.greatest("node", "node_b").alias("b"))
    return to_leader.unionByName(among.distinct())


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (its smallest node) for every node that has a link ``a, b``."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = kept_table(both, "links")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label"))
    labels = kept_table(labels.select("node", F.least("node", "label").alias("label")), "labels")
    total = None
    while True:
        now = labels.agg(F.sum(F.col("label").cast("decimal(38,0)")).alias("total")).first()["total"]
        if now == total:
            return labels.withColumnRenamed("label", "component")
        total = now
        of_b = labels.select(F.col("node").alias("b"), F.col("label").alias("seen"))
        seen = both.join(of_b, "b").groupBy("a").agg(F.min("seen").alias("seen"))
        hooked = labels.join(seen.withColumnRenamed("a", "node"), "node")
        parents = labels.select(F.col("node").alias("label"), F.col("label").alias("seen"))
        jumped = labels.join(parents, "label").select("node", "seen")
        smaller = hooked.select(
            F.explode(F.array("node", "label")).alias("node"), F.least("label", "seen").alias("seen")
        )
        labels = kept_table(
            smaller.unionByName(jumped).groupBy("node").agg(F.min("seen").alias("label")), "labels"
        )


def near_groups(
    docs: DataFrame, scheme: Scheme = Scheme(), id_col: str = "doc_id", text_col: str = "text", keyed: bool = False
) -> DataFrame:
    """``doc_id, fp, component, component_id`` for every row of ``docs``, with ``k1, k2`` if ``keyed``.

    ``component`` is a number of this run; ``component_id`` the smallest id, null if there is none.
    """
    rows = kept_table(fingerprints(docs, scheme, id_col, text_col, keyed), "fingerprints")
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("least_id"))
    nodes = kept_table(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    linked = components(links(nodes, scheme))
    named = nodes.join(linked, "node", "left").select("fp", "least_id", F.coalesce("component", "node").alias("component"))
    named = kept_table(named, "named")
    ids = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    return rows.join(kept_table(named.join(ids, "component").select("fp", "component", "component_id"), "named"), "fp")
