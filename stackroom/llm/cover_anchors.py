"""Removal of repeated word passages, found by anchors at the positions of a difference cover.

A difference cover of a period holds, for every pair of positions, one shift below the period
that takes both of them onto it. So if two documents share ``LENGTH`` words, some run of
``GRAM = LENGTH - PERIOD + 1`` words inside the match starts at a cover position in both of them,
however they are aligned. Only those runs are hashed: one for about five words.

1. Each text gives its anchors (64-bit hashes of the runs at cover positions). An anchor that
   occurs in two different texts is shared; a chance collision only makes one more candidate.
2. Shared anchors go back to their texts and are extended: every window of ``LENGTH`` words that
   holds one is a candidate and gets a 128-bit hash. Equal windows meet by that hash, combined
   before the shuffle to the smallest doc_id that has them; no pair of documents is ever made.
3. A candidate window that a smaller doc_id has as well is taken out of its text.

Texts of one word sequence are one class: its smallest id stands for it in all of this, and
what has a larger id loses every word (if there are ``LENGTH``). Copies inside an Arrow batch are
folded before anything is written.

Results for odd input: a null text has no words; a text shorter than ``LENGTH`` words loses
nothing; documents of one id do not take from each other; a null id is larger than any other, and
null ids do not take from each other; windows repeated only inside one document stay; an
empty table gives an empty table. A task holds one Arrow batch and the word hashes of a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stackroom.llm.common import kept_table
from stackroom.llm.suffix_index import text_key

LENGTH = 50
PERIOD = 31
#: The differences of these six run through all of 1 to 30, modulo 31, once.
COVER = (1, 5, 11, 24, 25, 27)
WORDS_KNOWN = 100_000
ROWS_OUT = 1 << 16

_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))


class WordHashes(dict):
    """16 bytes for each word; a bounded number of words is remembered."""

    def __missing__(self, word: bytes) -> bytes:
        digest = xxhash.xxh3_128_digest(word)
        if len(self) < WORDS_KNOWN:
            self[word] = digest
        return digest

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.__getitem__, words)), "<u8").reshape(-1, 2)


def run_hashes(hashes: np.ndarray, length: int, base: np.uint64) -> np.ndarray:
    """A polynomial hash of the ``length`` word hashes from each position."""
    if len(hashes) < length:
        return np.zeros(0, np.uint64)
    powers = np.full(len(hashes), base)
    powers[0] = 1
    powers = np.cumprod(powers)
    inverse = np.full(len(hashes) - length + 1, np.uint64(pow(int(base), -1, 1 << 64)))
    inverse[0] = 1
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * powers, out=sums[1:])
    return (sums[length:] - sums[:-length]) * np.cumprod(inverse)


def cover_positions(count: int) -> np.ndarray:
    """The cover positions below ``count``; the k-th of them is the same for every text."""
    periods = -(-count // PERIOD)
    at = (np.arange(periods)[:, None] * PERIOD + np.array(COVER)).ravel()
    return at[at < count]


def candidates(anchors: np.ndarray, n_words: int, length: int = LENGTH) -> np.ndarray:
    """Starts of the windows that hold an anchor (given by its number among the text's)."""
    at = anchors // len(COVER) * PERIOD + np.array(COVER)[anchors % len(COVER)]
    change = np.zeros(n_words + 2, np.int64)
    np.add.at(change, np.maximum(at - (PERIOD - 1), 0), 1)
    np.add.at(change, at + 1, -1)
    return np.flatnonzero(np.cumsum(change)[: max(0, n_words - length + 1)])


_ANCHORED = "row bigint, doc_id bigint, k1 bigint, k2 bigint, c1 bigint, c2 bigint, anchors array<bigint>"


def _anchored(length: int):
    gram = length - PERIOD + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, number = WordHashes(), TaskContext.get().partitionId() << 32
        names = [f.split()[0] for f in _ANCHORED.split(", ")]
        for batch in batches:
            first: dict[bytes, int] = {}  # the row of the least id of each class in the batch
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            classes = []
            for k, doc in enumerate(ids):
                classes.append(xxhash.xxh3_128_digest(b" ".join(texts[k].as_py().split())))
                other = first.setdefault(classes[-1], k)
                if doc is not None and (ids[other] is None or doc < ids[other]):
                    first[classes[-1]] = k
            anchors = []
            for k in range(len(ids)):
                if first[classes[k]] != k:
                    anchors.append(None)
                    continue
                words = texts[k].as_py().split()
                found = np.zeros(0, np.uint64)
                if len(words) >= length:
                    found = run_hashes(known.of(words)[:, 0], gram, _BASES[0])
                    found = found[cover_positions(len(found))]
                anchors.append(found.view(np.int64))
            halves = np.frombuffer(b"".join(classes), "<i8").reshape(-1, 2)
            rows = np.arange(number, number + len(ids))
            number += len(ids)
            columns = [pa.array(rows), *(batch.column(c) for c in ("doc_id", "k1", "k2"))]
            columns += [pa.array(halves[:, k].copy()) for k in (0, 1)]
            columns.append(pa.array(anchors, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


_WINDOWS = "w1 bigint, w2 bigint, doc_id bigint, row bigint, at int"


def _windows(length: int):
    names = [f.split()[0] for f in _WINDOWS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held, n_held = WordHashes(), [], 0
        for batch in batches:
            for k in range(batch.num_rows):
                words = batch.column("text")[k].as_py().split()
                at = candidates(batch.column("shared")[k].values.to_numpy(), len(words), length)
                hashes = known.of(words)
                pair = [run_hashes(hashes[:, c], length, _BASES[c])[at].view(np.int64) for c in (0, 1)]
                same = [pa.array([batch.column(c)[k].as_py()] * len(at), pa.int64()) for c in ("doc_id", "row")]
                held.append(pa.RecordBatch.from_arrays([*map(pa.array, pair), *same, pa.array(at.astype(np.int32))], names=names))
                n_held += len(at)
                if n_held >= ROWS_OUT:
                    yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                    held, n_held = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return run


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary")
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), text.alias("text"))
    return rows.select("doc_id", "text", *text_key(F.col("text")))


def _same_row(left: DataFrame, right: DataFrame) -> Column:
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["k1"] == right["k1"]) & (left["k2"] == right["k2"])


def repeats(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, k1, k2, whole, starts`` for the rows (``doc_id, text, k1, k2``) that lose words:
    all of them (``whole``), or the windows that begin at ``starts``."""
    read = kept_table(rows.mapInArrow(_anchored(length), _ANCHORED), "anchors")
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("of")
    classes = read.where("anchors is not null").groupBy("c1", "c2").agg(least)
    classes = classes.select("c1", "c2", F.col("of.doc_id").alias("least_id"), F.col("of.row").alias("row"))
    classes = kept_table(classes, "classes")

    met = read.select("row", "c1", F.posexplode("anchors").alias("k", "anchor"))
    shared = met.groupBy("anchor").agg(F.min("c1").alias("one"), F.max("c1").alias("other")).where("one != other")
    # Kept apart from the aggregation, both sides of a join are dealt anew and a hot key can be split.
    shared = kept_table(shared.select("anchor"), "shared")
    found = met.select("row", "k", "anchor").join(shared, "anchor")
    found = found.groupBy("row").agg(F.collect_list("k").alias("shared"))
    wanted = read.select("row", "doc_id", "k1", "k2").join(classes.select("row"), "row").join(found, "row")
    wanted = kept_table(wanted, "shared-anchors")

    held = rows.join(wanted, _same_row(rows, wanted)).select(wanted["doc_id"], wanted["row"], "text", "shared")
    windows = kept_table(held.mapInArrow(_windows(length), _WINDOWS), "windows")
    smallest = windows.groupBy("w1", "w2").agg(F.min("doc_id").alias("least_id"), F.count("*").alias("n"))
    smallest = kept_table(smallest.where("n > 1 and least_id is not null").drop("n"), "repeated-windows")
    taken = windows.join(smallest, ["w1", "w2"])
    taken = taken.where("doc_id is null or least_id < doc_id").groupBy("row").agg(F.collect_set("at").alias("starts"))
    # What a class loses, all rows of its smallest id lose; larger ids lose everything.
    lost = kept_table(classes.join(taken, "row", "left").drop("row"), "lost")
    every = read.select("doc_id", "k1", "k2", "c1", "c2").join(lost, ["c1", "c2"])
    copy = F.col("least_id").isNotNull() & (F.col("doc_id").isNull() | (F.col("doc_id") > F.col("least_id")))
    every = every.select("doc_id", "k1", "k2", copy.alias("whole"), "starts")
    return kept_table(every.where("whole or starts is not null").dropDuplicates(["doc_id", "k1", "k2"]), "repeats")


_REST = "doc_id bigint, n_words bigint, n_removed bigint, kept string"


def _rest(length: int):
    names = [f.split()[0] for f in _REST.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, kept = [], [], []
            for text, whole, starts in zip(*(batch.column(c) for c in ("text", "whole", "starts"))):
                words = text.as_py().split()
                counts.append(len(words))
                if whole.as_py() and len(words) >= length:
                    words = []
                elif starts.is_valid:
                    change = np.zeros(len(words) + 1, np.int64)
                    at = starts.values.to_numpy()
                    change[at] += 1
                    np.add.at(change, at + length, -1)
                    words = [words[k] for k in np.flatnonzero(np.cumsum(change)[:-1] == 0).tolist()]
                removed.append(counts[-1] - len(words))
                kept.append(b" ".join(words).decode())
            columns = [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in (counts, removed)), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def without_repeats(
    docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` (the words that stay, joined by one space) for every row."""
    rows = _keyed(docs, id_col, text_col)
    found = repeats(rows, length)
    joined = rows.join(found, _same_row(rows, found), "left").select(rows["doc_id"], "text", "whole", "starts")
    return joined.mapInArrow(_rest(length), _REST)
