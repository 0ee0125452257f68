"""Removal of byte strings that occur more than once, on a logarithmic family of suffix arrays.

What is removed: every byte covered by a string of ``LENGTH`` bytes that also starts anywhere
else in the corpus. Every such string (a window) has an anchor: the leftmost of its smallest
``GRAM``-byte grams by hash. The anchor depends on the window's bytes alone, so equal windows
have equal anchors at equal offsets. Neighbouring windows with one anchor form a zone; the
zones of a text hold each of its windows once, and a text has about one per 185 bytes.

1. Zones are found text by text and counted by a 128-bit hash. A zone met twice is repeated
   as a whole.
2. Zones that share a gram with different zones are fetched and dealt out by gram, in order. A
   task adds those of a gram, batch by batch, to a family of suffix arrays: a new batch gets a
   suffix array (the suffixes start at the anchors), is merge-scanned within itself and against
   every level for neighbours that agree on ``LENGTH`` bytes around the anchor, and levels of like
   size merge, so sizes grow geometrically. All matches of a zone contain its anchor, so their
   union is one interval. The next gram begins a new family, so a task holds one gram's zones.
3. A gram with more than ``HOT_ZONES`` different zones, as at the edges of a passage that many
   documents share, is not gathered anywhere: the windows of its zones are counted by 128-bit
   hash, which combines before the shuffle and is dealt out evenly.
4. Intervals meet their texts, and bytes are cut out.

The same runs on words: a text is then the 64-bit hashes of its words, eight bytes each, and the
length that of ``WORDS`` words. Spans are rounded inward to whole words. Both kinds of zones are
made in one pass over the texts and go through all steps together, told apart by ``kind``.

Texts are known by the first 120 bits of their SHA-256, so copies are indexed once, and rows
that repeat an id, or have none, do no harm. Results for odd input: a null text is empty; a
text shorter than ``LENGTH`` loses nothing; an empty table gives an empty table. Texts are
read whole, very long ones in overlapping segments of ``SEGMENT`` bytes.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from heapq import merge
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stackroom.llm.common import Scratch, kept_table, partitions
from stackroom.operators.keyed import might_be_among

LENGTH = 400
WORDS = 51
GRAM = 32
SEGMENT = 1 << 23
HOT_ZONES = 32
BATCH = 512
SALTS = 8
ROWS_OUT = 4096

#: Odd constants that mix the four words of a gram.
_MIX = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
_PLACE = np.uint64((1 << 24) - 1)

_BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def _gram_hashes(text: bytes, step: int = 1) -> np.ndarray:
    """A hash of the ``GRAM`` bytes from each position, or each multiple of ``step`` (which divides 8)."""
    n = (len(text) - GRAM) // step + 1
    words = np.ndarray(((len(text) - 8) // step + 1,), "<u8", text, 0, (step,))
    mixed = words[:n] * _MIX[0]
    for k in range(1, GRAM // 8):
        mixed ^= mixed >> np.uint64(29)
        mixed += words[8 // step * k : 8 // step * k + n]
        mixed *= _MIX[k]
    mixed ^= mixed >> np.uint64(32)
    return mixed


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours: running minima of blocks from both ends."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.uint64(2**64 - 1))
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def zones(text: bytes, length: int = LENGTH, step: int = 1) -> Iterator[tuple[np.ndarray, ...]]:
    """Arrays ``gram, lo, hi, at`` for each segment: the zone's windows start from ``lo`` to
    ``hi``, and its anchor stands at ``at``. All are multiples of ``step``."""
    for start in range(0, max(1, len(text) - length + 1), SEGMENT):
        part = text[start : start + SEGMENT + length - step]
        if len(part) < length:
            return
        grams = _gram_hashes(part, step)
        ranked = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)  # the leftmost of equals
        least = _sliding_min(ranked, (length - GRAM) // step + 1)
        lo = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
        hi = np.r_[lo[1:] - 1, len(least) - 1]
        at = (least[lo] & _PLACE).astype(np.int64)
        yield grams[at].view(np.int64), lo * step + start, hi * step + start, at * step + start


def shared_prefix(a: bytes, b: bytes, most: int) -> int:
    """How many leading bytes are equal, up to ``most``."""
    low, high = 0, min(len(a), len(b), most)
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


Suffix = tuple[bytes, bytes, int]  # from the anchor on, before the anchor (reversed), zone


class SuffixFamily:
    """Suffix arrays of geometric sizes over the zones added so far.

    ``reach[z]`` is how far matches of zone ``z`` reach before and after its anchor.
    """

    def __init__(self, length: int = LENGTH):
        self.length = length
        self.levels: list[list[Suffix]] = []
        self.reach: dict[int, tuple[int, int]] = {}

    def add(self, batch: list[Suffix]) -> None:
        array = sorted(batch)
        for k, suffix in enumerate(array):
            self._walk(suffix, array, range(k + 1, len(array)))
        for level in self.levels:
            at = 0
            for suffix in array:  # both are sorted, so the place only moves on
                at = bisect_left(level, suffix, at)
                self._walk(suffix, level, range(at, len(level)))
                self._walk(suffix, level, range(at - 1, -1, -1))
        while self.levels and len(self.levels[-1]) < 2 * len(array):
            array = list(merge(self.levels.pop(), array))
        self.levels.append(array)

    def _walk(self, suffix: Suffix, array: list[Suffix], places: range) -> None:
        """Neighbours share less and less; the walk ends when no match is possible."""
        after, before, zone = suffix
        least, right = self.length - len(before), len(after)
        for k in places:
            other_after, other_before, other = array[k]
            right = shared_prefix(after, other_after, right)
            if right < least:
                return
            if other != zone:
                left = shared_prefix(before, other_before, len(before))
                if left + right >= self.length:
                    self._reached(zone, left, right)
                    self._reached(other, left, right)

    def _reached(self, zone: int, left: int, right: int) -> None:
        known = self.reach.get(zone, (0, 0))
        self.reach[zone] = (max(known[0], left), max(known[1], right))


def _batches(rows: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _schema(spec: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in spec.split(", "))])


OCCURRENCES = "k1 bigint, k2 bigint, kind int, gram bigint, z1 bigint, z2 bigint, lo int, hi int, at int"
FETCHED = "kind int, gram bigint, hot boolean, n bigint, k1 bigint, k2 bigint, z1 bigint, z2 bigint, lo int, at int, content binary"
INTERVALS = "k1 bigint, k2 bigint, kind int, lo int, hi int"
COUNTED = "h1 bigint, h2 bigint, n bigint"
PLACED = "h1 bigint, h2 bigint, zone bigint, lo int"


def _halves(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)


def word_places(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a text start and end (ASCII white space parts them)."""
    blank = np.r_[True, _BLANK[np.frombuffer(text, np.uint8)], True]
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    return edges[::2], edges[1::2]


def word_codes(text: bytes) -> bytes:
    """Eight bytes for each word."""
    return b"".join(map(xxhash.xxh64_digest, text.split()))


def word_spans(text: bytes, spans: np.ndarray) -> np.ndarray:
    """The spans (rows of from, to) of ``word_codes(text)`` as spans of ``text``, rounded inward to words."""
    starts, ends = word_places(text)
    first, end = -(-spans[:, 0] // 8), spans[:, 1] // 8
    whole = end - first >= WORDS
    return np.stack([starts[first[whole]], ends[end[whole] - 1]], axis=1)


@dataclass(frozen=True)
class Kind:
    """What texts are taken as, the least length of a match in bytes of that, and the step of its windows."""

    number: int
    length: int
    encode: Callable[[bytes], bytes] | None = None
    step: int = 1

    def of(self, text: bytes) -> bytes:
        return self.encode(text) if self.encode else text


def as_bytes(length: int = LENGTH) -> Kind:
    return Kind(0, length)


def as_words() -> Kind:
    return Kind(1, 8 * WORDS, word_codes, 8)


def _occurrences(kinds: list[Kind]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
        for batch in batches:
            for k1, k2, plain in zip(*(batch.column(c) for c in ("k1", "k2", "text"))):
                for kind in kinds:
                    text = kind.of(plain.as_py())
                    if len(text) < kind.length:
                        continue
                    for gram, lo, hi, at in zones(text, kind.length, kind.step):
                        hashed = [xxhash.xxh3_128_digest(text[i : j + kind.length]) for i, j in zip(lo.tolist(), hi.tolist())]
                        pair = _halves(hashed)
                        keys = [np.full(len(lo), k.as_py(), np.int64) for k in (k1, k2)]
                        places = [x.astype(np.int32) for x in (lo, hi, at)]
                        yield [*keys, np.full(len(lo), kind.number, np.int32), gram, pair[:, 0], pair[:, 1], *places]

    return run


def _regrouped(run, spec: str):
    """Batches of the many small arrays that ``run`` gives, in the columns of ``spec``."""
    names = [f.split()[0] for f in spec.split(", ")]

    def joined(held: list[list[np.ndarray]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], names=names)

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for columns in run(batches):
            held.append(columns)
            n += len(columns[0])
            if n >= ROWS_OUT:
                yield joined(held)
                held, n = [], 0
        if held:
            yield joined(held)

    return grouped


def _fetch(kinds: list[Kind]):
    schema = _schema(FETCHED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for wanted, plain in zip(*(batch.column(c) for c in ("wanted", "text"))):
                plain, wanted = plain.as_py(), wanted.as_py()
                for kind in kinds:
                    mine = [z for z in wanted if z["kind"] == kind.number]
                    text = kind.of(plain) if mine else b""
                    for z in mine:
                        content = text[z["lo"] : z["hi"] + kind.length]
                        known = (z["kind"], z["gram"], z["hot"], z["n"], z["k1"], z["k2"], z["z1"], z["z2"], z["lo"])
                        rows.append((*known, z["at"] - z["lo"], content))
                if len(rows) >= ROWS_OUT:
                    yield from _batches(rows, schema)
                    rows = []
            yield from _batches(rows, schema)

    return run


def _matched(kinds: list[Kind]):
    schema, lengths = _schema(INTERVALS), {k.number: k.length for k in kinds}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family, single, seen, rows, now = SuffixFamily(0), {}, {}, [], None

        def ended() -> None:
            for zone, (left, right) in family.reach.items():
                if zone in single:  # zones met twice are repeated as a whole anyway
                    k1, k2, kind, anchor = single[zone]
                    rows.append((k1, k2, kind, anchor - left, anchor + right))

        for batch in batches:
            for start in range(0, batch.num_rows, BATCH):
                part = batch.slice(start, BATCH).to_pylist()
                for key, of_gram in groupby(part, key=lambda row: (row["kind"], row["gram"])):
                    if key != now:  # rows come in order of kind and gram
                        ended()
                        family, single, seen, now = SuffixFamily(lengths[key[0]]), {}, {}, key
                    added = []
                    for row in of_gram:
                        if (row["z1"], row["z2"]) in seen:  # a row that was there twice
                            continue
                        zone = seen[row["z1"], row["z2"]] = len(seen)
                        content, at = row["content"], row["at"]
                        added.append((content[at:], content[:at][::-1], zone))
                        if row["n"] == 1:
                            single[zone] = (row["k1"], row["k2"], row["kind"], row["lo"] + at)
                    if added:
                        family.add(added)
            if len(rows) >= ROWS_OUT:
                yield from _batches(rows, schema)
                rows.clear()
        ended()
        yield from _batches(rows, schema)

    return run


def _windows(kinds: list[Kind], spec: str):
    """A row for each window of a zone: its hash, and what ``spec`` asks of the zone."""
    names, of_kind = [f.split()[0] for f in spec.split(", ")], {k.number: (k.length, k.step) for k in kinds}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
        for batch in batches:
            for row in batch.to_pylist():
                content, (length, step) = memoryview(row["content"]), of_kind[row["kind"]]
                starts = range(0, len(content) - length + 1, step)
                pair = _halves([xxhash.xxh3_128_digest(content[s : s + length]) for s in starts])
                columns = [pair[:, 0], pair[:, 1]]
                columns += [np.full(len(starts), row[c], np.int64) for c in names[2:] if c != "lo"]
                if "lo" in names:
                    columns.append(np.array(starts, np.int32) + np.int32(row["lo"]))
                yield columns

    return run


def text_key(text: Column) -> list[Column]:
    """Two 60-bit halves of the text's SHA-256, as ``k1`` and ``k2``."""
    digest = F.sha2(text, 256)
    halves = [F.conv(F.substring(digest, start, 15), 16, 10).cast("bigint") for start in (1, 16)]
    return [half.alias(name) for half, name in zip(halves, ("k1", "k2"))]


def zones_of(rows: DataFrame, kinds: list[Kind]) -> DataFrame:
    """The zones of all texts (``k1, k2, text``)."""
    return rows.select("k1", "k2", "text").mapInArrow(_regrouped(_occurrences(kinds), OCCURRENCES), OCCURRENCES)


@dataclass(frozen=True)
class Level:
    """One level of the index: the zones of its texts, in the order of their grams, and the texts."""

    zones: DataFrame
    texts: DataFrame
    n_zones: int


class SuffixIndex:
    """A family of levels, each kept as tables in the shared folder, to which batches are added.

    The zones of a new batch meet those of every level by gram; where grams are shared, suffixes
    of old and new texts are merge-scanned together. Then the batch becomes a level, and levels
    of like size merge, so sizes grow geometrically and a zone is rewritten a logarithmic
    number of times.
    """

    def __init__(self, kinds: list[Kind]):
        self.kinds = kinds
        self.levels: list[Level] = []

    def add(self, rows: DataFrame) -> DataFrame:
        """``k1, k2, spans``: what repeats now in the texts of the batch (``doc_id, k1, k2, text``) and,
        because of it, in older ones."""
        rows = kept_table(rows.select("doc_id", "k1", "k2", "text"), "batch")
        zones = kept_table(zones_of(rows, self.kinds), "zones")
        found = repeated_intervals(rows, self.kinds, zones, self.levels)
        level = Level(zones, rows, zones.count())
        while self.levels and self.levels[-1].n_zones < 2 * level.n_zones:
            old = self.levels.pop()
            both = old.zones.unionByName(level.zones).repartitionByRange("kind", "gram").sortWithinPartitions("kind", "gram")
            texts = kept_table(old.texts.unionByName(level.texts), "level-texts")
            level = Level(kept_table(both, "level"), texts, old.n_zones + level.n_zones)
        self.levels.append(level)
        return found


def repeated_intervals(
    rows: DataFrame, kinds: list[Kind], zones: DataFrame | None = None, older: list[Level] | None = None
) -> DataFrame:
    """``k1, k2, spans`` (of ``kind, lo, hi``): the repeated intervals of each text that has any;
    they may overlap. ``rows`` are ``doc_id, k1, k2, text`` (binary); lengths and intervals are
    those of the text taken as its kind. ``zones`` are those of ``rows`` where they are made already;
    texts of ``older`` levels count where they share a gram with a text of ``rows``."""
    spark = rows.sparkSession
    scratch = Scratch(spark)  # all but the spans goes at the end, or as soon as it has been read
    occurrences = scratch.kept(zones_of(rows, kinds), "zones") if zones is None else zones
    if older:
        shared = scratch.kept(occurrences.select("kind", "gram").distinct(), "batch-grams")
        for level in older:
            occurrences = occurrences.unionByName(level.zones.join(shared, ["kind", "gram"], "left_semi").select(occurrences.columns))
            rows = rows.unionByName(level.texts)
        occurrences = scratch.kept(occurrences, "met-zones")
    # Zones whose gram is met once match nothing. About half of them go here, before any zone moves; what a
    # Bloom filter lets through besides is harmless.
    met_again = scratch.kept(occurrences.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram"), "met-grams")
    occurrences = scratch.kept(might_be_among(occurrences, met_again, "gram").select(occurrences.columns), "shared-zones")
    scratch.drop("met-grams", *(["zones"] if zones is None else []), *(["batch-grams", "met-zones"] if older else []))
    first = [F.first(c).alias(c) for c in ("k1", "k2", "kind", "gram", "lo", "hi", "at")]
    met = scratch.kept(occurrences.groupBy("z1", "z2").agg(F.count("*").alias("n"), *first), "distinct-zones")
    grams = met.groupBy("gram").agg(F.count("*").alias("n_zones")).where("n_zones > 1")
    contested = met.join(scratch.kept(grams, "grams"), "gram").withColumn("hot", F.col("n_zones") > HOT_ZONES)
    wanted = contested.groupBy("k1", "k2").agg(
        F.collect_list(F.struct("kind", "gram", "hot", "n", "k1", "k2", "z1", "z2", "lo", "hi", "at")).alias("wanted")
    )
    copies = rows.groupBy("k1", "k2").agg(F.min("doc_id").alias("one"))  # copies are fetched once
    wanted = scratch.kept(wanted.join(copies, ["k1", "k2"]), "wanted")
    scratch.drop("grams")
    held = rows.join(wanted.withColumnsRenamed({"k1": "w1", "k2": "w2"}), _same_text() & F.col("doc_id").eqNullSafe(F.col("one")))
    fetched = held.select("wanted", "text").mapInArrow(_fetch(kinds), FETCHED)
    fetched = scratch.kept(fetched.withColumn("zone", F.monotonically_increasing_id()), "contents")
    scratch.drop("wanted")

    length = F.element_at(F.create_map(*[F.lit(x) for k in kinds for x in (k.number, k.length)]), F.col("kind"))
    whole = met.where("n > 1").select("z1", "z2")
    found = occurrences.join(whole, ["z1", "z2"], "left_semi")
    found = found.select("k1", "k2", "kind", "lo", (F.col("hi") + length).alias("hi")).distinct()
    found = scratch.kept(found, "whole-zones")
    scratch.drop("distinct-zones", "shared-zones")
    dealt = fetched.where("not hot").drop("zone").repartition(partitions(spark), "gram").sortWithinPartitions("kind", "gram")
    found = found.unionByName(dealt.mapInArrow(_matched(kinds), INTERVALS))
    hot = fetched.where("hot").select("n", "zone", "k1", "k2", "kind", "lo", "content")
    # The windows of one zone differ, and a zone that a repeated row brings twice has n > 1.
    counted = hot.select("n", "kind", "content").mapInArrow(_regrouped(_windows(kinds, COUNTED), COUNTED), COUNTED)
    twice = counted.groupBy("h1", "h2").agg(F.sum("n").alias("n")).where("n > 1").select("h1", "h2")
    # There are very many windows, so they carry a number for their zone.
    placed = hot.where("n = 1").select("kind", "zone", "lo", "content").mapInArrow(_regrouped(_windows(kinds, PLACED), PLACED), PLACED)
    again = placed.join(twice, ["h1", "h2"], "left_semi").groupBy("zone").agg(F.min("lo").alias("lo"), F.max("lo").alias("hi"))
    again = again.join(hot.select("zone", "k1", "k2", "kind"), "zone").withColumn("hi", F.col("hi") + length)
    found = found.unionByName(again.select("k1", "k2", "kind", "lo", "hi"))
    spans = found.groupBy("k1", "k2").agg(F.sort_array(F.collect_list(F.struct("kind", "lo", "hi"))).alias("spans"))
    spans = kept_table(spans, "spans")
    scratch.drop()
    return spans


def _same_text() -> Column:
    return (F.col("k1") == F.col("w1")) & (F.col("k2") == F.col("w2"))


def _with_spans(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """``rows`` with the spans of their text. Copies of one text meet its spans in ``SALTS`` places."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))).alias("w_salt")
    spans = spans.select(F.col("k1").alias("w1"), F.col("k2").alias("w2"), "spans", every)
    return salted.join(spans, _same_text() & (F.col("salt") == F.col("w_salt")), "left")


def cut(text: bytes, spans: np.ndarray) -> tuple[bytes, int, int]:
    """The remaining bytes, how many were removed, and in how many runs. ``spans`` are rows of from, to,
    in order."""
    if not len(spans):
        return text, 0, 0
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.flatnonzero(np.r_[True, spans[1:, 0] > reach[:-1]])
    starts, ends = spans[new, 0].tolist(), reach[np.r_[new[1:] - 1, len(spans) - 1]].tolist()
    rest = b"".join(text[a:b] for a, b in zip([0, *ends], [*starts, len(text)]))
    return rest, len(text) - len(rest), len(starts)


def every_span(text: bytes, spans: np.ndarray) -> np.ndarray:
    """Spans of both kinds (rows of kind, from, to) as spans of the text's bytes, in order."""
    in_words = spans[:, 0] == 1
    found = spans[~in_words, 1:]
    if not in_words.any():
        return found
    found = np.concatenate([found, word_spans(text, spans[in_words, 1:])])
    return found[np.argsort(found[:, 0], kind="stable")]


def _keyed(docs: DataFrame, id_col: str, text_col: str, *extra: Column) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary")
    rows = docs.select(*extra, F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), text.alias("text"))
    return rows.select("*", *text_key(F.col("text")))


_REST = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary, n_kept bigint, rest string"


def _cut_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in _REST.split(", ")]
    for batch in batches:
        rows = []
        held = batch.column("spans")
        flat = np.stack([x.to_numpy().astype(np.int64) for x in held.flatten().flatten()], axis=1)
        ends = np.cumsum(pc.fill_null(pc.list_value_length(held), 0).to_numpy())
        for text, spans in zip(batch.column("text").to_pylist(), np.split(flat, ends[:-1])):
            in_bytes = spans[spans[:, 0] == 0, 1:]
            kept, removed, runs = cut(text, in_bytes)
            rest = cut(text, every_span(text, spans))[0] if len(in_bytes) < len(spans) else kept
            rows.append((len(text), removed, runs, kept, len(kept), rest.decode("utf-8", "ignore")))
        columns = list(zip(*rows)) if rows else [()] * 6
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, columns, kinds)], names=names)


def without_repeats(
    docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", by_words: bool = False
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (the remaining bytes), ``n_kept, rest`` for every
    row. ``rest`` is the remaining text; with ``by_words``, passages of ``WORDS`` words are cut out of
    it as well, whatever their bytes."""
    rows = _keyed(docs, id_col, text_col)
    kinds = [as_bytes(length), *([as_words()] if by_words else [])]
    spans = repeated_intervals(rows, kinds)
    return _with_spans(rows, spans).select("doc_id", "text", "spans").mapInArrow(_cut_rows, _REST)


def with_texts_cut(
    docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", by_words: bool = False
) -> DataFrame:
    """``docs`` with the remaining text in place of the text; characters cut in part go too.

    ``by_words``: passages of ``WORDS`` words that occur elsewhere, whatever their bytes and the
    white space between them, are cut as well."""

    @F.pandas_udf("string")
    def rest(texts: pd.Series, spans: pd.Series) -> pd.Series:
        lists = ([(x["kind"], x["lo"], x["hi"]) for x in held] if held is not None else [] for held in spans)
        rows = (np.array(held, np.int64).reshape(-1, 3) for held in lists)
        found = (cut(text, every_span(text, held))[0] for text, held in zip(texts, rows))
        return pd.Series([text.decode("utf-8", "ignore") for text in found])

    rows = _keyed(docs, id_col, text_col, F.struct("*").alias("row"))
    kinds = [as_bytes(length), *([as_words()] if by_words else [])]
    spans = repeated_intervals(rows.select("doc_id", "text", "k1", "k2"), kinds)
    joined = _with_spans(rows.drop("text"), spans)  # the text is in the row: it travels once
    joined = joined.withColumn("text", F.coalesce(F.col("row")[text_col], F.lit("")).cast("binary"))
    left = F.when(F.col("spans").isNull(), F.col("row")[text_col]).otherwise(rest("text", "spans"))
    return joined.select("row", left.alias("left")).select(
        *[F.col("left").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns]
    )
