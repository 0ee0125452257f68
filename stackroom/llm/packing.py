"""Packing documents into sequences: bounded-space online packing.

A task tokenises its documents and keeps at most ``OPEN`` windows open. Whole windows are
cut from a long document first. What remains goes to the open window that it fits best, or
opens one more; when none fits and no more may be open, the fullest is filled up with the
head of the piece and emitted, and the rest is placed in turn. So every emitted window is
full. At the end of a task the emptiest open windows fill up the others, and the one that is
left is merged with those of other tasks, best fit decreasing, in groups of ``TASKS_MERGED``
tasks: so many rows of (window, length) meet in one place, whatever the size of the corpus.

A task holds the pieces of its open windows and nothing else; pieces are written to the
shared folder once, so a lost executor repeats a task's packing as a whole.

Results for odd input: a null or empty text is its end token alone; rows that repeat an id
are packed one by one; a null id is carried along; an empty table has no pieces.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stackroom.llm.bpe import byte_alphabet
from stackroom.llm.common import Remembered, kept_table, process_cache

LENGTH = 2048
OPEN = 16
TASKS_MERGED = 64
ROWS_AT_ONCE = 128
ROWS_OUT = 1024

REMEMBERED = 300_000
LONGEST_REMEMBERED = 64

#: Code points below this one: Latin letters whose lower case is among them, and nothing that combines.
LATIN = 0x180


def _latin(category: str) -> str:
    """The Latin code points of a category, as part of a character class."""
    return "".join(f"\\u{c:04x}" for c in range(LATIN) if unicodedata.category(chr(c))[0] == category)


def latin_words() -> re.Pattern:
    """How the vocabulary file splits texts: contractions, runs of letters, single digits,
    runs of anything else but white space."""
    letters, numbers, spaces = _latin("L"), _latin("N"), r"\t-\r \x85\xa0"
    return re.compile(f"[{letters}]+|'(?:s|t|re|ve|m|ll|d)|[{numbers}]|[^{spaces}{letters}{numbers}]+")


class WordIds(Remembered):
    """The ids of words by word, learnt when a word is first asked for. Long words are not kept."""

    def __init__(self, most: int, learn: Callable[[str], bytes]):
        super().__init__(most)
        self.learn = learn

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self.learn(word)
        if len(word) <= LONGEST_REMEMBERED:
            self.make_room()
            self[word] = ids
        return ids


class WordCodec:
    """Ids of a vocabulary with word ends, equal to the tokenizers library.

    Each word is encoded by itself, so a worker remembers the ids of words. That way is
    taken for texts of Latin letters without combining marks, for which lower case is the
    same everywhere and normal form C changes nothing; other texts, and those that hold a
    special token, are encoded whole.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.beyond = re.compile(f"[^\\x00-\\u{LATIN - 1:04x}]")
        self.words = latin_words()
        self.model = self.tokenizer.model
        self.shown = {byte: character for character, byte in byte_alphabet().items()}
        self.ids = WordIds(REMEMBERED, self._learn)

    def _is_whole(self, text: str) -> bool:
        """Whether a text is to be encoded whole."""
        return any(s in text for s in self.special) or not text.isascii() and bool(self.beyond.search(text))

    def _whole(self, texts: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint32).tobytes() for e in encoded]

    def _learn(self, word: str) -> bytes:
        """The ids of a word. It is one piece, so the model takes it as it is, its bytes written
        in the vocabulary's characters."""
        shown = word if word.isascii() and word.isprintable() else "".join(map(self.shown.__getitem__, word.encode()))
        return array("I", [token.id for token in self.model.tokenize(shown)]).tobytes()

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        others = [k for k, t in enumerate(texts) if self._is_whole(t)]
        out = dict(zip(others, self._whole([texts[k] for k in others])))
        for k, text in enumerate(texts):
            if k not in out:
                out[k] = b"".join(map(self.ids.__getitem__, self.words.findall(text.lower())))
        return [out[k] for k in range(len(texts))]


def word_codec(path: str) -> WordCodec:
    known = process_cache()
    if ("words", path) not in known:
        known["words", path] = WordCodec(path)
    return known["words", path]


@dataclass
class Window:
    number: int
    filled: int = 0
    pieces: list[tuple] = field(default_factory=list)


class Packer:
    """The open windows of one task. ``place`` returns the rows of windows it has closed."""

    def __init__(self, first: int, length: int, most_open: int):
        self.next, self.length, self.most_open = first, length, most_open
        self.open: list[Window] = []

    def _new(self) -> Window:
        self.next += 1
        return Window(self.next - 1)

    def _put(self, window: Window, doc, total: int, ids: memoryview, start: int, size: int, first: int = 0) -> None:
        """Add ``size`` ids from ``start``; ``ids`` holds the document's ids from ``first`` on."""
        part = bytes(ids[4 * (start - first) : 4 * (start - first + size)])
        window.pieces.append((doc, start, size, zlib.crc32(part), total, window.number, window.filled, part))
        window.filled += size

    def place(self, doc, ids: bytes) -> list[tuple]:
        held, total, start, closed = memoryview(ids), len(ids) // 4, 0, []
        while total - start >= self.length:
            window = self._new()
            self._put(window, doc, total, held, start, self.length)
            closed += [(*p, False) for p in window.pieces]
            start += self.length
        while start < total:
            size = total - start
            fitting = [w for w in self.open if self.length - w.filled >= size]
            if fitting:
                window = max(fitting, key=lambda w: w.filled)
            elif len(self.open) < self.most_open:
                window = self._new()
                self.open.append(window)
            else:
                window = max(self.open, key=lambda w: w.filled)
                size = self.length - window.filled
            self._put(window, doc, total, held, start, size)
            start += size
            if window.filled == self.length:
                self.open.remove(window)
                closed += [(*p, False) for p in window.pieces]
        return closed

    def rest(self) -> list[tuple]:
        """Fill the open windows from the emptiest ones; the rows of all, one left open at most."""
        left = sorted(self.open, key=lambda w: w.filled)
        while len(left) > 1:
            giver, taker = left[0], left[-1]
            doc, start, size, _, total, _, _, part = giver.pieces.pop()
            moved = min(size, self.length - taker.filled)
            giver.filled -= size
            held, first = memoryview(part), start
            if moved < size:
                self._put(giver, doc, total, held, start, size - moved, first)
            self._put(taker, doc, total, held, start + size - moved, moved, first)
            left = [w for w in left if w.filled and w.filled < self.length]
        return [(*p, w.filled < self.length) for w in self.open for p in w.pieces]


_PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("window", pa.int64()),
        ("offset", pa.int64()),
        ("ids", pa.binary()),
        ("open", pa.bool_()),
    ]
)
_PIECES_SQL = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, window bigint, offset bigint, "
    "ids binary, open boolean"
)


def _merged(length: int):
    """Best fit decreasing over the windows that some tasks left open."""

    def run(left: pd.DataFrame) -> pd.DataFrame:
        left = left.sort_values(["filled", "window"], ascending=[False, True], kind="stable")
        fills: list[int] = []
        firsts: list[int] = []
        rows = []
        for window, filled in zip(left["window"].tolist(), left["filled"].tolist()):
            fitting = [k for k, f in enumerate(fills) if length - f >= filled]
            if fitting:
                k = max(fitting, key=fills.__getitem__)
            else:
                k = len(fills)
                fills.append(0)
                firsts.append(window)
            rows.append((window, firsts[k], fills[k]))
            fills[k] += filled
        return pd.DataFrame(rows, columns=["window", "sequence_id", "base"])

    return run


def packed(
    docs: DataFrame,
    path: str,
    end_id: int = 1,
    length: int = LENGTH,
    with_ids: bool = True,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids``.

    A document is its ids and ``end_id``. ``ids`` holds the piece's ids as little-endian
    unsigned 32-bit integers, or null without ``with_ids``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = word_codec(path)
        end = np.uint32(end_id).tobytes()
        packer = Packer(TaskContext.get().partitionId() << 32, length, OPEN)
        rows: list[tuple] = []

        def out(rows: list[tuple]) -> pa.RecordBatch:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), _PIECES)]
            if not with_ids:
                columns[7] = pa.nulls(len(rows), pa.binary())
            return pa.RecordBatch.from_arrays(columns, schema=_PIECES)

        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                numbers, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
                for doc, ids in zip(numbers, codec.encode_all(texts)):
                    rows += packer.place(doc, ids + end)
                if len(rows) >= ROWS_OUT:
                    yield out(rows)
                    rows = []
        rows += packer.rest()
        if rows:
            yield out(rows)
        codec.ids.forget()  # the worker stays for later tasks
        pa.default_memory_pool().release_unused()

    text = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), text)
    pieces = kept_table(rows.mapInArrow(run, _PIECES_SQL), "pieces")
    left = pieces.where("open").groupBy("window").agg(F.sum("length").alias("filled"))
    group = F.shiftright("window", 32 + TASKS_MERGED.bit_length() - 1).alias("group")
    merged = left.groupBy(group).applyInPandas(_merged(length), "window bigint, sequence_id bigint, base bigint")
    return pieces.join(kept_table(merged, "merged"), "window", "left").select(
        "doc_id",
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        F.coalesce("sequence_id", "window").alias("sequence_id"),
        (F.col("offset") + F.coalesce("base", F.lit(0))).alias("offset"),
        "ids",
    )
