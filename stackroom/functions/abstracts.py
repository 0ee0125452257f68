"""Plain-text abstracts from inverted indexes (word -> positions)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_INDEX_TYPE = "map<string,array<bigint>>"


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def parse_inverted_index(text: Column) -> Column:
    """JSON object -> array of (key word, value positions); unparsable -> null.

    Repeated keys stay separate entries, which is why the map never leaves the
    expression: collecting it would merge them.
    """
    index = F.from_json(text, _INDEX_TYPE, {"allowSingleQuotes": "false"})
    return F.map_entries(index)


def _placed_words(entries: Column) -> Column:
    """One (pos, word) per occurrence."""
    return F.flatten(
        F.transform(
            entries,
            lambda entry: F.transform(
                entry["value"],
                lambda pos: F.struct(pos.alias("pos"), entry["key"].alias("word")),
            ),
        )
    )


def abstract_from_json(text: Column) -> Column:
    """Words in order of (position, word), joined by a space.

    ``{}`` gives the empty string; null, unparsable text and any position that
    is not an integer give null.
    """
    return _bind(
        F.sort_array(_placed_words(parse_inverted_index(text))),
        # Null positions sort first, so the first element tells whether there are any.
        lambda words: F.when(
            F.get(words, F.lit(0)).isNotNull() & F.get(words, F.lit(0))["pos"].isNull(),
            F.lit(None).cast("string"),
        ).otherwise(F.array_join(words["word"], " ")),
    )


def abstract_from_map(index: Column) -> Column:
    """The same for a native ``map<string, array<bigint>>``.

    Words without positions are left out and null positions go last.
    """
    entries = F.filter(F.map_entries(index), lambda entry: entry["value"].isNotNull())

    def joined(words: Column) -> Column:
        placed = F.filter(words, lambda w: w["pos"].isNotNull())
        unplaced = F.filter(words, lambda w: w["pos"].isNull())
        return F.array_join(F.concat(placed, unplaced)["word"], " ")

    return _bind(F.sort_array(_placed_words(entries)), joined)
