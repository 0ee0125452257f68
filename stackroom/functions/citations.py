"""Short citations such as ``A & B (2020)``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def author_display_name(authorships: Column, position: int) -> Column:
    """Name of the author at ``position`` (from 0), null when missing."""
    return F.get(authorships["author"]["display_name"], F.lit(position))


def citation(authorships: Column, year: Column) -> Column:
    """``A (y)``, ``A & B (y)`` or ``A et al. (y)``; a null year prints ``n.d.``.

    No authors, a null first author, or a null second of two give null: concat
    passes nulls on. Everything reads the one leaf ``author.display_name``, so
    the scan reads no other part of the authorships.
    """
    count = F.size(authorships["author"]["display_name"])
    first = author_display_name(authorships, 0)
    who = (
        F.when(count == 1, first)
        .when(count == 2, F.concat(first, F.lit(" & "), author_display_name(authorships, 1)))
        .when(count > 2, F.concat(first, F.lit(" et al.")))
    )
    shown_year = F.coalesce(year.cast("string"), F.lit("n.d."))
    return F.concat(who, F.lit(" ("), shown_year, F.lit(")"))
