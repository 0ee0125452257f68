"""Normal form, canonical form, dataset and index block of a record id."""

from __future__ import annotations

import re
import string
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Datasets whose ids look like namespace/key.
NAMESPACES = (
    "institution-types",
    "work-types",
    "source-types",
    "licenses",
    "countries",
    "continents",
    "languages",
    "domains",
    "fields",
    "subfields",
    "sdgs",
)

# First letter of a short id and its dataset.
LETTERS = {
    "W": "works",
    "A": "authors",
    "S": "sources",
    "I": "institutions",
    "T": "topics",
    "K": "keywords",
    "P": "publishers",
    "F": "funders",
    "G": "awards",
    "C": "concepts",
}

IDS_PER_BLOCK = 10_000


@dataclass(frozen=True)
class IdScheme:
    """How full ids look: ``https://<host>/<short id>``."""

    host: str

    @property
    def prefix(self) -> str:
        return f"https://{self.host}/"

    @property
    def url_pattern(self) -> str:
        return rf"\Ahttps?://{re.escape(self.host)}/"

    @property
    def column_names(self) -> tuple[str, ...]:
        """Headers under which an id list may keep its ids."""
        return ("id", f"{self.host.split('.')[0]}_id", "work_id")


def trim_space(text: Column) -> Column:
    """Trim every Unicode white space, not only the space character."""
    return F.regexp_replace(text, r"(?U)\A\s++|\s++\z", "")


def unquoted(raw: Column) -> Column:
    return F.btrim(F.btrim(trim_space(raw), F.lit('"')), F.lit("'"))


def short_form(text: Column, scheme: IdScheme) -> Column:
    """Unquoted text without host and outer slashes."""
    return F.btrim(F.regexp_replace(text, scheme.url_pattern, ""), F.lit("/"))


def full_form(text: Column, scheme: IdScheme) -> Column:
    """Unquoted text as a URL; one that is a URL already stays as it is."""
    return F.when(text.rlike(scheme.url_pattern), text).otherwise(
        F.concat(F.lit(scheme.prefix), F.btrim(text, F.lit("/")))
    )


def normalize_id(raw: Column, scheme: IdScheme) -> Column:
    """Short form: no outer quotes, host or slashes."""
    return short_form(unquoted(raw), scheme)


def canonical_id(raw: Column, scheme: IdScheme) -> Column:
    """Full form as stored in the corpus."""
    return full_form(unquoted(raw), scheme)


def _lookup(table: dict[str, str], key: Column) -> Column:
    pairs = [F.lit(item) for pair in table.items() for item in pair]
    return F.try_element_at(F.create_map(*pairs), key)


def dataset_of(normalized: Column) -> Column:
    """Dataset a short id belongs to, null when unmapped. Only ASCII case is folded."""
    text = trim_space(normalized)
    namespace = F.translate(
        F.substring_index(text, "/", 1), string.ascii_uppercase, string.ascii_lowercase
    )
    letter = F.translate(F.substring(text, 1, 1), string.ascii_lowercase, string.ascii_uppercase)
    return F.when(
        text.contains("/"), _lookup({name: name for name in NAMESPACES}, namespace)
    ).otherwise(_lookup(LETTERS, letter))


def id_block(record_id: Column) -> Column:
    """Trailing number divided by 10000; null without digits or beyond 64 bits.

    Beyond 32 bits the value wraps, as the stored column is an INT. The range is
    tested on the text: a cast that fails row by row is very slow.
    """
    digits = F.regexp_extract(record_id, r"(?<![0-9])0*([0-9]+)\z", 1)
    size = F.length(digits)
    fits = size.between(1, 18) | ((size == 19) & (digits <= str(2**63 - 1)))
    block = F.call_function("div", F.when(fits, digits.cast("bigint")), F.lit(IDS_PER_BLOCK))
    return (F.pmod(block + F.lit(2**31), F.lit(2**32)) - F.lit(2**31)).cast("int")
