"""Paths of corpus files: manifest URL to local, absolute to relative."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what precedes the dataset in a manifest URL.
URL_MARKER = "/data/parquet/"

# The raw works wait in a folder of their own until enriched.
WORKS = "works"
RAW_SUFFIX = "_aws"
RAW_WORKS = WORKS + RAW_SUFFIX


def local_dir_for(dataset: Column) -> Column:
    return F.when(dataset == WORKS, F.lit(RAW_WORKS)).otherwise(dataset)


def dataset_in(folder: Column) -> Column:
    """Dataset whose downloads a folder holds: the other way round, null for made works."""
    return F.when(folder == RAW_WORKS, F.lit(WORKS)).when(folder != WORKS, folder)


def manifest_url_to_local(url: Column) -> Column:
    """Path below the corpus root for a manifest URL, null without the marker."""
    start = F.instr(url, URL_MARKER)
    rest = F.substring(url, start + len(URL_MARKER), F.length(url))
    entity = F.substring_index(rest, "/", 1)
    tail = F.substring(rest, F.length(entity) + 2, F.length(rest))
    local = F.concat(local_dir_for(entity), F.when(tail == "", "").otherwise(F.concat(F.lit("/"), tail)))
    return F.when(start > 0, local)


def _plain_root(root: str) -> str:
    plain = re.sub(r"\A[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", root).rstrip("/")
    if not plain.startswith("/"):
        raise ValueError(f"the corpus root must be an absolute path or URI: {root}")
    return plain


def relative_path(path: Column, root: str) -> Column:
    """Path below ``root``, with forward slashes. Scheme and authority are ignored.

    Runs for every row of a scan, so it is a search and a substring, no pattern.
    """
    prefix = _plain_root(root) + "/"
    start = F.instr(path, prefix)
    below = F.when(start > 0, F.substring(path, start + len(prefix), F.length(path)))
    return F.translate(F.coalesce(below, path), "\\", "/")


def scanned_file(root: str) -> Column:
    """Relative path of the file a row was read from (``file_path`` is URI-encoded)."""
    uri = F.col("_metadata.file_path")
    decoded = F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))
    return relative_path(F.when(uri.contains("%"), decoded).otherwise(uri), root)
