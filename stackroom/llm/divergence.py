"""How far sources of one language diverge in their words, from texts collapsed to one copy.

1. Equal texts of a language meet once: rows are combined per Arrow batch (a text with the number
   of its copies per source), dealt by (lang, text hash) and combined again, so a text is
   tokenised once however many rows hold it, and its counts are weighted by its copies.
2. Counts per (lang, source, term) and document frequencies are sums; a language keeps the
   terms of at least ``MIN_DOCS`` documents.
3. Every group gives every kept term a smoothed share ``p`` in units of 1e-9, an integer. Two
   sources differ by the sum over all kept terms of ``f(p, q) = (p - q)^2 / (p + q)``, rounded down
   term by term. Most terms are absent from most sources, so with ``z`` the share of an absent
   term the sum over terms splits into what holds for all of them, what a source's own terms
   add against ``z`` of the other, and a correction for terms that both have:

       V f(zs, zt) + sum_s [f(ps, zt) - f(zs, zt)] + sum_t [f(zs, pt) - f(zs, zt)]
                   + sum_both [f(ps, pt) - f(ps, zt) - f(zs, pt) + f(zs, zt)]

   Terms are dealt into blocks of about ``BLOCK`` entries (lang, term, source); a task adds the pairs
   of sources of its block in numpy and returns one row per pair, never one per term and pair.

Shares are made in decimals and all else in 64-bit integers, so the figures are exact while a
term's share sum stays below 2^53.

Results for odd input: null lang, source and text are empty strings, and an empty lang is a
language like others; rows count one by one, whether their ids repeat or not; a group without
terms, or a language that keeps none, still has a row for each pair, of value 0; an empty table
gives an empty table.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stackroom.llm.common import kept_table

MIN_DOCS = 10
TOP = 10
UNIT = 1_000_000_000
BLOCK = 50_000
HELD = 600_000
DOCS_BITS = 40
PAIRS_AT_ONCE = 1 << 20

#: ASCII letters in lower case and all bytes above ASCII stay; the rest parts terms.
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TERMS).split(b" ")


_COLLAPSED = pa.schema([("lang", pa.string()), ("key", pa.binary()), ("text", pa.string()), ("sources", pa.map_(pa.string(), pa.int64()))])
_COLLAPSED_SQL = "lang string, key binary, text string, sources map<string,bigint>"
_COUNTED = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])
_COUNTED_SQL = "lang string, source string, term string, n bigint, docs bigint"


def _collapsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each different text of a batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        found: dict[tuple[str, str], Counter] = defaultdict(Counter)
        for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text"))):
            found[lang, text][source] += 1
        langs, texts = zip(*found)
        keys = [xxhash.xxh3_128_digest(t.encode()) for t in texts]
        sources = [list(c.items()) for c in found.values()]
        columns = [pa.array(c, f.type) for c, f in zip((langs, keys, texts, sources), _COLLAPSED)]
        yield pa.RecordBatch.from_arrays(columns, schema=_COLLAPSED)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents per (lang, source, term); equal texts stand together."""
    # Both sums in one number, documents in the low bits: there are very many of them.
    held: dict[tuple[str, str], dict[bytes, int]] = defaultdict(dict)
    n_held, last, weights = 0, None, Counter()

    def add() -> None:
        nonlocal n_held
        if last is None:
            return
        found = Counter(terms(last[2]))
        found.pop(b"", None)
        for source, copies in weights.items():
            known = held[last[0], source]
            before = len(known)
            for term, n in found.items():
                known[term] = known.get(term, 0) + copies * ((n << DOCS_BITS) + 1)
            n_held += len(known) - before

    def out() -> Iterator[pa.RecordBatch]:
        nonlocal n_held
        for (lang, source), known in held.items():
            if known:
                n = [both >> DOCS_BITS for both in known.values()]
                docs = [both & ((1 << DOCS_BITS) - 1) for both in known.values()]
                columns = [[lang] * len(known), [source] * len(known), [t.decode() for t in known], n, docs]
                arrays = [pa.array(c, f.type) for c, f in zip(columns, _COUNTED)]
                yield pa.RecordBatch.from_arrays(arrays, schema=_COUNTED)
        held.clear()
        n_held = 0

    for batch in batches:
        for lang, key, text, sources in zip(*(batch.column(c).to_pylist() for c in ("lang", "key", "text", "sources"))):
            if last is None or (lang, key) != last[:2]:
                add()
                last, weights = (lang, key, text), Counter()
            weights.update(dict(sources))
            if n_held > HELD:
                yield from out()
    add()
    yield from out()


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs`` of ``docs`` (``lang, source, text``)."""
    distinct = docs.mapInArrow(_collapsed, _COLLAPSED_SQL)
    together = distinct.repartition("lang", "key").sortWithinPartitions("lang", "key")
    counted = together.mapInArrow(_counted, _COUNTED_SQL)
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, total: Column, kept: Column) -> Column:
    """``1 + floor(1e9 (n + 2) / (total + 2 kept))``, exact."""
    wide = [c.cast("decimal(28,0)") for c in (n + 2, total + 2 * kept)]
    return F.when(kept > 0, 1 + F.call_function("div", F.lit(UNIT) * wide[0], wide[1])).cast("bigint")


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _spread(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


_SUMS = "lang string, a string, b string, total bigint"


def _pair_sums(key: tuple, entries: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
    """What the terms of one block add to each ordered pair of sources."""
    names = sorted(groups["source"])
    absent = groups.set_index("source")["absent"].reindex(names).to_numpy()
    place = {s: k for k, s in enumerate(names)}
    entries = entries.sort_values("term", kind="stable")
    at, p = entries["source"].map(place).to_numpy(), entries["p"].to_numpy()
    sums = np.zeros((len(names), len(names)), np.int64)
    base = _f(absent[:, None], absent[None, :])
    for k in range(len(names)):  # a source's own terms against the share of an absent one
        own, n = np.unique(p[at == k], return_counts=True)
        if len(own):
            rows = max(1, PAIRS_AT_ONCE // len(own))
            for j in range(0, len(names), rows):
                sums[k, j : j + rows] = (_f(own[:, None], absent[None, j : j + rows]) - base[k, j : j + rows]).T @ n
    sums += sums.T
    _, starts, sizes = np.unique(entries["term"].to_numpy(), return_index=True, return_counts=True)
    for first in _steps(sizes):
        starts_, sizes_ = starts[first], sizes[first]
        left = np.repeat(np.arange(starts_[0], starts_[-1] + sizes_[-1]), np.repeat(sizes_, sizes_))
        offset = np.arange(len(left)) - np.repeat(np.cumsum(sizes_**2) - sizes_**2, sizes_**2)
        right = np.repeat(starts_, sizes_**2) + offset % np.repeat(sizes_, sizes_**2)
        s, t = at[left], at[right]
        both = _f(p[left], p[right]) - _f(p[left], absent[t]) - _f(absent[s], p[right]) + base[s, t]
        np.add.at(sums, (s, t), both)
    a, b = np.nonzero(~np.eye(len(names), dtype=bool))
    return pd.DataFrame({"lang": key[0], "a": [names[k] for k in a], "b": [names[k] for k in b], "total": sums[a, b]})


def _steps(sizes: np.ndarray) -> Iterator[slice]:
    """Runs of terms whose pairs of sources number about ``PAIRS_AT_ONCE``."""
    cost = np.cumsum(sizes.astype(np.int64) ** 2)
    at = 0
    while at < len(sizes):
        done = cost[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(cost, done + PAIRS_AT_ONCE, "right")))
        yield slice(at, end)
        at = end


def audited(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    top: int = TOP,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """``lang, source, part, item, value, rank``: for each source the divergence from every other
    of its language (part ``pair``), and the terms it uses most beyond the language (``term``)."""
    empty = F.lit("")
    rows = docs.select(*[
        F.coalesce(F.col(f"`{c}`").cast("string"), empty).alias(name)
        for c, name in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))
    ])
    by_source = term_counts(rows)
    by_term = by_source.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"), F.collect_list(F.struct("source", "n")).alias("uses")
    )
    by_term = kept_table(by_term.where(F.col("docs") >= min_docs).drop("docs"), "kept-terms")
    uses = by_term.select("lang", "term", "lang_n", F.inline("uses"))

    occurring = rows.select("lang", "source").distinct()
    langs = by_term.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"), F.sum(F.size("uses")).alias("entries"))
    totals = uses.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = F.lit(0).cast("bigint")
    groups = occurring.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", F.coalesce("total", zero).alias("total"), F.coalesce("kept", zero).alias("kept"),
        F.coalesce("lang_total", zero).alias("lang_total"), F.coalesce("entries", zero).alias("entries"),
    )
    groups = groups.withColumn("absent", share(zero, F.col("total"), F.col("kept")))
    groups = kept_table(groups.withColumn("n_blocks", F.ceil(F.col("entries") / BLOCK).cast("int")), "groups")

    shares = uses.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "n_blocks",
        share(F.col("n"), F.col("total"), F.col("kept")).alias("p"),
        share(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("q"),
    )
    shares = kept_table(shares, "shares")
    blocks = F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("block")
    constants = groups.where("n_blocks > 0").select("lang", "source", "absent", blocks)
    entries = shares.select("lang", F.pmod(F.xxhash64("term"), "n_blocks").cast("int").alias("block"), "source", "term", "p")
    sums = entries.groupBy("lang", "block").cogroup(constants.groupBy("lang", "block")).applyInPandas(_pair_sums, _SUMS)
    sums = sums.groupBy("lang", "a", "b").agg(F.sum("total").alias("total"))

    one = groups.select("lang", F.col("source").alias("a"), "kept", F.col("absent").alias("absent_a"))
    other = groups.select("lang", F.col("source").alias("b"), F.col("absent").alias("absent_b"))
    pairs = one.join(other, "lang").where("a <> b").join(sums, ["lang", "a", "b"], "left")
    base = F.when(F.col("kept") > 0, F.col("kept") * _spread(F.col("absent_a"), F.col("absent_b")))
    value = F.coalesce(base, zero) + F.coalesce("total", zero)
    pairs = pairs.select("lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"), value.alias("value"))

    window = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    said = shares.where("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _spread(F.col("p"), F.col("q")).alias("value")
    )
    said = said.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(window)).unionByName(said)
