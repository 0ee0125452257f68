"""Conversation repair, source divergence and difference-cover dedup against brute force and SQL."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import duckdb
import fixtures
import numpy as np
import pytest
from pyspark.sql import functions as F
from test_llm_operators import ordered

from stackroom.llm import conversations, cover_anchors, divergence, queries

CONVERSATIONS = "conv_id bigint, turn bigint, role string, text string, n bigint, code string, k1 string, audit string, codes string"


def cheapest_by_rows(codes: bytes) -> tuple[int, str]:
    """Least cost and audit, row by row over all four states."""

    def inserted(best: dict) -> dict:
        for _ in range(3):
            for state, (cost, audit) in list(best.items()):
                after, label = conversations._USER_NEXT[state], (cost + 5, audit + "I")
                if after not in best or label < best[after]:
                    best[after] = label
        return best

    best = inserted({conversations.START: (0, "")})
    for code in codes:
        after: dict = {}
        for state, (cost, audit) in best.items():
            for x, y, more, letter in conversations._row_edits(code):
                label = (cost + more, audit + letter)
                if x == state and (y not in after or label < after[y]):
                    after[y] = label
        best = inserted(after)
    return min(label for state, label in best.items() if state in conversations.ACCEPTED)


def codes_of(rng: random.Random, most: int) -> bytes:
    return bytes(rng.choice([0, 1, 2, 2, 3, 3]) + 4 * rng.choice([0, 0, 0, 1, 2, 3]) for _ in range(rng.randint(0, most)))


def test_cheapest_edits():
    rng = random.Random(1)
    for _ in range(3000):
        codes = codes_of(rng, 9)
        assert conversations.cheapest(codes) == cheapest_by_rows(codes)


def test_pieces_chain_to_the_whole():
    rng = random.Random(2)
    for _ in range(500):
        codes, size = codes_of(rng, 12) or b"\2", rng.randint(1, 4)
        parts = [codes[k : k + size] for k in range(0, len(codes), size)]
        costs, ranks = zip(*map(conversations.between_states, parts))
        cost, path = conversations.chained(list(costs), list(ranks))
        audit = "".join(
            conversations.cheapest(p, x, (y,), tail=False)[1] for p, x, y in zip(parts, path, path[1:])
        ) + conversations._TAIL[path[-1]]
        assert (cost, audit) == cheapest_by_rows(codes)


def conversation_rows() -> list[tuple]:
    rng = random.Random(3)
    texts = ["Hello.", "Yes", "No!", "", " \t\n", None, "é?", "no stop", "done. \n"]
    rows = [(conv, turn, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]), rng.choice(texts))
            for conv in [*range(60), None] for turn in [*range(rng.randint(1, 9)), None]]
    rows += [(100, turn, ("user", "assistant")[turn % 2], f"{turn % 37} x.") for turn in range(400)]  # a third of all rows
    rows += rows[:40] + [(101, None, "user", "a."), (101, None, "user", "a."), (102, 5, "user", "long. " * 20_000)]
    rows += [(103, -(2**40), "assistant", "first."), (103, 2**40, "assistant", "last.")]
    return rows


def conversations_by_sql(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    found = con.execute(queries.OP11_SQL)
    return [c[0] for c in found.description], ordered(found.fetchall())


@pytest.mark.parametrize("piece", [conversations.PIECE, 3])
def test_repaired(spark, monkeypatch, piece):
    monkeypatch.setattr(conversations, "PIECE", piece)
    rows = conversation_rows()
    full = spark.createDataFrame([(*r, 7, "x", "y", "z", "w") for r in rows], CONVERSATIONS).repartition(3)
    got = conversations.repaired(full)
    names, want = conversations_by_sql(rows)
    assert ordered(got.select(*names).collect()) == want
    by_id = {r.conv_id: r for r in got.collect()}
    assert by_id[100].duplicate > 250 and by_id[103].gaps in (0, 2**41 - 1) and len(by_id[100].audit) > 300
    assert all(r.n_repaired == sum(map(r.audit.count, "KRI")) for r in by_id.values())


def test_damage():
    """The checksum of the key decides, and every kind of damage is met."""
    import zlib

    kinds = {zlib.crc32(f"{c}:{t}".encode()) % 20 for c, t, *_ in conversation_rows() if None not in (c, t)}
    assert set(range(5)) <= kinds


def test_conversation_of_dropped_rows(spark):
    import zlib

    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = conversations.repaired(spark.createDataFrame([(conv, 0, "user", "Gone.")], "conv_id bigint, turn bigint, role string, text string"))
    assert tuple(got.first()) == (conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest(), 0)


def test_empty_conversations(spark):
    got = conversations.repaired(spark.createDataFrame([], CONVERSATIONS))
    assert got.columns[0] == "conv_id" and got.count() == 0


def source_rows() -> list[tuple]:
    rng = random.Random(4)
    words = [w * k for w in ("ab", "É", "Zz", "日本", "q") for k in range(1, 7)]
    rows = []
    for i in range(240):
        lang, source = rng.choice(["en", "de", None, ""]), rng.choice(["s0", "s0", "s1", "Ä", None, "z"])
        text = " ".join(rng.choices(words, k=rng.randint(0, 30))) + rng.choice(["", "1,2;3", "\n\n", "`x@Y[z{"])
        rows.append((i, rng.choice([text, text, None, "same Text. same text"]), lang, source))
    rows += [(i, "hot words of a third", "en", "s0") for i in range(120)]
    return rows + [(500, None, "fr", "one"), (501, "", "fr", "two"), (502, "alone " * 30_000, "nl", "one"), (None, "x", None, None)]


def documents_with_clashes(spark, rows):
    named = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    return named.withColumns({c: F.lit("clash") for c in ("key", "term", "n", "docs", "sources", "kept", "p", "item", "rank")}).repartition(4)


@pytest.mark.parametrize("block, pairs", [(divergence.BLOCK, divergence.PAIRS_AT_ONCE), (5, 7)])
def test_divergence(spark, monkeypatch, block, pairs):
    monkeypatch.setattr(divergence, "BLOCK", block)
    monkeypatch.setattr(divergence, "PAIRS_AT_ONCE", pairs)
    rows = source_rows()
    got = divergence.audited(documents_with_clashes(spark, rows))
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", rows)
    found = con.execute(queries.OP12_SQL)
    names, want = [c[0] for c in found.description], ordered(found.fetchall())
    assert ordered(got.select(*names).collect()) == want
    parts = Counter((r[names.index("lang")], r[names.index("part")]) for r in want)
    assert parts["fr", "pair"] == 2 and parts["nl", "pair"] == 0 and parts["en", "term"] > 0


def test_shares_of_large_counts(spark):
    """Counts beyond 64 bits once multiplied stay exact."""
    n, total, kept = 2**62, 2**62 + 12345, 999
    row = spark.sql(f"SELECT {n}L n, {total}L total, {kept}L kept").select(divergence.share(F.col("n"), F.col("total"), F.col("kept")))
    assert row.first()[0] == 1 + divergence.UNIT * (n + 2) // (total + 2 * kept)


def test_texts_are_tokenised_once(spark):
    counted = divergence.term_counts(
        spark.createDataFrame([("en", s, "One two, one") for s in "aab"], "lang string, source string, text string")
    )
    assert ordered(counted.collect()) == [("en", "a", "one", 4, 2), ("en", "a", "two", 2, 2), ("en", "b", "one", 2, 1), ("en", "b", "two", 1, 1)]


def test_empty_sources(spark):
    assert divergence.audited(documents_with_clashes(spark, source_rows()[:1]).where("false")).count() == 0


def test_cover():
    period, cover = cover_anchors.PERIOD, cover_anchors.COVER
    assert sorted((a - b) % period for a in cover for b in cover if a != b) == list(range(1, period))
    for i in range(period):
        for j in range(period):
            assert any((i + s) % period in cover and (j + s) % period in cover for s in range(period))


def test_run_hashes():
    hashes = np.random.default_rng(0).integers(0, 2**63, 70, np.uint64)
    base = cover_anchors._BASES[0]
    got = cover_anchors.run_hashes(hashes, 50, base).tolist()
    want = [sum(int(h) * pow(int(base), k, 1 << 64) for k, h in enumerate(hashes[i : i + 50])) % (1 << 64) for i in range(21)]
    assert got == want


def passages() -> list[tuple]:
    """The odd cases of the fixtures, and passages that meet at every alignment."""
    fifty = fixtures.prose(50, 77).split()
    rows = fixtures.documents()
    for k in range(40):
        own = [fixtures.prose(61 + k, 200 + k).split(), fixtures.prose(3, 300 + k).split()]
        part = fifty if k % 2 else fifty[1:] + ["tail"]
        rows.append((1000 - k, " ".join([*own[0][: k + 1], *part, *own[1]])))
    twice = fixtures.prose(60, 88)
    rows += [(2000, twice + " and " + twice), (2000, fixtures.prose(5, 1) + " " + twice), (2001, "short copy"), (2002, "short copy")]
    return rows + [(None, "lead " + twice), (None, " ".join(fifty))]


@pytest.mark.parametrize("n_partitions", [1, 5])
def test_cover_dedup(spark, n_partitions):
    rows = passages()
    got = cover_anchors.without_repeats(fixtures.table(spark, rows, n_partitions))
    got = got.selectExpr("doc_id", "n_words", "n_removed", "sha2(cast(kept as binary), 256) kept_sha256", "kept text")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    found = con.execute(queries.OP13_SQL)
    assert [c[0] for c in found.description] == got.columns
    want = ordered(found.fetchall())
    assert ordered(got.collect()) == want
    lost = {r[0]: r[2] for r in want if r[0] is not None}
    assert all(lost[1000 - k] == (0 if k > 37 else 50) for k in range(40)) and lost[2002] == 0 and lost[2000] == 0


def test_empty_cover_dedup(spark):
    assert cover_anchors.without_repeats(fixtures.table(spark, [])).count() == 0


def test_remembered_does_not_walk_through_its_memory():
    from stackroom.llm.common import Remembered

    class Walked(Remembered):
        def __iter__(self):
            raise AssertionError("walked through")

        keys = __iter__

    memory = Walked(100)
    memory.update({f"w{k}": k for k in range(40)})
    memory.old = Walked(100)
    memory.old.update({"old": 7})
    assert memory.known_of({"w1", "old", "new"}) == {"new"}
    assert memory["old"] == 7 and memory["w1"] == 1


def test_words_are_learnt_when_asked_for():
    from stackroom.llm.packing import LONGEST_REMEMBERED, WordIds

    asked = []
    ids = WordIds(4, lambda word: asked.append(word) or word.encode())
    long = "x" * (LONGEST_REMEMBERED + 1)
    words = ["a", "b", "a", long, "c", "d", "a", "e", "f", "g", "a", long]
    assert b"".join(map(ids.__getitem__, words)) == "".join(words).encode()
    # Long words are learnt anew, and the memory has two bounded generations; what is frequent stays.
    assert asked.count("a") == 1 and asked.count(long) == 2 and long not in ids
    assert len(ids) <= 3 and len(ids.old) <= 3
