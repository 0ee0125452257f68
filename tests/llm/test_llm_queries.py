"""Queries of the operators against their SQL, or against brute force over the same tables."""

import base64
import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import xxhash
from oracle import connect, difference
from test_llm_operators import brute_components, brute_fingerprint, ordered, repeats
from tokenizers import Tokenizer

from stackroom.llm import queries, url_filter

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.SQL))
def test_query_equals_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, SF_DIR), connect(SF_DIR), queries.SQL[name]) is None


@pytest.fixture(scope="module")
def documents():
    return [(r["doc_id"], r["text"] or "") for r in pq.read_table(f"{SF_DIR}/documents.parquet").to_pylist()]


def rows_of(spark, name, *columns):
    return ordered(queries.QUERIES[name](spark, SF_DIR).select(*columns).collect())


def test_suffix_index_query(spark, documents):
    want = []
    for (i, text), (n_bytes, removed, runs, kept) in zip(documents, repeats([t.encode() for _, t in documents], 400)):
        want.append((i, n_bytes, removed, runs, hashlib.sha256(kept).hexdigest(), len(kept)))
    got = rows_of(spark, "op2_suffix_index", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_kept")
    assert got == ordered(want) and any(r[2] for r in got)


def test_suffix_index_query_cuts_passages_of_short_words(spark, tmp_path):
    """A passage of 55 words in 274 bytes: the contract leaves it, ``text`` is without it. One of 50 words stays."""
    passage, shorter = (" ".join(f"{k}{n:03d}" for n in range(size)) for k, size in (("p", 55), ("q", 50)))
    own = [" ".join(f"d{i}w{n}" for n in range(90)) for i in range(4)]
    texts = [f"{own[0]} {passage}\n{shorter} end", f"begin {passage} {own[1]}", f"{shorter} {own[2]}", own[3], None]
    rows = list(enumerate(texts))
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op2_suffix_index(spark, str(tmp_path)).collect()}
    assert [got[i].text for i, _ in rows] == [(t or "").replace(passage, "") for t in texts]
    for i, text in rows:
        raw = (text or "").encode()
        assert tuple(got[i])[1:6] == (len(raw), 0, 0, hashlib.sha256(raw).hexdigest(), len(raw))


def test_simhash_query(spark, documents):
    fps = {i: brute_fingerprint(t, 3) for i, t in documents}
    label = brute_components(fps, 2)
    got = rows_of(spark, "op4_simhash", "doc_id", "fingerprint", "component_id")
    assert got == ordered((i, f"{fps[i]:016x}", label[i]) for i in fps)


def test_histogram_shards_query(spark, documents):
    """Shards are cut out of the rows in order of text hash and id, as a full sort gives them."""
    got = {r.doc_id: r for r in queries.op5_histogram_shards(spark, SF_DIR).collect()}
    sizes = {i: len(t.encode()) + 1 for i, t in documents}
    assert {i: (r["size"], r.text_crc32, r.law, r.grown_shard) for i, r in got.items()} == {
        i: (sizes[i], zlib.crc32(t.encode()), "bytes", None) for i, t in documents
    }
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    by_sort = sorted((signed(xxhash.xxh64_intdigest(t.encode(), 42)), i) for i, t in documents)
    in_order = [got[i].shard for _, i in by_sort]
    assert in_order == sorted(in_order) and set(in_order) == set(range(16))
    slots, total, below = defaultdict(list), sum(sizes.values()), 0
    for _, i in by_sort:
        slots[got[i].shard].append(got[i].slot)
    assert all(s == list(range(len(s))) for s in slots.values())
    for k in range(15):  # each cut is as near to its share as whole rows allow
        below += sum(sizes[i] for i, r in got.items() if r.shard == k)
        assert abs(below - total * (k + 1) / 16) <= max(sizes.values())


def test_forced_bpe_query(spark, documents):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    want = []
    for i, text in documents:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        raw = np.array(ids, "<u4").tobytes()
        want.append((i, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert rows_of(spark, "op6_forced_bpe", "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == ordered(want)


@pytest.fixture
def pages_with_copies(spark, tmp_path):
    """The given pages, some of them with equal payloads, and empty and null ones."""
    pages = pq.read_table(f"{SF_DIR}/pages.parquet").to_pylist()
    for k, page in enumerate(pages):
        if k % 5 == 0:
            page["html"] = pages[k // 10]["html"]
        if k % 17 == 0:
            page["html"] = "" if k % 2 else None
    spark.createDataFrame(pages, "page_id bigint, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    return str(tmp_path), pages


def test_warc_query(spark, pages_with_copies):
    folder, pages = pages_with_copies
    payloads = {p["page_id"]: (p["html"] or "").encode() for p in pages}
    largest = {}
    for i, payload in payloads.items():
        largest[payload] = max(i, largest.get(payload, i))
    want = []
    for i, payload in payloads.items():
        again = largest[payload] != i
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        want.append((i, len(payload), digest, "revisit" if again else "response", largest[payload] if again else None))
    got = queries.op7_warc(spark, folder)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert ordered(got.collect()) == ordered(want) and sum(w[3] == "revisit" for w in want) > 10


RULES_SQL = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
),
p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts
),
rules(h, p, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
fits AS (
  SELECT page_id, arg_max(h || rules.p, length(h || rules.p)) AS rule, arg_max(verdict, length(h || rules.p)) AS verdict
  FROM p JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, rules.p) GROUP BY page_id
)
SELECT page_id, host, path, rule, verdict FROM p LEFT JOIN fits USING (page_id)
"""


def test_url_filter_query(spark):
    """Host, path and rule of every page as SQL gives them, and the verdict where a rule fits."""
    want = connect(SF_DIR).execute(RULES_SQL).fetchall()
    got = {r.page_id: tuple(r)[:5] for r in queries.op8_url_filter(spark, SF_DIR).select("page_id", "host", "path", "rule", "verdict").collect()}
    assert len(got) == len(want) and any(w[3] for w in want) and any(not w[3] for w in want)
    for page_id, *parts, verdict in want:
        assert got[page_id][1:4] == tuple(parts) and got[page_id][4] in ([verdict] if verdict else ["allow", "block"])


def test_url_filter_of_a_very_long_url(spark):
    model = url_filter.trained(url_filter.labelled_urls(spark))
    rows = [(1, "http://casino.example.org/" + "a/" * 10_000), (2, "http://" + "x" * 20_000), (3, "://" * 5_000)]
    judged = {r.page_id: r for r in url_filter.judged(spark.createDataFrame(rows, "page_id bigint, url string"), model).collect()}
    assert len(judged[1].path) == 20_001 and len(judged[2].host) == 20_000 and judged[3].host == ":"


def test_online_packing_query(spark, documents):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {i: tokenizer.encode(t, add_special_tokens=False).ids + [1] for i, t in documents}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in queries.op10_online_packing(spark, SF_DIR).collect():
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert r.length == len(part) and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(ids)
    for held, whole in [(pieces[i], len(ids[i])) for i in ids] + [(s, None) for s in sequences.values()]:
        held, at = sorted(held), 0
        for start, length in held:
            assert start == at
            at += length
        assert at == whole or (whole is None and at <= 2048)
    least = -(-sum(map(len, ids.values())) // 2048)
    assert least <= len(sequences) <= least + 1
