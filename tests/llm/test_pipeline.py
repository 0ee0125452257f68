"""The pipeline, stage by stage against brute force, on a table of odd cases."""

from __future__ import annotations

from collections import defaultdict

import duckdb
import fixtures
import numpy as np
import public_tokenizers
import pytest
from test_llm_operators import brute_components, brute_fingerprint, repeats
from tokenizers import Tokenizer

import corpus_pipeline
from stackroom.llm import queries, suffix_index


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output rows of every stage."""
    folder = str(tmp_path_factory.mktemp("sf"))
    fixtures.table(spark).write.parquet(f"{folder}/documents.parquet")
    docs, found = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = f"{folder}/{name.replace(' ', '-')}.parquet"
        stage(spark, docs, folder).write.parquet(out)
        after = spark.read.parquet(out)
        if name != "packing":
            assert after.columns == docs.columns
        found[name] = (docs.collect(), after.collect())
        docs = after
    return found


def texts(rows):
    return sorted(((r.doc_id, r.text) for r in rows), key=str)


def test_quality_rules(stages):
    before, after = stages["quality rules"]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [(r.doc_id, r.text) for r in before])
    kept = con.execute(f"SELECT doc_id FROM ({queries.OP3_SQL}) WHERE kept").fetchall()
    assert sorted((r.doc_id for r in after), key=str) == sorted((i for (i,) in kept), key=str)
    assert all(r.n_chars == len(r.text) and r.row == "x" for r in after)


def test_exact_dedup(stages):
    before, after = stages["exact dedup"]
    groups = defaultdict(set)
    for r in before:
        groups[" ".join(r.text.split())].add(r.doc_id)
    want = [min((i for i in ids if i is not None), default=None) for ids in groups.values()]
    assert sorted((r.doc_id for r in after), key=str) == sorted(want, key=str)


def test_near_dedup(stages):
    """One document stays of all that fingerprints of at most two differing bits link."""
    before, after = stages["near dedup"]
    fps = {k: brute_fingerprint(r.text, 3) for k, r in enumerate(before)}
    label = brute_components(fps, 2)
    rank = lambda k: (before[k].doc_id is None, before[k].doc_id or 0)
    groups = defaultdict(list)
    for k in fps:
        groups[label[k]].append(k)
    want = [before[min(group, key=rank)].doc_id for group in groups.values()]
    assert sorted((r.doc_id for r in after), key=str) == sorted(want, key=str) and len(after) < len(before)


def test_near_dedup_of_rows_that_repeat_an_id(spark):
    """A near copy goes, and a clean text under the same id stays; of null ids one stays."""
    text, other = fixtures.prose(900, 31), fixtures.prose(300, 34)
    near = text + " end"
    assert (brute_fingerprint(text, 3) ^ brute_fingerprint(near, 3)).bit_count() <= 2
    rows = [(1, text), (2, near), (2, fixtures.prose(300, 32)), (3, fixtures.prose(300, 33)), (None, other), (None, other), (None, near)]
    after = corpus_pipeline.near_dedup(spark, fixtures.table(spark, rows), "").collect()
    assert texts(after)[1:] == sorted([rows[0], rows[2], rows[3], rows[4], rows[4]], key=str)[1:] and {r.doc_id for r in after} == {1, 2, 3, None}


def test_exact_dedup_of_rows_that_repeat_an_id(spark):
    rows = [(1, "a  b"), (1, "a b"), (2, "a b"), (1, "c"), (None, "c"), (None, "d"), (None, "d "), (None, None), (None, "")]
    after = corpus_pipeline.exact_dedup(spark, fixtures.table(spark, rows), "").collect()
    assert sorted((str(r.doc_id), " ".join((r.text or "").split())) for r in after) == [("1", "a b"), ("1", "c"), ("None", ""), ("None", "d"), ("None", "d")]


def test_repeated_passages(stages):
    before, after = stages["repeated passages"]
    want = []
    for r, found in zip(before, repeats([r.text.encode() for r in before], suffix_index.LENGTH)):
        rest = found[3].decode("utf-8", "ignore")
        if rest.split():
            want.append((r.doc_id, rest))
    assert texts(after) == sorted(want, key=str)
    assert any(a.text != b.text for a in after for b in before if a.doc_id == b.doc_id)


def test_passages_of_over_50_words(spark):
    """51 short words go, however they are spaced; 50 stay; long texts without spaces go by bytes."""
    own = lambda n, mark: " ".join(f"{mark}{k}" for k in range(n))
    short, fifty, solid = own(51, "p"), own(50, "q"), "".join(chr(0x4E00 + k) for k in range(200))
    rows = []
    for k in range(2):
        space = "  \n" if k else " "
        rows.append((k, f"{own(60, f'a{k}x')} {space.join(short.split())} {own(60, f'b{k}x')}"))
        rows.append((10 + k, f"{own(60, f'c{k}x')} {fifty} {own(60, f'd{k}x')}"))
        rows.append((20 + k, f"{own(9, f'e{k}x')} {solid} {own(9, f'f{k}x')}"))
    assert len(short) < suffix_index.LENGTH <= len(solid.encode())
    after = {r.doc_id: r.text.split() for r in corpus_pipeline.repeated_passages(spark, fixtures.table(spark, rows), "").collect()}
    for i, text in rows:
        if i < 20:
            assert after[i] == [w for w in text.split() if w not in short.split()]
        else:
            assert not set(solid) & set("".join(after[i]))


def test_packing(stages):
    before, after = stages["packing"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = sorted(tokenizer.encode(r.text, add_special_tokens=False).ids + [1] for r in before if r.doc_id is not None)
    pieces = defaultdict(list)
    for p in sorted(after, key=lambda p: p.start):
        if p.doc_id is not None:
            pieces[p.doc_id] += np.frombuffer(p.ids, "<u4").tolist()
    assert sorted(pieces.values()) == want


def test_run_and_empty_table(spark, tmp_path):
    fixtures.table(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert [n for n, _ in corpus_pipeline.STAGES][-1] == "packing" and corpus_pipeline.ORACLE_SQL is None
