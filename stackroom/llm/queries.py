"""One query per operator over the given tables, with SQL where SQL can express it.

A query applies its operator, with production parameters, to the whole table and adds
the digest columns of its result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stackroom.llm import (
    bpe,
    conversations,
    cover_anchors,
    cuckoo,
    divergence,
    licenses,
    line_rules,
    packing,
    sharding,
    simhash,
    suffix_index,
    url_filter,
    warc,
)
from stackroom.llm.common import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_cuckoo_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = cuckoo.exact_groups(table(spark, sf_dir, "documents"))
    sha = F.lower(F.hex("digest")).alias("text_sha256")
    return groups.select("doc_id", "keep_id", "group_size", "kept", sha)


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""


def op2_suffix_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``text`` is what remains when repeated passages of 51 words are cut out as well; the other columns
    are of strings of 400 bytes alone."""
    rest = suffix_index.without_repeats(table(spark, sf_dir, "documents"), by_words=True)
    sha = F.sha2("kept", 256).alias("kept_sha256")
    return rest.select("doc_id", "n_bytes", "n_removed", "n_spans", sha, "n_kept", F.col("rest").alias("text"))


def op3_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.judged(table(spark, sf_dir, "documents")).drop("clean_text")


def _sql_count(text: str, characters: str) -> str:
    return f"length(regexp_replace({text}, '[^{characters}]+', '', 'g'))"


_FAILS = f"""(
      (regexp_matches(l, '[{line_rules.SYMBOLS}!{line_rules.SEPARATORS}]')
       AND (20 * {_sql_count("l", line_rules.SYMBOLS)} > length(l) OR 20 * (length(l) - length(replace(l, '!!', ''))) > length(l)))
      OR (length(l) > {line_rules.LONG_LINE} AND NOT regexp_matches(l, '[.,;:!?…。、！？।؟]'))
      OR ({_sql_count("l", line_rules.SEPARATORS)} >= 3 AND 30 * {_sql_count("l", line_rules.SEPARATORS)} > length(l))
      OR (length(l) <= {line_rules.MAX_BOILERPLATE_CHARS} AND (regexp_matches(l, '{line_rules.MENU}')
          OR {" OR ".join(f"contains(lower(l), '{p}')" for p in line_rules.BOILERPLATE)})))"""

OP3_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws,
         string_split(coalesce(text, ''), chr(10)) AS ls
  FROM documents
),
windows AS (
  SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
  FROM (SELECT r, ws, unnest(generate_series(1, len(ws) - 2)) AS i FROM d)
),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM windows) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT place) AS n_repeat_words FROM (SELECT r, unnest([i, i + 1, i + 2]) AS place FROM twice) GROUP BY r),
measured AS (
  SELECT r, doc_id, text, len(ws) AS n_words,
         length(array_to_string(ws, '')) AS word_chars,
         {_sql_count("text", line_rules.SYMBOLS)} AS n_symbols,
         len(list_filter(ls, lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')))
           - len(list_distinct(list_filter(ls, lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')))) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words,
         length(array_to_string(list_filter(ls, lambda l: NOT {_FAILS}), chr(10))) AS n_clean
  FROM d LEFT JOIN covered USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {line_rules.MIN_WORDS} OR 100 * n_repeat_words > {line_rules.MAX_REPEATED} * n_words AS base_failed,
       NOT (n_words < {line_rules.MIN_WORDS} OR 100 * n_repeat_words > {line_rules.MAX_REPEATED} * n_words)
         AND 100 * n_clean >= {100 - line_rules.MAX_LOSS} * length(text) AS kept
FROM measured
"""

def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex(F.col("fp")[0]), 16, "0")).alias("fingerprint")
    return groups.select("doc_id", digits, "component_id")


def op5_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = sharding.sharded(table(spark, sf_dir, "documents"))
    grown = F.lit(None).cast("int").alias("grown_shard")
    return shards.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", grown)


def op6_forced_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = bpe.decoded(bpe.encoded(table(spark, sf_dir, "documents"), path), path)
    return rows.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    records = warc.read_archives(spark, path)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = url_filter.trained(url_filter.labelled_urls(spark))
    return url_filter.judged(table(spark, sf_dir, "pages"), model)


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scanned(table(spark, sf_dir, "documents"))


def _sql_lines(text: str) -> str:
    joined = f"array_to_string(list_filter(string_split(lower({text}), chr(10)), lambda l: NOT regexp_matches(l, '{licenses.COPYRIGHT_LINE}')), chr(1))"
    for old, new in licenses.SPELLINGS:
        joined = f"replace({joined}, '{old}', '{new}')"
    punctuation = licenses.PUNCTUATION.replace(r"\x00", r"\x02")
    return f"list_transform(string_split(regexp_replace({joined}, '{punctuation}', ' ', 'g'), chr(1)), lambda l: trim(l, ' '))"


_WORDED = "list_filter(ls, lambda l: l <> '')"
_KNOWN = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in licenses.KNOWN)

OP9_SQL = f"""
WITH known AS (
  SELECT sha256(array_to_string({_WORDED}, ' ')) AS digest, min(license_id) AS license_id
  FROM (SELECT license_id, {_sql_lines("text")} AS ls FROM (VALUES {_KNOWN}) AS v(license_id, text)) GROUP BY 1
),
d AS (SELECT row_number() OVER () AS r, doc_id, {_sql_lines("coalesce(text, '')")} AS ls FROM documents),
u AS (SELECT r, doc_id, {_WORDED} AS ls, sha256(array_to_string({_WORDED}, ' ')) AS text_digest FROM d),
each AS (SELECT r, sha256(line) AS digest FROM (SELECT r, unnest(ls) AS line FROM u) UNION ALL SELECT r, text_digest FROM u),
hits AS (
  SELECT r, list_sort(list(DISTINCT license_id)) AS ids FROM each JOIN known USING (digest)
  WHERE digest <> sha256('') GROUP BY r
)
SELECT doc_id, text_digest, license_id, coalesce(array_to_string(ids, ','), '') AS notices, coalesce(len(ids), 0) AS n_notices
FROM u LEFT JOIN hits USING (r) LEFT JOIN known ON digest = text_digest AND text_digest <> sha256('')
"""


def op10_online_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.packed(table(spark, sf_dir, "documents"), path, with_ids=False).drop("ids")

def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repaired(table(spark, sf_dir, "conversations")).drop("n_repaired")


# The checksum, bit by bit over the bytes of the key, which are digits, minus, colon and space.
_SQL_CRC32 = """list_reduce([4294967295::BIGINT] || list_transform(string_split(key, ''), lambda c: ord(c)::BIGINT),
    lambda crc, byte: list_reduce([xor(crc, byte)] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
      lambda v, skip: xor(v // 2, (v % 2) * 3988292384)))"""

OP11_SQL = rf"""
WITH RECURSIVE named AS (
  SELECT coalesce(conv_id::VARCHAR, ' ') AS conv, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
  FROM conversations
),
kinds AS (SELECT conv, turn, role, text, xor({_SQL_CRC32}, 4294967295) % 20 AS kind FROM named),
hit AS (
  SELECT conv, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END)
  FROM kinds
),
numbered AS (SELECT *, row_number() OVER () AS r FROM hit),
placed AS (
  SELECT conv, turn, role, text, row_number() OVER o AS i, left(role, 1) AS initial,
         lag(left(role, 1)) OVER o AS before,
         right(regexp_replace(text, '[\x20\x09-\x0D]+$', ''), 1) AS last_char,
         row_number() OVER (PARTITION BY conv, role, text ORDER BY turn NULLS FIRST, r) AS seen
  FROM numbered
  WINDOW o AS (PARTITION BY conv ORDER BY turn NULLS FIRST, sha256(strlen(role)::VARCHAR || ':' || role || text), r)
),
faults AS (
  SELECT *, CASE WHEN last_char = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate'
                 WHEN last_char NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'fine' END AS fault
  FROM placed
),
counts AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM faults GROUP BY conv
),
-- States: 0 nothing given, 1 system, 2 user, 3 assistant.
inserted(x, y, n) AS (VALUES (0, 0, 0), (1, 1, 0), (2, 2, 0), (3, 3, 0), (0, 2, 1), (1, 2, 1), (3, 2, 1), (2, 3, 1), (0, 3, 2), (1, 3, 2)),
edits(letter, x, y, needs, price) AS (VALUES
  ('D', 0, 0, NULL, 2), ('D', 1, 1, NULL, 2), ('D', 2, 2, NULL, 2), ('D', 3, 3, NULL, 2),
  ('R', 0, 2, '*', 1), ('R', 1, 2, '*', 1), ('R', 3, 2, '*', 1), ('R', 2, 3, '*', 1),
  ('K', 0, 1, 's', 0), ('K', 0, 2, 'u', 0), ('K', 1, 2, 'u', 0), ('K', 3, 2, 'u', 0), ('K', 2, 3, 'a', 0)),
moves AS (
  SELECT repeat('I', n) || letter AS letters, inserted.x, edits.y, needs, price + 5 * n AS price
  FROM inserted JOIN edits ON edits.x = inserted.y
),
lattice(conv, i, state, best) AS (
  SELECT conv, 0::BIGINT, 0, {{'cost': 0::BIGINT, 'audit': ''}} FROM counts
  UNION ALL
  SELECT conv, f.i, m.y, min({{'cost': l.best.cost + price + CASE WHEN needs IS NOT NULL AND fault = 'truncated' THEN 5 ELSE 0 END,
                              'audit': l.best.audit || letters}})
  FROM lattice l JOIN faults f USING (conv) JOIN moves m ON m.x = l.state
  WHERE f.i = l.i + 1 AND (needs IS NULL OR (fault IN ('fine', 'truncated') AND needs IN ('*', initial)))
  GROUP BY conv, f.i, m.y
),
audits AS (
  SELECT conv, min({{'cost': best.cost + 5 * more, 'audit': best.audit || repeat('I', more)}}) AS best
  FROM lattice JOIN counts c USING (conv) JOIN (VALUES (0, 0), (1, 2), (2, 1), (3, 0)) AS tail(state, more) USING (state)
  WHERE lattice.i = c.n GROUP BY conv
),
letters AS (SELECT conv, unnest(string_split(best.audit, '')) AS letter, generate_subscripts(string_split(best.audit, ''), 1) AS k FROM audits),
steps AS (
  SELECT conv, k, letter, count(*) FILTER (letter <> 'I') OVER (PARTITION BY conv ORDER BY k) AS i FROM letters WHERE letter <> ''
),
given AS (
  SELECT conv, k, letter, text, role, i, CASE WHEN letter = 'K' AND role[1] = 's' THEN 0 ELSE 1 END AS spoken
  FROM steps LEFT JOIN faults USING (conv, i) WHERE letter <> 'D'
),
repaired AS (
  SELECT conv, sha256(string_agg(CASE WHEN letter = 'K' THEN role WHEN nth % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' ||
                                 CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY k)) AS hash
  FROM (SELECT *, sum(spoken) OVER (PARTITION BY conv ORDER BY k) AS nth FROM given) GROUP BY conv
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0) AS cost,
       coalesce(best.audit, '') AS audit, coalesce(hash, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce(conv_id::VARCHAR, ' ') AS conv FROM conversations) o
LEFT JOIN counts USING (conv) LEFT JOIN audits USING (conv) LEFT JOIN repaired USING (conv)
"""


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audited(table(spark, sf_dir, "documents"))


OP12_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
),
said AS (
  SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
),
kept AS (SELECT lang, term FROM said GROUP BY ALL HAVING count(DISTINCT r) >= {divergence.MIN_DOCS}),
uses AS (SELECT lang, source, term, count(*) AS n FROM said SEMI JOIN kept USING (lang, term) GROUP BY ALL),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
totals AS (
  SELECT lang, source, coalesce(sum(n), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN uses USING (lang, source) GROUP BY ALL
),
p AS (
  SELECT lang, source, term, coalesce(n, 0) AS n, 1 + ({divergence.UNIT}::HUGEINT * (coalesce(n, 0) + 2)) // (total + 2 * v)::HUGEINT AS p
  FROM totals JOIN kept USING (lang) JOIN sizes USING (lang) LEFT JOIN uses USING (lang, source, term)
),
q AS (
  SELECT lang, term, 1 + ({divergence.UNIT}::HUGEINT * (sum(n) + 2)::HUGEINT) // (sum(sum(n)) OVER (PARTITION BY lang) + 2 * any_value(v))::HUGEINT AS q
  FROM uses JOIN sizes USING (lang) GROUP BY lang, term
),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM totals a JOIN totals b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source
),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value
  FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
) WHERE part = 'pair' OR rank <= {divergence.TOP}
"""


def op13_cover_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = cover_anchors.without_repeats(table(spark, sf_dir, "documents"))
    sha = F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    return rest.select("doc_id", "n_words", "n_removed", sha, F.col("kept").alias("text"))


OP13_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws
  FROM documents
),
w AS (
  SELECT r, doc_id, i, md5(array_to_string(ws[i:i + {cover_anchors.LENGTH - 1}], ' ')) AS h
  FROM (SELECT r, doc_id, ws, unnest(generate_series(1, len(ws) - {cover_anchors.LENGTH - 1})) AS i FROM d)
),
taken AS (
  SELECT r, i FROM (SELECT r, i, doc_id, min(doc_id) OVER (PARTITION BY h) AS least FROM w)
  WHERE least < doc_id OR (doc_id IS NULL AND least IS NOT NULL)
),
gone AS (SELECT DISTINCT r, i + unnest(generate_series(0, {cover_anchors.LENGTH - 1})) AS i FROM taken),
each AS (SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM d),
rest AS (SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text FROM each ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed,
       sha256(coalesce(rest.text, '')) AS kept_sha256, coalesce(rest.text, '') AS text
FROM d LEFT JOIN rest USING (r)
"""


QUERIES = {
    "op1_cuckoo_dedup": op1_cuckoo_dedup,
    "op2_suffix_index": op2_suffix_index,
    "op3_line_rules": op3_line_rules,
    "op4_simhash": op4_simhash,
    "op5_histogram_shards": op5_histogram_shards,
    "op6_forced_bpe": op6_forced_bpe,
    "op7_warc": op7_warc,
    "op8_url_filter": op8_url_filter,
    "op9_license_scan": op9_license_scan,
    "op10_online_packing": op10_online_packing,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_source_divergence": op12_source_divergence,
    "op13_cover_anchors": op13_cover_anchors,
}

SQL = {
    "op1_cuckoo_dedup": OP1_SQL,
    "op3_line_rules": OP3_SQL,
    "op9_license_scan": OP9_SQL,
    "op11_conversation_repair": OP11_SQL,
    "op12_source_divergence": OP12_SQL,
    "op13_cover_anchors": OP13_SQL,
}
