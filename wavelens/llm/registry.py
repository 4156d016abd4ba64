"""The registered queries of this subpackage, one per operator, and their SQL checks."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavelens.llm import (
    bpe,
    decontaminate,
    embed_dedup,
    exact_dedup,
    langid,
    lexical_search,
    license_scan,
    line_dedup,
    minhash,
    packing,
    periodic,
    pii,
    sharding,
)
from wavelens.llm.common import filled, keyed_text, table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ADDED = packing.added_tokens(public_tokenizers.path("byte_bpe_50k.json"))
SHARDS = [f"shard-{i:03d}" for i in range(256)]


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text, and the bytes they decode to, as digests."""
    docs = keyed_text(table(spark, sf_dir, "documents"))
    encoded = bpe.encode(docs, RANKS, public_tokenizers.PATTERN).drop("text")
    decoded = bpe.decode(encoded, RANKS)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every paragraph of all documents that is a licence notice, and which."""
    return license_scan.scan(keyed_text(table(spark, sf_dir, "documents")))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which lines of every document repeat an earlier one, nearly or exactly."""
    return line_dedup.report(keyed_text(table(spark, sf_dir, "documents")))


OP3_SQL = r"""
WITH texts AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (SELECT doc_id, unnest(lines) AS line_text, generate_subscripts(lines, 1) - 1 AS line FROM texts),
sets AS (
  SELECT doc_id, line, list_distinct(list_filter(
    string_split_regex(line_text, '[ 	
]+'), lambda w: w <> '')) AS ws FROM lines
),
long AS (SELECT row_number() OVER (ORDER BY doc_id, line) AS id, doc_id, line, ws, len(ws) AS n FROM sets WHERE len(ws) >= 1),
words AS (SELECT id, n, unnest(ws) AS w FROM long),
counts AS (SELECT w, count(*) AS c FROM words GROUP BY w),
ranked AS (
  SELECT id, n, w, row_number() OVER (PARTITION BY id ORDER BY c, w) AS r FROM words JOIN counts USING (w)
),
prefix AS (SELECT id, n, w FROM ranked WHERE r <= n - (n * 80 + 99) // 100 + 1),
pairs AS (
  SELECT DISTINCT x.id AS a, y.id AS b FROM prefix x JOIN prefix y ON x.w = y.w AND x.id < y.id
  WHERE least(x.n, y.n) * 100 >= greatest(x.n, y.n) * 80
),
matched AS (
  SELECT DISTINCT b AS id FROM pairs JOIN long x ON x.id = a JOIN long y ON y.id = b
  WHERE 180 * len(list_intersect(x.ws, y.ws)) >= 80 * (x.n + y.n)
),
gone AS (SELECT doc_id, line FROM long JOIN matched USING (id))
SELECT t.doc_id, len(t.lines) AS n_lines, count(g.line) AS n_removed,
       coalesce(string_agg(CAST(g.line AS VARCHAR), ',' ORDER BY g.line), '') AS removed
FROM texts t LEFT JOIN gone g ON g.doc_id = t.doc_id GROUP BY t.doc_id, t.lines
"""


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces with their places in sequences of 2048 tokens."""
    docs = keyed_text(table(spark, sf_dir, "documents"))
    return packing.pack_documents(docs, RANKS, public_tokenizers.PATTERN, added=ADDED)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What becomes of each document when equal texts are kept once."""
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


OP5_SQL = r"""
WITH texts AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM texts WINDOW g AS (PARTITION BY t)
"""


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, by a model fitted on the documents not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = langid.predict(docs, langid.trained(docs), ["doc_id"])
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op7_embed_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all embeddings."""
    return embed_dedup.near_dedup(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


OP7_SQL = r"""
WITH RECURSIVE vectors AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
usable AS (
  SELECT vec_id, v, sqrt(list_inner_product(v, v)) AS size FROM vectors
  WHERE v IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0
),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y ON x.vec_id < y.vec_id AND len(x.v) = len(y.v) WHERE list_inner_product(x.v, y.v) / (x.size * y.size) >= 0.95),
ways AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT vec_id, vec_id AS other FROM embeddings UNION SELECT r.vec_id, w.b FROM reach r JOIN ways w ON w.a = r.other),
direct AS (SELECT a AS vec_id, count(*) AS n FROM ways GROUP BY a)
SELECT vec_id, coalesce(max(n), 0) AS n_links, min(other) AS component_id, vec_id = min(other) AS kept
FROM reach LEFT JOIN direct USING (vec_id) GROUP BY vec_id
"""


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard of every document among 256, with the bytes it brings there."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.octet_length(filled()).cast("long").alias("n_bytes")
    )
    return sharding.place(docs, "doc_id", SHARDS)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document, and terms that disclose whom it is about."""
    found = pii.scan(keyed_text(table(spark, sf_dir, "documents")))
    base = F.filter("spans", lambda s: s["kind"].isin(list(pii.PATTERNS)))
    counts = [
        F.size(F.filter("spans", pii.of_kind(kind))).cast("long").alias(f"n_{kind}")
        for kind in pii.PATTERNS
    ]
    return found.select(
        "doc_id", *counts,
        F.sha2(pii.written(base), 256).alias("base_sha256"),
        pii.written("spans").alias("spans"),
    )


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of documents by two-word shingles."""
    return minhash.near_dedup(keyed_text(table(spark, sf_dir, "documents")), words=2)


OP10_SQL = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) > 1 THEN list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) ELSE ws END) AS shingle FROM texts
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
ways AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, w.b FROM reach r JOIN ways w ON w.a = r.other)
SELECT doc_id, coalesce(max(n), 0) AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fifty best documents for every benchmark item."""
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP11_SQL = r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
),
items AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
),
sizes AS (SELECT doc_id, len(terms) AS n FROM texts WHERE len(terms) > 0),
corpus AS (SELECT count(*) AS total, CAST(sum(n) AS BIGINT) AS words FROM sizes),
found AS (
  SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(terms) AS term FROM texts)
  WHERE term IN (SELECT term FROM items) GROUP BY doc_id, term
),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * max(total) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM found, corpus GROUP BY term
),
scores AS (
  SELECT item_id, doc_id,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * total) // words)))) AS BIGINT) AS score
  FROM found JOIN items USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id), corpus GROUP BY item_id, doc_id
),
ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM scores WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 50
"""


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document lie in passages of which benchmark items."""
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP12_SQL = r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
),
windows AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS k, ws[p : p + least(len(ws), 10) - 1] AS gram
  FROM (SELECT *, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS p FROM items WHERE len(ws) > 0)
),
grams AS (
  SELECT doc_id, k, p, ws[p : p + k - 1] AS gram
  FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS p FROM texts, (SELECT DISTINCT k FROM windows))
),
hits AS (SELECT doc_id, item_id, g.k, p FROM grams g JOIN windows w ON g.k = w.k AND g.gram = w.gram),
places AS (SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(p, p + k)) AS place FROM hits) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS list
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(ws) AS n_words, coalesce(places.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items,
       sha256(coalesce(list, '')) AS items_sha256, places.n IS NOT NULL AS contaminated
FROM texts LEFT JOIN places USING (doc_id) LEFT JOIN named USING (doc_id)
"""


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document, of which one in ten is made periodic first."""
    return periodic.report(table(spark, sf_dir, "documents"), alter=True)


OP13_SQL = r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS own,
         CAST(xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
           lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]),
             lambda x, bit: xor(x >> 1, CASE WHEN x & 1 = 1 THEN CAST(3988292384 AS BIGINT) ELSE 0 END))), CAST(4294967295 AS BIGINT)) AS BIGINT) AS h
  FROM documents
),
facts AS (SELECT *, len(own) AS n, h // 10 AS g FROM texts),
places AS (SELECT *, CASE WHEN n > 0 THEN g % n ELSE 0 END AS a FROM facts),
periods AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM places),
docs AS MATERIALIZED (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
    THEN list_transform(range(n), lambda i: own[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END]) ELSE own END AS ws
  FROM periods
),
grams AS MATERIALIZED (SELECT doc_id, i, hash(ws[i + 1 : i + 16]) AS quick FROM (SELECT doc_id, ws, unnest(range(n - 15)) AS i FROM docs WHERE n >= 24)),
twice AS (SELECT doc_id, i, ws[i + 1 : i + 16] AS gram FROM grams SEMI JOIN (SELECT doc_id, quick FROM grams GROUP BY doc_id, quick HAVING count(*) > 1) t USING (doc_id, quick) JOIN docs USING (doc_id)),
pairs AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM twice x JOIN twice y ON x.doc_id = y.doc_id AND x.gram = y.gram AND x.i < y.i),
islands AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs),
stretches AS (SELECT doc_id, q, min(i) AS s, count(*) + 15 AS shared FROM islands GROUP BY doc_id, q, island),
runs AS MATERIALIZED (SELECT doc_id, s, shared + q AS length, min(q) AS period FROM stretches WHERE shared >= 2 * q AND shared + q >= 24 GROUP BY doc_id, s, shared + q),
listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || length || ',' || period || chr(10), '' ORDER BY s, period) AS list FROM runs GROUP BY doc_id
),
best AS (
  SELECT DISTINCT ON (r.doc_id) r.doc_id, r.s, r.length, r.period FROM runs r
  WHERE NOT EXISTS (SELECT 1 FROM runs o WHERE o.doc_id = r.doc_id AND o.length * r.period > r.length * o.period) ORDER BY r.doc_id, r.s, r.period
),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + period, s + length)) AS i FROM runs),
kept AS (
  SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS text
  FROM (SELECT doc_id, unnest(ws) AS w, unnest(range(n)) AS i FROM docs SEMI JOIN runs USING (doc_id)) ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, s AS start, length, period, 1000 * length // period AS exponent_milli,
       sha256(coalesce(list, '')) AS runs_sha256, sha256(CASE WHEN n_runs IS NULL THEN array_to_string(ws, ' ') ELSE coalesce(kept.text, '') END) AS collapsed_sha256
FROM docs LEFT JOIN listed USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_license_scan": op2_license_scan,
    "op3_line_dedup": op3_line_dedup,
    "op4_packing": op4_packing,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_langid": op6_langid,
    "op7_embed_dedup": op7_embed_dedup,
    "op8_sharding": op8_sharding,
    "op9_pii": op9_pii,
    "op10_minhash": op10_minhash,
    "op11_lexical_search": op11_lexical_search,
    "op12_decontaminate": op12_decontaminate,
    "op13_periodic_runs": op13_periodic_runs,
}

SQL: dict[str, str] = {
    "op3_line_dedup": OP3_SQL,
    "op5_exact_dedup": OP5_SQL,
    "op7_embed_dedup": OP7_SQL,
    "op10_minhash": OP10_SQL,
    "op11_lexical_search": OP11_SQL,
    "op12_decontaminate": OP12_SQL,
    "op13_periodic_runs": OP13_SQL,
}
