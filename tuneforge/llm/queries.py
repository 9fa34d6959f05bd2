"""Registered queries of the subpackage: QUERIES (name -> function) and ORACLES (name -> DuckDB SQL)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, centroid, conversation_repair, exact_dedup, fingerprint, hilbert_ann, html_main, mixture, near_dup, sharding, token_store, toxicity, warc
from .common import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op4_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, _ = mixture.mix(table(spark, sf_dir, "documents"))
    return documents.select("doc_id", "size", "source_size", "target", "taken")


@query
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_classes(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


ORACLES["op6_exact_dedup"] = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
), w AS (
  SELECT doc_id, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size, text_sha256
  FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM w
"""

SHARDS = 40


@query
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shard_documents(table(spark, sf_dir, "documents"), SHARDS)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                       F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


@query
def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return bpe.decode(encoded, ranks).select(
        "doc_id", F.col("n_ids").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def toxicity_model(documents: DataFrame, labels: DataFrame) -> toxicity.Machine:
    """Fitted on labelled rows that are not held out."""
    rows = toxicity.fit_rows(documents, labels.filter(~toxicity.held_out(F.col("doc_id"))))
    return toxicity.fit([t for t, _ in rows], [y for _, y in rows])


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity_model(documents, table(spark, sf_dir, "labels"))
    return toxicity.score(documents, model).select(
        "doc_id", F.coalesce(toxicity.held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


END_ID = 2


@query
def op8_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    _, manifest = token_store.write_store(table(spark, sf_dir, "documents"), path, END_ID)
    return token_store.read_store(manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op1_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.read_records(warc.list_records(manifest)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op1_warc_zip"] = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM f
"""


@query
def op5_site_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main.extract(table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = near_dup.near_classes(table(spark, sf_dir, "documents"))
    return classes.select("doc_id", "class_id", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


@query
def op10_hilbert_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_ann.search(table(spark, sf_dir, "embeddings"), queries_every=20, k=20)


@query
def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_edits(table(spark, sf_dir, "documents"))


def _sketch_sql(text: str) -> str:
    space = r"[\x20\x09-\x0D]+"
    bare = f"regexp_replace({text}, '^{space}|{space}$', '', 'g')"
    shingle = "left(md5(array_to_string(w[i:i + 4], ' ')), 16)"
    return (f"list_transform([CASE WHEN {bare} = '' THEN [] ELSE regexp_split_to_array({bare}, '{space}') END], "
            f"lambda w: list_sort(list_distinct(list_transform(range(1, CASE WHEN len(w) = 0 THEN 1 ELSE greatest(len(w) - 4, 1) + 1 END), "
            f"lambda i: {shingle})))[1:{fingerprint.K}])[1]")


def _alike_sql(a: str, b: str) -> str:
    return (f"list_transform([list_sort(list_distinct(list_concat({a}, {b})))[1:{fingerprint.K}]], lambda u: CASE WHEN len(u) = 0 THEN 1.0::DOUBLE ELSE "
            f"len(list_filter(u, lambda x: list_contains({a}, x) AND list_contains({b}, x)))::DOUBLE / len(u) END)[1]")


ORACLES["op11_fingerprints"] = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         coalesce(lead(coalesce(text, '')) OVER (ORDER BY doc_id), first_value(coalesce(text, '')) OVER (ORDER BY doc_id)) AS following
  FROM documents
), e AS (
  SELECT *, length(text) AS n, left(text, length(text) - length(text) // 4) || left(following, length(text) // 4) AS edited FROM d
), s AS (
  SELECT doc_id, n, edited, {_sketch_sql('text')} AS own, {_sketch_sql('edited')} AS other, {_sketch_sql('following')} AS nxt FROM e
)
SELECT doc_id, n AS n_chars, sha256(edited) AS edited_sha256, array_to_string(own, '') AS fingerprint,
       array_to_string(other, '') AS edited_fingerprint, {_alike_sql('own', 'other')} AS near_edited, {_alike_sql('own', 'nxt')} AS near_next
FROM s
"""


@query
def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid.cluster(table(spark, sf_dir, "embeddings"))


def _centroid_sql(rounds: int = 10, k: int = 8, width: int = 64) -> str:
    """The rounds spelled out, each over (vector, component) rows."""
    parts = [f"""
  kept AS (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings WHERE len(embedding) = {width} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {width}
  ),
  comp AS MATERIALIZED (SELECT r, unnest(range({width})) AS i, unnest(v) AS x FROM kept),
  start AS (SELECT r, row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS c FROM kept ORDER BY c LIMIT {k}),
  c0 AS MATERIALIZED (SELECT c, i, x FROM start JOIN comp USING (r))"""]

    def placed(n: int) -> str:
        return f"""
  a{n} AS MATERIALIZED (
    SELECT r, min(d) AS d, arg_min(c, (d, c)) AS c FROM (
      SELECT p.r, q.c, sum((p.x - q.x) * (p.x - q.x)) AS d FROM comp p JOIN c{n} q USING (i) GROUP BY ALL) GROUP BY r)"""

    for n in range(rounds):
        parts.append(placed(n))
        parts.append(f"""
  c{n + 1} AS MATERIALIZED (
    SELECT c, i, coalesce(m.x, q.x) AS x FROM c{n} q LEFT JOIN (
      SELECT c, i, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS x
      FROM a{n} JOIN comp USING (r) GROUP BY ALL) m USING (c, i))""")
    parts.append(placed(rounds))
    return "WITH " + ",".join(parts) + f"""
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
       CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, h AS centroid_sha256
FROM a{rounds} JOIN kept USING (r)
JOIN (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS h FROM c{rounds} GROUP BY c) USING (c)
"""


ORACLES["op12_centroids"] = _centroid_sql()


@query
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return conversation_repair.repair_all(rows, conversation_repair.damage(rows))


_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(k) + 1), lambda i: ascii(k[i])::BIGINT)),
      lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
        lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"""


def _least(*options: str) -> str:
    """The cheapest, then least, of (cost, audit) structs; null ones do not count."""
    return f"list_min(list_filter([{', '.join(options)}], lambda x: x IS NOT NULL))"


def _edit(state: str, letters: str, cost: str, only: str = "true") -> str:
    return f"CASE WHEN {state} IS NOT NULL AND {only} THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{letters}'}} END"


def _kept(initial: str) -> str:
    return f"NOT gone AND left(role, 1) = '{initial}'"


# The same DP forwards: for each row in turn, the cheapest audit that ends in each of the four states.
ORACLES["op13_conversation_repair"] = f"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
  FROM conversations
), kinds AS (SELECT *, {_CRC32} % 20 AS kind FROM keyed),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM kinds WHERE kind <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i FROM damaged
), seen AS (
  SELECT *, NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
         NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') AS cut, left(lag(role) OVER w, 1) || left(role, 1) AS pair, lag(i) OVER w AS previous
  FROM placed WINDOW w AS (PARTITION BY conv_id ORDER BY i)
), rows AS MATERIALIZED (SELECT *, blank OR again AS gone, CASE WHEN cut AND NOT blank AND NOT again THEN 3 ELSE 0 END AS extra FROM seen),
dp AS (
  SELECT conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': ''}} AS s0, NULL::STRUCT(c BIGINT, a VARCHAR) AS s1,
         NULL::STRUCT(c BIGINT, a VARCHAR) AS s2, NULL::STRUCT(c BIGINT, a VARCHAR) AS s3
  FROM (SELECT DISTINCT conv_id FROM rows)
  UNION ALL
  SELECT conv_id, i, {_edit('s0', 'D', '4')}, {_least(_edit('s1', 'D', '4'), _edit('s0', 'K', 'extra', _kept('s')))},
         {_least(_edit('t2', 'D', '4'), *[_edit(s, 'K', 'extra', _kept('u')) for s in ('s0', 's1', 't3')],
                 *[_edit(s, 'R', '3 + extra', 'NOT gone') for s in ('s0', 's1', 't3')])},
         {_least(_edit('t3', 'D', '4'), _edit('t2', 'K', 'extra', _kept('a')), _edit('t2', 'R', '3 + extra', 'NOT gone'))}
  FROM (
    SELECT r.*, s0, s1, {_least('s2', *[_edit(s, 'I', '3') for s in ('s0', 's1', 's3')])} AS t2,
           {_least('s3', _edit('s2', 'I', '3'), _edit('s0', 'II', '6'), _edit('s1', 'II', '6'))} AS t3
    FROM dp JOIN rows r ON r.conv_id IS NOT DISTINCT FROM dp.conv_id AND r.i = dp.i + 1)
), best AS (
  SELECT conv_id, {_least('s0', 's3', _edit('s2', 'I', '3'), _edit('s1', 'II', '6'))} AS b
  FROM (SELECT *, max(i) OVER (PARTITION BY conv_id) AS n FROM dp) WHERE i = n
), letters AS (
  SELECT conv_id, p, letter, sum(CASE WHEN letter = 'I' THEN 0 ELSE 1 END) OVER w AS i, sum(CASE WHEN letter = 'D' THEN 0 ELSE 1 END) OVER w AS line
  FROM (SELECT conv_id, unnest(range(1, length(b.a) + 1)) AS p, unnest(string_split(b.a, '')) AS letter FROM best)
  WINDOW w AS (PARTITION BY conv_id ORDER BY p)
), lines AS (
  SELECT l.conv_id, line, letter, CASE WHEN letter = 'I' THEN '' ELSE text END AS text, role,
         max(CASE WHEN line = 1 AND letter = 'K' AND left(role, 1) = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY l.conv_id) AS led
  FROM letters l LEFT JOIN rows r ON r.conv_id IS NOT DISTINCT FROM l.conv_id AND r.i = l.i WHERE letter <> 'D'
), repaired AS (
  SELECT conv_id, sha256(string_agg(CASE WHEN letter = 'K' THEN role WHEN (line - led) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text,
                                    chr(10) ORDER BY line)) AS h
  FROM lines GROUP BY conv_id
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank,
         count(*) FILTER (WHERE again AND NOT blank) AS duplicate, count(*) FILTER (WHERE extra > 0) AS truncated,
         count(*) FILTER (WHERE previous IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM rows GROUP BY conv_id
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(b.c, 0) AS cost, coalesce(b.a, '') AS audit, coalesce(h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN repaired p ON p.conv_id IS NOT DISTINCT FROM o.conv_id
"""
