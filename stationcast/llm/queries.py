"""Registered queries of this subpackage, each over its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationcast.llm.support import scratch

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


@query("op1_token_store")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stationcast.llm import token_store as S

    store = S.write_store(table(spark, sf_dir, "documents", "doc_id", "text"), scratch(spark, "token-store"))
    found = S.read_digests(store, S.lookup(store, S.open_keys(spark, store)), complete=True)
    return found.select(F.col("key").alias("doc_id"), "start", "n_tokens", "ids_crc32")


WORD_SQL = r"[^\x20\x09-\x0D]+"

OP3_SQL = rf"""
WITH RECURSIVE sizes AS MATERIALIZED (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD_SQL}')), 0)::BIGINT AS size FROM documents
), per_source AS (
  SELECT source, sum(size)::BIGINT AS source_size, count(*) AS documents FROM sizes GROUP BY source
), weighted AS MATERIALIZED (
  SELECT *, [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::BIGINT AS weight FROM per_source
), rounds AS (
  SELECT 0 AS round, sum(source_size) * 1.5::DOUBLE AS left_words, sum(weight)::DOUBLE AS left_weight FROM weighted
  UNION ALL
  SELECT round + 1,
    (SELECT sum(source_size) * 1.5::DOUBLE - coalesce(sum(2.0::DOUBLE * source_size) FILTER (2.0::DOUBLE * source_size * r.left_weight < weight * r.left_words), 0) FROM weighted),
    (SELECT coalesce(sum(weight) FILTER (NOT (2.0::DOUBLE * source_size * r.left_weight < weight * r.left_words)), 0)::DOUBLE FROM weighted)
  FROM rounds r WHERE round < (SELECT count(*) + 1 FROM weighted)
), final AS (SELECT left_words, left_weight FROM rounds ORDER BY round DESC LIMIT 1
), targets AS MATERIALIZED (
  SELECT w.*, CASE WHEN 2.0::DOUBLE * source_size * left_weight < weight * left_words THEN 2.0::DOUBLE * source_size
    ELSE weight * left_words / left_weight END AS target,
    ((source_size + documents + 4194303) // 4194304)::BIGINT AS shards, row_number() OVER (ORDER BY source NULLS LAST) AS place
  FROM weighted w, final
), total AS (SELECT round(sum(target) / 16)::BIGINT AS seats, sum(target) AS w, count(*) AS n FROM targets
), source_quotients AS (
  SELECT place, k, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, place, k) AS r FROM targets,
    LATERAL (SELECT unnest(range((2 * (SELECT seats FROM total) * target / (SELECT w FROM total))::BIGINT + (SELECT n FROM total) + 2)) AS k)
  WHERE target > 0
), source_blocks AS MATERIALIZED (
  SELECT t.*, coalesce(b.won, 0) AS source_blocks FROM targets t
  LEFT JOIN (SELECT place, count(*) AS won FROM source_quotients WHERE r <= (SELECT seats FROM total) GROUP BY place) b USING (place)
), docs AS MATERIALIZED (
  SELECT s.doc_id, s.size, b.source, b.place, b.source_size, b.target, b.source_blocks,
    md5('mix-1|' || coalesce(s.doc_id::VARCHAR, '')) AS h,
    ('0x' || substr(md5('mix-1|shard|' || coalesce(s.doc_id::VARCHAR, '')), 1, 8))::BIGINT % b.shards AS shard
  FROM sizes s JOIN source_blocks b ON s.source IS NOT DISTINCT FROM b.source
), ordered AS MATERIALIZED (
  SELECT *, sum(size) OVER (PARTITION BY place, shard ORDER BY h, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS begins FROM docs
), totals AS MATERIALIZED (
  SELECT place, shard, any_value(source) AS source, any_value(source_blocks) AS seats, sum(size)::BIGINT AS shard_size,
    sum(sum(size)) OVER (PARTITION BY place) AS w, count(*) OVER (PARTITION BY place) AS n_shards
  FROM docs GROUP BY place, shard
), shard_quotients AS (
  SELECT place, shard, row_number() OVER (PARTITION BY place ORDER BY shard_size / (2 * k + 1) DESC, shard, k) AS r, seats FROM totals,
    LATERAL (SELECT unnest(range((2 * seats * shard_size / w)::BIGINT + n_shards + 2)) AS k)
  WHERE shard_size > 0
), quotas AS (
  SELECT t.place, t.shard, (shard_size + 15) // 16 AS n, least(coalesce(won, 0), 2 * ((shard_size + 15) // 16)) AS quota, 
    ('0x' || substr(md5('mix-1|start|' || coalesce(source, '') || '|' || t.shard), 1, 8))::BIGINT AS start_hash
  FROM totals t LEFT JOIN (SELECT place, shard, count(*) AS won FROM shard_quotients WHERE r <= seats GROUP BY place, shard) USING (place, shard)
  WHERE shard_size > 0
), runs AS (SELECT place, shard, quota // n AS passes, start_hash % n * 16 AS lo, start_hash % n + quota % n AS hi, n FROM quotas)
SELECT doc_id, size, source_size, target,
  (coalesce(passes, 0) * size
   + coalesce(least(greatest(least(hi, n) * 16 - begins, 0), size) - least(greatest(lo - begins, 0), size), 0)
   + coalesce(least(greatest(greatest(hi - n, 0) * 16 - begins, 0), size), 0))::BIGINT AS taken
FROM ordered LEFT JOIN runs USING (place, shard)
"""


@query("op3_source_mix", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stationcast.llm.mixing import mix

    return mix(table(spark, sf_dir, "documents", "doc_id", "text", "source")).select("doc_id", "size", "source_size", "target", "taken")


OP7_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
t AS (SELECT h, max(page_id) AS top, count(*) AS n FROM p GROUP BY h)
SELECT page_id, octet_length(encode(html)) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(h, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT, 1)), '') AS payload_digest,
  CASE WHEN n > 1 AND top IS DISTINCT FROM page_id AND top IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n > 1 AND top IS DISTINCT FROM page_id THEN top END AS refers_to
FROM p JOIN t USING (h)
"""


@query("op7_warc_bundles", OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stationcast.llm import warc

    archive = warc.write_archive(table(spark, sf_dir, "pages", "page_id", "url", "html"), scratch(spark, "warc"))
    found = warc.read_archive(archive)
    return found.select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


OP10_SQL = """
WITH rules(rule, verdict) AS (VALUES ('org/', 'allow'), ('example.org/es/', 'block'), ('example.org/en/1', 'block'), ('com/fr/', 'allow'), ('com/de/', 'block')),
cut AS (SELECT page_id, CASE WHEN contains(url, '://') THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^?#]*') ELSE '' END AS rest FROM pages),
u AS (SELECT page_id, translate(split_part(rest, '/', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  CASE WHEN contains(rest, '/') THEN substr(rest, strpos(rest, '/')) ELSE '' END AS path FROM cut),
hit AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict FROM u JOIN rules
  ON (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1))) AND starts_with(path, substr(rule, strpos(rule, '/'))) GROUP BY page_id)
SELECT u.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM u LEFT JOIN hit USING (page_id)
"""


@query("op10_url_rules", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stationcast.llm.url_rules import judge_urls

    return judge_urls(table(spark, sf_dir, "pages", "page_id", "url"))


OP2_SQL = rf"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS MATERIALIZED (SELECT *, regexp_extract_all(text, '{WORD_SQL}') AS words,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD_SQL}')) AS lines FROM d),
grams AS (SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram FROM w, LATERAL (SELECT unnest(range(1, len(words) - 1)) AS i)),
hot AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM grams) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM hot, (SELECT unnest([0, 1, 2]) AS j) GROUP BY doc_id),
m AS MATERIALIZED (SELECT w.doc_id, lang, source, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
  coalesce(rep.n, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines, length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper FROM w LEFT JOIN rep ON w.doc_id = rep.doc_id),
r AS MATERIALIZED (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  coalesce(n_symbols::DOUBLE / nullif(n_words, 0), 0) AS r1, coalesce(word_chars::DOUBLE / nullif(n_words, 0), 0) AS r2, coalesce(n_dup_lines::DOUBLE / nullif(n_lines, 0), 0) AS r3,
  coalesce(n_repeat_words::DOUBLE / nullif(n_words, 0), 0) AS r4, coalesce(n_upper::DOUBLE / nullif(word_chars, 0), 0) AS r5 FROM m),
long AS (SELECT lang, source, unnest([1, 2, 3, 4, 5]) AS k, unnest([r1, r2, r3, r4, r5]) AS v FROM r WHERE NOT base_failed),
steps AS (SELECT k, lang, source, grouping(lang) AS gl, grouping(source) AS gs, least(floor(v * 1024), 1048576) AS step, count(*) AS c
  FROM long GROUP BY GROUPING SETS ((k, lang, source, step), (k, lang, step), (k, step))),
upto AS (SELECT *, sum(c) OVER (PARTITION BY k, lang, source, gl, gs ORDER BY step) AS upto, sum(c) OVER (PARTITION BY k, lang, source, gl, gs) AS n FROM steps),
q AS (SELECT k, lang, source, gl, gs, n, (min(step) FILTER (4 * upto >= n) + 0.5::DOUBLE) / 1024 AS q1, (min(step) FILTER (4 * upto >= 3 * n) + 0.5::DOUBLE) / 1024 AS q3
  FROM upto GROUP BY k, lang, source, gl, gs, n),
f AS (SELECT k, lang, source, gl, gs, n, q1, q3, greatest(q3 - q1, [0.05::DOUBLE, 0.5, 0.2, 0.15, 0.05][k]) * 3 AS wide FROM q),
cut AS (SELECT own.k, own.lang, own.source, CASE WHEN own.n >= 100 THEN own.q1 - own.wide WHEN l.n >= 100 THEN l.q1 - l.wide ELSE a.q1 - a.wide END AS low,
  CASE WHEN own.n >= 100 THEN own.q3 + own.wide WHEN l.n >= 100 THEN l.q3 + l.wide ELSE a.q3 + a.wide END AS high
  FROM f own JOIN f l ON own.k = l.k AND own.lang IS NOT DISTINCT FROM l.lang JOIN f a ON own.k = a.k
  WHERE own.gl = 0 AND own.gs = 0 AND l.gl = 0 AND l.gs = 1 AND a.gl = 1 AND a.gs = 1),
bad AS (SELECT DISTINCT doc_id FROM r JOIN cut ON r.lang IS NOT DISTINCT FROM cut.lang AND r.source IS NOT DISTINCT FROM cut.source
  WHERE [r1, r2, r3, r4, r5][k] > high OR (k = 2 AND r2 < low))
SELECT r.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND bad.doc_id IS NULL AS kept
FROM r LEFT JOIN bad ON r.doc_id = bad.doc_id
"""


@query("op2_quality_rules", OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stationcast.llm.quality import judge

    found = judge(table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op6_toxic_passages")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stationcast.llm import toxicity as X

    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = X.learn(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    rows = X.scored(docs, model, keep=("doc_id",))
    predicted = (F.col("score") >= 0.5).cast("int")
    return rows.select("doc_id", X.held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"), "evidence", "passages")


@query("op9_main_text")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stationcast.llm.density import extract_main_text

    return extract_main_text(table(spark, sf_dir, "pages", "page_id", "url", "html"))


OP4_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, rank::INT AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""


@query("op4_bit_sliced_top_k", OP4_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stationcast.llm.bitsliced import top_k

    return top_k(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


@query("op8_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stationcast.llm.packing import pack

    return pack(table(spark, sf_dir, "documents", "doc_id", "text"))


OP5_SQL = rf"""
WITH RECURSIVE w AS MATERIALIZED (SELECT doc_id, list_transform(regexp_extract_all(coalesce(text, ''), '{WORD_SQL}'),
  lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS words FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, hash(gram) AS h FROM (
  SELECT doc_id, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram FROM w, LATERAL (SELECT unnest(range(1, len(words) - 1)) AS i) WHERE len(words) >= 3
  UNION ALL SELECT doc_id, array_to_string(words, ' ') FROM w WHERE len(words) BETWEEN 1 AND 2)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
link AS MATERIALIZED (SELECT a.doc_id AS u, b.doc_id AS v FROM s a JOIN s b ON a.h = b.h AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id GROUP BY a.doc_id, b.doc_id, na.n, nb.n
  HAVING 100 * count(*) >= 90 * (na.n + nb.n - count(*))),
reach AS (SELECT doc_id AS u, doc_id AS label FROM w UNION SELECT link.v, reach.label FROM reach JOIN link ON link.u = reach.u)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, (SELECT min(label) FROM reach WHERE reach.u = w.doc_id) AS component_id,
  (SELECT count(*) FROM link WHERE link.u = w.doc_id)::BIGINT AS n_links FROM w LEFT JOIN n USING (doc_id)
"""


@query("op5_similar_documents", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stationcast.llm.jaccard import similarity_join

    return similarity_join(table(spark, sf_dir, "documents", "doc_id", "text")).drop("component")


@query("op11_token_counts")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stationcast.llm.token_counts import count_tokens

    return count_tokens(table(spark, sf_dir, "documents", "doc_id", "text"))


OP12_SQL = r"""
WITH RECURSIVE given AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  xor(list_reduce(list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ord(x)::BIGINT),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda x, i: xor(x >> 1, 3988292384 * (x & 1))), 4294967295::BIGINT), 4294967295) % 20 AS fault FROM conversations),
damaged AS (SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
  CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE WHEN fault = 3 THEN 2 ELSE 1 END)) AS copy FROM given WHERE fault <> 0),
placed AS (SELECT coalesce(conv_id::VARCHAR, '') AS c, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
  rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS trimmed FROM damaged),
faults AS MATERIALIZED (SELECT *, left(role, 1) AS r, lag(left(role, 1)) OVER (PARTITION BY c ORDER BY i) AS before, trimmed = '' AS blank, trimmed <> '' AND row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 AS duplicate FROM placed),
f AS MATERIALIZED (SELECT *, NOT blank AND NOT duplicate AND right(trimmed, 1) NOT IN ('.', '!', '?') AS truncated, blank OR duplicate AS gone, count(*) OVER (PARTITION BY c) AS n FROM faults),
sweep AS (SELECT DISTINCT c, n + 1 AS i, {'c': 0, 'a': ''} AS h0, {'c': 10, 'a': 'II'} AS h1, {'c': 5, 'a': 'I'} AS h2, {'c': 0, 'a': ''} AS h3 FROM f
  UNION ALL SELECT c, i, list_min([b0, {'c': 5 + x2.c, 'a': 'I' || x2.a}]), list_min([b1, {'c': 5 + x2.c, 'a': 'I' || x2.a}]), x2, x3 FROM (
    SELECT c, i, b0, b1, list_min([b2, {'c': 5 + b3.c, 'a': 'I' || b3.a}]) AS x2, list_min([b3, {'c': 5 + b2.c, 'a': 'I' || b2.a}]) AS x3 FROM (
      SELECT f.c, f.i,
        list_min([{'c': 2 + h0.c, 'a': 'D' || h0.a}] || CASE WHEN gone THEN [] ELSE [{'c': 1 + 5 * truncated::INT + h2.c, 'a': 'R' || h2.a}] || CASE r WHEN 'u' THEN [{'c': 5 * truncated::INT + h2.c, 'a': 'K' || h2.a}] WHEN 's' THEN [{'c': 5 * truncated::INT + h1.c, 'a': 'K' || h1.a}] ELSE [] END END) AS b0,
        list_min([{'c': 2 + h1.c, 'a': 'D' || h1.a}] || CASE WHEN gone THEN [] ELSE [{'c': 1 + 5 * truncated::INT + h2.c, 'a': 'R' || h2.a}] || CASE WHEN r = 'u' THEN [{'c': 5 * truncated::INT + h2.c, 'a': 'K' || h2.a}] ELSE [] END END) AS b1,
        list_min([{'c': 2 + h2.c, 'a': 'D' || h2.a}] || CASE WHEN gone THEN [] ELSE [{'c': 1 + 5 * truncated::INT + h3.c, 'a': 'R' || h3.a}] || CASE WHEN r = 'a' THEN [{'c': 5 * truncated::INT + h3.c, 'a': 'K' || h3.a}] ELSE [] END END) AS b2,
        list_min([{'c': 2 + h3.c, 'a': 'D' || h3.a}] || CASE WHEN gone THEN [] ELSE [{'c': 1 + 5 * truncated::INT + h2.c, 'a': 'R' || h2.a}] || CASE WHEN r = 'u' THEN [{'c': 5 * truncated::INT + h2.c, 'a': 'K' || h2.a}] ELSE [] END END) AS b3
      FROM sweep JOIN f ON f.c = sweep.c AND f.i = sweep.i - 1))),
best AS MATERIALIZED (SELECT c, h0.c AS cost, h0.a AS audit FROM sweep WHERE i = 1),
letters AS (SELECT c, p, audit[p] AS edit, count(*) FILTER (audit[p] <> 'I') OVER (PARTITION BY c ORDER BY p) AS i FROM best, LATERAL (SELECT unnest(range(1, length(audit) + 1)) AS p)),
kept AS (SELECT l.c, l.p, l.edit, f.role, CASE WHEN l.edit = 'I' THEN '' ELSE f.text END AS text, row_number() OVER (PARTITION BY l.c ORDER BY l.p) AS o
  FROM letters l LEFT JOIN f ON f.c = l.c AND f.i = l.i AND l.edit <> 'I' WHERE l.edit <> 'D'),
opened AS (SELECT *, max((o = 1 AND edit = 'K' AND left(role, 1) = 's')::INT) OVER (PARTITION BY c) AS s FROM kept),
repaired AS (SELECT c, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN (o - s) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY o)) AS h FROM opened GROUP BY c),
sums AS (SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
  count(*) FILTER (i > 1 AND (before || r) NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY c)
SELECT g.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal,
  coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit, coalesce(h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) g LEFT JOIN sums s ON s.c = coalesce(g.conv_id::VARCHAR, '') LEFT JOIN best b ON b.c = s.c LEFT JOIN repaired r ON r.c = s.c
"""


@query("op12_conversation_repair", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stationcast.llm.conversations import audit_damaged

    return audit_damaged(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


OP13_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD_SQL}') AS w FROM documents),
firsts AS (SELECT t, min(doc_id) AS first FROM d GROUP BY t),
marks AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
f AS MATERIALIZED (SELECT part, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS bad, [len(w) < 50, 100 * len(list_distinct(w)) < 65 * len(w),
  100 * length(regexp_replace(d.t, '[^A-Z]', '', 'g')) > 5 * length(d.t), regexp_matches(d.t, '[#$%&*|]'), coalesce(d.doc_id > first, false)] AS x
  FROM d JOIN firsts ON d.t = firsts.t LEFT JOIN marks ON d.doc_id = marks.doc_id),
counts AS MATERIALIZED (SELECT part, x, good, bad, count(*) AS n, list_sum(list_transform(x, lambda y: y::INT)) AS fails FROM f GROUP BY ALL),
l AS (SELECT unnest([1, 2, 3, 4, 5]) AS i),
orders AS (SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM l a JOIN l b ON a.i <> b.i JOIN l c ON c.i NOT IN (a.i, b.i) JOIN l d ON d.i NOT IN (a.i, b.i, c.i) JOIN l e ON e.i NOT IN (a.i, b.i, c.i, d.i)),
steps AS (SELECT o, unnest([1, 2, 3, 4, 5]) AS step FROM orders),
m AS (SELECT part, o, step, n, good, bad, fails, x[o[step]] AS hit, len(list_filter(o[1:step - 1], lambda i: x[i])) > 0 AS before FROM counts, steps)
SELECT part, array_to_string(list_transform(o, lambda i: substr('ABCDE', i, 1)), '') AS filter_order, step::INT AS step,
  coalesce(sum(n) FILTER (NOT hit AND NOT before), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (hit AND NOT before), 0)::BIGINT AS removed, coalesce(sum(n) FILTER (hit AND before), 0)::BIGINT AS redundant,
  coalesce(sum(n) FILTER (hit AND fails = 1), 0)::BIGINT AS unique_fails, coalesce(sum(n) FILTER (hit AND NOT before AND good), 0)::BIGINT AS good_lost,
  coalesce(sum(n) FILTER (hit AND NOT before AND bad), 0)::BIGINT AS toxic_lost, coalesce(sum(n * 120 // nullif(fails, 0)) FILTER (hit), 0)::BIGINT AS shapley
FROM m GROUP BY part, o, step
"""


@query("op13_filter_audit", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stationcast.llm.term_matrix import audit

    return audit(table(spark, sf_dir, "documents", "doc_id", "text", "source"), table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))
