"""Queries of the training-data operators: one per operator, each over its whole table.

Every function takes ``(spark, sf_dir)``; the digest columns are derived here from what the
operators return.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapse.llm import bpe, chat, decontam, divergence, html, minhash, quality, secrets, shards, substring, tokens, trie, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query
def op1_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).cast("long").alias("text_crc32"))
    return shards.shuffle_into_shards(docs, 40).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc.new_archive_path(spark)
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    page = lambda c: F.regexp_extract(c, f"^{warc.URN}(-?[0-9]+)$", 1).try_cast("long")
    return warc.read_archives(spark, path).filter("kind = 'record'").select(
        page("id").alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"),
        F.when(F.col("type") == "revisit", page("refers_to")).alias("refers_to"))


SQL["op3_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, strlen(body)::BIGINT AS payload_bytes, sha1(body) AS hex FROM p),
b AS (
  SELECT page_id, payload_bytes, (
    SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
             1 + (((('0x' || substr(hex, 1 + 10 * (k // 8), 10))::UBIGINT >> (5 * (7 - k % 8))) & 31))::INT, 1), '' ORDER BY k)
    FROM range(32) t(k)) AS payload_digest
  FROM d),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM b)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to
FROM m"""


@query
def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=2)


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.judged(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return out.select("doc_id", *quality.FEATURES, "base_failed", "kept")


SQL["op5_quality"] = """
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT *, list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM t),
g AS (
  SELECT rid, j, count(*) OVER (PARTITION BY rid, gram) AS times
  FROM (SELECT rid, j, words[j : j + 4] AS gram
        FROM (SELECT rid, words, unnest(range(1, len(words) - 3)) AS j FROM w WHERE len(words) >= 5))),
r AS (
  SELECT rid, count(DISTINCT k) AS n FROM (SELECT rid, unnest(range(j, j + 5)) AS k FROM g WHERE times > 1) GROUP BY rid),
f AS (
  SELECT w.rid, doc_id, lang, source, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN r ON w.rid = r.rid),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f),
v AS (
  SELECT rid, lang, source, ratio, floor(top / greatest(bottom, 1))::BIGINT AS v
  FROM (SELECT rid, lang, source, unnest(['symbols', 'length', 'dup_lines', 'repeats']) AS ratio,
               unnest([1000 * n_symbols, 100 * word_chars, 1000 * n_dup_lines, 1000 * n_repeat_words]) AS top,
               unnest([n_words, n_words, n_lines, n_words]) AS bottom
        FROM b)),
k AS (
  SELECT lang, source, ratio, 16 * shift + floor(v / pow(2, shift))::INT AS bucket, count(*) AS n
  FROM (SELECT v.*, greatest(length(bin(v.v)) - 5, 0) AS shift FROM v JOIN b USING (rid) WHERE NOT base_failed)
  GROUP BY ALL),
cum AS (
  SELECT 'o' AS level, lang, source, ratio, bucket, sum(n) OVER (PARTITION BY lang, source, ratio ORDER BY bucket) AS c,
         sum(n) OVER (PARTITION BY lang, source, ratio) AS total FROM k
  UNION ALL
  SELECT 'l', lang, NULL, ratio, bucket, sum(n) OVER (PARTITION BY lang, ratio ORDER BY bucket), sum(n) OVER (PARTITION BY lang, ratio)
  FROM (SELECT lang, ratio, bucket, sum(n) AS n FROM k GROUP BY ALL)
  UNION ALL
  SELECT 'a', NULL, NULL, ratio, bucket, sum(n) OVER (PARTITION BY ratio ORDER BY bucket), sum(n) OVER (PARTITION BY ratio)
  FROM (SELECT ratio, bucket, sum(n) AS n FROM k GROUP BY ALL)),
q AS (
  SELECT level, lang, source, ratio, max(total)::BIGINT AS total, min(bucket) FILTER (10 * c >= total) AS b1,
         min(bucket) FILTER (10 * c >= 5 * total) AS b5, min(bucket) FILTER (10 * c >= 9 * total) AS b9
  FROM cum GROUP BY ALL),
ql AS (
  SELECT * REPLACE (((b1 - 16 * greatest(b1 // 16 - 1, 0)) * pow(2, greatest(b1 // 16 - 1, 0)))::BIGINT AS b1,
                    ((b5 - 16 * greatest(b5 // 16 - 1, 0)) * pow(2, greatest(b5 // 16 - 1, 0)))::BIGINT AS b5,
                    ((b9 - 16 * greatest(b9 // 16 - 1, 0)) * pow(2, greatest(b9 // 16 - 1, 0)))::BIGINT AS b9) FROM q),
lq AS (
  SELECT l.lang, l.ratio, (l.total * l.b1 + 200 * a.b1) // (l.total + 200) AS d, (l.total * l.b5 + 200 * a.b5) // (l.total + 200) AS m,
         (l.total * l.b9 + 200 * a.b9) // (l.total + 200) AS u
  FROM ql l JOIN ql a ON a.level = 'a' AND l.ratio = a.ratio WHERE l.level = 'l'),
oq AS (
  SELECT o.lang, o.source, o.ratio, lq.d AS ld, lq.m AS lm, lq.u AS lu, (o.total * o.b1 + 200 * lq.d) // (o.total + 200) AS d,
         (o.total * o.b5 + 200 * lq.m) // (o.total + 200) AS m, (o.total * o.b9 + 200 * lq.u) // (o.total + 200) AS u,
         CASE o.ratio WHEN 'symbols' THEN 60 WHEN 'length' THEN 100 WHEN 'dup_lines' THEN 300 ELSE 150 END AS room
  FROM ql o JOIN lq ON o.lang IS NOT DISTINCT FROM lq.lang AND o.ratio = lq.ratio WHERE o.level = 'o'),
p AS (
  SELECT lang, source, ratio, m + 2 * least(u - m, 2 * (lu - lm) + room // 2) + room AS high,
         CASE WHEN ratio = 'length' THEN m - 2 * least(m - d, 2 * (lm - ld) + room // 2) - room END AS low
  FROM oq),
verdict AS (
  SELECT v.rid, bool_and(v.v <= high AND (low IS NULL OR v.v >= low)) AS inside
  FROM v JOIN p ON v.ratio = p.ratio AND v.lang IS NOT DISTINCT FROM p.lang AND v.source IS NOT DISTINCT FROM p.source GROUP BY v.rid)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce(inside, false) AS kept
FROM b LEFT JOIN verdict USING (rid)"""


@query
def op6_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.kept_digest(table(spark, sf_dir, "documents"))


@query
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digest(table(spark, sf_dir, "documents"))


@query
def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = "\\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", planted), (-7, 1, "assistant", planted)], "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.format_chats(given.unionByName(more)))


@query
def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html.main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokens.new_flat_path(spark)
    tokens.write_flat(table(spark, sf_dir, "documents"), path)
    out = tokens.token_counts(spark, path)
    number = F.concat_ws("-", F.regexp_extract("file", r"part-(\d+)-", 1), F.regexp_extract("file", r"file=(\d+)/", 1))
    return out.withColumn("file", number)


@query
def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


SQL["op11_divergence"] = r"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
w AS (
  SELECT rid, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY ALL HAVING count(DISTINCT rid) >= 30),
cells AS (SELECT w.lang, source, w.term, count(*) AS n FROM w JOIN kept ON w.lang = kept.lang AND w.term = kept.term GROUP BY ALL),
size AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang),
grp AS (
  SELECT g.lang, g.source, coalesce(t.total, 0)::HUGEINT AS total
  FROM (SELECT DISTINCT lang, source FROM d) g
  LEFT JOIN (SELECT lang, source, sum(n) AS total FROM cells GROUP BY ALL) t ON g.lang = t.lang AND g.source = t.source),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000 * (coalesce(c.n, 0) + 5)::HUGEINT) // (g.total + 5 * s.v) AS p,
         1 + (1000000000 * (k.n + 5)::HUGEINT) // (s.total + 5 * s.v) AS q
  FROM grp g JOIN kept k ON g.lang = k.lang JOIN size s ON g.lang = s.lang
  LEFT JOIN cells c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
far AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN far f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM parts)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50"""


@query
def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.conversation_trie(table(spark, sf_dir, "conversations"))


SQL["op12_trie"] = r"""
WITH t AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
           sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS pos,
         {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS said
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, list(said ORDER BY pos) AS turns FROM t GROUP BY c),
-- crc32 by bits: each byte is followed by eight shifts (256); its last two bits are what is needed
crc AS (
  SELECT c, turns, xor(list_reduce(list_concat([4294967295::UBIGINT], flatten(list_transform(string_split(c::VARCHAR, ''),
             lambda ch: [ascii(ch)::UBIGINT, 256, 256, 256, 256, 256, 256, 256, 256]))),
           lambda a, x: CASE WHEN x < 256 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::UBIGINT) ELSE a >> 1 END), 4294967295::UBIGINT) % 4 AS h
  FROM own),
built AS (
  SELECT a.c, list_concat(coalesce(b.turns, [])[1 : a.h], a.turns[a.h + 1 :]) AS turns
  FROM crc a LEFT JOIN own b ON b.c = a.c - a.c % 20),
pre AS (SELECT c, d, turns[1 : d] AS seq, len(turns) = d AS ends FROM (SELECT c, turns, unnest(range(0, len(turns) + 1)) AS d FROM built)),
node AS (
  SELECT seq, d, min(c) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM pre GROUP BY seq, d),
spot AS (SELECT pre.c, pre.d, node.conv_id FROM pre JOIN node ON pre.d = node.d AND pre.seq = node.seq),
up AS (
  SELECT n.conv_id, n.d, p.conv_id AS parent, n.n_convs, n.ends_sha256,
         CASE WHEN n.d = 0 THEN 0 ELSE (n.n_convs - 1) * len(regexp_extract_all(n.seq[n.d].text, '[^\x20\x09-\x0D]+')) END AS saved
  FROM node n LEFT JOIN spot p ON p.c = n.conv_id AND p.d = n.d - 1),
kids AS (SELECT parent, d - 1 AS d, count(*) AS n FROM up WHERE d > 0 GROUP BY ALL),
full_node AS (SELECT up.*, coalesce(kids.n, 0) AS n_children FROM up LEFT JOIN kids ON kids.parent = up.conv_id AND kids.d = up.d),
sums AS (
  SELECT a.conv_id, a.d, count(*) FILTER (n.n_children = 0) AS n_leaves, sum(n.saved) AS saved_tokens
  FROM full_node n JOIN spot a ON a.c = n.conv_id AND a.d <= n.d GROUP BY ALL)
SELECT n.conv_id, n.d::BIGINT AS depth, n.parent AS parent_conv_id, n.n_convs::BIGINT AS n_convs, n.n_children::BIGINT AS n_children,
       s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM full_node n JOIN sums s ON s.conv_id = n.conv_id AND s.d = n.d"""


@query
def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_digest(table(spark, sf_dir, "documents"))
