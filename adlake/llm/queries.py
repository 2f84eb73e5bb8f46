"""Registered queries of the operators: ``opN_<name>`` over its whole table, and their SQL."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_exact_dedup", r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
g AS (SELECT doc_id, norm, min(doc_id) OVER (PARTITION BY norm) AS keep_id,
             count(*) OVER (PARTITION BY norm) AS group_size,
             row_number() OVER (PARTITION BY norm ORDER BY doc_id NULLS LAST) AS place FROM d)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(norm) AS text_sha256 FROM g""")
def op1_exact_dedup(spark, sf_dir):
    from adlake.llm.exact_dedup import mark_duplicates
    return mark_duplicates(table(spark, sf_dir, "documents"))


@query("op2_packing")
def op2_packing(spark, sf_dir):
    from adlake.llm.packing import pack
    return pack(table(spark, sf_dir, "documents"), with_ids=False, added_tokens=True)


URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


@query("op4_url_filter", r"""
WITH u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
           FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) AS path FROM u),
r(rule, rhost, rpath, verdict) AS (VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
     ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
m AS (SELECT page_id, host, path, rule, verdict, row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC) AS place
      FROM p LEFT JOIN r ON (host = rhost OR suffix(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE place = 1""")
def op4_url_filter(spark, sf_dir):
    from adlake.llm.url_filter import judge
    return judge(table(spark, sf_dir, "pages"), URL_RULES)


@query("op3_chat_format", r"""
WITH m AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
s AS (SELECT *, 23 + length(role) + length(text) + len(regexp_extract_all(role || chr(10) || text,
        chr(9243) || '|<\|[^|<>\n]{1,40}\|>|</?s>|\[/?INST\]|<</?SYS>>')) AS formatted FROM m)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(formatted) AS BIGINT) AS formatted_chars
FROM s GROUP BY conv_id""")
def op3_chat_format(spark, sf_dir):
    from pyspark.sql import functions as F
    from adlake.llm.chat_format import PART, read_back, render
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit("</s>[INST] ok [/INST]").alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    nothing = [F.lit(None).cast(k) for k in ("string", "int", "int", "double", "int")]
    part = F.struct(F.lit("text").alias("type"), "text", *[n.alias(c) for n, c in zip(
        nothing, ("uri", "width", "height", "seconds", "pages"))]).cast(PART)
    return read_back(render(rows.withColumn("parts", F.array(part))))


@query("op5_language_id")
def op5_language_id(spark, sf_dir):
    from adlake.llm.language_id import fit, identify
    docs = table(spark, sf_dir, "documents")
    return identify(docs, fit(docs))


@query("op6_warc", r"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
h AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS hex, max(page_id) OVER (PARTITION BY sha1(payload)) AS last FROM p),
b AS (SELECT *, list_reduce(list_transform(range(8), lambda i: list_reduce(list_transform(range(3, -1, -1), lambda k:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST('0x' || substr(hex, 5 * i + 1, 5) AS BIGINT) >> (5 * k)) & 31 AS BIGINT) + 1, 1)),
        lambda x, y: x || y)), lambda x, y: x || y) AS payload_digest FROM h)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < last THEN last END AS refers_to FROM b""")
def op6_warc(spark, sf_dir):
    from adlake.llm.warc import pages_to_warc
    return pages_to_warc(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op7_simhash")
def op7_simhash(spark, sf_dir):
    from adlake.llm.simhash import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


@query("op8_decontaminate", r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
w AS (SELECT DISTINCT item_id, n, array_to_string(words[k:k + n - 1], ' ') AS win
      FROM (SELECT item_id, words, least(len(words), 10) AS n, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS k FROM i WHERE len(words) > 0)),
g AS (SELECT r, n, k, array_to_string(words[k:k + n - 1], ' ') AS win
      FROM (SELECT r, words, n, unnest(range(1, len(words) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM w))),
m AS (SELECT r, k, g.n, item_id FROM g JOIN w ON g.win = w.win AND g.n = w.n),
hit AS (SELECT r, count(DISTINCT pos) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS pos FROM m) GROUP BY r),
it AS (SELECT r, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
       FROM (SELECT DISTINCT r, item_id FROM m) GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN it USING (r)""")
def op8_decontaminate(spark, sf_dir):
    from adlake.llm.decontaminate import report
    return report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("items")


@query("op9_html_extract")
def op9_html_extract(spark, sf_dir):
    from adlake.llm.html_extract import main_text
    return main_text(table(spark, sf_dir, "pages"))


@query("op10_token_counts")
def op10_token_counts(spark, sf_dir):
    from adlake.llm.token_counts import count_tokens
    return count_tokens(table(spark, sf_dir, "documents"))


@query("op12_importance", r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
i AS (SELECT -row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
f AS (SELECT r, array_to_string(words[k:k + n - 1], ' ') AS f, count(*) AS c
      FROM (SELECT r, words, n, unnest(range(1, len(words) - n + 2)) AS k
            FROM (SELECT r, words FROM d UNION ALL SELECT r, words FROM i), (VALUES (1), (2), (3)) v(n)) GROUP BY ALL),
entries AS (SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END, b)
                        ORDER BY b) AS t FROM range(256) bytes(b)),
h AS (SELECT f, bytes, xor(4294967295, list_reduce(bytes, lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]), 4294967295::BIGINT)) % 10000 AS bucket
      FROM (SELECT f, list_transform(regexp_extract_all(hex(encode(f)), '..'), lambda x: CAST('0x' || x AS BIGINT)) AS bytes
            FROM (SELECT DISTINCT f FROM f)), entries),
n AS (SELECT bucket, sum(c) FILTER (r > 0) AS s, sum(c) FILTER (r < 0) AS t FROM f JOIN h USING (f) GROUP BY bucket),
g AS (SELECT bucket, CAST(floor(1000 * ln(CAST(coalesce(t, 0) + 1 AS DOUBLE) * (sum(s) OVER () + 10000)
             / (CAST(coalesce(s, 0) + 1 AS DOUBLE) * (sum(t) OVER () + 10000)))) AS BIGINT) AS gain FROM n),
w AS (SELECT r, sum(c) AS n_features, sum(c * gain) AS weight FROM f JOIN h USING (f) JOIN g USING (bucket) WHERE r > 0 GROUP BY r),
v AS (SELECT r, doc_id, len(words) >= 20 AS may, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features,
             CAST(coalesce(weight, 0) AS BIGINT) AS weight, CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' ||
             substr(sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
      FROM d LEFT JOIN w USING (r))
SELECT doc_id, n_features, weight, score, CASE WHEN may AND place <= drawn THEN place END AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY may ORDER BY score DESC, doc_id NULLS LAST) AS place,
             5 * count(*) OVER (PARTITION BY may) // 100 AS drawn FROM v)""")
def op12_importance(spark, sf_dir):
    from adlake.llm.importance import importance
    return importance(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op11_alignment")
def op11_alignment(spark, sf_dir):
    from adlake.llm.alignment import align
    return align(table(spark, sf_dir, "documents"))


@query("op13_ngram_jaccard")
def op13_ngram_jaccard(spark, sf_dir):
    from adlake.llm.jaccard import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"))
