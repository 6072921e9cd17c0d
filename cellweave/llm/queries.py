"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.llm import chat, fingerprints, infill, language, lexicon, licences, nearest, packing, quality, ranked_search, tables, token_counts, urls
from cellweave.llm import near_duplicates as near
from cellweave.llm.registry import query


@query("op1_token_counts")
def count_tokens(spark: SparkSession, folder: str) -> DataFrame:
    docs = tables.read(spark, folder, "documents")
    return token_counts.histogram(token_counts.lengths(docs, public_tokenizers.path("byte_bpe_50k.json")))


@query("op2_best_fit_packing")
def best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    cut = packing.pieces(tables.read(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(cut).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op3_minhash_near_dedup")
def minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near.near_duplicates(tables.read(spark, folder, "documents"), size=2, percent=80)


def _sql_spelled(text: str) -> str:
    text = f"' ' || {text} || ' '"
    for old, new in licences.SPELLINGS:
        text = f"replace({text}, ' {old} ', ' {new} ')"
    return f"trim({text})"


def _sql_lines(text: str) -> str:
    kept = rf"list_filter(string_split({text}, chr(10)), lambda x: NOT regexp_matches(x, '{licences.COPYRIGHT}'))"
    return f"list_filter(list_transform({kept}, lambda x: trim(regexp_replace(lower(x), '[^a-z0-9]+', ' ', 'g'))), lambda x: x <> '')"


LICENCE_SQL = f"""
WITH known AS (
  SELECT {_sql_spelled(f"array_to_string({_sql_lines('text')}, ' ')")} AS known, min(licence) AS licence
  FROM (VALUES {", ".join(map(str, licences.KNOWN))}) AS k(licence, text) GROUP BY 1 HAVING known <> ''
), rows AS (
  SELECT row_number() OVER () AS uid, doc_id, {_sql_lines('text')} AS lines FROM documents
), found AS (
  SELECT uid, count(*) AS n, string_agg(DISTINCT licence, ',' ORDER BY licence) AS notices
  FROM (SELECT uid, unnest(list_transform(lines, lambda x: {_sql_spelled('x')})) AS line FROM rows) JOIN known ON line = known GROUP BY uid
), whole AS (SELECT uid, doc_id, {_sql_spelled("array_to_string(lines, ' ')")} AS text FROM rows)
SELECT doc_id, sha256(text) AS digest, licence, coalesce(n, 0) AS n_notices, coalesce(notices, '') AS notices
FROM whole LEFT JOIN known ON text = known LEFT JOIN found USING (uid)
"""


@query("op4_license_scan", LICENCE_SQL)
def license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licences.scan(tables.read(spark, folder, "documents"), licences.known_licences(spark))


def _sql_escape(text: str) -> str:
    text = f"replace({text}, '\\', '\\\\')"
    for c in chat.CONTROL:
        text = f"replace({text}, '{c}', '{c[0]}\\{c[1:]}')"
    return text


CHAT_SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked AS (
  SELECT *, {_sql_escape('text')} AS escaped, replace({_sql_escape('role')}, '|', '\\|') AS role_text,
         lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(escaped) + CASE WHEN before IS NULL THEN length(role_text) + {len("<|role:|>" + chr(10))}
            WHEN before <> role THEN length(role_text) + {len("<|role:|>" + chr(10) + chat.END)} ELSE {len(chat.NEXT)} END)
            + {len(chat.END)} AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
"""


@query("op5_chat_format", CHAT_SQL)
def chat_format(spark: SparkSession, folder: str) -> DataFrame:
    probe = "</s>[INST] ok [/INST]"
    extra = spark.sql(f"SELECT -7L AS conv_id, 0L AS turn, 'user' AS role, '{probe}' AS text UNION ALL SELECT -7L, 1L, 'assistant', '{probe}'")
    chats = tables.read(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    read = chat.format_chats(chats).select(
        "conv_id", F.length("formatted").cast("long").alias("formatted_chars"),
        chat.read_turns(F.col("formatted")).alias("turns"), chat.learnt_text(F.col("formatted"), F.col("loss_spans")).alias("learnt"),
    )
    all_turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.encode(all_turns, "UTF-8"), 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"), F.sha2(F.encode("learnt", "UTF-8"), 256).alias("loss_sha256"), "formatted_chars",
    )


@query("op6_lz_fingerprint")
def lz_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprint_documents(tables.read(spark, folder, "documents"))


@query("op7_language_id")
def language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(tables.read(spark, folder, "documents")).select("doc_id", "held_out", "lang_pred", "score")


@query("op8_bpe_lexicon")
def bpe_lexicon(spark: SparkSession, folder: str) -> DataFrame:
    return lexicon.round_trip(tables.read(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]

URL_SQL = f"""
WITH rules(rule_host, rule_path, verdict) AS (VALUES {", ".join(map(str, RULES))}),
parts AS (
  SELECT page_id, lower_host AS host, coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM (SELECT *, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_host FROM pages)
)
SELECT page_id, host, path,
       (SELECT max_by(rule_host || rule_path, length(rule_host || rule_path)) FROM rules
        WHERE (host = rule_host OR suffix(host, '.' || rule_host)) AND starts_with(path, rule_path)) AS rule,
       coalesce((SELECT max_by(verdict, length(rule_host || rule_path)) FROM rules
        WHERE (host = rule_host OR suffix(host, '.' || rule_host)) AND starts_with(path, rule_path)), 'allow') AS verdict
FROM parts
"""


@query("op9_url_filter", URL_SQL)
def url_filter(spark: SparkSession, folder: str) -> DataFrame:
    values = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {values} AS rules(host, path, verdict)")
    return urls.judge(tables.read(spark, folder, "pages"), rules)


@query("op10_quality_rules")
def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality.judge(tables.read(spark, folder, "documents"), tables.read(spark, folder, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "anomaly"
    )


INFILL_SQL = """
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), drawn AS (
  SELECT *, CAST(len(u) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(u) + 1) AS a, CAST('0x' || h[9:16] AS BIGINT) % (len(u) + 1) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 90
              THEN 'plain' WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM units
), cut AS (
  SELECT *, array_to_string(u[1:least(a, b)], '') AS prefix, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS middle,
         array_to_string(u[greatest(a, b) + 1:], '') AS suffix FROM drawn
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256
FROM cut
"""


@query("op11_fill_in_middle", INFILL_SQL)
def fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    return infill.digests(infill.reorder(tables.read(spark, folder, "documents")))


@query("op12_nearest_neighbours")
def nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return nearest.search(tables.read(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
RANKED_SQL = f"""
WITH items AS (SELECT row_number() OVER () AS item, item_id, unnest(list_distinct({_TERMS})) AS term FROM benchmark),
docs AS (SELECT row_number() OVER () AS doc, doc_id, {_TERMS} AS terms FROM documents),
totals AS (SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS total FROM docs WHERE len(terms) > 0),
lengths AS (SELECT doc, doc_id, 100 - 90 + (90 * CAST(len(terms) AS BIGINT) * n_docs) // total AS m FROM docs, totals WHERE len(terms) > 0),
counts AS (
  SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest(terms) AS term FROM docs) WHERE term IN (SELECT term FROM items) GROUP BY doc, term
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM counts, totals GROUP BY term
), scores AS (
  SELECT item, any_value(item_id) AS item_id, doc, any_value(doc_id) AS doc_id,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM items JOIN counts USING (term) JOIN weights USING (term) JOIN lengths USING (doc) GROUP BY item, doc
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""


@query("op13_ranked_search", RANKED_SQL)
def lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search.search(tables.read(spark, folder, "documents"), tables.read(spark, folder, "benchmark"))
