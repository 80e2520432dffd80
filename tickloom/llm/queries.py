"""The registered query of each operator, with its SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import (
    decontaminate, fim, html, language, packing, pii, prefixes, quality, sequences, simhash, substrings, toxicity, warc,
)

QUERIES: dict = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(query):
        QUERIES[name] = query
        if sql:
            SQL[name] = sql
        return query
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


MEASURES_SQL = rf"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), p AS (
  SELECT doc_id, i, [words[i], words[i + 1], words[i + 2]] AS k
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)
), r AS (
  SELECT doc_id, i, lag(i, 1, -9) OVER (PARTITION BY doc_id ORDER BY i) AS last
  FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS n FROM p) WHERE n > 1
), c AS (
  SELECT doc_id, sum(least(i - last, 3)) AS n FROM r GROUP BY doc_id
), m AS (
  SELECT w.doc_id, len(words)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(c.n, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines,
    length(regexp_replace(text, '[^!?]', '', 'g'))::BIGINT AS n_marks,
    len(list_filter(words, lambda x: list_contains({list(quality.STOP_WORDS)!r}, x)))::BIGINT AS n_stop_words
  FROM w LEFT JOIN c ON w.doc_id = c.doc_id
), q AS (
  SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed,
    CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END AS mean_word_chars,
    CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0 END AS symbols_per_word,
    CASE WHEN n_words > 0 THEN n_marks / n_words ELSE 0 END AS marks_per_word,
    CASE WHEN n_words > 0 THEN n_stop_words / n_words ELSE 0 END AS stop_words_ratio,
    CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END AS dup_lines_ratio
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, {quality.rule_sql()} AS kept FROM q
"""


@register("op1_quality_rules", MEASURES_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the measures and verdict of the quality rules."""
    return quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@register("op4_simhash_near_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint and the group it links to."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


@register("op5_best_fit_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces with their sequence and place."""
    return packing.pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


REPEATS_SQL = rf"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), p AS (
  SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM w
), k AS (
  SELECT doc_id, i, words[i] AS word,
    CASE WHEN i + {substrings.WINDOW - 1} <= len(words) THEN array_to_string(words[i:i + {substrings.WINDOW - 1}], ' ') END AS k
  FROM p
), m AS (
  SELECT *, CASE WHEN k IS NOT NULL AND min(doc_id) OVER (PARTITION BY k) < doc_id THEN 1 ELSE 0 END AS bad FROM k
), c AS (
  SELECT doc_id, i, word,
    max(bad) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN {substrings.WINDOW - 1} PRECEDING AND CURRENT ROW) AS gone
  FROM m
), g AS (
  SELECT doc_id, sum(gone)::BIGINT AS n_removed, coalesce(string_agg(word, ' ' ORDER BY i) FILTER (gone = 0), '') AS kept
  FROM c GROUP BY doc_id
)
SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN g ON w.doc_id = g.doc_id
"""


@register("op8_substring_dedup", REPEATS_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's counts and the digest of what is left of it."""
    return substrings.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


def _base32_sql(hexed: str) -> str:
    """Base32 of 40 hex digits: five of them are four of base 32."""
    part = "('0x' || substr({h}, {i}, 5))::INTEGER"
    digits = [f"substr('{warc.BASE32}', (({part.format(h=hexed, i=1 + 5 * i)} >> {shift}) & 31) + 1, 1)"
              for i in range(8) for shift in (15, 10, 5, 0)]
    return " || ".join(digits)


WARC_SQL = f"""
WITH d AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), m AS (
  SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM d
)
SELECT page_id, payload_bytes, {_base32_sql('h')} AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM m
"""


@register("op7_warc_archive", WARC_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record as read back from the archive."""
    return warc.round_trip(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register("op6_html_extraction")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


@register("op3_pii_pseudonyms")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text with pseudonyms, and the number of values replaced."""
    docs = table(spark, sf_dir, "documents").select("doc_id", pii.pseudonyms(F.col("text"), pii.TEST_KEY).alias("p"))
    counts = [F.coalesce(F.col(f"p.n_{k}"), F.lit(0)).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return docs.select("doc_id", F.col("p.text").alias("text"), *counts)


@register("op9_benchmark_decontamination")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of a document and a benchmark item it holds."""
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "item_id", "item_words", "matched_words", F.size("tiles").alias("n_tiles"), "coverage")


def _fold(folds: int):
    """Remainder of the CRC-32 of the doc_id written as text."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds))


@register("op2_toxicity")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity; labels of the held-out fifth are not learned."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(_fold(5) != 0)
    model = toxicity.train(docs, labels)
    return toxicity.scored(docs, model).select("doc_id", F.coalesce(_fold(5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


@register("op10_language_id")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language; the held-out third is not learned from."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.train(docs.filter(_fold(3) != 1))
    return language.identified(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(_fold(3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")


@register("op11_token_sequences")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place and ids as read back from the files of sequences."""
    return sequences.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"))


def _crc_table() -> list[int]:
    """The remainders of all bytes by the reversed polynomial of CRC-32."""
    rows = list(range(256))
    for _ in range(8):
        rows = [(r >> 1) ^ (0xEDB88320 if r & 1 else 0) for r in rows]
    return rows


def _crc_sql(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text."""
    byte = f"list_transform(range(1, length({text}) + 1), lambda i: ascii(substr({text}, i, 1))::BIGINT)"
    step = f"lambda a, x: xor(a >> 8, ({_crc_table()}::BIGINT[])[(xor(a, x) & 255) + 1])"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {byte}), {step}), 4294967295)"


TRIE_SQL = rf"""
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, substr(key, 1, 32)) AS p, key, words
  FROM (SELECT conv_id, turn, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS key,
      len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+'))::BIGINT AS words
    FROM conversations WHERE conv_id IS NOT NULL)
), c AS (
  SELECT conv_id, conv_id - conv_id % {prefixes.FAMILY} AS base, {_crc_sql('conv_id::VARCHAR')} % {prefixes.MAX_SHARED} AS h
  FROM (SELECT DISTINCT conv_id FROM t)
), r AS (
  SELECT c.conv_id, t.p, t.key, t.words FROM c JOIN t ON t.conv_id = c.base AND t.p <= c.h
  UNION ALL
  SELECT c.conv_id, t.p + 3, t.key, t.words FROM c JOIN t ON t.conv_id = c.conv_id AND t.p > c.h
), l AS (
  SELECT c.conv_id, coalesce(k, []) AS k, coalesce(w, []) AS w
  FROM c LEFT JOIN (SELECT conv_id, list(key ORDER BY p) AS k, list(words ORDER BY p) AS w FROM r GROUP BY conv_id) x ON c.conv_id = x.conv_id
), m AS (
  SELECT conv_id, d, len(k) = d AS last, sha256(array_to_string(k[1:d], ',')) AS pk, CASE WHEN d > 0 THEN w[d] ELSE 0 END AS words
  FROM (SELECT conv_id, k, w, unnest(range(0, len(k) + 1)) AS d FROM l)
), n AS (
  SELECT d, pk, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words,
    coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '') AS ends
  FROM m GROUP BY d, pk
), e AS (
  SELECT n.d, n.pk, u.pk AS parent_pk, u.conv_id AS parent_conv_id
  FROM n JOIN m ON m.conv_id = n.conv_id AND m.d = n.d - 1 JOIN n u ON u.d = m.d AND u.pk = m.pk
), k AS (
  SELECT d - 1 AS d, parent_pk AS pk, count(*) AS n_children FROM e GROUP BY d, parent_pk
), s AS (
  SELECT m.d, m.pk, sum((v.n_convs - 1) * v.words)::BIGINT AS saved_tokens, sum(CASE WHEN k.d IS NULL THEN 1 ELSE 0 END)::BIGINT AS n_leaves
  FROM n v JOIN m ON m.conv_id = v.conv_id AND m.d <= v.d LEFT JOIN k ON k.d = v.d AND k.pk = v.pk
  GROUP BY m.d, m.pk
)
SELECT n.conv_id, n.d AS depth, e.parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children, s.n_leaves, s.saved_tokens,
  sha256(n.ends) AS ends_sha256
FROM n JOIN s ON s.d = n.d AND s.pk = n.pk LEFT JOIN e ON e.d = n.d AND e.pk = n.pk LEFT JOIN k ON k.d = n.d AND k.pk = n.pk
"""


@register("op12_prefix_trie", TRIE_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of all rebuilt conversations."""
    return prefixes.prefix_trie(table(spark, sf_dir, "conversations"))


def _draw_sql(i: int) -> str:
    return f"('0x' || substr(h, {8 * i + 1}, 8))::BIGINT"


FIM_SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('{fim.SEED}:' || doc_id::VARCHAR) AS h,
    regexp_extract_all(coalesce(text, ''), '[^
]*
|[^
]+') AS u
  FROM documents
), c AS (
  SELECT *, len(u) AS n, {_draw_sql(0)} % (len(u) + 1) AS x, {_draw_sql(1)} % (len(u) + 1) AS y,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
      OR {_draw_sql(2)} % 100 >= {fim.FIM_PERCENT} THEN 'plain'
      WHEN {_draw_sql(3)} % 100 < {fim.SPM_PERCENT} THEN 'spm' ELSE 'psm' END AS form
  FROM d
), p AS (
  SELECT doc_id, n, form, text, array_to_string(u[1:least(x, y)], '') AS pre,
    array_to_string(u[least(x, y) + 1:greatest(x, y)], '') AS mid, array_to_string(u[greatest(x, y) + 1:n], '') AS suf
  FROM c
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
    ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""


@register("op13_fill_in_middle", FIM_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's cuts with digests of its output and of the text restored from that."""
    made = fim.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))
