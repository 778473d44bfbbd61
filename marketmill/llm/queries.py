"""The registered queries of the operators, and SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketmill.llm import (
    decontamination,
    exact_dedup,
    filter_audit,
    language_id,
    line_dedup,
    minhash,
    packing,
    quality,
    simhash,
    substring_dedup,
    suffix_dedup,
    warc,
    whitening,
)

TOKENIZER = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def digest(column: str) -> Column:
    return F.sha2(F.col(column).cast("binary"), 256).alias("kept_sha256")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(packing.tokenised_pieces(docs, public_tokenizers.path(TOKENIZER)))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language_id.identify(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"), digest_all=True)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.grade(docs, labels).select("doc_id", "held_out", "score", "predicted")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontamination.contaminated(docs, items)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.round_trip(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.drop_common_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", digest("text"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.drop_repeated_words(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", digest("text"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.drop_repeated_bytes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", digest("body"))


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), words=2, least=80)
    return found.select("doc_id", "n_shingles", F.col("component").alias("component_id"), "kept")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_components(table(spark, sf_dir, "embeddings"))


QUERIES = {
    query.__name__: query
    for query in (
        op1_best_fit_packing,
        op2_language_id,
        op3_exact_dedup,
        op4_quality,
        op5_decontamination,
        op6_simhash,
        op7_warc,
        op8_line_dedup,
        op9_substring_dedup,
        op10_suffix_dedup,
        op11_minhash,
        op12_filter_audit,
        op13_whitening,
    )
}

SQL = {
    "op3_exact_dedup": r"""
        WITH texts AS (
            SELECT doc_id,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body
            FROM documents)
        SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = min(doc_id) OVER same AS kept, sha256(body) AS text_sha256
        FROM texts WINDOW same AS (PARTITION BY body)
    """,
    "op7_warc": """
        WITH payloads AS (
            SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex,
                   max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last
            FROM pages)
        SELECT page_id, strlen(body)::BIGINT AS payload_bytes,
               array_to_string(list_transform(range(0, 32), lambda i: substr(
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   (1 + ((('0x' || substr(hex, (1 + 5 * (i // 4))::INT, 5))::BIGINT
                          >> (15 - 5 * (i % 4))::INT) & 31))::INT, 1)), '') AS payload_digest,
               CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> last THEN last END AS refers_to
        FROM payloads
    """,
    "op8_line_dedup": """
        WITH split AS (
            SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        keyed AS (
            SELECT doc_id, unnest(lines) AS line, unnest(range(0, len(lines))) AS place,
                   unnest(list_transform(lines, lambda x: translate(
                       trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))) AS key
            FROM split),
        common AS (
            SELECT key FROM keyed WHERE length(key) >= 1
            GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
        SELECT doc_id, count(*) AS n_lines, count(common.key) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY place)
                               FILTER (WHERE common.key IS NULL), '')) AS kept_sha256
        FROM keyed LEFT JOIN common ON keyed.key = common.key
        GROUP BY doc_id
    """,
    "op9_substring_dedup": r"""
        WITH split AS (
            SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''),
                       '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
        placed AS (
            SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place,
                   unnest(list_transform(range(1, len(words) + 1), lambda i: CASE
                       WHEN i + 19 <= len(words)
                       THEN array_to_string(list_slice(words, i, i + 19), ' ') END)) AS run
            FROM split),
        judged AS (
            SELECT doc_id, word, place, run IS NOT NULL
                   AND row_number() OVER (PARTITION BY run ORDER BY doc_id, place) > 1 AS later
            FROM placed),
        covered AS (
            SELECT doc_id, word, place, bool_or(later) OVER (
                       PARTITION BY doc_id ORDER BY place
                       ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone
            FROM judged),
        kept AS (
            SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed,
                   string_agg(word, ' ' ORDER BY place) FILTER (WHERE NOT gone) AS text
            FROM covered GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
               sha256(coalesce(kept.text, '')) AS kept_sha256
        FROM documents d LEFT JOIN kept ON d.doc_id = kept.doc_id
    """,
    "op12_filter_audit": r"""
        WITH texts AS (
            SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body,
                   list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                               lambda x: x <> '') AS words
            FROM documents),
        said AS (
            SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic
            FROM labels GROUP BY doc_id),
        failed AS (
            SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
                   len(words) < 100 AS a,
                   100 * len(list_distinct(words)) < 80 * len(words) AS b,
                   100 * (length(body) - length(regexp_replace(body, '[A-Z]', '', 'g')))
                       > 10 * length(body) AS c,
                   regexp_matches(body, '[#$%&*|]') AS d,
                   texts.doc_id > min(texts.doc_id) OVER (PARTITION BY body) AS e
            FROM texts LEFT JOIN said ON texts.doc_id = said.doc_id),
        counted AS (
            SELECT part, good, toxic, list_filter(['A', 'B', 'C', 'D', 'E'], lambda x:
                       CASE x WHEN 'A' THEN a WHEN 'B' THEN b WHEN 'C' THEN c
                              WHEN 'D' THEN d ELSE e END) AS fails, count(*) AS n
            FROM failed GROUP BY ALL),
        letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
        orders AS (
            SELECT p.x || q.x || r.x || s.x || t.x AS filter_order
            FROM letters p, letters q, letters r, letters s, letters t
            WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
        steps AS (
            SELECT filter_order, unnest(range(1, 6))::INT AS step FROM orders),
        placed AS (
            SELECT part, filter_order, step, n, good, toxic, fails,
                   substr(filter_order, step, 1) AS filter,
                   coalesce(list_min(list_transform(fails, lambda x: instr(filter_order, x))), 6)
                       AS gone
            FROM counted, steps),
        summed AS (
            SELECT part, filter_order, step, filter,
                   sum(n) FILTER (WHERE gone > step) AS kept,
                   sum(n) FILTER (WHERE gone = step) AS removed,
                   sum(n) FILTER (WHERE gone < step AND list_contains(fails, filter))
                       AS redundant,
                   sum(n) FILTER (WHERE fails = [filter]) AS unique_fails,
                   sum(n) FILTER (WHERE gone = step AND good) AS good_lost,
                   sum(n) FILTER (WHERE gone = step AND toxic) AS toxic_lost
            FROM placed GROUP BY ALL)
        SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept,
               coalesce(removed, 0)::BIGINT AS removed,
               coalesce(redundant, 0)::BIGINT AS redundant,
               coalesce(unique_fails, 0)::BIGINT AS unique_fails,
               coalesce(good_lost, 0)::BIGINT AS good_lost,
               coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
               coalesce(sum(removed) OVER (PARTITION BY part, filter), 0)::BIGINT AS shapley
        FROM summed
    """,
}
