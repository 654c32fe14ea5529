"""One query for each operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidebook.llm import (
    fingerprint,
    jaccard,
    ledger,
    pieces,
    pii,
    quotes,
    resampling,
    roles,
    secrets,
    sharding,
    templates,
    toxicity,
    whitening,
)
from tidebook.llm.common import table


def op1_factorization_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op2_quotation_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.link_quotes(table(spark, sf_dir, "conversations"), deepest=None)


def op3_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_jaccard_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_join(table(spark, sf_dir, "documents"), k=3, percent=90)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digest(pii.find_pii(table(spark, sf_dir, "documents")))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.secret_digest(secrets.find_secrets(docs, secrets.train_ratio(docs)))


def op7_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op9_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_documents(table(spark, sf_dir, "documents"))


def op10_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_documents(table(spark, sf_dir, "documents"), pieces.load_vocabulary())


def op11_role_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.repair_digest(table(spark, sf_dir, "conversations"))


def op12_polarised_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten_embeddings(table(spark, sf_dir, "embeddings"))


def op13_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.quality_digest(ledger.rule_ledger(table(spark, sf_dir, "documents")))


QUERIES = {
    "op1_factorization_machine": op1_factorization_machine,
    "op2_quotation_links": op2_quotation_links,
    "op3_importance_resampling": op3_importance_resampling,
    "op4_jaccard_regions": op4_jaccard_regions,
    "op5_pii": op5_pii,
    "op6_secret_scan": op6_secret_scan,
    "op7_template_leaks": op7_template_leaks,
    "op8_virtual_slots": op8_virtual_slots,
    "op9_scaled_sketch": op9_scaled_sketch,
    "op10_sentence_pieces": op10_sentence_pieces,
    "op11_role_repair": op11_role_repair,
    "op12_polarised_whitening": op12_polarised_whitening,
    "op13_rule_ledger": op13_rule_ledger,
}
ORACLES: dict[str, str] = {
    "op13_rule_ledger": r"""
        WITH cut AS (
            SELECT row_number() OVER () AS row_id, doc_id,
                   [x FOR x IN string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS words,
                   [x FOR x IN string_split(coalesce(text, ''), chr(10))
                    IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
            FROM documents
        ), windows AS (
            SELECT row_id, i, words[i : i + 4] AS gram
            FROM (SELECT row_id, words, unnest(range(1, len(words) - 3)) AS i FROM cut)
        ), twice AS (
            SELECT row_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY row_id, gram) > 1
        ), covered AS (
            SELECT row_id, sum(least(5, coalesce(after - i, 5))) AS n
            FROM (SELECT row_id, i, lead(i) OVER (PARTITION BY row_id ORDER BY i) AS after FROM twice)
            GROUP BY row_id
        ), sizes AS (
            SELECT doc_id, len(words)::BIGINT AS n_words,
                   length(array_to_string(words, ''))::BIGINT AS word_chars,
                   (length(array_to_string(words, ''))
                    - length(regexp_replace(array_to_string(words, ''), '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
                   (len(lines) - list_unique(lines))::BIGINT AS n_dup_lines,
                   coalesce(n, 0)::BIGINT AS n_repeat_words,
                   len(lines)::BIGINT AS n_lines,
                   len([x FOR x IN words IF regexp_matches(x, '\p{L}')])::BIGINT AS n_letter_words
            FROM cut LEFT JOIN covered USING (row_id)
        ), judged AS (
            SELECT *, (n_words < 10)::BIGINT
                   + 2 * (100 * n_repeat_words > 20 * n_words)::BIGINT
                   + 4 * (n_words > 0 AND (word_chars < 3 * n_words OR word_chars > 12 * n_words))::BIGINT
                   + 8 * (10 * n_symbols > n_words)::BIGINT
                   + 16 * (10 * n_dup_lines > 4 * n_lines)::BIGINT
                   + 32 * (10 * n_letter_words < 7 * n_words)::BIGINT AS failures
            FROM sizes
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
               failures & 3 <> 0 AS base_failed, failures = 0 AS kept, failures, 3 AS policy
        FROM judged
    """,
}
