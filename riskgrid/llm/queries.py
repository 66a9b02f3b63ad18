"""One query per operator, with production parameters, over its whole table; SQL for the one that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskgrid.llm import (
    chunks,
    decontaminate,
    html_text,
    jaccard,
    katz,
    neighbours,
    packing,
    periodic,
    pii,
    quality_rules,
    secret_scan,
    sharding,
    spelling,
)
from riskgrid.llm.common import id_remainder, table
from riskgrid.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(id_remainder(katz.FOLDS) == katz.HELD_OUT, F.lit(False))
    return katz.score(katz.train(docs, ~held_out))


def op2_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.repeats(table(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.assess(table(spark, sf_dir, "documents"))


def op5_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find_pii(docs, pii.train(docs))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op7_quality_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return neighbours.score(docs, neighbours.train(docs, table(spark, sf_dir, "labels")))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_jaccard_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes(table(spark, sf_dir, "documents"))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digests(sharding.shuffle(table(spark, sf_dir, "documents"), scratch_path(spark, "shards")))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digests(periodic.periodic_runs(table(spark, sf_dir, "documents"), periodic.made_periodic))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(table(spark, sf_dir, "documents"), spelling.misspelt)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_katz_backoff,
        op2_chunk_dedup,
        op3_secret_scan,
        op4_quality_rules,
        op5_pii_crf,
        op6_html_text,
        op7_quality_neighbours,
        op8_packing,
        op9_decontaminate,
        op10_jaccard_classes,
        op11_sharding,
        op12_periodic_runs,
        op13_spelling_variants,
    )
}
ORACLES: dict[str, str] = {
    "op4_quality_rules": r"""
        with texts as (select doc_id, coalesce(text, '') as t from documents),
        split as (
            select doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as w,
                   list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as lines
            from texts),
        windows as (
            select doc_id, i, array_to_string(w[i:i+4], ' ') as shingle
            from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 1))) as i from split)),
        twice as (select doc_id, i from windows qualify count(*) over (partition by doc_id, shingle) > 1),
        covered as (
            select doc_id, count(distinct i + k) as n_repeat_words
            from twice, (select unnest(range(5)) as k) group by doc_id),
        measured as (
            select doc_id, len(w) as n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) as word_chars,
                   length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols,
                   len(lines) as n_lines, len(lines) - len(list_distinct(lines)) as n_dup_lines,
                   coalesce(n_repeat_words, 0) as n_repeat_words,
                   length(t) - length(replace(t, '!', '')) as bangs,
                   len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i-1])) as stutters
            from split left join covered using (doc_id)),
        judged as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from measured)
        select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               not base_failed and 10 * n_symbols <= n_words and not (n_dup_lines >= 4 and 10 * n_dup_lines > 3 * n_lines)
               and word_chars between 3 * n_words and 10 * n_words and 10 * stutters <= 3 * n_words
               and 2 * bangs <= n_words as kept
        from judged""",
}
