"""Registered queries of the text operators, and the DuckDB SQL of those that
SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rivulet.llm import (
    bpe,
    chat,
    exact_dedup,
    fingerprint,
    license_scan,
    lm_score,
    near_dedup,
    packing,
    repair,
    sharding,
    spelling,
    substring_dedup,
    toxicity,
)
from rivulet.session import apply_runtime_conf
from rivulet.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_runtime_conf(spark)
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql.strip()
        return run
    return deco


@register("op1_sharding")
def op1(spark, sf_dir):
    """All documents in 8 shards that match the mixture of sources."""
    return sharding.shard_documents(read_table(spark, sf_dir, "documents"))


@register("op2_lm_scoring")
def op2(spark, sf_dir):
    """Base and model log10 probability of every document."""
    return lm_score.lm_scores(read_table(spark, sf_dir, "documents"))


@register("op3_fingerprints")
def op3(spark, sf_dir):
    """Fingerprints of every document and of its edited text."""
    return fingerprint.document_fingerprints(read_table(spark, sf_dir, "documents"))


@register("op4_exact_dedup", """
WITH n AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM n
""")
def op4(spark, sf_dir):
    """Which document stays of every group of equal texts."""
    return exact_dedup.exact_duplicates(read_table(spark, sf_dir, "documents"), keep="largest")


@register("op5_chat_formatting")
def op5(spark, sf_dir):
    """Turns recovered from the raw transcript of every conversation."""
    return chat.formatted_learnt(read_table(spark, sf_dir, "conversations"))


@register("op6_packing")
def op6(spark, sf_dir):
    """All documents' ids in sequences of 1024."""
    return packing.packed_digests(read_table(spark, sf_dir, "documents"))


@register("op7_substring_dedup", r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), win AS (
  SELECT doc_id, unnest(range(1, greatest(len(ws) - 18, 1)::BIGINT)) AS i, ws FROM w
), firsts AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY array_to_string(ws[i:i+19], ' ') ORDER BY doc_id, i) AS rn FROM win
), gone AS (
  SELECT doc_id, list_distinct(flatten(list(range(i, i + 20)))) AS g FROM firsts WHERE rn > 1 GROUP BY doc_id
)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(len(g), 0)::BIGINT AS n_removed,
       sha256(coalesce(array_to_string(list_filter(ws, lambda x, i: g IS NULL OR NOT list_contains(g, i)), ' '), '')) AS kept_sha256
FROM w LEFT JOIN gone USING (doc_id)
""")
def op7(spark, sf_dir):
    """Documents without the words of repeated 20-word windows."""
    return substring_dedup.kept_digests(read_table(spark, sf_dir, "documents"))


@register("op8_near_dedup")
def op8(spark, sf_dir):
    """Class of near copies of every document."""
    return near_dedup.near_duplicates(read_table(spark, sf_dir, "documents"))


@register("op9_byte_bpe")
def op9(spark, sf_dir):
    """Every document encoded to byte-level BPE ids and decoded again."""
    return bpe.bpe_digests(read_table(spark, sf_dir, "documents"))


@register("op10_toxicity")
def op10(spark, sf_dir):
    """Toxicity score of every document."""
    return toxicity.toxicity_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@register("op11_spelling_variants")
def op11(spark, sf_dir):
    """Form and root of every word of the documents."""
    return spelling.spelling_forms(read_table(spark, sf_dir, "documents"))


@register("op12_license_scan", license_scan.oracle_sql())
def op12(spark, sf_dir):
    """License notices of every document."""
    return license_scan.license_scan(read_table(spark, sf_dir, "documents"))


@register("op13_conversation_repair")
def op13(spark, sf_dir):
    """The cheapest repair of every damaged conversation."""
    return repair.repaired_digests(read_table(spark, sf_dir, "conversations"))
