"""Queries of the training-text operators, over whole tables and whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from arbora.llm import canonical, copies, packing, tokens, truncation
from arbora.util import table


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return copies.entry_copies(table(spark, d, "crosswalk_entries"))


def p2_records(spark: SparkSession, d: str) -> DataFrame:
    return copies.entry_records(table(spark, d, "crosswalk_entries"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return canonical.mapped(table(spark, d, "psic_rev5_deterministic_audit"), table(spark, d, "crosswalk_entries"), table(spark, d, "reference_labels"))


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode(table(spark, d, "documents"))


def p8_packed(spark: SparkSession, d: str) -> DataFrame:
    sizes = tokens.encode(table(spark, d, "documents"), count_only=True)
    return packing.pack(sizes, "doc_id", "n_tokens")


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return truncation.truncated(table(spark, d, "documents")).select("doc_id")


def p9_sources(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return truncation.by_source(docs, truncation.truncated(docs))


QUERIES = {f.__name__: f for f in (p2_found, p2_records, p3_found, p7_ids, p8_packed, p9_found, p9_sources)}

_RECORDS = r"""WITH keyed AS (
  SELECT entry_id, worklist_id, scheme, version, mapping_kind, match_type, source_field, regexp_replace(lower(coalesce(source, '')), '[^\p{L}\p{N}]', '', 'g') AS s,
    list_sort(list_filter(list_transform(regexp_split_to_array(source_value, '[,;|，；｜]'), lambda p: regexp_replace(lower(p), '[^\p{L}\p{N}]', '', 'g')), lambda p: p <> '')) AS v,
    list_sort(list_filter(list_transform(string_split(coalesce(codes, ''), '|'), lambda c: trim(c, E' \t\n\r')), lambda c: c <> '')) AS c
  FROM crosswalk_entries WHERE regexp_matches(source_value, '[^\s]')),
grouped AS (SELECT *, min(entry_id) OVER w AS keep_id, count(*) OVER w AS n FROM keyed WINDOW w AS (PARTITION BY worklist_id, scheme, version, mapping_kind, match_type, source_field, s, v, c))"""

SQL = {
    "p2_found": f"{_RECORDS} SELECT keep_id, entry_id AS copy_id FROM grouped WHERE entry_id <> keep_id",
    "p2_records": f"{_RECORDS} SELECT entry_id, n AS copies FROM grouped WHERE entry_id = keep_id",
}
