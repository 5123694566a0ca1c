"""Queries of the general data-preparation operators, over whole tables, with SQL to hold them against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arbora.operators import hierarchy, orphans, packed, rowparse
from arbora.util import table

RELEASE = ["scheme", "version"]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return hierarchy.endless(table(spark, d, "taxonomy_nodes"), RELEASE)


def p1_hierarchy(spark: SparkSession, d: str) -> DataFrame:
    h = hierarchy.hierarchy(table(spark, d, "taxonomy_nodes"), RELEASE)
    return h.select("scheme", "version", "code", "root", "depth", "path", "descendants")


def p1_descendants(spark: SparkSession, d: str) -> DataFrame:
    h = hierarchy.Stage(hierarchy.hierarchy(table(spark, d, "taxonomy_nodes"), RELEASE)).df
    return hierarchy.descendants(h, RELEASE).select("scheme", "version", "code", "descendant", F.col("hops").cast("bigint").alias("hops"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return packed.audit_values(table(spark, d, "psic_rev5_deterministic_audit"), table(spark, d, "reference_labels"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return orphans.code_orphans(table(spark, d, "crosswalk_entries"), table(spark, d, "taxonomy_nodes")).drop("at")


def p5_report(spark: SparkSession, d: str) -> DataFrame:
    return orphans.orphan_report(orphans.code_orphans(table(spark, d, "crosswalk_entries"), table(spark, d, "taxonomy_nodes")))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return rowparse.entry_lines(table(spark, d, "crosswalk_raw_lines")).where("reason is not null").select("line_id", "reason")


def p6_loaded(spark: SparkSession, d: str) -> DataFrame:
    return rowparse.loaded_entries(table(spark, d, "crosswalk_raw_lines"))


QUERIES = {f.__name__: f for f in (p1_found, p1_hierarchy, p1_descendants, p4_found, p5_found, p5_report, p6_found, p6_loaded)}

_LINKS = """links AS (
  SELECT n.scheme, n.version, n.code, max(p.code) AS parent
  FROM (SELECT DISTINCT scheme, version, code, nullif(trim(parent_code, E' \\t\\n\\r'), '') AS pc FROM taxonomy_nodes WHERE code IS NOT NULL) n
  LEFT JOIN (SELECT DISTINCT scheme, version, code FROM taxonomy_nodes) p ON p.scheme = n.scheme AND p.version = n.version AND p.code = n.pc
  GROUP BY ALL)"""
_TREE = f"""WITH RECURSIVE {_LINKS},
tree AS (
  SELECT scheme, version, code, code AS root, 1::BIGINT AS depth, code AS path, [code] AS above FROM links WHERE parent IS NULL
  UNION ALL
  SELECT l.scheme, l.version, l.code, t.root, t.depth + 1, t.path || '/' || l.code, list_append(t.above, l.code)
  FROM tree t JOIN links l ON l.scheme = t.scheme AND l.version = t.version AND l.parent = t.code)"""
_PAIRS = """pairs AS (
  SELECT scheme, version, a AS code, code AS descendant, depth - i AS hops
  FROM (SELECT scheme, version, code, depth, unnest(above) AS a, unnest(range(1, depth + 1)) AS i FROM tree) WHERE i < depth)"""

_REFS = r"""refs AS (
  SELECT DISTINCT 'crosswalk_entries' AS table_name, entry_id AS row_id, scheme, version, trim(c, E' \t\n\r') AS code, reviewed_at AS tat
  FROM (SELECT *, unnest(string_split(codes, '|')) AS c FROM crosswalk_entries) WHERE regexp_matches(trim(c, E' \t\n\r'), '^([0-9]+|[A-Z])$')
  UNION ALL
  SELECT 'taxonomy_nodes', node_id, scheme, version, trim(parent_code, E' \t\n\r'), loaded_at FROM taxonomy_nodes WHERE trim(parent_code, E' \t\n\r') <> ''),
hist AS (
  SELECT r.table_name, r.row_id, r.code AS ref_code, r.tat, count(n.node_id) AS n,
    coalesce(bool_or(n.loaded_at <= r.tat AND (n.removed_at IS NULL OR n.removed_at > r.tat)), false) AS there, coalesce(bool_or(n.loaded_at <= r.tat), false) AS born
  FROM refs r LEFT JOIN taxonomy_nodes n USING (scheme, version, code) GROUP BY ALL),
found AS (
  SELECT table_name, row_id, ref_code, tat, CASE WHEN n = 0 THEN 'missing' WHEN born THEN 'deleted' ELSE 'late' END AS reason
  FROM hist WHERE n = 0 OR (tat IS NOT NULL AND NOT there))"""

_ANY = r'("([^"]|"")*"|[^",]*)'
_ROWS = rf"""lines AS (SELECT *, coalesce(raw_line, '') AS x FROM crosswalk_raw_lines),
cut AS (
  SELECT *, regexp_full_match(x, '{_ANY}(,{_ANY})*', 's') AS quoted,
    list_transform(regexp_extract_all(',' || x, '(?s),{_ANY}', 1), lambda v: nullif(trim(CASE WHEN v[1] = '"' THEN replace(v[2:-2], '""', '"') ELSE v END, E' \t\n\r'), '')) AS v FROM lines),
judged AS (
  SELECT *, CASE WHEN NOT quoted THEN 'quoting' WHEN len(v) <> 12 THEN 'columns'
    WHEN NOT coalesce(upper(v[7]) IN ('EXACT', 'SUBTREE', 'UNION', 'NOT_ACTIVITY', 'UNCODEABLE', 'CLASS'), true) THEN 'mapping_kind'
    WHEN v[10] IS NOT NULL AND NOT (regexp_full_match(v[10], '[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?') AND coalesce(try_cast(v[10] AS DOUBLE) BETWEEN 0 AND 1, false)) THEN 'confidence'
    WHEN NOT coalesce(lower(v[12]) IN ('category', 'name'), true) THEN 'source_field' END AS reason FROM cut)"""

_PACKED = r"""cells AS (SELECT audit_id, source, replace(replace(source_value, '""', '"'), '\"', '"') AS v FROM psic_rev5_deterministic_audit WHERE source_value IS NOT NULL),
starts AS (SELECT *, unnest(range(1, length(v) + 1)) AS i FROM cells),
hits AS (SELECT s.audit_id, s.i, s.i + length(r.label) AS e, r.label FROM starts s JOIN reference_labels r ON r.kind = 'category' AND r.source = s.source AND starts_with(substr(s.v, s.i), r.label)),
kept AS (SELECT * FROM hits h WHERE NOT EXISTS (SELECT 1 FROM hits g WHERE g.audit_id = h.audit_id AND g.i <= h.i AND g.e >= h.e AND g.e - g.i > h.e - h.i)),
named AS (SELECT audit_id, 'source_value' AS field_name, row_number() OVER (PARTITION BY audit_id ORDER BY i) AS pos, label AS item, count(*) OVER (PARTITION BY audit_id) AS n FROM kept),
raw AS (
  SELECT audit_id, 'suggested_codes' AS field_name, suggested_codes AS c FROM psic_rev5_deterministic_audit
  UNION ALL SELECT audit_id, 'candidate_codes', candidate_codes FROM psic_rev5_deterministic_audit),
words AS (
  SELECT audit_id, field_name, list_filter(regexp_extract_all(regexp_replace(regexp_replace(c, '\([0-9]\.[0-9]+\)', ' ', 'g'), '(^|[\s;,])[0-9]+\)', '\1 ', 'g'), '[\w.]+'), lambda w: regexp_full_match(w, '[0-9]{2,}|[A-Z]')) AS w FROM raw)"""

SQL = {
    "p1_found": f"""{_TREE},
lost AS (SELECT * FROM links l WHERE NOT EXISTS (SELECT 1 FROM tree t WHERE t.scheme = l.scheme AND t.version = l.version AND t.code = l.code)),
walk AS (
  SELECT scheme, version, code, parent AS cur, [code] AS seen FROM lost
  UNION ALL
  SELECT w.scheme, w.version, w.code, l.parent, list_append(w.seen, w.cur) FROM walk w JOIN lost l ON l.scheme = w.scheme AND l.version = w.version AND l.code = w.cur WHERE NOT list_contains(w.seen, w.cur))
SELECT scheme, version, code, list_min(seen[list_position(seen, cur):]) AS cycle_code FROM walk WHERE list_contains(seen, cur)""",
    "p1_hierarchy": f"{_TREE}, {_PAIRS} SELECT t.scheme, t.version, t.code, t.root, t.depth, t.path, (SELECT count(*) FROM pairs p WHERE p.scheme = t.scheme AND p.version = t.version AND p.code = t.code) AS descendants FROM tree t",
    "p1_descendants": f"{_TREE}, {_PAIRS} SELECT scheme, version, code, descendant, hops FROM pairs",
    "p4_found": f"""WITH {_PACKED}
SELECT audit_id, field_name, pos::INTEGER AS pos, item FROM named WHERE n > 1
UNION ALL SELECT audit_id, field_name, unnest(range(1, len(w) + 1))::INTEGER, unnest(w) FROM words WHERE len(w) > 1""",
    "p5_found": f"WITH {_REFS} SELECT table_name, row_id, ref_code, reason FROM found",
    "p5_report": f"WITH {_REFS} SELECT table_name, strftime(tat, '%Y-%m') AS month, reason, count(*) AS n_refs, count(DISTINCT row_id) AS n_rows FROM found GROUP BY ALL",
    "p6_found": f"WITH {_ROWS} SELECT line_id, reason FROM judged WHERE reason IS NOT NULL",
    "p6_loaded": f"""WITH {_ROWS} SELECT line_id, v[1] AS source, v[2] AS source_value, try_cast(v[3] AS BIGINT) AS row_count, try_cast(v[4] AS DOUBLE) AS row_share, v[5] AS scheme, v[6] AS version,
  upper(v[7]) AS mapping_kind, v[8] AS codes, v[9] AS match_type, try_cast(v[10] AS DOUBLE) AS confidence, v[11] AS notes, lower(v[12]) AS source_field FROM judged WHERE reason IS NULL""",
}
