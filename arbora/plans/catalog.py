"""Queries of the classification operators over the whole test tables, with SQL written independently."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arbora.functions import text as tx
from arbora.operators import classify as cl
from arbora.operators import evaluate as el
from arbora.operators import evidence as ev
from arbora.operators import ingest as ig
from arbora.operators import retrieve as rt
from arbora.operators import roles as ro
from arbora.operators import rules as ru
from arbora.operators import tree as tr
from arbora.operators import vote as vt
from arbora.operators import worklist as wl
from arbora.plans.problems import _TREE
from arbora.util import Stage, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
RELEASES = ev.DEFAULT_RELEASES
SCOPE = tr.SCOPE

_B = r"E' \t\n\r\f'"


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return keep


def _tree(s: SparkSession, d: str) -> DataFrame:
    return tr.prepare(table(s, d, "taxonomy_nodes"))


def _ascii(x):
    return x.rlike(r"^\p{ASCII}*$")


def _printable(c: str):
    return F.col(c).rlike(r"^[ -~]*\z")


# text ------------------------------------------------------------------------------------------------

_FOLD = r"trim(regexp_replace(lower({x}), '[^\w=:+&/.-]+', ' ', 'g'))"
_WORDS = "('', 'n/a', 'na', 'none', 'null', '-', 'others', 'other', 'unknown')"
_LIT = f"nullif(trim(source_value, {_B}), '')"
_TXT = f"CASE WHEN lower({_LIT}) NOT IN {_WORDS} THEN {_LIT} END"


@query(f"""SELECT entry_id, {_LIT} AS literal, {_TXT} AS observed, coalesce({_FOLD.format(x=_TXT)}, '') AS observed_key, coalesce({_FOLD.format(x=_LIT)}, '') AS reviewed_key
FROM crosswalk_entries WHERE regexp_full_match(source_value, '[\\x00-\\x7F]*', 's')""")
def text_keys(s, d):
    """Keys of every label that is plain ASCII; others go through Unicode folding, which SQL lacks."""
    v = F.col("source_value")
    return table(s, d, "crosswalk_entries").where(_ascii(v)).select("entry_id", tx.clean_literal(v).alias("literal"), tx.clean_text(v).alias("observed"), tx.observed_key(v).alias("observed_key"), tx.reviewed_key(v).alias("reviewed_key"))


@query()
def text_keys_unicode(s, d):
    v = F.col("source_value")
    return table(s, d, "crosswalk_entries").select("entry_id", tx.observed_key(v).alias("observed_key"), tx.reviewed_key(v).alias("reviewed_key"))


@query("""SELECT ref_id, trim(regexp_replace(CASE source WHEN 'osm' THEN replace(split_part(label, '=', 2) || ' ' || split_part(label, '=', 1), '_', ' ') WHEN 'overture' THEN replace(label, '_', ' ') ELSE replace(label, '>', ' ') END, '\\s+', ' ', 'g')) AS query_text
FROM reference_labels WHERE kind = 'category'""")
def label_query_text(s, d):
    return table(s, d, "reference_labels").where("kind = 'category'").select("ref_id", tx.category_query(F.col("source"), F.col("label")).alias("query_text"))


@query("""SELECT entry_id, substr(sha1(concat_ws(chr(31), lower(trim(coalesce(source, ''))), lower(trim(coalesce(source_field, ''))), trim(coalesce(source_value, '')))), 1, 16) AS joint_key FROM crosswalk_entries
WHERE regexp_full_match(coalesce(source_value, ''), '[ -~]*') AND regexp_full_match(coalesce(source, ''), '[ -~]*')""")
def joint_keys(s, d):
    plain = r"^[ -~]*\z"
    x = table(s, d, "crosswalk_entries").where(F.coalesce("source_value", F.lit("")).rlike(plain) & F.coalesce("source", F.lit("")).rlike(plain))
    return _joint(x)


@query()
def joint_keys_all(s, d):
    return _joint(table(s, d, "crosswalk_entries"))


def _joint(x):
    return x.select("entry_id", tx.joint_key(F.col("source"), F.col("source_field"), F.col("source_value")).alias("joint_key"))


@query("""SELECT place_row, coalesce(lower(trim(overture_has_foursquare_provenance)) IN ('1', 'true', 'yes', 'y', 't'), false) AS provenance, coalesce(lower(trim(completed_transitively)) IN ('1', 'true', 'yes', 'y', 't'), false) AS transitive,
  cluster_max_pair_distance_m AS distance FROM places""")
def place_flags(s, d):
    return table(s, d, "places").select("place_row", tx.truthy(F.col("overture_has_foursquare_provenance")).alias("provenance"), tx.truthy(F.col("completed_transitively")).alias("transitive"), tx.as_float(F.col("cluster_max_pair_distance_m")).alias("distance"))


_CODES = "list_filter(list_transform(string_split(coalesce(codes, ''), '|'), lambda c: trim(c, ' ')), lambda c: c <> '')"


@query(f"SELECT entry_id, len({_CODES})::BIGINT AS n, array_to_string({_CODES}, '|') AS codes FROM crosswalk_entries")
def split_code_lists(s, d):
    c = tx.split_codes(F.col("codes"))
    return table(s, d, "crosswalk_entries").select("entry_id", F.size(c).cast("bigint").alias("n"), F.array_join(c, "|").alias("codes"))


@query("""SELECT node_id, CASE WHEN scheme = 'psic' AND regexp_full_match(code, '[A-V]') THEN 'section' WHEN NOT regexp_full_match(code, '[0-9]+') THEN NULL
  WHEN scheme = 'psic' THEN CASE length(code) WHEN 2 THEN 'division' WHEN 3 THEN 'group' WHEN 4 THEN 'class' WHEN 5 THEN 'subclass' END
  WHEN scheme = 'pcpc' THEN CASE length(code) WHEN 1 THEN 'section' WHEN 2 THEN 'division' WHEN 3 THEN 'group' WHEN 4 THEN 'class' WHEN 5 THEN 'subclass' WHEN 6 THEN 'item' END
  WHEN scheme = 'pscc' THEN CASE length(code) WHEN 2 THEN 'chapter' WHEN 4 THEN 'heading' WHEN 6 THEN 'hs_subheading' WHEN 8 THEN 'ahtn_subheading' WHEN 11 THEN 'commodity' END END AS inferred FROM taxonomy_nodes""")
def inferred_levels(s, d):
    return table(s, d, "taxonomy_nodes").select("node_id", tx.infer_level(F.col("scheme"), F.col("code")).alias("inferred"))


# trees -----------------------------------------------------------------------------------------------

_CLOSURE = "clo AS (SELECT scheme, version, code, unnest(above) AS ancestor, depth - unnest(range(1, depth + 1)) AS hops FROM tree)"
_ONE = "one AS (SELECT scheme, version, code, arg_min(level, node_id) AS level, arg_min(title, node_id) AS title, arg_min(description, node_id) AS description, arg_min(includes, node_id) AS includes FROM taxonomy_nodes WHERE code IS NOT NULL GROUP BY ALL)"


@query(f"{_TREE}, {_CLOSURE} SELECT scheme, version, code, ancestor, hops FROM clo")
def tree_closure(s, d):
    return tr.closure(_tree(s, d)).withColumn("hops", F.col("hops").cast("bigint"))


@query(f"""{_TREE}, {_CLOSURE}, kids AS (SELECT scheme, version, parent AS code, count(*) AS k FROM links WHERE parent IS NOT NULL GROUP BY ALL),
t AS (SELECT tree.*, coalesce(k, 0) AS n_children FROM tree LEFT JOIN kids USING (scheme, version, code))
SELECT c.scheme, c.version, c.ancestor AS code, any_value(a.depth) AS depth, any_value(a.n_children) AS n_children, any_value(a.n_children) = 0 AS is_leaf, max(t.depth) AS branch_max_depth, sum((t.n_children = 0)::INT)::BIGINT AS n_leaves
FROM clo c JOIN t ON t.scheme = c.scheme AND t.version = c.version AND t.code = c.code JOIN t a ON a.scheme = c.scheme AND a.version = c.version AND a.code = c.ancestor GROUP BY 1, 2, 3""")
def tree_dims(s, d):
    return tr.dims(_tree(s, d)).drop("parent", "root").select("scheme", "version", "code", "depth", "n_children", "is_leaf", "branch_max_depth", "n_leaves")


@query(f"{_TREE}, {_CLOSURE} SELECT scheme, version, ancestor AS code, code AS leaf FROM clo WHERE NOT EXISTS (SELECT 1 FROM links l WHERE l.scheme = clo.scheme AND l.version = clo.version AND l.parent = clo.code)")
def tree_leaves(s, d):
    return tr.leaves(_tree(s, d))


_SETS = f"sets AS (SELECT DISTINCT entry_id, scheme, version, unnest({_CODES}) AS code FROM crosswalk_entries WHERE contains(codes, '|'))"


@query(f"""{_TREE}, {_CLOSURE}, {_SETS}, known AS (SELECT s.* FROM sets s JOIN tree t USING (scheme, version, code)),
anc AS (SELECT k.entry_id, c.ancestor, count(*) AS n, (SELECT t.depth FROM tree t WHERE t.scheme = k.scheme AND t.version = k.version AND t.code = c.ancestor) AS depth FROM known k JOIN clo c USING (scheme, version, code) GROUP BY k.entry_id, c.ancestor, k.scheme, k.version),
size AS (SELECT entry_id, count(*) AS n FROM known GROUP BY 1)
SELECT s.entry_id, arg_max(a.ancestor, a.depth) AS lca FROM size s LEFT JOIN anc a ON a.entry_id = s.entry_id AND a.n = s.n GROUP BY 1""")
def tree_lca(s, d):
    """Lowest common ancestor of the known codes of every packed code cell."""
    x = table(s, d, "crosswalk_entries").where("contains(codes, '|')").select("entry_id", *SCOPE, F.explode(tx.split_codes(F.col("codes"))).alias("code"))
    return tr.with_paths(x.distinct(), _tree(s, d), ["entry_id"]).select("entry_id", tr.lca(F.col("paths")).alias("lca"))


@query(f"""{_TREE}, {_CLOSURE}, pairs0 AS (SELECT entry_id, scheme, version, {_CODES}[1] AS a, {_CODES}[2] AS b FROM crosswalk_entries WHERE len({_CODES}) >= 2)
SELECT p.entry_id, CASE WHEN x.code IS NOT NULL AND y.code IS NOT NULL THEN x.depth + y.depth - 2 * (SELECT count(*) FROM clo c JOIN clo e ON e.scheme = c.scheme AND e.version = c.version AND e.ancestor = c.ancestor
  WHERE c.scheme = p.scheme AND c.version = p.version AND c.code = p.a AND e.code = p.b) END AS distance
FROM pairs0 p LEFT JOIN tree x ON x.scheme = p.scheme AND x.version = p.version AND x.code = p.a LEFT JOIN tree y ON y.scheme = p.scheme AND y.version = p.version AND y.code = p.b""")
def tree_distance(s, d):
    c = tx.split_codes(F.col("codes"))
    x = table(s, d, "crosswalk_entries").where(F.size(c) >= 2).select("entry_id", *SCOPE, F.get(c, 0).alias("a"), F.get(c, 1).alias("b"))
    return tr.distance(x, _tree(s, d)).select("entry_id", F.col("distance").cast("bigint").alias("distance"))


_RANK = """CASE x.scheme WHEN 'psic' THEN list_position(['section', 'division', 'group', 'class', 'subclass'], lower({l}))
  WHEN 'pcpc' THEN list_position(['section', 'division', 'group', 'class', 'subclass', 'item'], lower({l})) WHEN 'pscc' THEN list_position(['chapter', 'heading', 'hs_subheading', 'ahtn_subheading', 'commodity'], lower({l})) END"""


@query(f"""WITH {_ONE}, pc AS (SELECT scheme, version, code, max(nullif(trim(parent_code, ' '), '')) AS pc FROM taxonomy_nodes GROUP BY ALL),
x AS (SELECT o.scheme, o.version, o.code, o.level, pc.pc, p.code AS there, p.level AS pl FROM one o JOIN pc USING (scheme, version, code) LEFT JOIN one p ON p.scheme = o.scheme AND p.version = o.version AND p.code = pc.pc),
r AS (SELECT *, {_RANK.format(l='x.level')} AS r, {_RANK.format(l='x.pl')} AS q FROM x)
SELECT scheme, version, code, finding FROM (SELECT *, CASE WHEN coalesce(r, 0) = 0 THEN NULL WHEN r = 1 AND pc IS NOT NULL THEN 'top_level_with_parent' WHEN r > 1 AND there IS NULL THEN 'orphan' WHEN coalesce(q, 0) = 0 THEN NULL
  WHEN q >= r THEN 'parent_not_shallower' WHEN regexp_full_match(code, '[0-9]+') AND regexp_full_match(pc, '[0-9]+') AND NOT starts_with(code, pc) THEN 'prefix_violation' WHEN r - q > 1 THEN 'level_gap' END AS finding FROM r) WHERE finding IS NOT NULL""")
def tree_findings(s, d):
    return tr.findings(table(s, d, "taxonomy_nodes"))


@query(f"WITH {_ONE} SELECT scheme, version, lower(level) AS level, count(*) AS n FROM one GROUP BY ALL")
def tree_histogram(s, d):
    return tr.histogram(table(s, d, "taxonomy_nodes"))


@query()
def tree_fingerprints(s, d):
    return tr.fingerprint(table(s, d, "taxonomy_nodes"))


@query(f"""{_TREE}, {_CLOSURE}, {_ONE} SELECT c.scheme, c.version, c.code, string_agg(coalesce(o.level, '') || ':' || c.ancestor || ' ' || coalesce(o.title, ''), ' > ' ORDER BY c.hops DESC) AS text
FROM clo c JOIN one o ON o.scheme = c.scheme AND o.version = c.version AND o.code = c.ancestor GROUP BY 1, 2, 3""")
def tree_paths(s, d):
    return tr.rendered_path(_tree(s, d))


@query(f"""{_TREE}, {_CLOSURE}, {_ONE} SELECT n.node_id, {', '.join(f"(SELECT arg_min(c.ancestor, c.hops) FROM clo c JOIN one o ON o.scheme = c.scheme AND o.version = c.version AND o.code = c.ancestor WHERE lower(o.level) = '{v}' AND c.scheme = n.scheme AND c.version = n.version AND c.code = n.code) AS psic_{v}" for v in tx.LEVELS['psic'])}
FROM taxonomy_nodes n WHERE n.scheme = 'psic'""")
def ancestor_columns(s, d):
    n = table(s, d, "taxonomy_nodes").where("scheme = 'psic'").select("node_id", *SCOPE, "code")
    return tr.ancestor_columns(n, _tree(s, d), "psic", tx.LEVELS["psic"]).drop(*SCOPE, "code")


# places and rules --------------------------------------------------------------------------------------

_EV = " UNION ALL ".join(
    f"SELECT place_row, {i}::BIGINT AS source_ord, {j}::BIGINT AS field_ord, '{s}' AS source, '{f}' AS field, trim({s}_{f}, {_B}) AS value, "
    + (f"CASE WHEN lower(trim(overture_has_foursquare_provenance)) IN ('1', 'true', 'yes', 'y', 't') THEN 'fsq-lineage' ELSE '{s}' END" if s != "osm" else "'osm'")
    + f" AS dep_group FROM places WHERE lower(trim({s}_{f}, {_B})) NOT IN {_WORDS}"
    for i, s in enumerate(ev.SOURCES)
    for j, f in enumerate(("category", "name"))
)


@query(f"WITH e AS ({_EV}) SELECT * FROM e")
def evidence_groups(s, d):
    return ev.evidence(table(s, d, "places")).withColumns({c: F.col(c).cast("bigint") for c in ("source_ord", "field_ord")})


@query("""SELECT place_row, concat_ws('|', CASE WHEN lower(trim(completed_transitively)) IN ('1', 'true', 'yes', 'y', 't') THEN 'ENTITY_MATCH_SUSPECT_TRANSITIVE' END, CASE WHEN cluster_max_pair_distance_m >= 80 THEN 'ENTITY_MATCH_SUSPECT_DISTANCE' END,
  CASE WHEN match_score_min < 0.85 THEN 'ENTITY_MATCH_SUSPECT_LOW_MATCH_SCORE' END) AS flags FROM places""")
def match_flags(s, d):
    return table(s, d, "places").select("place_row", F.array_join(ev.suspicion(table(s, d, "places")), "|").alias("flags"))


@query("""SELECT trim(canonical_id) AS canonical_id, 'blank' AS problem FROM places WHERE coalesce(trim(canonical_id), '') = ''
UNION ALL SELECT trim(canonical_id), 'repeated' FROM places WHERE trim(canonical_id) <> '' GROUP BY 1 HAVING count(*) > 1""")
def places_contract(s, d):
    return ev.contract(table(s, d, "places"))


def _rules(s, d):
    return ru.prepared(table(s, d, "crosswalk_entries"))


_RULES = rf"""rules0 AS (SELECT entry_id AS rule_id, coalesce(nullif(lower(trim(source, ' ')), ''), '') AS source, trim(source_value, ' ') AS value, scheme, trim(version, ' ') AS version, CASE upper(trim(mapping_kind, ' ')) WHEN 'CLASS' THEN 'EXACT' ELSE upper(trim(mapping_kind, ' ')) END AS kind,
  {_CODES} AS codes, coalesce(nullif(lower(trim(match_type, ' ')), ''), 'exact') AS match_type, confidence, coalesce(nullif(lower(trim(source_field, ' ')), ''), 'category') AS field FROM crosswalk_entries WHERE trim(mapping_kind, ' ') <> ''),
rules AS (SELECT *, CASE WHEN kind = 'UNION' THEN kind || ':' || array_to_string(list_sort(codes), '|') ELSE kind || ':' || array_to_string(codes, '|') END AS signature,
  coalesce({_FOLD.format(x="nullif(trim(value, ' '), '')")}, '') AS key FROM rules0)"""


@query(f"""{_TREE}, {_CLOSURE}, {_RULES}, codes1 AS (SELECT DISTINCT rule_id, scheme, version, unnest(codes) AS code FROM rules), known AS (SELECT c.*, t.code IS NOT NULL AS there FROM codes1 c LEFT JOIN tree t USING (scheme, version, code)),
roots AS (SELECT k.rule_id, count(*) FILTER (WHERE NOT there) AS unknown, count(*) FILTER (WHERE there AND NOT EXISTS (SELECT 1 FROM known o JOIN clo c ON c.scheme = k.scheme AND c.version = k.version AND c.code = k.code AND c.ancestor = o.code WHERE o.rule_id = k.rule_id AND o.code <> k.code)) AS roots FROM known k GROUP BY 1)
SELECT rule_id, problem FROM (SELECT r.rule_id, CASE WHEN source NOT IN ('fsq', 'overture', 'osm') THEN 'unknown_source' WHEN coalesce(value, '') = '' THEN 'blank_value' WHEN version IS NULL OR version = '' THEN 'blank_version' WHEN field NOT IN ('category', 'name') THEN 'unknown_field'
  WHEN NOT coalesce(confidence BETWEEN 0 AND 1, true) THEN 'confidence' WHEN match_type NOT IN ('exact', 'contains', 'regex') THEN 'unknown_match_type' WHEN len(list_distinct(codes)) < len(codes) THEN 'repeated_codes'
  WHEN kind IN ('EXACT', 'SUBTREE') AND len(codes) <> 1 THEN 'not_one_code' WHEN kind = 'UNION' AND len(codes) < 2 THEN 'union_too_small' WHEN kind IN ('NOT_ACTIVITY', 'UNCODEABLE') AND len(codes) > 0 THEN 'codes_on_no_activity'
  WHEN coalesce(unknown, 0) > 0 THEN 'unknown_codes' WHEN kind = 'UNION' AND roots < 2 THEN 'union_collapses' END AS problem FROM rules r LEFT JOIN roots USING (rule_id) WHERE r.value IS NULL OR regexp_full_match(r.value, '[ -~]*')) WHERE problem IS NOT NULL""")
def rule_problems(s, d):
    """Problems of rules; held against SQL for labels of plain ASCII, as folding goes beyond SQL."""
    r = _rules(s, d)
    return ru.problems(r.where(F.col("value").isNull() | _printable("value")), _tree(s, d))


@query(f"WITH {_RULES} SELECT source, scheme, version, field, key, count(*) AS n_rules FROM rules WHERE match_type = 'exact' AND regexp_full_match(value, '[ -~]*') GROUP BY ALL HAVING count(DISTINCT signature) > 1")
def rule_conflicts(s, d):
    return ru.conflicts(_rules(s, d).where(_printable("value")))


@query()
def rule_problems_all(s, d):
    return ru.problems(_rules(s, d), _tree(s, d))


@query()
def rule_conflicts_all(s, d):
    return ru.conflicts(_rules(s, d))


_LABELS = f"labels AS (SELECT DISTINCT source, field, value FROM ({_EV}) WHERE regexp_full_match(value, '[ -~]*'))"
_MATCH = f"""{_LABELS}, {_RULES}, lk AS (SELECT *, {_FOLD.format(x='value')} AS key FROM labels), ex AS (SELECT l.source, l.field, l.value, r.scheme, r.version, min(r.rule_id) AS rule_id FROM lk l JOIN rules r ON r.match_type = 'exact' AND r.source = l.source AND r.field = l.field AND r.key = l.key AND l.key <> '' AND regexp_full_match(r.value, '[ -~]*') GROUP BY ALL),
sc AS (SELECT l.source, l.field, l.value, r.scheme, r.version, r.rule_id, r.signature, length(r.value) AS len FROM lk l JOIN rules r ON r.source = l.source AND r.field = l.field AND regexp_full_match(r.value, '[ -~]*') AND ((r.match_type = 'contains' AND contains(l.key, r.key)) OR (r.match_type = 'regex' AND regexp_matches(l.value, '(?i)' || r.value))))"""


def _all_labels(s, d):
    return ev.labels(table(s, d, "places"))


def _labels(s, d):
    return _all_labels(s, d).where(_printable("value"))


def _plain_rules(s, d):
    return _rules(s, d).where(_printable("value"))


@query(f"WITH {_MATCH} SELECT * FROM ex")
def rule_match_exact(s, d):
    return ru.match_exact(_labels(s, d), _plain_rules(s, d))


@query(f"WITH {_MATCH} SELECT source, field, value, scheme, version, rule_id FROM sc")
def rule_match_scan(s, d):
    return ru.scan_hits(_labels(s, d), _plain_rules(s, d))


@query(f"""WITH {_MATCH}, g AS (SELECT source, field, value, scheme, version, count(DISTINCT signature) > 1 AS ambiguous, arg_max(rule_id, len * 1000000000 - rule_id) AS best FROM sc WHERE NOT EXISTS (SELECT 1 FROM ex WHERE ex.source = sc.source AND ex.field = sc.field AND ex.value = sc.value AND ex.scheme = sc.scheme AND ex.version = sc.version) GROUP BY ALL)
SELECT *, false AS ambiguous FROM ex UNION ALL SELECT source, field, value, scheme, version, CASE WHEN NOT ambiguous THEN best END, ambiguous FROM g""")
def rule_match(s, d):
    return ru.match(_labels(s, d), _plain_rules(s, d))


@query()
def rule_match_exact_all(s, d):
    return ru.match_exact(_all_labels(s, d), _rules(s, d))


@query()
def rule_match_scan_all(s, d):
    return ru.scan_hits(_all_labels(s, d), _rules(s, d))


@query()
def rule_match_all(s, d):
    return ru.match(_all_labels(s, d), _rules(s, d))


def _facts(s, d):
    tree = _tree(s, d)
    return cl.classify(table(s, d, "places"), Stage(ru.valid(_rules(s, d), tree)).df, tree)


@query()
def classify_all(s, d):
    return cl.stored(_facts(s, d))


@query()
def classified_summary(s, d):
    return cl.summary(table(s, d, "places").select("place_row", "canonical_id", "canonical_name", "lon", "lat"), _facts(s, d), list(RELEASES))


@query()
def economic_roles(s, d):
    rules, _ = ro.role_rules(table(s, d, "crosswalk_entries"))
    f = _facts(s, d).where("scheme = 'psic'").select("place_row", "code")
    p = ro.profiles(table(s, d, "places"), rules, f)
    return p.withColumns({c: F.to_json(c) for c in ("io_roles", "role_flags")})


# worklists ---------------------------------------------------------------------------------------------

_CATS = " UNION ALL ".join(f"SELECT '{s}' AS source, trim({s}_category, ' ') AS source_value FROM places" for s in ev.SOURCES)
_COUNTS = f"counts AS (SELECT source, source_value, count(*) AS row_count FROM ({_CATS}) WHERE source_value <> '' GROUP BY ALL)"
_INIT = f"""{_COUNTS}, fresh AS (SELECT source, source_value, 'category' AS source_field, row_count, row_count / (SELECT count(*) FROM places) AS row_share, x.* FROM counts, (VALUES {', '.join(f"('{a}', '{b}')" for a, b in RELEASES.items())}) x(scheme, version))"""
_JK = "substr(sha1(concat_ws(chr(31), lower(trim({a}source)), lower(trim({a}source_field)), trim({a}source_value))), 1, 16)"


@query(f"WITH {_COUNTS} SELECT * FROM counts")
def category_counts(s, d):
    return wl.category_counts(table(s, d, "places"))


@query(f"WITH {_COUNTS} SELECT source, source_value, row_count, rank FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY row_count DESC, source_value) AS rank FROM counts) WHERE rank <= 20")
def top_categories(s, d):
    return wl.top_categories(table(s, d, "places"))


@query(f"WITH {_INIT} SELECT source, source_value, source_field, {_JK.format(a='')} AS joint_key, row_count, row_share, scheme, version FROM fresh")
def worklist_init(s, d):
    return wl.init(table(s, d, "places"), RELEASES)


_REV = ("mapping_kind", "codes", "match_type", "confidence", "notes")


@query(f"""WITH {_INIT}, old AS (SELECT source, source_value, coalesce(nullif(trim(source_field), ''), 'category') AS source_field, scheme, version, arg_max({{{', '.join(f"{c}: nullif(trim({c}::VARCHAR), '')" for c in _REV)}}}, entry_id) AS r FROM crosswalk_entries
  WHERE coalesce({', '.join(f"nullif(trim({c}::VARCHAR), '')" for c in _REV)}) IS NOT NULL AND source_value IS NOT NULL AND regexp_full_match(source_value, '[ -~]*') GROUP BY 1, 2, 3, 4, 5)
SELECT source, source_value, source_field, scheme, version, coalesce(row_count, 0) AS row_count, round(coalesce(row_share, 0), 9) AS row_share, {', '.join(f'r.{c} AS {c}' for c in _REV if c != 'confidence')} FROM (SELECT * FROM fresh WHERE regexp_full_match(source_value, '[ -~]*')) FULL JOIN old USING (source, source_value, source_field, scheme, version)""")
def worklist_refresh(s, d):
    plain = _printable("source_value")
    out = wl.refresh(wl.init(table(s, d, "places"), RELEASES).where(plain), table(s, d, "crosswalk_entries").where(plain))
    return out.drop("joint_key", "confidence").withColumn("row_share", F.round("row_share", 9))


@query()
def worklist_refresh_all(s, d):
    return wl.refresh(wl.init(table(s, d, "places"), RELEASES), table(s, d, "crosswalk_entries"))


@query("""WITH w AS (SELECT *, lower(regexp_replace(coalesce(source, ''), '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g')) AS ks, coalesce(source_field, 'category') AS kf, regexp_replace(coalesce(source_value, ''), '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g') AS kv, ((coalesce(trim(mapping_kind), '') = '')::BIGINT * 2 + (NOT ((scheme = 'psic' AND version = 'rev5') OR (scheme = 'pcpc' AND version = '2002') OR (scheme = 'pscc' AND version = '2022')))::BIGINT) * 10000000000 + entry_id AS o FROM crosswalk_entries WHERE worklist_id IS NOT NULL),
b AS (SELECT worklist_id, ks, lower(trim(kf)) AS kf, kv, scheme AS peer_scheme, arg_min(entry_id, o) AS peer_id FROM w GROUP BY ALL)
SELECT w.entry_id, b.peer_scheme, b.peer_id FROM w JOIN b ON b.worklist_id = w.worklist_id AND b.ks = w.ks AND b.kf = lower(trim(w.kf)) AND b.kv = w.kv WHERE b.peer_scheme <> w.scheme""")
def peer_choice(s, d):
    return wl.peers(table(s, d, "crosswalk_entries"), RELEASES)


@query("""SELECT scheme, version, count(*) AS n_rows, sum((coalesce(trim(mapping_kind), '') <> '')::INT)::BIGINT AS reviewed_rows, sum(coalesce(row_count, 0))::BIGINT AS occurrences, coalesce(sum(row_count) FILTER (WHERE trim(mapping_kind) <> ''), 0)::BIGINT AS reviewed_occurrences,
  coalesce(sum(row_count) FILTER (WHERE upper(trim(mapping_kind)) IN ('EXACT', 'SUBTREE', 'UNION', 'CLASS') AND trim(codes) <> ''), 0)::BIGINT AS coded_occurrences FROM crosswalk_entries GROUP BY ALL""")
def coverage_report(s, d):
    return wl.coverage(table(s, d, "crosswalk_entries"))


# retrieval -----------------------------------------------------------------------------------------------


def _corpus(s, d):
    n = tr.one_per_code(table(s, d, "taxonomy_nodes"))
    return rt.node_texts(n.where(F.concat_ws(":", *SCOPE).isin([f"{a}:{b}" for a, b in RELEASES.items()])))


def _queries(s, d):
    """Every title of the list of codes, asked of the base release of its scheme."""
    rel = F.create_map(*[F.lit(x) for kv in RELEASES.items() for x in kv])
    return table(s, d, "reference_labels").where("kind = 'code'").select("scheme", rel[F.col("scheme")].alias("version"), F.col("label").alias("query"))


_IDX = f"""{_ONE}, corpus AS (SELECT scheme, version, code, lower(concat_ws(E'\\n', nullif(trim(title), ''), nullif(trim(description), ''), nullif(trim(includes), ''))) AS x FROM one WHERE (scheme, version) IN (('psic', 'rev5'), ('pcpc', '2002'), ('pscc', '2022'))),
queries AS (SELECT DISTINCT scheme, CASE scheme WHEN 'psic' THEN 'rev5' WHEN 'pcpc' THEN '2002' ELSE '2022' END AS version, label AS query FROM reference_labels WHERE kind = 'code')"""


def _tfidf_sql(kind: str, weight: float) -> str:
    if kind == "word":
        terms = "list_concat(regexp_extract_all({x}, '[\\p{{L}}\\p{{N}}_]{{2,}}'), list_transform(range(1, greatest(len(regexp_extract_all({x}, '[\\p{{L}}\\p{{N}}_]{{2,}}')), 1)), lambda i: regexp_extract_all({x}, '[\\p{{L}}\\p{{N}}_]{{2,}}')[i] || ' ' || regexp_extract_all({x}, '[\\p{{L}}\\p{{N}}_]{{2,}}')[i + 1]))"
    else:
        terms = "flatten(list_transform(list_filter(regexp_split_to_array({x}, '\\s+'), lambda t: t <> ''), lambda t: list_concat(" + ", ".join(f"list_transform(range(1, length(t) + 4 - {n}), lambda i: substr(' ' || t || ' ', i, {n}))" for n in (3, 4, 5)) + ")))"
    k = kind[0]
    return f"""{k}t AS (SELECT scheme, version, code, term, 1 + ln(count(*)) AS tf FROM (SELECT scheme, version, code, unnest({terms.format(x='x')}) AS term FROM corpus) GROUP BY ALL),
{k}n AS (SELECT scheme, version, count(*) AS n FROM corpus GROUP BY ALL), {k}i AS (SELECT t.scheme, t.version, term, ln((1 + any_value(n)) / (1 + count(*))) + 1 AS idf FROM {k}t t JOIN {k}n USING (scheme, version) GROUP BY 1, 2, 3),
{k}d AS (SELECT scheme, version, code, term, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY scheme, version, code)) AS w FROM {k}t JOIN {k}i USING (scheme, version, term)),
{k}q AS (SELECT scheme, version, query, term, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY scheme, version, query)) AS w FROM (SELECT scheme, version, query, term, 1 + ln(count(*)) AS tf FROM (SELECT scheme, version, query, unnest({terms.format(x='lower(query)')}) AS term FROM queries) GROUP BY ALL) JOIN {k}i USING (scheme, version, term)),
{k}s AS (SELECT q.scheme, q.version, query, code, {weight} * sum(q.w * d.w) AS score FROM {k}q q JOIN {k}d d USING (scheme, version, term) GROUP BY 1, 2, 3, 4)"""


def _ranked_sql(parts: dict[str, float], n: int) -> str:
    both = " UNION ALL ".join(f"SELECT * FROM {k[0]}s" for k in parts)
    return f"WITH {_IDX}, {', '.join(_tfidf_sql(k, w) for k, w in parts.items())}, s AS (SELECT scheme, version, query, code, round(sum(score), 9) AS score FROM ({both}) GROUP BY 1, 2, 3, 4) SELECT scheme, version, query, code, round(score, 6) AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY scheme, version, query ORDER BY score DESC, code DESC) AS rank FROM s WHERE score > 0) WHERE rank <= {n}"


def _top(s, d, kinds, n):
    return rt.top(rt.scores(_queries(s, d), _corpus(s, d), kinds), n).withColumn("score", F.round("score", 6))


@query(_ranked_sql({"word": 1.0}, 5))
def tfidf_word_topk(s, d):
    return _top(s, d, {"word": 1.0}, 5)


@query(_ranked_sql({"char": 1.0}, 5))
def tfidf_char_topk(s, d):
    return _top(s, d, {"char": 1.0}, 5)


@query(_ranked_sql({"word": 0.6, "char": 0.4}, 5))
def tfidf_hybrid_topk(s, d):
    return _top(s, d, None, 5)


@query()
def tfidf_beam_topk(s, d):
    tree = _tree(s, d)
    return rt.beam(Stage(rt.scores(_queries(s, d), _corpus(s, d))).df, tree, tr.closure(tree), 5)


# evaluation, ingestion, votes -------------------------------------------------------------------------------

_JUDGED = f"""{_TREE}, {_CLOSURE}, asked AS (SELECT audit_id, 'psic' AS scheme, 'rev5' AS version, nullif(split_part(suggested_codes, '|', 1), '') AS code, nullif(split_part(candidate_codes, '|', 2), '') AS gold FROM psic_rev5_deterministic_audit),
j AS (SELECT a.audit_id, a.scheme, a.version, a.code, a.gold, g.above AS gp, p.above AS pp, len(list_intersect(g.above, p.above)) AS shared FROM asked a JOIN tree g ON g.scheme = a.scheme AND g.version = a.version AND g.code = a.gold LEFT JOIN tree p ON p.scheme = a.scheme AND p.version = a.version AND p.code = a.code),
jr AS (SELECT *, CASE WHEN code IS NULL THEN 'missing' WHEN pp IS NULL THEN 'invalid' WHEN code = gold THEN 'exact' WHEN shared = len(pp) THEN 'ancestor_backoff' WHEN shared = len(gp) THEN 'over_specific' ELSE 'wrong_branch' END AS relation FROM j)"""


def _judged(s, d):
    part = lambda c, i: F.nullif(F.split_part(c, F.lit("|"), F.lit(i)), F.lit(""))
    x = table(s, d, "psic_rev5_deterministic_audit").select("audit_id", F.lit("psic").alias("scheme"), F.lit("rev5").alias("version"), part("suggested_codes", 1).alias("code"), part("candidate_codes", 2).alias("gold"))
    return el.judged(x, _tree(s, d))


@query(f"{_JUDGED} SELECT scheme, version, relation, count(*) AS n FROM jr GROUP BY ALL")
def eval_relations(s, d):
    return el.relations(_judged(s, d))


@query(f"""{_JUDGED}, x AS (SELECT scheme, version, unnest(range(1, len(gp) + 1)) AS depth, gp, pp FROM jr), y AS (SELECT scheme, version, depth, gp[depth] AS y, CASE WHEN depth <= len(pp) THEN pp[depth] END AS p FROM x),
b AS (SELECT scheme, version, depth, count(*) AS eligible_gold, count(p) AS produced, coalesce(sum((y = p)::INT), 0) AS hits FROM y GROUP BY ALL),
l AS (SELECT scheme, version, depth, y AS label, count(*) AS ny, 0 AS np FROM y WHERE p IS NOT NULL GROUP BY ALL UNION ALL SELECT scheme, version, depth, p, 0, count(*) FROM y WHERE p IS NOT NULL GROUP BY ALL),
c AS (SELECT scheme, version, depth, sum(a * z) AS chance, count(*) AS labels FROM (SELECT scheme, version, depth, label, sum(ny) AS a, sum(np) AS z FROM l GROUP BY ALL) GROUP BY ALL)
SELECT scheme, version, depth, eligible_gold, produced, round(produced / eligible_gold, 6) AS production_rate, round(CASE WHEN produced > 0 THEN hits / produced END, 6) AS accuracy,
  round(CASE WHEN labels > 1 AND produced > 0 AND chance <> produced * produced THEN (hits / produced - chance / (produced * produced)) / (1 - chance / (produced * produced)) END, 6) AS kappa FROM b LEFT JOIN c USING (scheme, version, depth)""")
def eval_depth_metrics(s, d):
    return el.by_depth(_judged(s, d)).withColumn("depth", F.col("depth").cast("bigint"))


@query(f"""{_JUDGED} SELECT scheme, version, count(*) AS n, round(avg((pp IS NOT NULL)::INT), 6) AS coverage, round(avg((relation = 'exact')::INT), 6) AS exact_accuracy, round(avg((relation IN ('exact', 'ancestor_backoff', 'over_specific'))::INT), 6) AS hierarchy_compatible,
  round(avg(CASE WHEN pp IS NOT NULL THEN len(gp) + len(pp) - 2 * shared END), 6) AS mean_distance FROM jr GROUP BY ALL""")
def eval_summary(s, d):
    return el.summary(_judged(s, d))


_LONGEST = ", ".join(f"arg_max(trim({c}, ' '), length(trim({c}, ' ')) * 1000000000 - node_id) AS {c}" for c in ig.TEXTS)


@query(f"""SELECT scheme, version, code, {_LONGEST}, min(lower(trim(level))) AS level, max(nullif(trim(parent_code, ' '), '')) AS parent_code, count(*) AS n_rows,
  coalesce(min(lower(trim(level))) <> max(lower(trim(level))), false) OR coalesce(min(nullif(trim(parent_code, ' '), '')) <> max(nullif(trim(parent_code, ' '), '')), false) AS conflict FROM taxonomy_nodes WHERE code IS NOT NULL GROUP BY scheme, version, code""")
def duplicate_merge(s, d):
    return ig.merge_duplicates(table(s, d, "taxonomy_nodes"))


@query("""WITH one AS (SELECT scheme, version, code, min(node_id) AS o, max(nullif(trim(parent_code, ' '), '')) AS p FROM taxonomy_nodes WHERE code IS NOT NULL GROUP BY ALL),
pre AS (SELECT a.scheme, a.version, a.code, arg_max(b.code, length(b.code)) AS prefix FROM one a JOIN one b ON a.scheme = b.scheme AND a.version = b.version AND regexp_full_match(a.code, '[0-9]{2,}') AND length(b.code) < length(a.code) AND starts_with(a.code, b.code) GROUP BY ALL),
sec AS (SELECT a.scheme, a.version, a.code, arg_max(b.code, b.o) AS section FROM one a JOIN one b ON a.scheme = 'psic' AND a.scheme = b.scheme AND a.version = b.version AND regexp_full_match(a.code, '[0-9]{2}') AND regexp_full_match(b.code, '[A-V]') AND b.o < a.o GROUP BY ALL)
SELECT one.scheme, one.version, one.code, CASE WHEN g.code IS NOT NULL THEN one.p ELSE coalesce(prefix, section) END AS parent, CASE WHEN g.code IS NOT NULL THEN 'given' WHEN prefix IS NOT NULL THEN 'prefix' WHEN section IS NOT NULL THEN 'section' ELSE 'none' END AS how
FROM one LEFT JOIN one g ON g.scheme = one.scheme AND g.version = one.version AND g.code = one.p LEFT JOIN pre ON pre.scheme = one.scheme AND pre.version = one.version AND pre.code = one.code LEFT JOIN sec ON sec.scheme = one.scheme AND sec.version = one.version AND sec.code = one.code""")
def parent_derivation(s, d):
    return ig.derive_parents(table(s, d, "taxonomy_nodes"))


@query("""WITH mine AS (SELECT DISTINCT scheme, version, code FROM taxonomy_nodes WHERE scheme = 'pscc' AND regexp_full_match(code, '[0-9]+')), want AS (SELECT DISTINCT m.scheme, m.version, substr(m.code, 1, w) AS code, w FROM mine m, (VALUES (2), (4), (6), (8)) x(w) WHERE w < length(m.code))
SELECT scheme, version, code, CASE w WHEN 2 THEN 'chapter' WHEN 4 THEN 'heading' WHEN 6 THEN 'hs_subheading' WHEN 8 THEN 'ahtn_subheading' END AS level FROM want ANTI JOIN mine USING (scheme, version, code)""")
def prefix_completion(s, d):
    return ig.complete_prefixes(table(s, d, "taxonomy_nodes"))


@query(f"""{_TREE}, cand AS (SELECT audit_id, unnest(string_split(candidate_codes, '|')[1:3]) AS code, unnest(range(1, len(string_split(candidate_codes, '|')[1:3]) + 1)) AS pass_no FROM psic_rev5_deterministic_audit WHERE candidate_codes IS NOT NULL),
pth AS (SELECT c.audit_id, c.pass_no, coalesce(t.above, []) AS path FROM cand c LEFT JOIN tree t ON t.scheme = 'psic' AND t.version = 'rev5' AND t.code = c.code), n AS (SELECT audit_id, count(*) AS n, max(len(path)) AS longest FROM pth GROUP BY 1),
v AS (SELECT audit_id, code, count(*) AS votes, max(i) AS i FROM (SELECT audit_id, unnest(path) AS code, unnest(range(1, len(path) + 1)) AS i FROM pth) GROUP BY 1, 2), w AS (SELECT v.audit_id, arg_max(code, i) AS code, arg_max(votes, i) AS votes FROM v JOIN n USING (audit_id) WHERE votes >= n // 2 + 1 GROUP BY 1)
SELECT n.audit_id, w.code, round(w.votes / n.n, 6) AS agreement, CASE WHEN w.code IS NOT NULL THEN '' WHEN longest = 0 THEN 'INSUFFICIENT_AT_ROOT' ELSE 'NO_CONSENSUS' END AS flags FROM n LEFT JOIN w USING (audit_id)""")
def vote_consensus(s, d):
    """The first three candidates of every audited label as the ends of three walks."""
    x = table(s, d, "psic_rev5_deterministic_audit").where("candidate_codes is not null")
    c = x.select("audit_id", F.posexplode(F.slice(F.split("candidate_codes", r"\|"), 1, 3)).alias("pass_no", "code"))
    t = _tree(s, d).where("scheme = 'psic' and version = 'rev5'").select("code", "path")
    return vt.consensus(c.join(t, "code", "left").select("audit_id", "pass_no", F.coalesce("path", F.array().cast("array<string>")).alias("path")), "audit_id")
