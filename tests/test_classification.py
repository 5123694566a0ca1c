import pytest
from pyspark.sql import functions as F

from arbora.functions import text as tx
from arbora.operators import classify as cl
from arbora.operators import evaluate as el
from arbora.operators import fusion as fu
from arbora.operators import ingest as ig
from arbora.operators import rules as ru
from arbora.operators import tree as tr
from arbora.operators import vote as vt
from arbora.operators import worklist as wl

PARENT = {"10": "A", "101": "10", "1011": "101", "10111": "1011", "10112": "1011", "102": "10", "1021": "102", "10210": "1021", "20": "B", "201": "20", "2011": "201", "20110": "2011"}
ENTRY = "entry_id long, source string, source_value string, scheme string, version string, mapping_kind string, codes string, match_type string, confidence double, source_field string"
PLACE = "place_row long, fsq_category string, fsq_name string, overture_category string, overture_name string, osm_category string, osm_name string, overture_has_foursquare_provenance string, completed_transitively string, cluster_max_pair_distance_m double, match_score_min double, product_text string"


def path(c):
    return [*(path(PARENT[c]) if c in PARENT else []), c]


def test_text(spark):
    rows = [("  Straße — X ",), ("Other",), ("n/a",), (None,), ("café",), ("A  > B",), ("ﬁne",)]
    got = [tuple(r) for r in spark.createDataFrame(rows, "x string").select(tx.observed_key(F.col("x")), tx.reviewed_key(F.col("x"))).collect()]
    assert got == [("strasse x", "strasse x"), ("", "other"), ("", "n/a"), ("", ""), ("café", "café"), ("a b", "a b"), ("fine", "fine")]
    one = spark.createDataFrame([("k=v | k=w | a=b", "7.0", "1")], "t string, c string, d string")
    r = one.select(tx.tag_map(F.col("t")).alias("m"), tx.code_text(F.col("c")).alias("c"), tx.pad_code(F.lit("psic"), F.lit("division"), F.col("d")).alias("d"), tx.joint_key(F.lit("fsq"), F.lit("category"), F.lit("Bakery")).alias("k"), tx.combine_text(F.lit("A b"), F.lit("a  B"), F.lit("none"), F.lit("c")).alias("j")).first()
    assert (r.m, r.c, r.d, r.k, r.j) == ({"k": "w", "a": "b"}, "7", "01", "da72d8f7be83f3ad", "A b | c")


def test_tree(spark, toy_tree):
    d = {r.code: r for r in tr.dims(toy_tree).where("scheme = 'psic'").collect()}
    assert (d["10"].depth, d["10"].branch_max_depth, d["10"].n_leaves, d["10111"].is_leaf) == (2, 5, 3, True)
    pairs = spark.createDataFrame([("psic", "rev5", a, b) for a, b in (("10111", "10112"), ("10111", "20"), ("10", "10"), ("10", "zz"))], "scheme string, version string, a string, b string")
    assert {(r.a, r.b): r.distance for r in tr.distance(pairs, toy_tree).collect()} == {("10111", "10112"): 2, ("10111", "20"): 7, ("10", "10"): 0, ("10", "zz"): None}


@pytest.mark.parametrize(
    ("items", "status", "code", "flags", "groups"),
    [
        ([("fsq", "fsq", "SUBTREE", ["10"]), ("osm", "osm", "EXACT", ["1011"])], "NESTED", "1011", [], 2),
        ([("fsq", "fsq", "EXACT", ["1011"]), ("osm", "osm", "EXACT", ["2011"])], "CONFLICT", None, [], 2),
        ([("fsq", "l", "EXACT", ["1011"]), ("overture", "l", "EXACT", ["1021"])], "INTERSECT", "10", ["DEPENDENT_CONFLICT:l"], 1),
        ([("fsq", "fsq", "UNION", ["1011", "2011"])], "UNION", None, ["NO_COMMON_ANCESTOR"], 1),
        ([("fsq", "fsq", "UNION", ["10111", "10112"])], "UNION", "1011", [], 1),
        ([("fsq", "fsq", "EXACT", ["10111"]), ("osm", "osm", "EXACT", ["10112"])], "INTERSECT", "1011", ["INDEPENDENT_SIBLING_BACKOFF"], 2),
        ([("fsq", "fsq", "EXACT", ["10111"]), ("osm", "osm", "EXACT", ["10112"]), ("overture", "overture", "SUBTREE", ["10"])], "INTERSECT", "1011", ["INDEPENDENT_SIBLING_BACKOFF"], 3),
        ([("fsq", "fsq", "EXACT", ["10111"]), ("osm", "osm", "EXACT", ["10210"])], "CONFLICT", None, [], 2),
        ([("fsq", "fsq", "EXACT", ["1011"]), ("osm", "osm", "EXACT", ["1011"])], "INTERSECT", "1011", [], 2),
        ([("fsq", "l", "EXACT", ["1011"]), ("fsq", "l", "EXACT", ["2011"]), ("overture", "l", "SUBTREE", ["101"])], "INTERSECT", "1011", ["DEPENDENT_CONFLICT:l"], 1),
        ([("fsq", "l", "EXACT", ["1011"]), ("fsq", "l", "SUBTREE", ["101"]), ("overture", "l", "EXACT", ["2011"])], "UNION", None, ["DEPENDENT_CONFLICT:l", "NO_COMMON_ANCESTOR"], 1),
        ([("fsq", "fsq", "SUBTREE", ["10"])], "SINGLE", "10", [], 1),
        ([], "EMPTY", None, [], 0),
    ],
)
def test_fusion(spark, items, status, code, flags, groups):
    def rep(codes):
        out = path(codes[0])
        for c in codes[1:]:
            out = [x for x in out if x in path(c)]
        return out

    made = [(s, g, k, c, [path(x) for x in c], rep(c)) for s, g, k, c in items]
    df = spark.createDataFrame([("psic", made)], "scheme string, items array<struct<source:string,dep_group:string,kind:string,codes:array<string>,roots:array<array<string>>,rep_path:array<string>>>")
    f = fu.fuse(df).first().fusion
    assert (f.status, f.code, f.flags, f.independent_groups) == (status, code, flags, groups)


def entry(i, source, value, kind, codes, match="exact", field="category", scheme="psic", version="rev5", conf=0.5):
    return (i, source, value, scheme, version, kind, codes, match, conf, field)


def test_rules(spark, toy_tree):
    rows = [
        entry(1, "fsq", "Bakery", "EXACT", "1011"), entry(2, "fsq", "bakery", "EXACT", "2011"), entry(3, "fsq", "bread", "SUBTREE", "101", "contains"), entry(4, "fsq", "bread s", "SUBTREE", "101", "contains"), entry(5, "fsq", r"^cak\w+", "EXACT", "10112", "regex"),
        entry(6, "fsq", "ake", "EXACT", "20", "contains"), entry(7, "xx", "a", "EXACT", "10"), entry(8, "fsq", "Other", "EXACT", "10"), entry(9, "fsq", "u", "UNION", "10|101"), entry(10, "fsq", "n", "NOT_ACTIVITY", "10"), entry(11, "fsq", "q", "EXACT", "99"), entry(12, "fsq", "r", None, "10"), entry(13, "fsq", "c", "CLASS", "10", conf=1.5), entry(14, "fsq", "w", "EXACT", "10|20"),
    ]
    r = ru.prepared(spark.createDataFrame(rows, ENTRY))
    assert {x.rule_id: x.problem for x in ru.problems(r, toy_tree).collect()} == {7: "unknown_source", 8: "generic_label", 9: "union_collapses", 10: "codes_on_no_activity", 11: "unknown_codes", 13: "confidence", 14: "not_one_code"}
    assert [(x.key, x.n_rules) for x in ru.conflicts(r).collect()] == [("bakery", 2)]
    labels = spark.createDataFrame([("fsq", "category", v) for v in ("BAKERY", "bread shop", "bread", "cakes", "zzz", "n/a")], "source string, field string, value string")
    got = {x.value: (x.rule_id, x.ambiguous) for x in ru.match(labels, ru.valid(r, toy_tree)).collect()}
    assert got == {"BAKERY": (1, False), "bread shop": (4, False), "bread": (3, False), "cakes": (None, True)}


def test_classification_and_summary(spark, toy_tree):
    rules = [
        entry(1, "fsq", "a", "EXACT", "1011"), entry(2, "osm", "b", "EXACT", "2011"), entry(3, "osm", "park", "NOT_ACTIVITY", ""), entry(4, "fsq", "hall", "NOT_ACTIVITY", "", field="name"), entry(5, "fsq", "u", "UNION", "1011|2011"), entry(6, "osm", "none", "UNCODEABLE", "", field="name"),
        entry(7, "fsq", "a", "SUBTREE", "101", scheme="pcpc", version="2002"), entry(8, "fsq", "shop", "EXACT", "2011", field="name"),
    ]
    v = ru.valid(ru.prepared(spark.createDataFrame(rules, ENTRY)), toy_tree)

    def place(i, fsq=None, name=None, osm=None, osm_name=None, dist=None):
        return (i, fsq, name, None, None, osm, osm_name, None, None, dist, None, None)

    places = spark.createDataFrame([place(1, "a"), place(2, "a", osm="b"), place(3, "a", osm="b", dist=90.0), place(4, osm="park"), place(5, "a", osm="park"), place(6, "a", "hall"), place(7, "u"), place(8), place(9, "a", "shop"), place(10, osm="park", osm_name="none")], PLACE)
    f = cl.classify(places, v, toy_tree, {"psic": "rev5", "pcpc": "2002"}).cache()
    got = {r.place_row: (r.status, r.code, r.deciding_component, r.flags) for r in f.where("scheme = 'psic'").collect()}
    assert got == {
        1: ("SINGLE", "1011", "FUSION", []), 2: ("CONFLICT", None, "FUSION", ["LLM_NOT_CONFIGURED"]), 3: ("REVIEW_ENTITY_MATCH", None, "FUSION", ["ENTITY_MATCH_SUSPECT_DISTANCE"]), 4: ("NOT_PSIC_ACTIVITY", None, "CROSSWALK", []),
        5: ("CONFLICT", None, "FUSION", ["ACTIVITY_NON_ACTIVITY_CONFLICT"]), 6: ("NOT_PSIC_ACTIVITY", None, "CROSSWALK", ["CROSSWALK_NAME_RULE_OVERRODE_CATEGORY"]), 7: ("UNION", None, "FUSION", ["NO_COMMON_ANCESTOR", "LLM_NOT_CONFIGURED"]), 8: ("EMPTY", None, "FUSION", ["LLM_NOT_CONFIGURED"]),
        9: ("SINGLE", "2011", "FUSION", ["CROSSWALK_NAME_RULE_OVERRODE_CATEGORY"]), 10: ("NOT_PSIC_ACTIVITY", None, "CROSSWALK", []),
    }
    one = f.where("scheme = 'pcpc' and place_row = 1").first()
    assert (one.status, one.code, one.classification_depth, one.branch_max_depth, one.max_depth) == ("POTENTIAL_PRODUCT_FAMILY_PARTIAL", "101", 3, 5, 5)
    s = {r.place_row: r for r in cl.summary(places, f, ["psic", "pcpc"]).collect()}
    assert len(s) == 10 and s[1].psic_code == "1011" and s[1].pcpc_status == "POTENTIAL_PRODUCT_FAMILY_PARTIAL"
    assert cl.classify(places.limit(0), v, toy_tree, {"psic": "rev5"}).count() == 0


def test_evaluation(spark, toy_tree):
    rows = [(1, "psic", "rev5", "1011", "1011"), (2, "psic", "rev5", "101", "10111"), (3, "psic", "rev5", "20", "10210"), (4, "psic", "rev5", None, "20110"), (5, "psic", "rev5", "zz", "10")]
    j = el.judged(spark.createDataFrame(rows, "id int, scheme string, version string, code string, gold string"), toy_tree)
    assert {r.id: r.relation for r in j.collect()} == {1: "exact", 2: "ancestor_backoff", 3: "wrong_branch", 4: "missing", 5: "invalid"}
    d = {r.depth: r for r in el.by_depth(j).collect()}
    assert (d[1].eligible_gold, d[1].produced, d[1].accuracy) == (5, 3, round(2 / 3, 6))
    assert el.summary(j).first().hierarchy_compatible == 0.4


def test_votes(spark):
    rows = [(1, 0, ["A", "10", "101"]), (1, 1, ["A", "10"]), (1, 2, ["B"]), (2, 0, ["A"]), (2, 1, ["B"]), (3, 0, []), (3, 1, [])]
    got = {r.id: (r.code, r.agreement, r.flags) for r in vt.consensus(spark.createDataFrame(rows, "id int, pass_no int, path array<string>"), "id").collect()}
    assert got == {1: ("10", round(2 / 3, 6), ""), 2: (None, None, "NO_CONSENSUS"), 3: (None, None, "INSUFFICIENT_AT_ROOT")}


def test_walk(spark):
    children = {None: ["A", "B"], "A": ["10"], "10": []}
    said = {("go", "A"): '{"decision": "A"}', ("go", "10"): 'so: {"decision": "10"} ok', ("stop", "A"): '{"decision": "STOP_HERE"}'}
    ask = lambda text, options, n: said.get((text, options[0]), "")
    df = spark.createDataFrame([(1, "go"), (2, "stop"), (3, None)], "id int, text string")
    assert {(r.id, tuple(r.path)) for r in vt.walk(df, "id", "text", children, ask, 2).collect()} == {(1, ("A", "10")), (2, ()), (3, ())}
    assert vt.lenient_json("x {bad} {\"a\": 1}") == {"a": 1} and vt.lenient_json(None) == {}


def test_ingest(spark, toy_nodes):
    rows = [(1, "psic", "x", "A", "section", "t", None), (2, "psic", "x", "01", "division", "t", None), (3, "psic", "x", "011", "group", "short", "zz"), (4, "psic", "x", "011", "group", "longer", "zz"), (5, "psic", "x", "B", "section", "t", None), (6, "psic", "x", "02", "division", "t", None)]
    df = spark.createDataFrame(rows, "node_id long, scheme string, version string, code string, level string, title string, parent_code string").withColumns({c: F.lit("") for c in ("description", "includes", "excludes")})
    assert {r.code: (r.parent, r.how) for r in ig.derive_parents(df).collect()} == {"A": (None, "none"), "B": (None, "none"), "01": ("A", "section"), "02": ("B", "section"), "011": ("01", "prefix")}
    assert {r.code: (r.title, r.n_rows) for r in ig.merge_duplicates(df).where("code = '011'").collect()} == {"011": ("longer", 2)}
    cells = spark.createDataFrame([("s", 1, 0, "A"), ("s", 1, 5, "Farms"), ("s", 2, 1, "01"), ("s", 2, 2, "011"), ("s", 2, 5, "Crops")], "sheet string, row_no int, col_no int, value string")
    assert {(r.code, r.level, r.title) for r in ig.from_matrix(cells, "psic", "x").collect()} == {("A", "section", "Farms"), ("01", "division", "Crops"), ("011", "group", "Crops")}


def test_peers_and_refresh(spark):
    cols = "entry_id long, worklist_id string, source string, source_field string, source_value string, scheme string, version string, mapping_kind string, codes string, match_type string, confidence double, notes string"
    row = lambda i, s, v, k=None: (i, "w", "osm", "category", "x", s, v, k, None, None, None, None)
    df = spark.createDataFrame([row(1, "psic", "rev5"), row(2, "pcpc", "1"), row(3, "pcpc", "2002"), row(4, "pcpc", "1", "EXACT"), row(5, "pscc", "1"), row(6, "pscc", "2022")], cols)
    got = {(r.entry_id, r.peer_scheme): r.peer_id for r in wl.peers(df, {"psic": "rev5", "pcpc": "2002", "pscc": "2022"}).collect()}
    assert got[1, "pcpc"] == 4 and got[1, "pscc"] == 6 and got[2, "psic"] == 1 and (2, "pcpc") not in got


def test_queries_over_labels_beyond_ascii(spark, toy_nodes, tmp_path):
    import hashlib

    from arbora.plans.catalog import QUERIES

    labels = ["Café Öl", "CAFÉ  ÖL", "öl", "Straße", "plain", "日本", None]
    rules = [
        (1, "fsq", labels[0], "EXACT", "20110", "exact"), (2, "fsq", labels[1], "EXACT", "10111", "exact"), (3, "fsq", labels[2], "SUBTREE", "20", "contains"), (4, "fsq", labels[3], "EXACT", "zz", "exact"),
        (5, "fsq", labels[4], "EXACT", "zz", "exact"), (6, "fsq", labels[5], "EXACT", "20110", "exact"), (7, "fsq", labels[6], "EXACT", "20110", "exact"),
    ]
    entries = [(i, s, v, "psic", "rev5", k, c, m, None, "category", "w", f"note {i}") for i, s, v, k, c, m in rules]
    spark.createDataFrame(entries, ENTRY + ", worklist_id string, notes string").write.parquet(f"{tmp_path}/crosswalk_entries.parquet")
    toy_nodes.write.parquet(f"{tmp_path}/taxonomy_nodes.parquet")
    seen = ["café öl", "Straße", "Grüne ÖLmühle", "plain", "日本"]
    spark.createDataFrame([(i, v, *[None] * 10) for i, v in enumerate(seen)], PLACE).write.parquet(f"{tmp_path}/places.parquet")
    run = lambda name: QUERIES[name](spark, str(tmp_path)).collect()

    key = lambda v: " ".join(v.casefold().split())
    sha = lambda v: hashlib.sha1(f"fsq\x1fcategory\x1f{v or ''}".encode()).hexdigest()[:16]
    assert {(r.entry_id, r.joint_key) for r in run("joint_keys_all")} == {(i, sha(v)) for i, _, v, *_ in rules}
    assert {(r.rule_id, r.problem) for r in run("rule_problems_all")} == {(4, "unknown_codes"), (5, "unknown_codes"), (7, "blank_value")}
    assert [(r.key, r.n_rules) for r in run("rule_conflicts_all")] == [("café öl", 2)]
    exact = {(v, min(i for i, _, w, _, _, m in rules if w and m == "exact" and key(w) == key(v))) for v in seen if any(w and m == "exact" and key(w) == key(v) for _, _, w, _, _, m in rules)}
    scan = {(v, i) for v in seen for i, _, w, _, _, m in rules if m == "contains" and key(w) in key(v)}
    assert {(r.value, r.rule_id) for r in run("rule_match_exact_all")} == exact and len(exact) == 4
    assert {(r.value, r.rule_id) for r in run("rule_match_scan_all")} == scan and len(scan) == 2
    assert {(r.value, r.rule_id) for r in run("rule_match_all")} == exact | {x for x in scan if x[0] not in dict(exact)}
    got = {(r.source_value, r.scheme): (r.row_count, r.notes) for r in run("worklist_refresh_all")}
    want = {(v, s): (1, None) for v in seen for s in ("psic", "pcpc", "pscc")}
    want |= {(v, "psic"): (int(v in seen), f"note {i}") for i, _, v, *_ in rules if v}
    assert got == want


SCAN_RULES = [
    ("contains", v) for v in ("bread house of manila", "BREAD", "ead", "a b", "", None, "Öl", "house of", "zzzz", "Straße")
] + [
    ("regex", v) for v in (r"\bbread\w*\s+house\b", r"bread|cake", r"(cake|tart)s?", r"cak+e", r"^öl", r"^Öl$", r"br.{2}d", r"[bc]read house", r"purée\w*", r"\d+", r"a\.b", "", r"hous?e of", r"tart.*?shop", r"breads*", r"of manil", r"STRASSE", r"ſhop", "K")
]
SCAN_LABELS = ["Bread House of Manila", "The bread house of manila 2", "breads  House", "bred", "CAKE", "caKKe shop", "tart and cake shop", "öl", "ÖL", "Öl 24", "Purée bar", "PURÉE bar", "a.b", "a-b", "a  b", "hose of x", "straße", "STRASSE", "n/a", "shop", "ſhop", "K", "k"]


def _scan_case(spark):
    rows = [entry(3 * i + j, "fsq", v, "SUBTREE" if i % 3 else "EXACT", "101" if i % 2 else "20", m, version=w) for i, (m, v) in enumerate(SCAN_RULES) for j, w in enumerate(("rev5", "rev4", None))]
    rows += [entry(10_000 + i, "fsq", r"\bbread\w*\s+house\b", "EXACT", "20", "regex", version=f"v{i % 7}") for i in range(1200)]  # one text, many rules
    rows += [entry(20_000, "fsq", "CAKE", "EXACT", "10"), entry(20_001, "fsq", "cake", "EXACT", "20"), entry(20_002, "fsq", "a.b", "EXACT", "10", version=None), entry(20_003, "osm", "bread", "EXACT", "10", "contains")]
    labels = spark.createDataFrame([("fsq", "category", v) for v in SCAN_LABELS], "source string, field string, value string")
    return labels, ru.prepared(spark.createDataFrame(rows, ENTRY))


def _every_pair(labels, rules):
    """Label and rule pairs tried one by one."""
    x = labels.withColumn("clean", tx.clean_text(F.col("value"))).where("clean is not null").withColumn("k", tx.observed_key(F.col("value")))
    r = rules.where("match_type <> 'exact'").select("scheme", "version", "rule_id", "source", "field", "match_type", "key", F.col("value").alias("pattern"))
    hit = F.when(F.col("match_type") == "contains", F.contains("k", "key")).otherwise(F.rlike("clean", F.concat(F.lit("(?i)"), "pattern")))
    return {(p.value, p.version, p.rule_id) for p in x.join(r, ["source", "field"]).where(hit).collect()}


def _joins_by_bucket(df):
    """Whether labels and rules meet by source and field alone, which are a few tasks."""
    import re

    return re.search(r"Join \[source#\d+L?, field#\d+L?\], \[source", df._jdf.queryExecution().executedPlan().toString()) is not None


def test_every_label_decided_like_pair_by_pair(spark):
    labels, rules = _scan_case(spark)
    pairs, info = _every_pair(labels, rules), {r.rule_id: (r.signature, len(r.value or "")) for r in rules.collect()}
    exact = {(r.value, r.version): r.rule_id for r in ru.match_exact(labels, rules).collect()}
    want = {(v, w, i, False) for (v, w), i in exact.items()}
    for v, w in {(v, w) for v, w, _ in pairs if w is None or (v, w) not in exact}:
        ids = [i for a, b, i in pairs if (a, b) == (v, w)]
        ambiguous = len({info[i][0] for i in ids}) > 1
        want.add((v, w, None if ambiguous else max(ids, key=lambda i: (info[i][1], -i)), ambiguous))
    df = ru.match(labels, rules)
    got = [(r.value, r.version, r.rule_id, r.ambiguous) for r in df.collect()]
    assert set(got) == want and len(got) == len(want) and ("a.b", None) in exact
    assert not _joins_by_bucket(df)


def test_labels_of_places(spark):
    from arbora.operators import evidence as ev

    cells = [" Bakery ", "Bakery", "n/a", None, "ﬁne", "fine", "OTHERS", ""]
    places = spark.createDataFrame([(i, a, b, *[None] * 9) for i, (a, b) in enumerate(zip(cells, cells[1:]))], PLACE)
    rows = [tuple(r) for r in ev.labels(places).collect()]
    assert sorted(rows) == sorted(set(map(tuple, ev.evidence(places).select("source", "field", "value").collect()))) and len(rows) == 4


def test_every_rule_of_a_label_found_like_pair_by_pair(spark):
    labels, rules = _scan_case(spark)
    df = ru.scan_hits(labels, rules)
    got = [(r.value, r.version, r.rule_id) for r in df.collect()]
    assert set(got) == _every_pair(labels, rules) and len(got) == len(set(got)) > 3600
    assert not _joins_by_bucket(df)


@pytest.mark.parametrize("name", ["rule_match", "rule_match_scan"])
def test_comparisons_meet_by_text(spark, tmp_path, name):
    from arbora.plans.catalog import QUERIES

    rows = [entry(1, "fsq", "bread", "EXACT", "10", "contains"), entry(2, "fsq", r"\bbread\w*", "EXACT", "10", "regex"), entry(3, "fsq", "ad", "EXACT", "10", "contains"), entry(4, "fsq", "öl", "EXACT", "10", "contains")]
    spark.createDataFrame(rows, ENTRY).write.parquet(f"{tmp_path}/crosswalk_entries.parquet")
    spark.createDataFrame([(i, v, *[None] * 10) for i, v in enumerate(["Breads", "bad öl", "Adze"])], PLACE).write.parquet(f"{tmp_path}/places.parquet")
    df = QUERIES[name](spark, str(tmp_path))
    want = {("Breads", 2), ("Adze", 3)} | ({("Breads", 1), ("Breads", 3)} if name == "rule_match_scan" else set())
    assert {(r.value, r.rule_id) for r in df.collect()} == want
    assert not _joins_by_bucket(df)
