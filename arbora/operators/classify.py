"""Places to codes: rules matched once per distinct label, decisions fused once per distinct sequence,
and the first step that applies gives a place its result in each scheme."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arbora.functions.text import clean_text
from arbora.operators import evidence as ev
from arbora.operators import rules as ru
from arbora.operators.fusion import fuse
from arbora.operators.tree import SCOPE, dims, intersect_subtrees

_CODED = list(ru.CODED)
_NONE = "array<string>"


def mapped_evidence(places: DataFrame, rules: DataFrame, releases: dict[str, str], key: str = "place_row") -> DataFrame:
    """(key, scheme, version, items, ambiguous): the decisions on each place's labels in order, after
    name rules have overruled categories they contradict.

    items: array of struct(source_ord, field_ord, source, dep_group, kind, codes, roots, rep_path)."""
    e = ev.evidence(places, key)
    labels = e.select("source", "field", "value").distinct()
    chosen = rules.where(F.concat_ws(":", *SCOPE).isin([f"{s}:{v}" for s, v in releases.items()]))
    hits = ru.match(labels, chosen).join(chosen.select("rule_id", "kind", "codes", "roots", "rep_path"), "rule_id", "left")
    x = e.join(hits, ["source", "field", "value"])
    item = F.struct("source_ord", "field_ord", "source", "dep_group", "kind", "codes", "roots", "rep_path", F.col("rule_id").alias("rule_id"))
    x = x.groupBy(key, *SCOPE).agg(F.array_sort(F.collect_list(F.when(F.col("kind").isNotNull(), item))).alias("items"), F.array_sort(F.collect_set(F.when(F.col("ambiguous"), F.col("source")))).alias("ambiguous"))
    # the same rule under both fields of a source counts once
    once = F.filter("items", lambda i: ~F.exists("items", lambda o: (o["source"] == i["source"]) & (o["rule_id"] == i["rule_id"]) & (o["field_ord"] < i["field_ord"])))
    x = x.withColumn("items", once)
    overruled = F.array_compact(F.transform(F.array(*map(F.lit, ev.SOURCES)), lambda s: F.when(F.exists("items", lambda c: (c["source"] == s) & (c["field_ord"] == 0) & F.exists("items", lambda n: (n["source"] == s) & (n["field_ord"] == 1) & _overrules(n, c))), s)))
    x = x.withColumn("overruled", overruled)
    return x.withColumn("items", F.filter("items", lambda i: (i["field_ord"] == 1) | ~F.array_contains("overruled", i["source"])))


def _overrules(name: Column, category: Column) -> Column:
    """Whether a name rule stands alone: it and the category disagree on activity, or have no subtree in common."""
    coded = lambda i: i["kind"].isin(_CODED)
    idle = lambda i: i["kind"] == "NOT_ACTIVITY"
    apart = (F.size(name["roots"]) > 0) & (F.size(category["roots"]) > 0) & (F.size(intersect_subtrees(category["roots"], name["roots"])) == 0)
    return (idle(name) & coded(category)) | (coded(name) & idle(category)) | apart


def eligibility(items: Column) -> Column:
    has = lambda kinds: F.exists(items, lambda i: i["kind"].isin(*kinds))
    informative = F.filter(items, lambda i: i["kind"] != "UNCODEABLE")
    return F.when(has(_CODED), "ELIGIBLE").when(F.size(informative) > 0, "NOT_ACTIVITY").otherwise("UNCERTAIN")


def activity_conflict(items: Column) -> Column:
    """Independent groups that disagree on whether there is an activity at all."""
    return F.exists(items, lambda a: a["kind"].isin(_CODED) & F.exists(items, lambda b: (b["kind"] == "NOT_ACTIVITY") & (a["dep_group"] != b["dep_group"])))


def classify(places: DataFrame, rules: DataFrame, tree: DataFrame, releases: dict[str, str] | None = None, key: str = "place_row", product: str | None = "product_text") -> DataFrame:
    """One row per place and scheme: key, scheme, version, code, level, status, deciding_component,
    candidate_codes, evidence_sources, flags, classification_depth, branch_max_depth, max_depth."""
    releases = releases or ev.DEFAULT_RELEASES
    m = mapped_evidence(places, rules, releases, key)
    m = m.withColumn("coded", F.transform(F.filter("items", lambda i: i["kind"].isin(_CODED)), lambda i: F.struct(i["source"].alias("source"), i["dep_group"].alias("dep_group"), i["kind"].alias("kind"), i["codes"].alias("codes"), i["roots"].alias("roots"), i["rep_path"].alias("rep_path"), i["rule_id"].alias("rule_id"))))
    m = m.withColumn("sequence", F.xxhash64("scheme", F.to_json(F.transform("coded", lambda i: F.struct(i["source"].alias("s"), i["dep_group"].alias("g"), i["rule_id"].alias("r"))))))
    fused = fuse(m.groupBy("scheme", "sequence").agg(F.first("coded").alias("items"))).select("scheme", "sequence", "fusion")
    text = clean_text(F.col(product)) if product and product in places.columns else F.lit(None).cast("string")
    # each place once per scheme; the few schemes are unrolled, not joined
    every = places.select(key, ev.suspicion(places).alias("suspect"), text.alias("product"), F.explode(F.array(*[F.struct(F.lit(s).alias("scheme"), F.lit(v).alias("version")) for s, v in releases.items()])).alias("x")).select(key, "suspect", "product", "x.*")
    x = every.join(m.join(fused, ["scheme", "sequence"]), [key, *SCOPE], "left")
    empty = F.array().cast(_NONE)
    items = F.coalesce(F.col("items"), F.filter("items", lambda i: F.lit(False)))
    x = x.withColumn("e_flags", F.concat(F.transform(F.coalesce("ambiguous", empty), lambda s: F.concat(F.lit("CROSSWALK_AMBIGUOUS:"), s)), F.when(F.size(F.coalesce("overruled", empty)) > 0, F.array(F.lit("CROSSWALK_NAME_RULE_OVERRODE_CATEGORY"))).otherwise(empty)))
    f = lambda c: F.col(f"fusion.{c}")
    status, code = F.coalesce(f("status"), F.lit("EMPTY")), f("code")
    clash = (F.col("scheme") == "psic") & F.coalesce(activity_conflict(items), F.lit(False))
    idle = (F.col("scheme") == "psic") & F.coalesce(eligibility(items) == "NOT_ACTIVITY", F.lit(False))
    doubt = (status == "CONFLICT") & (F.size("suspect") > 0)
    solved = code.isNotNull() & status.isin("SINGLE", "NESTED", "INTERSECT")
    no_product = (F.col("scheme") == "pscc") & F.col("product").isNull() & (status == "EMPTY")
    step = F.when(clash, 1).when(idle, 2).when(doubt, 3).when(solved, 4).when(no_product, 5).otherwise(6)
    x = x.withColumn("step", step)
    is_step = lambda *n: F.col("step").isin(*n)
    x = x.withColumn("code", F.when(is_step(4, 6), code))
    d = dims(tree).join(tree.select(*SCOPE, "code", "level"), [*SCOPE, "code"]).select(*SCOPE, "code", "level", "n_children", F.col("depth").alias("classification_depth"), "branch_max_depth")
    deep = tree.groupBy(*SCOPE).agg(F.max("depth").alias("max_depth"))
    x = x.join(d, [*SCOPE, "code"], "left").join(deep, SCOPE, "left")
    base = F.when(is_step(1), F.when(F.size("suspect") > 0, "REVIEW_ENTITY_MATCH").otherwise("CONFLICT")).when(is_step(2), "NOT_PSIC_ACTIVITY").when(is_step(3), "REVIEW_ENTITY_MATCH").when(is_step(5), "NO_PRODUCT_EVIDENCE").otherwise(status)
    family = (F.col("scheme") == "pcpc") & F.col("code").isNotNull()
    out = F.when(family, F.when(F.col("n_children") > 0, "POTENTIAL_PRODUCT_FAMILY_PARTIAL").otherwise("POTENTIAL_PRODUCT_FAMILY_FULL")).otherwise(base)
    sources = F.when(is_step(1, 2), F.transform(items, lambda i: i["source"])).otherwise(f("evidence_sources"))
    ff = F.coalesce(f("flags"), empty)
    own = (
        F.when(is_step(1), F.concat(ff, "suspect", F.array(F.lit("ACTIVITY_NON_ACTIVITY_CONFLICT"))))
        .when(is_step(2), empty)
        .when(is_step(3), F.concat(ff, "suspect"))
        .when(is_step(4), ff)
        .when(is_step(5), F.array(F.lit("PSCC_REQUIRES_PRODUCT_EVIDENCE")))
        .otherwise(F.concat(ff, F.when(status.isin("EMPTY", "CONFLICT", "UNION"), F.array(F.lit("LLM_NOT_CONFIGURED"))).otherwise(empty)))
    )
    return x.select(
        key, *SCOPE, "code", "level", out.alias("status"), F.when(is_step(2), "CROSSWALK").when(is_step(5), "POLICY").otherwise("FUSION").alias("deciding_component"),
        F.when(is_step(2, 5), empty).otherwise(F.coalesce(f("candidate_codes"), empty)).alias("candidate_codes"), F.when(is_step(5), empty).otherwise(F.coalesce(sources, empty)).alias("evidence_sources"),
        F.concat("e_flags", own).alias("flags"), "classification_depth", "branch_max_depth", "max_depth",
    )


def stored(facts: DataFrame) -> DataFrame:
    """Facts as they are written: lists as compact JSON."""
    return facts.withColumns({c: F.to_json(c) for c, t in facts.dtypes if t.startswith("array")})


def summary(places: DataFrame, facts: DataFrame, schemes: list[str], key: str = "place_row") -> DataFrame:
    """places + {scheme}_code, {scheme}_level, {scheme}_status: one aggregation for all schemes, joined once."""
    wide = facts.groupBy(key).agg(*[F.max(F.when(F.col("scheme") == s, F.col(c))).alias(f"{s}_{c}") for s in schemes for c in ("code", "level", "status")])
    return places.join(wide, key, "left")
