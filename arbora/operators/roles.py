"""Economic roles of places from role rules and assigned codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arbora.functions.text import split_codes
from arbora.operators import rules as ru
from arbora.operators.evidence import evidence

#: Order of roles. Fixed values.
ROLES = ("PRODUCER", "INTERMEDIATE_DEMAND", "HOUSEHOLD_FINAL_DEMAND_PROXY", "GOVERNMENT_FINAL_DEMAND_PROXY", "NPISH_FINAL_DEMAND_PROXY", "CAPITAL_ASSET", "CONTAINER")
LABEL = ["source", "field", "value"]


def role_rules(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Role rules, the scheme copies of a label merged, and the labels whose copies disagree.

    (rule_id, source, field, value, key, match_type, unit_type, establishment_status, io_roles, confidence)"""
    blank = lambda c: F.nullif(F.upper(F.trim(c)), F.lit(""))
    low = lambda c, d: F.coalesce(F.nullif(F.lower(F.trim(c)), F.lit("")), F.lit(d))
    x = entries.select(
        F.col("entry_id").alias("rule_id"), low("source", "").alias("source"), low("source_field", "category").alias("field"), F.trim("source_value").alias("value"), low("match_type", "exact").alias("match_type"),
        blank("unit_type").alias("unit_type"), blank("establishment_status").alias("establishment_status"), F.when(F.size(split_codes(F.col("io_roles"))) > 0, F.array_join(F.array_sort(split_codes(F.upper("io_roles"))), "|")).alias("io_roles"), "confidence",
    ).where("value <> '' and coalesce(unit_type, establishment_status, io_roles) is not null")
    fields = ["match_type", "unit_type", "establishment_status", "io_roles"]
    one = x.groupBy(*LABEL).agg(F.min("rule_id").alias("rule_id"), F.min("confidence").alias("confidence"), *[F.max(c).alias(c) for c in fields], *[(F.min(c) != F.max(c)).alias(f"{c}_differs") for c in fields])
    differs = F.coalesce(F.greatest(*[F.coalesce(F.col(f"{c}_differs"), F.lit(False)) for c in fields]), F.lit(False))
    one = one.withColumn("differs", differs).drop(*[f"{c}_differs" for c in fields])
    return one.where(~F.col("differs")).drop("differs"), one.where("differs").select(*LABEL)


def role_matches(labels: DataFrame, rules: DataFrame) -> DataFrame:
    """(label, rule_id): an exact rule alone, else every scanned rule that matches."""
    keyed = ru.reviewed_key(F.col("value"))
    r = rules.withColumns({"scheme": F.lit("-"), "version": F.lit("-"), "key": keyed})
    exact = ru.match_exact(labels, r)
    scanned = ru.scan_hits(labels, r).join(exact.select(*LABEL), LABEL, "left_anti")
    return exact.unionByName(scanned).select(*LABEL, "rule_id")


def profiles(places: DataFrame, rules: DataFrame, psic: DataFrame, key: str = "place_row") -> DataFrame:
    """(key, unit_type, establishment_status, io_roles, role_confidence, role_status, role_flags).

    psic: (key, code) of assigned psic codes. Name rules of a source replace its category rules."""
    e = evidence(places, key)
    hits = role_matches(e.select(*LABEL).distinct(), rules).join(rules.select("rule_id", "unit_type", "establishment_status", "io_roles", "confidence"), "rule_id")
    x = e.join(hits, LABEL)
    named = x.groupBy(key, "source").agg(F.max(F.col("field") == "name").alias("by_name"), (F.min("field") != F.max("field")).alias("both"))
    x = x.join(named, [key, "source"]).where((F.col("field") == "name") | ~F.col("by_name"))
    each = x.groupBy(key).agg(
        F.collect_set("unit_type").alias("units"), F.collect_set("establishment_status").alias("states"), F.array_distinct(F.flatten(F.collect_set(F.split("io_roles", r"\|")))).alias("roles"), F.min("confidence").alias("role_confidence"),
        F.collect_set(F.when(F.col("both"), F.concat(F.lit("ROLE_NAME_RULE_PRECEDENCE:"), "source"))).alias("named"), F.count("*").alias("n"),
    )
    y = places.select(key).join(each, key, "left").join(psic.where("code is not null").select(key, F.lit(True).alias("active")), key, "left")
    none = F.array().cast("array<string>")
    arr = lambda c: F.coalesce(c, none)
    active = F.coalesce("active", F.lit(False))
    flag = lambda c, name: F.when(c, F.array(F.lit(name))).otherwise(none)
    clash_u, clash_e = F.size(arr("units")) > 1, F.size(arr("states")) > 1
    have = F.array_union(arr("roles"), F.when(active, F.array(F.lit(ROLES[0]), F.lit(ROLES[1]))).otherwise(none))
    single = lambda c: F.when(F.size(arr(c)) == 1, F.get(c, 0)).otherwise("UNCERTAIN")
    flags: Column = F.concat(arr("named"), flag(clash_u, "ROLE_UNIT_TYPE_CONFLICT"), flag(clash_e, "ROLE_ESTABLISHMENT_STATUS_CONFLICT"), flag(active, "IO_ROLE_FROM_PSIC_ACTIVITY"))
    return y.select(
        key, single("units").alias("unit_type"), single("states").alias("establishment_status"), F.filter(F.array(*map(F.lit, ROLES)), lambda r: F.array_contains(have, r)).alias("io_roles"), "role_confidence",
        F.when(clash_u | clash_e, "REVIEW").when(F.col("n") > 0, "REVIEWED").when(active, "INFERRED_FROM_TAXONOMY").otherwise("UNRESOLVED").alias("role_status"), F.array_sort(F.array_distinct(flags)).alias("role_flags"),
    )


