"""Evidence of one place and release fused to the deepest defensible code.

Places with the same sequence of decisions and dependencies share a result, so the fold below runs once
per distinct sequence. A root is its path from the top, subtrees meet by comparing paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arbora.operators.packed import let
from arbora.operators.tree import intersect_subtrees, lca, normalize_roots

_PATHS = "array<array<string>>"


def _within(items: Column) -> Column:
    """struct(roots, clash) of one dependency group, folded in order: where nothing is left of the
    intersection, the union goes on and the clash is kept."""
    sets = F.filter(F.transform(items, lambda i: i["roots"]), lambda r: F.size(r) > 0)
    start = F.struct(F.coalesce(F.get(sets, 0), F.array().cast(_PATHS)).alias("roots"), F.lit(False).alias("clash"))

    def step(acc: Column, r: Column) -> Column:
        return let(intersect_subtrees(acc["roots"], r), lambda both: F.when(F.size(both) > 0, F.struct(both.alias("roots"), acc["clash"].alias("clash"))).otherwise(F.struct(normalize_roots(F.array_union(acc["roots"], r)).alias("roots"), F.lit(True).alias("clash"))))

    return F.aggregate(F.slice(sets, 2, F.greatest(F.size(sets) - 1, F.lit(0))), start, step)


def _across(groups: Column) -> Column:
    """struct(roots, conflict): the groups' roots intersected; nothing left is a conflict."""
    start = F.struct(F.get(groups, 0).alias("roots"), F.lit(False).alias("conflict"))

    def step(acc: Column, r: Column) -> Column:
        return let(intersect_subtrees(acc["roots"], r), lambda both: F.struct(F.when(acc["conflict"] | (F.size(both) == 0), acc["roots"]).otherwise(both).alias("roots"), (acc["conflict"] | (F.size(both) == 0)).alias("conflict")))

    return F.aggregate(F.slice(groups, 2, F.greatest(F.size(groups) - 1, F.lit(0))), start, step)


def sibling_parent(groups: Column) -> Column:
    """The common parent of independent siblings, if that is all the disagreement: every group has one
    root, two or more are deepest and share a parent below the top, the others lie on the way to it."""
    one = F.forall(groups, lambda g: F.size(g) == 1)
    paths = F.array_distinct(F.transform(groups, lambda g: F.get(g, 0)))
    deepest = F.array_max(F.transform(paths, F.size))
    low = F.filter(paths, lambda p: F.size(p) == deepest)
    parents = F.array_distinct(F.transform(low, lambda p: F.slice(p, 1, F.greatest(F.size(p) - 1, F.lit(0)))))
    up = F.get(parents, 0)
    others = F.forall(paths, lambda p: (F.size(p) == deepest) | (F.slice(up, 1, F.size(p)) == p))
    return F.when((F.size(groups) >= 2) & one & (F.size(low) >= 2) & (F.size(parents) == 1) & (F.size(up) >= 2) & others, F.element_at(up, -1))


def fuse(sequences: DataFrame) -> DataFrame:
    """(scheme, items) -> + fusion struct(status, code, candidate_codes, evidence_sources,
    independent_groups, flags). items: array of struct(source, dep_group, kind, codes, roots, rep_path) in order,
    coded ones only. EMPTY for none."""
    items = F.col("items")
    x = sequences.withColumn("_names", F.array_distinct(F.transform(items, lambda i: i["dep_group"])))
    x = x.withColumn("_each", F.transform("_names", lambda g: F.struct(g.alias("g"), _within(F.filter(items, lambda i: i["dep_group"] == g)).alias("r"))))
    x = x.withColumn("_groups", F.filter(F.transform("_each", lambda e: e["r"]["roots"]), lambda r: F.size(r) > 0))
    x = x.withColumn("_clashes", F.transform(F.filter("_each", lambda e: e["r"]["clash"]), lambda e: F.concat(F.lit("DEPENDENT_CONFLICT:"), e["g"])))
    x = x.withColumn("_sibling", F.when(F.col("scheme") == "psic", sibling_parent(F.col("_groups")))).withColumn("_left", F.when(F.size("_groups") > 0, _across(F.col("_groups"))))
    x = x.withColumn("_code", F.when(~F.col("_left.conflict"), lca(F.col("_left.roots"))))
    codes = F.array_sort(F.array_distinct(F.flatten(F.transform(items, lambda i: i["codes"]))))
    by_depth = F.transform(F.array_sort(F.array_distinct(F.transform(F.flatten(F.transform(items, lambda i: i["roots"])), lambda p: F.struct(F.size(p).alias("d"), F.element_at(p, -1).alias("c"))))), lambda s: s["c"])
    by_depth = F.array_union(by_depth, codes)  # codes dropped under a root of their own rule come last
    reps = F.filter(F.transform(items, lambda i: i["rep_path"]), lambda p: F.size(p) > 0)
    ordered = F.array_sort(F.transform(reps, lambda p: F.struct(F.size(p).alias("d"), p.alias("p"))))
    chain = lambda o: F.forall(F.sequence(F.lit(0), F.greatest(F.size(o) - 2, F.lit(0))), lambda i: (F.size(o) < 2) | (F.slice(F.get(o, i + 1)["p"], 1, F.get(o, i)["d"]) == F.get(o, i)["p"]))
    nested = let(ordered, lambda o: (F.size(o) > 0) & chain(o) & (F.size(F.array_distinct(F.transform(o, lambda s: s["d"]))) > 1))
    status = (
        F.when(F.size("_groups") == 0, "EMPTY")
        .when(F.col("_sibling").isNotNull(), "INTERSECT")
        .when(F.col("_left.conflict"), "CONFLICT")
        .when(F.col("_code").isNull(), "UNION")
        .when(F.size(items) == 1, F.when(F.get(items, 0)["kind"] == "UNION", "UNION").otherwise("SINGLE"))
        .otherwise(F.when(nested, "NESTED").otherwise("INTERSECT"))
    )
    x = x.withColumn("_status", status)
    fused = F.struct(
        F.col("_status").alias("status"), F.coalesce("_sibling", "_code").alias("code"),
        F.when(F.col("_sibling").isNotNull() | (F.col("_status") == "CONFLICT"), by_depth).otherwise(codes).alias("candidate_codes"),
        F.array_distinct(F.transform(items, lambda i: i["source"])).alias("evidence_sources"), F.size("_names").alias("independent_groups"),
        F.concat("_clashes", F.when(F.col("_sibling").isNotNull(), F.array(F.lit("INDEPENDENT_SIBLING_BACKOFF"))).when((F.col("_status") == "UNION") & F.col("_code").isNull(), F.array(F.lit("NO_COMMON_ANCESTOR"))).otherwise(F.array().cast("array<string>"))).alias("flags"),
    )
    return x.withColumn("fusion", fused).drop(*[c for c in x.columns if c.startswith("_")])
