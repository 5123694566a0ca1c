"""Predicted codes against gold codes at every depth of a tree."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arbora.operators.tree import SCOPE, common_prefix


def judged(pairs: DataFrame, tree: DataFrame) -> DataFrame:
    """pairs (id, scheme, version, code, gold) with known gold -> + paths, relation, distance.

    relation: exact, ancestor_backoff, over_specific, wrong_branch, missing or invalid."""
    g = tree.select(*SCOPE, F.col("code").alias("gold"), F.col("path").alias("gp"))
    p = tree.select(*SCOPE, "code", F.col("path").alias("pp"))
    x = pairs.join(g, [*SCOPE, "gold"]).join(p, [*SCOPE, "code"], "left")
    shared = F.size(common_prefix(F.col("gp"), F.col("pp")))
    r = (
        F.when(F.col("code").isNull(), "missing")
        .when(F.col("pp").isNull(), "invalid")
        .when(F.col("code") == F.col("gold"), "exact")
        .when(shared == F.size("pp"), "ancestor_backoff")
        .when(shared == F.size("gp"), "over_specific")
        .otherwise("wrong_branch")
    )
    return x.withColumn("relation", r).withColumn("distance", F.when(F.col("pp").isNotNull(), F.size("gp") + F.size("pp") - 2 * shared))


def relations(j: DataFrame) -> DataFrame:
    return j.groupBy(*SCOPE, "relation").agg(F.count("*").alias("n"))


def by_depth(j: DataFrame) -> DataFrame:
    """(scheme, version, depth, eligible_gold, produced, production_rate, accuracy, kappa).

    Kappa compares agreement with what the label shares at that depth would give by chance; null unless
    there are two labels or more."""
    x = j.select(*SCOPE, "gp", "pp", F.explode(F.sequence(F.lit(1), F.size("gp"))).alias("depth"))
    x = x.select(*SCOPE, "depth", F.get("gp", F.col("depth") - 1).alias("y"), F.get("pp", F.col("depth") - 1).alias("p"))
    key = [*SCOPE, "depth"]
    cells = x.groupBy(*key, "y", "p").agg(F.count("*").alias("n"))
    base = cells.groupBy(*key).agg(F.sum("n").alias("eligible_gold"), F.sum(F.when(F.col("p").isNotNull(), F.col("n")).otherwise(0)).alias("produced"), F.sum(F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0)).alias("hits"))
    both = cells.where("p is not null")
    ys = both.groupBy(*key, F.col("y").alias("label")).agg(F.sum("n").alias("ny"))
    ps = both.groupBy(*key, F.col("p").alias("label")).agg(F.sum("n").alias("np"))
    chance = ys.join(ps, [*key, "label"], "full").groupBy(*key).agg(F.sum(F.coalesce(F.col("ny") * F.col("np"), F.lit(0))).alias("chance"), F.count("*").alias("labels"))
    y = base.join(chance, key, "left")
    po, pe = F.col("hits") / F.col("produced"), F.col("chance") / (F.col("produced") * F.col("produced"))
    return y.select(*key, "eligible_gold", "produced", F.round(F.col("produced") / F.col("eligible_gold"), 6).alias("production_rate"), F.round(F.when(F.col("produced") > 0, F.try_divide("hits", "produced")), 6).alias("accuracy"), F.round(F.when((F.col("labels") > 1) & (F.col("produced") > 0), F.try_divide(po - pe, 1 - pe)), 6).alias("kappa"))


def summary(j: DataFrame) -> DataFrame:
    """(scheme, version, n, coverage, exact_accuracy, hierarchy_compatible, mean_distance)."""
    ok = F.col("relation").isin("exact", "ancestor_backoff", "over_specific")
    mean = lambda c: F.round(F.avg(c.cast("double")), 6)
    return j.groupBy(*SCOPE).agg(F.count("*").alias("n"), mean(F.col("pp").isNotNull()).alias("coverage"), mean(F.col("relation") == "exact").alias("exact_accuracy"), mean(ok).alias("hierarchy_compatible"), F.round(F.avg("distance"), 6).alias("mean_distance"))
