"""Trees of codes: one prepared table, from which closure, depth, ancestors and distances follow.

``prepare`` resolves every node's path once by doubling pointers; the path array (root first) then
answers ancestor questions row by row: the lowest common ancestor of two nodes of a tree is the end of
the common prefix of their paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arbora.functions.text import level_rank
from arbora.operators.hierarchy import hierarchy
from arbora.util import Stage

SCOPE = ["scheme", "version"]
_SEP = "\x1f"


def one_per_code(nodes: DataFrame) -> DataFrame:
    """The first delivered row of each (scheme, version, code)."""
    cols = [c for c in ("level", "title", "description", "includes", "excludes", "source_url") if c in nodes.columns]
    return nodes.where(F.col("code").isNotNull()).groupBy(*SCOPE, "code").agg(*[F.min_by(c, "node_id").alias(c) for c in cols])


def prepare(nodes: DataFrame) -> DataFrame:
    """Every node whose parents end: scheme, version, code, parent, root, depth, path (array, root first),
    pre, last, level, title, includes, description."""
    h = hierarchy(nodes, SCOPE, sep=_SEP).withColumn("path", F.split("path", _SEP))
    return Stage(h.join(one_per_code(nodes), [*SCOPE, "code"])).df


def closure(tree: DataFrame) -> DataFrame:
    """(scheme, version, code, ancestor, hops), itself included."""
    x = tree.select(*SCOPE, "code", "depth", F.posexplode("path").alias("i", "ancestor"))
    return x.select(*SCOPE, "code", "ancestor", (F.col("depth") - F.col("i") - 1).alias("hops"))


def dims(tree: DataFrame) -> DataFrame:
    """Per node: depth, number of children and leaves, the deepest depth and the leaf test of its branch."""
    kids = tree.groupBy(*SCOPE, F.col("parent").alias("code")).agg(F.count("*").alias("n_children"))
    x = tree.join(kids, [*SCOPE, "code"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    below = x.select(*SCOPE, F.explode("path").alias("code"), "depth", (F.col("n_children") == 0).cast("int").alias("leaf"))
    below = below.groupBy(*SCOPE, "code").agg(F.max("depth").alias("branch_max_depth"), F.sum("leaf").alias("n_leaves"))
    return x.join(below, [*SCOPE, "code"]).select(*SCOPE, "code", "parent", "root", "depth", "n_children", (F.col("n_children") == 0).alias("is_leaf"), "branch_max_depth", "n_leaves")


def leaves(tree: DataFrame) -> DataFrame:
    """(scheme, version, code, leaf) for every node."""
    inner = tree.select(*SCOPE, F.col("parent").alias("leaf")).distinct()
    return closure(tree.join(inner.withColumnRenamed("leaf", "code"), [*SCOPE, "code"], "left_anti")).select(*SCOPE, F.col("ancestor").alias("code"), F.col("code").alias("leaf"))


def common_prefix(a: Column, b: Column) -> Column:
    """Of two root paths; the paths of one tree have their common nodes at their heads."""
    return F.array_intersect(a, b)


def common_path(paths: Column) -> Column:
    """From the root to the lowest common ancestor-or-self; empty across roots, null for none."""
    return F.aggregate(F.slice(paths, 2, F.greatest(F.size(paths) - 1, F.lit(0))), F.get(paths, 0), common_prefix)


def lca(paths: Column) -> Column:
    """Lowest common ancestor-or-self of an array of root paths; null for none or across roots."""
    return F.try_element_at(common_path(paths), F.lit(-1))


def with_paths(sets: DataFrame, tree: DataFrame, key: list[str], code: str = "code") -> DataFrame:
    """(key, scheme, version, paths): the known codes of each set with their paths; sets without any are gone."""
    t = tree.select(*SCOPE, F.col("code").alias(code), "path")
    return sets.join(t, [*SCOPE, code]).groupBy(*key, *SCOPE).agg(F.array_sort(F.collect_set("path")).alias("paths"))


def distance(pairs: DataFrame, tree: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """pairs + distance: depths less twice that of the common ancestor, which counts 0 across roots;
    null where a code is unknown."""
    left = tree.select(*SCOPE, F.col("code").alias(a), F.col("path").alias("_pa"))
    right = tree.select(*SCOPE, F.col("code").alias(b), F.col("path").alias("_pb"))
    x = pairs.join(left, [*SCOPE, a], "left").join(right, [*SCOPE, b], "left")
    d = F.size("_pa") + F.size("_pb") - 2 * F.size(common_prefix(F.col("_pa"), F.col("_pb")))
    return x.withColumn("distance", F.when(F.col("_pa").isNotNull() & F.col("_pb").isNotNull(), d)).drop("_pa", "_pb")


def findings(nodes: DataFrame) -> DataFrame:
    """(scheme, version, code, finding), the first that holds of: top_level_with_parent, orphan,
    parent_not_shallower, prefix_violation, level_gap. Levels the scheme doesn't have are passed over."""
    n = one_per_code(nodes).join(nodes.where("code is not null").groupBy(*SCOPE, "code").agg(F.max(F.nullif(F.trim("parent_code"), F.lit(""))).alias("pc")), [*SCOPE, "code"])
    p = n.select(*SCOPE, F.col("code").alias("pc"), F.col("level").alias("pl"))
    x = n.join(p.withColumn("there", F.lit(True)), [*SCOPE, "pc"], "left")
    r, q = level_rank(F.col("scheme"), F.col("level")), level_rank(F.col("scheme"), F.col("pl"))
    digits = F.col("code").rlike("^[0-9]+$") & F.col("pc").rlike("^[0-9]+$")
    f = (
        F.when(r.isNull(), None)
        .when((r == 0) & F.col("pc").isNotNull(), "top_level_with_parent")
        .when((r > 0) & F.col("there").isNull(), "orphan")
        .when(q.isNull(), None)
        .when(q >= r, "parent_not_shallower")
        .when(digits & ~F.col("code").startswith(F.col("pc")), "prefix_violation")
        .when(r - q > 1, "level_gap")
    )
    return x.select(*SCOPE, "code", f.alias("finding")).where("finding is not null")


def histogram(nodes: DataFrame) -> DataFrame:
    return one_per_code(nodes).groupBy(*SCOPE, F.lower("level").alias("level")).agg(F.count("*").alias("n"))


def fingerprint(nodes: DataFrame) -> DataFrame:
    """(scheme, version, fingerprint): one hash per release that doesn't depend on order or partitions;
    rows are hashed apart and added, so no release is gathered in one place."""
    row = F.sha2(F.concat_ws("\x1f", "code", F.coalesce("level", F.lit("")), F.coalesce("title", F.lit(""))), 256)
    parts = [F.conv(F.substring(row, 1 + 12 * i, 12), 16, 10).cast("decimal(38,0)") for i in range(4)]
    x = one_per_code(nodes).select(*SCOPE, *[p.alias(f"h{i}") for i, p in enumerate(parts)])
    return x.groupBy(*SCOPE).agg(F.count("*").alias("n"), *[F.sum(f"h{i}").alias(f"h{i}") for i in range(4)]).select(*SCOPE, F.sha2(F.concat_ws("-", "n", "h0", "h1", "h2", "h3"), 256).alias("fingerprint"))


def rendered_path(tree: DataFrame) -> DataFrame:
    """(scheme, version, code, text): level:code title, from the root down, joined by ' > '."""
    label = F.concat(F.coalesce("level", F.lit("")), F.lit(":"), F.col("code"), F.lit(" "), F.coalesce("title", F.lit("")))
    names = tree.select(*SCOPE, F.col("code").alias("ancestor"), label.alias("label"))
    x = tree.select(*SCOPE, "code", F.posexplode("path").alias("i", "ancestor")).join(names, [*SCOPE, "ancestor"])
    x = x.groupBy(*SCOPE, "code").agg(F.array_sort(F.collect_list(F.struct("i", "label"))).alias("p"))
    return x.select(*SCOPE, "code", F.array_join("p.label", " > ").alias("text"))


def ancestor_columns(coded: DataFrame, tree: DataFrame, scheme: str, levels: tuple[str, ...]) -> DataFrame:
    """coded (scheme, version, code, ...) + one column per level with the ancestor-or-self code there."""
    lv = tree.select(*SCOPE, F.col("code").alias("ancestor"), F.lower("level").alias("lv")).where(F.col("scheme") == scheme)
    x = closure(tree.where(F.col("scheme") == scheme)).join(lv, [*SCOPE, "ancestor"])
    wide = x.groupBy(*SCOPE, "code").pivot("lv", list(levels)).agg(F.min_by("ancestor", "hops"))
    return coded.join(wide.select(*SCOPE, "code", *[F.col(v).alias(f"{scheme}_{v}") for v in levels]), [*SCOPE, "code"], "left")


def normalize_roots(paths: Column) -> Column:
    """The paths of an array that have no other path of it above them."""
    return F.filter(paths, lambda p: ~F.exists(paths, lambda q: (F.size(q) < F.size(p)) & (F.element_at(q, -1) == F.get(p, F.size(q) - 1))))


def intersect_subtrees(a: Column, b: Column) -> Column:
    """Deeper of each nested pair of paths; the union of subtrees of a met with that of b."""
    under = lambda p, q: (F.size(q) <= F.size(p)) & (F.element_at(q, -1) == F.get(p, F.size(q) - 1))
    both = F.array_union(F.filter(a, lambda p: F.exists(b, lambda q: under(p, q))), F.filter(b, lambda p: F.exists(a, lambda q: under(p, q))))
    return normalize_roots(both)


