"""Parent-child rows to whole hierarchies with nested-set ranges.

Both passes double pointers, so a forest of depth d takes about log2(d) rounds, each one join and one
partially aggregated sum over the nodes:

* upward: ``size_k(v)`` counts the descendants of v less than 2^k steps below it; the nodes exactly 2^k
  steps below hand theirs up. A node whose pointer runs past a root is processed; when a round
  processes none, what is left never ends: it lies on a cycle or below one.
* downward: a child starts where the subtrees of its preceding siblings end (a prefix sum over blocks
  of siblings, so that no parent with countless children becomes one task), and doubling adds these
  offsets up along the path to the root. ``[pre, last]`` is then the range of a node's descendants.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arbora.util import Stage, blank_to_null, scope_key

#: Blocks of siblings in which prefix sums are taken apart and put together.
SIBLING_BLOCKS = 256


def parent_links(nodes: DataFrame, scope: list[str], code: str, parent: str) -> DataFrame:
    """(_s, scope..., code, ptr): one row per distinct node. Rows without a code are no nodes. Parents
    compare without surrounding white space, blank is none; a parent without a row of its own ends the
    chain. Rows that disagree take the largest parent."""
    one = (
        nodes.where(F.col(code).isNotNull())
        .select(scope_key(scope).alias("_s"), *[F.col(c).alias(f"_k{i}") for i, c in enumerate(scope)], F.col(code).alias("_c"), blank_to_null(F.col(parent)).alias("_p"))
        .groupBy("_s", "_c")
        .agg(*[F.first(f"_k{i}").alias(f"_k{i}") for i in range(len(scope))], F.max("_p").alias("_p"))
    )
    there = one.select(F.col("_s").alias("_ts"), F.trim("_c").alias("_tc"), F.col("_c").alias("_to")).groupBy("_ts", "_tc").agg(F.max("_to").alias("_to"))
    return one.join(there, (one._s == there._ts) & (one._p == there._tc), "left").select("_s", *[f"_k{i}" for i in range(len(scope))], "_c", F.col("_to").alias("_p"))


def _target(state: DataFrame, cols: list[str]) -> DataFrame:
    return state.select(F.col("_s").alias("t_s"), F.col("_c").alias("t_c"), *[F.col(c).alias(f"t{c}") for c in cols])


def _on() -> Column:
    """Where a pointer points. A node without one gets a key that no code has, so that processed nodes
    spread over all tasks of the join."""
    return (F.col("_s") == F.col("t_s")) & (F.coalesce("_ptr", F.concat(F.lit("\x00"), "_c")) == F.col("t_c"))


def _doubled(state: DataFrame, kept: list[str], sums: dict[str, Column]) -> DataFrame:
    """One round: every pointer jumps over the pointer it points at. ``sums`` says how a column joins
    with the target's, which has the prefix ``t_``."""
    moved = F.col("_ptr").isNotNull()
    j = state.join(_target(state, ["_ptr", *sums]), _on(), "left")
    return j.select("_s", "_c", F.col("t_ptr").alias("_ptr"), *kept, *[F.when(moved, e).otherwise(F.col(c)).alias(c) for c, e in sums.items()])


def _upward(links: DataFrame) -> tuple[Stage, int]:
    """(_s, _c, _p, _ptr, _depth, _root, _size) with _ptr null where processed; and how many are not."""
    now = Stage(links.select("_s", "_c", "_p", F.col("_p").alias("_ptr"), F.lit(1).cast("long").alias("_depth"), F.when(F.col("_p").isNull(), F.col("_c")).alias("_root"), F.lit(1).cast("long").alias("_size")))
    left = now.df.where("_ptr is not null").count()
    while left:
        s = now.df
        handed = s.where("_ptr is not null").groupBy(F.col("_s").alias("h_s"), F.col("_ptr").alias("h_c")).agg(F.sum("_size").alias("h_size"))
        sized = s.join(handed, (F.col("_s") == F.col("h_s")) & (F.col("_c") == F.col("h_c")), "left").withColumn("_size", F.col("_size") + F.coalesce("h_size", F.lit(0))).drop("h_s", "h_c", "h_size")
        new = Stage(_doubled_from(sized, s))
        now.drop()
        was, now = left, new
        if (left := now.df.where("_ptr is not null").count()) == was:
            break
    return now, left


def _doubled_from(sized: DataFrame, s: DataFrame) -> DataFrame:
    moved = F.col("_ptr").isNotNull()
    j = sized.join(_target(s, ["_ptr", "_depth", "_root"]), _on(), "left")
    return j.select("_s", "_c", "_p", F.col("t_ptr").alias("_ptr"), F.when(moved, F.col("_depth") + F.col("t_depth")).otherwise(F.col("_depth")).alias("_depth"), F.when(moved, F.col("t_root")).otherwise(F.col("_root")).alias("_root"), "_size")


def _offsets(done: DataFrame) -> DataFrame:
    """+ _off: 1 + the sizes of all preceding siblings, for roots 1. Siblings are ordered by the block
    of their code's hash, then by code; blocks are summed apart, so a hot parent is many small groups."""
    kids = done.where("_p is not null").withColumn("_b", F.pmod(F.xxhash64("_c"), F.lit(SIBLING_BLOCKS)))
    blocks = kids.groupBy("_s", "_p", "_b").agg(F.sum("_size").alias("_in"))
    before = Window.partitionBy("_s", "_p").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_base", F.coalesce(F.sum("_in").over(before), F.lit(0))).drop("_in")
    inner = Window.partitionBy("_s", "_p", "_b").orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    kids = kids.withColumn("_at", F.coalesce(F.sum("_size").over(inner), F.lit(0))).join(blocks, ["_s", "_p", "_b"])
    return kids.select(*done.columns, (F.col("_base") + F.col("_at") + 1).alias("_off")).unionByName(done.where("_p is null").withColumn("_off", F.lit(1).cast("long")))


def _cycles(left: DataFrame, n: int) -> DataFrame:
    """(_s, _c, _cycle) of unprocessed nodes. The pointers have jumped 2^k steps; once their targets
    stay the same set they lie on cycles, and once the smallest code of the 2^k nodes from a node on
    stays the same everywhere it is that of the whole cycle."""
    now = Stage(left.select("_s", "_c", F.col("_p").alias("_ptr"), F.col("_c").alias("_min")))
    images, steps = -1, 1
    while True:
        new = Stage(_doubled(now.df, [], {"_min": F.least("_min", "t_min")}))
        steps *= 2
        old = now.df.select("_s", "_c", F.col("_min").alias("o_min"))
        changed = new.df.join(old, ["_s", "_c"]).where(F.col("_min") != F.col("o_min")).limit(1).count()
        now.drop()
        was, now, images = images, new, new.df.select("_s", "_ptr").distinct().count()
        if (not changed and images == was) or steps > 2 * n:
            break
    on = now.df.select("_s", F.col("_c").alias("_ptr"), F.col("_min").alias("_cycle"))
    return now.df.select("_s", "_c", "_ptr").join(on, ["_s", "_ptr"]).select("_s", "_c", "_cycle")


def endless(nodes: DataFrame, scope: list[str], code: str = "code", parent: str = "parent_code") -> DataFrame:
    """(scope..., code, cycle_code): the nodes from which the parents run into a cycle, and the smallest
    code on it. Empty tables give no rows."""
    links = Stage(parent_links(nodes, scope, code, parent))
    up, n = _upward(links.df)
    if n == 0:
        return links.df.where("false").select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(scope)], F.col("_c").alias("code"), F.col("_c").alias("cycle_code"))
    left = up.df.where("_ptr is not null").select("_s", "_c", "_p")
    return _cycles(left, n).join(links.df, ["_s", "_c"]).select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(scope)], F.col("_c").alias("code"), F.col("_cycle").alias("cycle_code"))


def hierarchy(nodes: DataFrame, scope: list[str], code: str = "code", parent: str = "parent_code", sep: str = "/") -> DataFrame:
    """(scope..., code, parent, root, depth, path, pre, last, descendants): every node whose parents end.

    pre numbers the nodes of a tree from 1 in preorder; the descendants of a node are those of its root
    with pre in (its pre, its last]. Nodes on or below cycles are given by ``endless``. Nulls in scope
    columns equal each other; rows without a code are left out; repeated rows count once; an empty table
    gives no rows."""
    links = Stage(parent_links(nodes, scope, code, parent))
    up, _ = _upward(links.df)
    done = up.df.where("_ptr is null").select("_s", "_c", "_p", "_depth", "_root", "_size")
    now = Stage(_offsets(done).select("_s", "_c", F.col("_p").alias("_ptr"), F.col("_off").alias("_pre"), F.col("_c").alias("_path")))
    while now.df.where("_ptr is not null").limit(1).count():
        new = Stage(_doubled(now.df, [], {"_pre": F.col("_pre") + F.col("t_pre"), "_path": F.concat("t_path", F.lit(sep), "_path")}))
        now.drop()
        now = new
    out = now.df.join(done, ["_s", "_c"]).join(links.df.drop("_p"), ["_s", "_c"])
    return out.select(
        *[F.col(f"_k{i}").alias(c) for i, c in enumerate(scope)], F.col("_c").alias("code"), F.col("_p").alias("parent"), F.col("_root").alias("root"), F.col("_depth").alias("depth"), F.col("_path").alias("path"),
        # each node on the path adds its offset; a child's range begins right after its parent's own number
        F.col("_pre").alias("pre"), (F.col("_pre") + F.col("_size") - 1).alias("last"), (F.col("_size") - 1).alias("descendants"),
    )


def descendants(h: DataFrame, scope: list[str]) -> DataFrame:
    """(scope..., root, code, descendant, hops) for every node and each node below it, from the ranges.

    A range is cut into at most 2 log2(n) dyadic blocks and a node stands in one block of each size, so
    that containment is an equality of blocks: no comparison of all pairs within a tree. Sizes of blocks
    go as far as the largest range of the tree has bits."""
    keyed = h.withColumn("_s", scope_key(scope))
    lo, hi = F.col("pre") + 1, F.col("last") + 1
    above = keyed.where("descendants > 0")
    # greedy cut of [lo, hi): at most one block up and one down per size
    bits = F.sequence(F.lit(0), F.ceil(F.log2(F.col("last") + 2)).cast("int"))
    up = lambda j: ((lo + F.shiftleft(F.lit(1).cast("long"), 1) * 0 + _pow(j) - 1) / _pow(j)).cast("long")
    down = lambda j: F.floor(hi / _pow(j)).cast("long")
    # block b of size 2^j lies in [lo, hi) iff up(j) <= b < down(j); it is a maximal one iff its parent does not
    inside = lambda j: F.filter(F.array(up(j), down(j) - 1), lambda b: (b >= up(j)) & (b < down(j)) & ~((F.floor(b / 2) >= up(j + 1)) & (F.floor(b / 2) < down(j + 1))))
    blocks = F.flatten(F.transform(bits, lambda j: F.transform(F.array_distinct(inside(j)), lambda b: F.struct(j.alias("j"), b.cast("long").alias("b")))))
    a = above.select("_s", "root", "code", F.col("depth").alias("_d"), F.explode(blocks).alias("x")).select("_s", "root", "code", "_d", "x.j", "x.b")
    top = above.groupBy("_s", "root").agg(F.max(F.ceil(F.log2(F.col("last") + 2)).cast("int")).alias("_top"))
    n = keyed.where("depth > 1").join(top, ["_s", "root"]).select("_s", *scope, "root", F.col("code").alias("descendant"), "depth", "pre", F.explode(F.sequence(F.lit(0), F.col("_top"))).alias("j"))
    n = n.withColumn("b", F.floor(F.col("pre") / _pow(F.col("j"))).cast("long"))
    return n.join(a, ["_s", "root", "j", "b"]).select(*scope, "root", "code", "descendant", (F.col("depth") - F.col("_d")).cast("int").alias("hops"))


def _pow(j: Column) -> Column:
    return F.pow(F.lit(2.0), j).cast("long")
