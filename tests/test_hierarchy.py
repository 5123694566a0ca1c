import random

from pyspark.sql import functions as F

from arbora.operators import hierarchy as h

SCHEMA = "scheme string, version string, code string, parent_code string, root string, _s string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)


def brute(rows):
    parent = {}
    for s, v, c, p in rows:
        if c is not None:
            p = (p or "").strip() or None
            parent[s, v, c] = max(filter(None, [parent.get((s, v, c)), p]), default=None)
    ends, loops = {}, {}
    for k in parent:
        path, x = [], k
        while x in parent and x not in path:
            path.append(x)
            x = (k[0], k[1], parent[x])
        if x in path:
            loops[k] = min(c for _, _, c in path[path.index(x) :])
        else:
            ends[k] = [c for _, _, c in reversed(path)]
    return ends, loops


def check(spark, rows):
    ends, loops = brute(rows)
    df = frame(spark, rows)
    assert {(r[0], r[1], r[2]): r[3] for r in h.endless(df, ["scheme", "version"]).collect()} == loops
    got = h.hierarchy(df, ["scheme", "version"]).collect()
    assert {(r.scheme, r.version, r.code): r.path.split("/") for r in got} == ends
    by_root = {}
    for r in got:
        assert r.depth == len(ends[r.scheme, r.version, r.code]) and r.root == ends[r.scheme, r.version, r.code][0]
        below = {k for k, p in ends.items() if k[:2] == (r.scheme, r.version) and r.code in p}
        assert r.descendants == len(below) - 1 and r.last - r.pre == r.descendants
        by_root.setdefault((r.scheme, r.version, r.root), []).append(r)
    for rs in by_root.values():
        assert sorted(r.pre for r in rs) == list(range(1, len(rs) + 1))
        for r in rs:
            assert {x.code for x in rs if r.pre < x.pre <= r.last} == {x.code for x in rs if x.code != r.code and r.code in x.path.split("/")}
    return ends


def test_shapes_of_links(spark):
    rows = [
        ("s", "1", "a", None), ("s", "1", "b", " a"), ("s", "1", "c", "b\t"), ("s", "1", "d", "  "), ("s", "1", "e", "gone"),
        ("s", "1", "x", "y"), ("s", "1", "y", "z"), ("s", "1", "z", "x"), ("s", "1", "w", "y"), ("s", "1", "ww", "w"), ("s", "1", "self", "self"), ("s", "1", "k", "self"),
        ("s", "2", "a", "b"), ("s", "2", "b", None), (None, "1", "a", None), (None, "1", "b", "a"), (None, None, "b", "a"), ("s", "1", "b", "a"), ("s", "1", "b", "a"), ("s", "1", None, "a"),
    ]
    ends = check(spark, rows)
    pairs = h.descendants(h.hierarchy(frame(spark, rows), ["scheme", "version"]), ["scheme", "version"]).collect()
    want = {(s, v, a, c, len(p) - 1 - i) for (s, v, c), p in ends.items() for i, a in enumerate(p[:-1])}
    assert {(r.scheme, r.version, r.code, r.descendant, r.hops) for r in pairs} == want and len(pairs) == len(want)


def test_random_forest_with_hot_parent_and_long_chain(spark):
    rnd = random.Random(7)
    rows = [("s", "1", "hub", None)] + [("s", "1", f"k{i}", "hub") for i in range(400)] + [("s", "1", f"n{i}", f"k{rnd.randrange(400)}" if i < 50 else f"n{rnd.randrange(i)}") for i in range(200)]
    rows += [("s", "1", f"c{i}", f"c{i - 1}" if i else "hub") for i in range(70)] + [("s", "3", f"r{i}", f"r{(i + 1) % 37}") for i in range(37)]
    check(spark, rows)


def test_empty(spark):
    df = frame(spark, [])
    assert h.endless(df, ["scheme", "version"]).count() == 0 and h.hierarchy(df, ["scheme", "version"]).count() == 0


def test_ranges_join_without_pairs_of_a_tree(spark):
    hier = frame(spark, [("s", "1", "a", None), ("s", "1", "b", "a")])
    plan = h.descendants(h.hierarchy(hier, ["scheme", "version"]), ["scheme", "version"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Cross" not in plan and F is not None
