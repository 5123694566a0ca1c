"""TF-IDF retrieval of tree nodes: sparse products as joins on terms, ranked per query.

Words: lower-cased runs of two or more letters, digits or underscores, and pairs of neighbours.
Characters: 3- to 5-grams of each word with a blank around it. tf = 1 + ln n, idf = ln((1+N)/(1+df)) + 1,
vectors of unit length. Queries are distinct texts; a node's score is 0.6 of the word cosine and 0.4 of
the character cosine. Ties go to the larger code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arbora.operators.tree import SCOPE

TOKEN = r"([\p{L}\p{N}_]{2,})"
WEIGHTS = {"word": 0.6, "char": 0.4}


def word_terms(text: Column) -> Column:
    w = F.regexp_extract_all(F.lower(text), F.lit(TOKEN), 1)
    pairs = F.transform(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), lambda t, i: F.concat_ws(" ", t, F.get(w, i + 1)))
    return F.concat(w, pairs)


def char_terms(text: Column) -> Column:
    padded = F.transform(F.filter(F.split(F.lower(text), r"\s+"), lambda t: t != ""), lambda t: F.concat(F.lit(" "), t, F.lit(" ")))

    none = F.array().cast("array<string>")

    def grams(p: Column, n: int) -> Column:
        return F.when(F.length(p) >= n, F.transform(F.sequence(F.lit(1), F.greatest(F.length(p) - n + 1, F.lit(1))), lambda i: p.substr(i, F.lit(n)))).otherwise(none)

    # a word too short for its smallest n counts once, whole; the larger n are then passed over
    return F.flatten(F.transform(padded, lambda p: F.concat(F.when(F.length(p) < 3, F.array(p)).otherwise(none), grams(p, 3), grams(p, 4), grams(p, 5))))


def _tf(rows: DataFrame, keys: list[str], terms: Column) -> DataFrame:
    return rows.select(*keys, F.explode(terms).alias("term")).groupBy(*keys, "term").agg((1 + F.log(F.count("*"))).alias("tf"))


def _unit(weighed: DataFrame, keys: list[str]) -> DataFrame:
    norm = weighed.groupBy(*keys).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("_n"))
    return weighed.join(norm, keys).withColumn("w", F.col("w") / F.col("_n")).drop("_n")


def fit(nodes: DataFrame, terms) -> tuple[DataFrame, DataFrame]:
    """(scheme, version, code, term, w) and (scheme, version, term, idf) of nodes (scheme, version, code, text)."""
    tf = _tf(nodes, [*SCOPE, "code"], terms(F.col("text")))
    n = nodes.groupBy(*SCOPE).agg(F.count("*").alias("n"))
    idf = tf.groupBy(*SCOPE, "term").agg(F.count("*").alias("df")).join(n, SCOPE).select(*SCOPE, "term", (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf"))
    return _unit(tf.join(idf, [*SCOPE, "term"]).select(*SCOPE, "code", "term", (F.col("tf") * F.col("idf")).alias("w")), [*SCOPE, "code"]), idf


def scores(queries: DataFrame, nodes: DataFrame, kinds: dict[str, float] | None = None) -> DataFrame:
    """(scheme, version, query, code, score) of every pair that shares a term; queries: (scheme, version, query)."""
    out = None
    for kind, weight in (kinds or WEIGHTS).items():
        terms = word_terms if kind == "word" else char_terms
        index, idf = fit(nodes, terms)
        q = _tf(queries.distinct(), [*SCOPE, "query"], terms(F.col("query"))).join(idf, [*SCOPE, "term"])
        q = _unit(q.select(*SCOPE, "query", "term", (F.col("tf") * F.col("idf")).alias("w")), [*SCOPE, "query"]).withColumnRenamed("w", "qw")
        s = q.join(index, [*SCOPE, "term"]).groupBy(*SCOPE, "query", "code").agg((weight * F.sum(F.col("qw") * F.col("w"))).alias("score"))
        out = s if out is None else out.unionByName(s)
    return out.groupBy(*SCOPE, "query", "code").agg(F.round(F.sum("score"), 9).alias("score"))


def top(scored: DataFrame, n: int) -> DataFrame:
    w = Window.partitionBy(*SCOPE, "query").orderBy(F.desc("score"), F.desc("code"))
    return scored.where("score > 0").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def within_branches(scored: DataFrame, branches: DataFrame, closure: DataFrame) -> DataFrame:
    """Scores of nodes under the branches asked for with each query; branches: (scheme, version, query, root)."""
    allowed = branches.join(closure.select(*SCOPE, F.col("ancestor").alias("root"), "code"), [*SCOPE, "root"]).select(*SCOPE, "query", "code").distinct()
    return scored.join(allowed, [*SCOPE, "query", "code"], "left_semi")


def beam(scored: DataFrame, tree: DataFrame, closure: DataFrame, n: int, width: int = 4) -> DataFrame:
    """The best of the first two levels open their branches, within which all nodes rank again; queries
    without a hit up there rank over all nodes."""
    coarse = scored.join(tree.where("depth <= 2").select(*SCOPE, "code"), [*SCOPE, "code"], "left_semi")
    roots = top(coarse, width).select(*SCOPE, "query", F.col("code").alias("root"))
    inside = within_branches(scored, roots, closure)
    flat = scored.join(roots.select(*SCOPE, "query").distinct(), [*SCOPE, "query"], "left_anti")
    return top(inside.unionByName(flat.select(inside.columns)), n)


def node_texts(tree: DataFrame) -> DataFrame:
    parts = F.concat_ws("\n", *[F.nullif(F.trim(c), F.lit("")) for c in ("title", "description", "includes")])
    return tree.select(*SCOPE, "code", parts.alias("text"))
