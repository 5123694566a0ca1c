"""Freely typed values mapped to the entries of a reference list, or to none.

Token-level repair: the distinct tokens of all typed values meet the list's vocabulary once. Tokens and
vocabulary share a padded 2-gram (3-gram from ten letters on) before their edit distance is taken, so no
token is compared with the whole vocabulary; cut-off words and words without vowels match by prefix and
by consonants. Then soft TF-IDF: every form of an entry (its name, its name without asides, its other
name, and these written as one word) is reached through its rarest token only, and stands if each of its
words is matched by some typed token; forms rank by the idf-weighted similarity of their words, less what
the typed value holds besides. Each distinct value is judged once and joined back to its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arbora.operators.packed import packed_labels
from arbora.util import Stage, trimmed

#: Words that carry no meaning of their own in a name.
SMALL = ("of", "for", "with", "to", "and", "the", "in", "from", "at")
LONG = 10
VOWELS = "[aeiouy]"
#: Accents don't distinguish words here. Fixed values.
ACCENTED = "áàâäãåéèêëíìîïóòôöõúùûüýÿñç"
PLAIN = "aaaaaaeeeeiiiiooooouuuuyync"


def words(x: Column) -> Column:
    """Lower-case runs of letters, digits and apostrophes, without small words."""
    # plain classes only: a repeated group would recurse once per letter of a very long value
    w = F.regexp_extract_all(F.translate(F.lower(x), ACCENTED, PLAIN), F.lit(r"([\p{L}\p{M}\p{N}'’]++)"), 1)
    w = F.filter(F.transform(w, lambda t: F.regexp_replace(t, "^['’]++|['’]++$", "")), lambda t: t != "")
    return F.filter(w, lambda t: ~t.isin(*SMALL))


def _grams(w: Column, q: int) -> Column:
    p = F.concat(F.lit("^"), w, F.lit("$"))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(p) - q + 1, F.lit(1))), lambda i: p.substr(i, F.lit(q))))


def _skeleton(w: Column) -> Column:
    return F.regexp_replace(w, VOWELS, "")


def forms(reference: DataFrame) -> DataFrame:
    """(list, ref_id, words, glued): names of entries as bags of words. Categories are listed by source,
    codes by scheme; of a category only the last step of its path or the value of its key counts."""
    leaf = F.regexp_replace(F.regexp_replace(F.col("label"), r"^.*>\s*", ""), r"^[^=]*=", "")
    name = F.when(F.col("kind") == "category", F.replace(leaf, F.lit("_"), F.lit(" "))).otherwise(F.col("label"))
    plain = F.regexp_replace(name, r"\"[^\"]*\"|\S+'s(?=\s)", " ")
    listed = F.concat_ws(":", "kind", F.coalesce(F.when(F.col("kind") == "category", F.col("source")).otherwise(F.col("scheme")), F.lit("")))
    x = reference.select(listed.alias("list"), "ref_id", F.explode(F.array_distinct(F.filter(F.array(words(name), words(plain), words(F.col("alt_label"))), lambda w: F.size(w) > 0))).alias("words"))
    joined = x.where(F.size("words") > 1).withColumn("words", F.array(F.array_join("words", ""))).withColumn("glued", F.lit(True))
    return x.withColumn("glued", F.lit(False)).unionByName(joined).groupBy("list", "ref_id", "words").agg(F.min("glued").alias("glued"))


def repaired(tokens: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(t, v, sim): each distinct token with the words of the vocabulary (v, glued) that it may stand for.
    Of names written as one word most must be there, as their first word alone is another value."""
    vocabulary = vocabulary.groupBy("v").agg(F.min("glued").alias("glued"))
    # few bytes but much arithmetic: an explicit number of tasks is not merged into one
    n_tasks = 3 * tokens.sparkSession.sparkContext.defaultParallelism
    tokens = tokens.repartition(n_tasks, "t")
    v = vocabulary.select("v", F.explode(F.when(F.length("v") < LONG, _grams(F.col("v"), 2)).otherwise(_grams(F.col("v"), 3))).alias("g"))
    t = tokens.select("t", F.explode(F.array_distinct(F.concat(_grams(F.col("t"), 2), _grams(F.col("t"), 3)))).alias("g"))
    skeletons = vocabulary.select("v", F.concat(F.lit("="), _skeleton(F.col("v"))).alias("g")).where("length(g) > 3")
    bare = tokens.select("t", F.concat(F.lit("="), _skeleton(F.col("t"))).alias("g")).where("length(g) > 3")
    pairs = t.unionByName(bare).join(v.unionByName(skeletons), "g").where("length(t) <= length(v) + 3").select("t", "v").distinct()
    pairs = pairs.repartition(n_tasks, "t", "v").join(vocabulary, "v").where(~F.col("glued") | (F.length("t") >= 0.75 * F.length("v")))
    one = F.regexp_replace(F.regexp_replace("t", "ies$", "y"), "s$", "")  # a plural of a listed singular
    d = F.least(F.levenshtein("t", "v"), F.levenshtein(one, F.col("v")))
    swapped = (d == 2) & (F.length("t") == F.length("v")) & (F.array_sort(F.split("t", "")) == F.array_sort(F.split("v", "")))
    edits = F.when(swapped, 1).otherwise(d)
    n = F.length("v")
    most = F.when(n < 3, 0).when(n < 5, 1).when(n < 9, 2).otherwise(3)
    close = F.when(edits <= most, 1 - edits / F.greatest(n, F.length("t")))
    cut = F.when((F.length("t") >= 3) & F.col("v").startswith(F.col("t")), 0.75 + 0.2 * F.length("t") / n)
    half = F.when((F.length("t") >= 5) & (F.length("t") < n) & (F.levenshtein(F.col("t"), F.col("v").substr(F.lit(1), F.length("t"))) <= 1), 0.7)
    bones = F.when((_skeleton(F.col("t")) == _skeleton(F.col("v"))) & ((F.col("t") == _skeleton(F.col("t"))) | (edits <= 3)), 0.8)
    return pairs.withColumn("sim", F.greatest(close, cut, half, bones)).where("sim > 0").select("t", "v", "sim")


def canonical(typed: DataFrame, reference: DataFrame, margin: float = 1e-6) -> DataFrame:
    """typed (list, value) -> + ref_id, -1 if the list has no such entry; one row per distinct pair."""
    vals = Stage(typed.select("list", "value").distinct().withColumn("ws", words(F.col("value")))).df
    # spaced-out letters are put together, by wider gaps if there are some, and altogether
    spaced = F.size(F.filter("ws", lambda w: F.length(w) == 1)) * 2 > F.size("ws")
    closed = words(F.regexp_replace("value", r"(?<=\S) (?=\S)", ""))
    x = vals.select("list", "value", F.when(spaced, F.array_distinct(F.concat(closed, F.array(F.array_join("ws", "")), F.filter("ws", lambda w: F.length(w) > 1)))).otherwise(F.array_distinct("ws")).alias("ws"))
    f = forms(reference)
    df = f.select("list", "ref_id", F.explode("words").alias("v")).distinct().groupBy("list", "v").agg(F.count("*").alias("df"))
    total = f.groupBy("list").agg(F.count_distinct("ref_id").alias("n"))
    idf = df.join(total, "list").select("list", "v", F.log(1 + F.col("n") / F.col("df")).alias("idf"))
    # each form with the idf of its words, under its rarest word
    weighed = f.select("list", "ref_id", F.hash("words").alias("h"), F.explode("words").alias("v")).join(idf, ["list", "v"])
    weighed = weighed.groupBy("list", "ref_id", "h").agg(F.collect_set(F.struct("v", "idf")).alias("need"), F.max_by("v", F.struct("idf", "v")).alias("anchor"))
    weighed = Stage(weighed).df
    tokens = x.select("list", "value", F.explode("ws").alias("t"))
    fixes = Stage(repaired(tokens.select("t").distinct(), f.select(F.explode("words").alias("v"), "glued"))).df
    hits = Stage(tokens.join(fixes, "t")).df
    held = hits.groupBy("list", "value").agg(F.collect_list(F.struct("t", "v", "sim")).alias("have"))
    reached = hits.select("list", "value", F.col("v").alias("anchor")).distinct().join(weighed, ["list", "anchor"])
    both = reached.join(held, ["list", "value"]).join(x.select("list", "value", F.size("ws").alias("n_typed")), ["list", "value"])
    best = lambda v: F.array_max(F.transform(F.filter("have", lambda h: h["v"] == v), lambda h: F.struct(h["sim"].alias("sim"), h["t"].alias("t"))))
    sims = F.transform("need", lambda w: F.struct(w["idf"].alias("idf"), best(w["v"]).alias("b")))
    sims = F.transform(sims, lambda s: F.struct(s["idf"].alias("idf"), s["b"]["sim"].alias("sim"), s["b"]["t"].alias("t")))
    scored = both.withColumn("sims", sims).where(F.forall("sims", lambda s: s["sim"].isNotNull()) & (F.size(F.array_distinct("sims.t")) == F.size("sims")))  # a typed token stands for one word
    top, norm = F.aggregate("sims", F.lit(0.0), lambda a, s: a + s["idf"] * s["sim"]), F.aggregate("sims", F.lit(0.0), lambda a, s: a + s["idf"])
    scored = scored.select("list", "value", "ref_id", (top / norm - 0.02 * (F.col("n_typed") - F.size("need"))).alias("score"))
    ranked = scored.groupBy("list", "value", "ref_id").agg(F.max("score").alias("score")).groupBy("list", "value").agg(F.max_by("ref_id", F.struct("score", -F.col("ref_id"))).alias("ref_id"))
    return vals.select("list", "value").join(ranked, ["list", "value"], "left").withColumn("ref_id", F.coalesce("ref_id", F.lit(-1)).cast("bigint"))


def typed_codes(typed: DataFrame, reference: DataFrame) -> DataFrame:
    """(list, value, by_code): values that write a listed code in some way of their own; the way that
    drops least is taken (``.0`` behind a number counts as put there by a spreadsheet)."""
    main = F.regexp_extract("value", r"(?:^|[\s#(.:])([0-9](?:[0-9.\-–]*[0-9])?)(?=$|[\s(),;])", 1)
    letter = F.regexp_extract("value", r"(?:^|[\s#(])([A-Z])(?=$|[\s(),;])", 1)
    bare = F.regexp_replace(main, r"[^0-9]", "")
    ways = F.array(F.regexp_replace(F.regexp_replace(main, r"\.0+$", ""), r"[^0-9]", ""), bare, letter)
    x = typed.select("list", "value", F.posexplode(ways).alias("p", "code")).where("code <> ''")
    listed = reference.where("kind = 'code'").select(F.concat_ws(":", F.lit("code"), "scheme").alias("list"), "code", "ref_id")
    return x.join(listed, ["list", "code"]).groupBy("list", "value").agg(F.min_by("ref_id", "p").alias("by_code"))


def mapped(audit: DataFrame, entries: DataFrame, reference: DataFrame) -> DataFrame:
    """(table_name, row_id, ref_id) for the typed labels of the audit and the typed codes of the entries.

    Null and blank values, values that are listed labels to the letter and cells of several values are
    not asked about. A value whose source or scheme has no list comes out as -1."""
    labels = reference.where("kind = 'category'").select("source", "label").distinct()
    a = audit.where(trimmed(F.col("source_value")) != "").select("audit_id", "source", "source_value")
    several = packed_labels(a, "audit_id", "source", "source_value", labels).where("n > 1").select("audit_id").distinct()
    a = a.join(labels.withColumnRenamed("label", "source_value"), ["source", "source_value"], "left_anti").join(several, "audit_id", "left_anti")
    a = a.select(F.lit("psic_rev5_deterministic_audit").alias("table_name"), F.col("audit_id").alias("row_id"), F.concat_ws(":", F.lit("category"), F.coalesce("source", F.lit(""))).alias("list"), F.col("source_value").alias("value"))
    kept = F.filter(F.transform(F.split("codes", r"\|"), trimmed), lambda c: (c != "") & ~c.rlike(r"^(?:[0-9]+|[A-Z])$"))
    e = entries.where(F.size(kept) > 0).select(F.lit("crosswalk_entries").alias("table_name"), F.col("entry_id").alias("row_id"), F.concat_ws(":", F.lit("code"), F.coalesce("scheme", F.lit(""))).alias("list"), trimmed(F.col("codes")).alias("value"))
    asked = Stage(a.unionByName(e)).df
    distinct = asked.select("list", "value").distinct()
    by_code = typed_codes(distinct, reference)
    by_name = canonical(distinct, reference)
    answer = by_name.join(by_code, ["list", "value"], "left").select("list", "value", F.coalesce("by_code", "ref_id").alias("ref_id"))
    return asked.join(answer, ["list", "value"]).select("table_name", "row_id", "ref_id")
