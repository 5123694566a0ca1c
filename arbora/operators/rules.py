"""Reviewed rules: validation, and matching observed labels exactly, by substring and by pattern.

Everything runs over distinct labels. Exact rules are an equi-join on the folded key. Rules that share a
substring or a pattern are matched as one text and told apart only afterwards. A label that a text matches
holds every run of letters that the text spells out, so that labels and texts meet by equality of one
gram of such a run, the rarest of a few; only texts that spell out less are tried on every label of their
source and field, slice by slice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arbora.functions.text import blank_key_words, clean_text, observed_key, reviewed_key, split_codes
from arbora.operators.tree import SCOPE, common_path, normalize_roots
from arbora.util import Stage

SOURCES = ("fsq", "overture", "osm")
KINDS = ("EXACT", "SUBTREE", "UNION", "NOT_ACTIVITY", "UNCODEABLE")
CODED = ("EXACT", "SUBTREE", "UNION")
BUCKET = ["source", *SCOPE, "field"]
SCANNED = ("contains", "regex")
#: Lengths of the grams by which labels and texts meet.
GRAMS = (8, 4)
#: Rules of one text that are joined in one piece, and slices of the labels that every text of no gram is tried on.
PIECE, SLICES = 500, 48
#: Patterns made of letters that must be there, classes and anchors; the (?i) before them folds ASCII only.
_PLAIN = r"^(?:[\p{L}\p{N} _'&,-](?![*+?{])|(?:\\[bBdDsSwW]|\.)(?:[*+?][+?]?)?|[\^$])*+\z"


def prepared(entries: DataFrame) -> DataFrame:
    """Reviewed rows as rules; a blank kind is an unreviewed row and no rule. CLASS is EXACT."""
    low = lambda c, d: F.coalesce(F.nullif(F.lower(F.trim(c)), F.lit("")), F.lit(d))
    kind = F.upper(F.trim("mapping_kind"))
    x = entries.where(kind != "").select(
        F.col("entry_id").alias("rule_id"), low("source", "").alias("source"), F.trim("source_value").alias("value"), low("scheme", "").alias("scheme"), F.trim("version").alias("version"),
        F.when(kind == "CLASS", "EXACT").otherwise(kind).alias("kind"), split_codes(F.col("codes")).alias("codes"), low("match_type", "exact").alias("match_type"), F.col("confidence"), low("source_field", "category").alias("field"),
    )
    # key of the value; what a label of the same text would be looked up by
    return x.withColumn("key", reviewed_key(F.col("value"))).withColumn("signature", signature())


def signature() -> Column:
    """What changes a decision: the kind and the codes, whose order counts for nothing in a union."""
    return F.concat_ws(":", "kind", F.array_join(F.when(F.col("kind") == "UNION", F.array_sort("codes")).otherwise(F.col("codes")), "|"))


def problems(rules: DataFrame, tree: DataFrame) -> DataFrame:
    """(rule_id, problem): the first thing wrong with each rule, all rules at once."""
    codes = rules.select("rule_id", *SCOPE, "kind", F.explode("codes").alias("code")).join(tree.select(*SCOPE, "code", "path"), [*SCOPE, "code"], "left")
    known = codes.groupBy("rule_id").agg(F.sum(F.col("path").isNull().cast("int")).alias("unknown"), F.size(normalize_roots(F.collect_set("path"))).alias("roots"))
    x = rules.join(known, "rule_id", "left")
    n = F.size("codes")
    p = (
        F.when(~F.col("source").isin(*SOURCES), "unknown_source")
        .when(F.coalesce(F.col("value"), F.lit("")) == "", "blank_value")
        .when(~F.col("scheme").isin("psic", "pcpc", "pscc"), "unknown_scheme")
        .when(F.coalesce(F.col("version"), F.lit("")) == "", "blank_version")
        .when(~F.col("field").isin("category", "name"), "unknown_field")
        .when(~F.coalesce(F.col("confidence"), F.lit(0.0)).between(0, 1), "confidence")
        .when(~F.col("match_type").isin("exact", "contains", "regex"), "unknown_match_type")
        .when((F.col("match_type") != "regex") & (F.col("key") == ""), "empty_key")
        .when((F.col("match_type") == "exact") & blank_key_words(F.col("value")), "generic_label")
        .when(~F.col("kind").isin(*KINDS), "unknown_kind")
        .when(F.size(F.array_distinct("codes")) < n, "repeated_codes")
        .when(F.col("kind").isin("EXACT", "SUBTREE") & (n != 1), "not_one_code")
        .when((F.col("kind") == "UNION") & (n < 2), "union_too_small")
        .when(F.col("kind").isin("NOT_ACTIVITY", "UNCODEABLE") & (n > 0), "codes_on_no_activity")
        .when(F.coalesce("unknown", F.lit(0)) > 0, "unknown_codes")
        .when((F.col("kind") == "UNION") & (F.col("roots") < 2), "union_collapses")
    )
    return x.select("rule_id", p.alias("problem")).where("problem is not null")


def conflicts(rules: DataFrame) -> DataFrame:
    """(bucket, key, n_rules): keys of exact rules that decide differently."""
    x = rules.where("match_type = 'exact'").groupBy(*BUCKET, "key", "signature").agg(F.count("*").alias("n"))
    return x.groupBy(*BUCKET, "key").agg(F.sum("n").alias("n_rules"), F.count("*").alias("k")).where("k > 1").drop("k")


def valid(rules: DataFrame, tree: DataFrame) -> DataFrame:
    """Rules without problems, with the root paths of their codes and the code that stands for them."""
    ok = rules.join(problems(rules, tree), "rule_id", "left_anti")
    codes = ok.select("rule_id", *SCOPE, F.explode("codes").alias("code")).join(tree.select(*SCOPE, "code", "path"), [*SCOPE, "code"])
    roots = codes.groupBy("rule_id").agg(F.array_sort(normalize_roots(F.collect_set("path"))).alias("roots"))
    return ok.join(roots, "rule_id", "left").withColumn("roots", F.coalesce("roots", F.array().cast("array<array<string>>"))).withColumn("rep_path", common_path(F.col("roots")))


def match_exact(labels: DataFrame, rules: DataFrame) -> DataFrame:
    """labels (source, field, value) -> + scheme, version, rule_id. Of equal keys the first rule counts."""
    first = rules.where("match_type = 'exact'").groupBy(*BUCKET, "key").agg(F.min("rule_id").alias("rule_id"))
    return labels.withColumn("key", observed_key(F.col("value"))).where("key <> ''").join(first, ["source", "field", "key"]).select("source", "field", "value", *SCOPE, "rule_id")


def _folded(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _pieces(run: Column, n: int, starts: Column) -> Column:
    return F.transform(starts, lambda i: run.substr(i.cast("int"), F.lit(n)))


def _all_grams(x: Column) -> Column:
    """Every gram of a label."""
    each = [F.when(F.length(x) >= n, _pieces(x, n, F.sequence(F.lit(1), F.greatest(F.length(x) - n + 1, F.lit(1))))).otherwise(F.array().cast("array<string>")) for n in GRAMS]
    return F.array_distinct(F.concat(*each))


def _some_grams(run: Column) -> Column:
    """Up to four grams spread over a run; none of one too short."""
    out = F.array().cast("array<string>")
    for n in reversed(GRAMS):
        rest = F.length(run) - n
        out = F.when(rest >= 0, _pieces(run, n, F.array(*[F.floor(rest * k / 3) + 1 for k in range(4)]))).otherwise(out)
    return out


def _runs(text: Column, match_type: Column) -> Column:
    """What any match holds: the key itself, or the runs of letters of a plain pattern."""
    opened = F.split(F.regexp_replace(text, r"\\[bBdDsSwW]|[.*+?^$]", "\n"), "\n")
    spelled = F.when(text.rlike(_PLAIN), F.filter(F.transform(opened, _folded), lambda r: r != "")).otherwise(F.array().cast("array<string>"))
    return F.when(match_type == "contains", F.array(text)).otherwise(spelled)


def _identified(labels: DataFrame) -> DataFrame:
    """Labels with a number, their key and what patterns see of them, made once."""
    x = labels.select("source", "field", "value").withColumn("clean", clean_text(F.col("value"))).where("clean is not null")
    return Stage(x.withColumn("key", observed_key(F.col("value"))).withColumn("lid", F.monotonically_increasing_id())).df


def _scanned(rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Substring and pattern rules with their text, and the distinct texts (tid, parts)."""
    text = F.when(F.col("match_type") == "contains", F.col("key")).otherwise(F.col("value"))
    r = Stage(rules.where(F.col("match_type").isin(*SCANNED)).select(*BUCKET, "match_type", text.alias("text"), "rule_id", "signature", F.length("value").alias("len")).where("text is not null")).df
    t = r.groupBy("source", "field", "match_type", "text").agg(F.ceil(F.count("*") / PIECE).cast("int").alias("parts"))
    t = t.withColumn("runs", _runs(F.col("text"), F.col("match_type"))).withColumn("tid", F.monotonically_increasing_id())
    texts = Stage(t.withColumn("grams", F.array_distinct(F.flatten(F.transform("runs", _some_grams))))).df
    return r.join(texts.select("source", "field", "match_type", "text", "tid", "parts"), ["source", "field", "match_type", "text"]), texts


def _text_hits(labels: DataFrame, texts: DataFrame) -> DataFrame:
    """(lid, tid, parts): every label and every text that matches it."""
    named = lambda t, g: F.xxhash64("source", "field", t, g)
    needed = Stage(texts.select("tid", F.explode("grams").alias("g"), "source", "field", "match_type").select("tid", named("match_type", "g").alias("h"))).df
    hays = F.array(*[F.struct(F.lit(m).alias("m"), _all_grams(h).alias("gs")) for m, h in zip(SCANNED, (F.col("key"), _folded(F.col("clean"))))])
    held = labels.select("lid", "source", "field", F.explode(hays).alias("x")).select("lid", "source", "field", "x.m", F.explode("x.gs").alias("g")).select("lid", named("m", "g").alias("h"))
    held = Stage(held.join(needed.select("h").distinct(), "h", "left_semi")).df
    # of the grams of a text the one that the fewest labels hold; if some gram is in none, no label matches
    n = F.coalesce("n", F.lit(0))
    rarest = needed.join(held.groupBy("h").agg(F.count("*").alias("n")), "h", "left").groupBy("tid").agg(F.min_by("h", n).alias("h"), F.min(n).alias("n")).where("n > 0").select("tid", "h")
    see = ["source", "field", "match_type", "text", "runs", "parts"]
    near = rarest.join(held, "h").select("lid", "tid").join(texts.select("tid", *see), "tid")
    near = near.join(labels.withColumnsRenamed({"source": "l_source", "field": "l_field"}), "lid").where("l_source = source and l_field = field")
    # texts on the left: each is compiled once for all labels of a slice
    wide = texts.where(F.size("grams") == 0).select("tid", *see, F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1))).alias("slice"))
    wide = wide.join(labels.withColumn("slice", F.pmod(F.xxhash64("lid"), F.lit(SLICES)).cast("int")).hint("merge"), ["source", "field", "slice"])
    hay = F.when(F.col("match_type") == "contains", F.col("key")).otherwise(_folded(F.col("clean")))
    there = F.forall("runs", lambda r: F.contains(hay, r))
    hit = F.when(there, (F.col("match_type") == "contains") | F.rlike("clean", F.concat(F.lit("(?i)"), "text")))
    out = ["lid", "tid", "parts", "match_type", "text", "runs", "key", "clean"]
    return near.select(out).unionByName(wide.select(out)).where(hit).select("lid", "tid", "parts")


def _spread(hits: DataFrame) -> DataFrame:
    """Hits once for each piece of their text's rules, so that a text of many rules is no single task."""
    return hits.select("lid", "tid", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))


def scan_hits(labels: DataFrame, rules: DataFrame) -> DataFrame:
    """Every (label, rule) of substring and pattern rules that match."""
    x = _identified(labels)
    r, texts = _scanned(rules)
    r = r.select("tid", F.pmod(F.xxhash64("rule_id"), F.col("parts")).cast("int").alias("part"), *SCOPE, "rule_id")
    hits = _text_hits(x, texts).join(x.select("lid", "source", "field", "value"), "lid")
    hits = hits.select("tid", "source", "field", "value", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    return hits.join(r, ["tid", "part"]).select("source", "field", "value", *SCOPE, "rule_id")


def match(labels: DataFrame, rules: DataFrame) -> DataFrame:
    """labels + scheme, version, rule_id, ambiguous: at most one decision per label and release.

    Exact rules come first. Scanned rules that disagree give none and are marked; those that agree give
    the one of the longest value, the first on a tie. Rules of one text and release are one row before
    they meet labels."""
    x = _identified(labels)
    r, texts = _scanned(rules)
    best = F.struct("len", (-F.col("rule_id")).alias("nth"))
    r = r.groupBy("tid", "parts", *SCOPE).agg(F.min("signature").alias("lo"), F.max("signature").alias("hi"), F.max(best).alias("best"))
    r = r.withColumn("part", F.pmod(F.xxhash64(*SCOPE), F.col("parts")).cast("int")).drop("parts")
    s = _spread(_text_hits(x, texts)).join(r, ["tid", "part"]).select("lid", *SCOPE, "lo", "hi", "best", F.lit(None).cast("long").alias("exact"))
    # each value is folded once, not once for each of its rules
    same = rules.where("match_type = 'exact'").groupBy(*BUCKET, "value").agg(F.min("rule_id").alias("exact"))
    keys = Stage(rules.where("match_type = 'exact'").select("source", "field", "value").distinct()).df.withColumn("key", reviewed_key(F.col("value")))
    meant = x.where("key <> ''").select("lid", "source", "field", "key").join(keys, ["source", "field", "key"]).select("lid", "source", "field", "value")
    e = meant.join(same, ["source", "field", "value"]).select("lid", *SCOPE, "exact")
    # no version equals none, so that an exact rule without one comes before no other
    apart = F.col("version").isNull() & F.col("exact").isNotNull()
    both = e.unionByName(s, allowMissingColumns=True).repartition("lid").groupBy("lid", *SCOPE, apart.alias("apart"))  # shuffled once for this and the join below
    d = both.agg(F.min("exact").alias("exact"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max("best").alias("best"))
    ambiguous = F.col("exact").isNull() & (F.col("lo") != F.col("hi"))
    d = d.select("lid", *SCOPE, F.coalesce("exact", F.when(~ambiguous, -F.col("best.nth"))).alias("rule_id"), ambiguous.alias("ambiguous"))
    return d.join(x.select("lid", "source", "field", "value"), "lid").select("source", "field", "value", *SCOPE, "rule_id", "ambiguous")
