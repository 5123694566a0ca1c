"""Scalars over noisy text, as column expressions that stay in generated code. Spark has neither NFKC nor
case folding of its own; the Unicode library it ships has both, and text beyond ASCII is handed to that."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from arbora.util import trimmed

#: Labels that mean nothing in observed text. Fixed values.
NULL_WORDS = ("", "n/a", "na", "none", "null", "-", "others", "other", "unknown")
_ASCII = r"^\p{ASCII}*+$"


def _unicode(x: Column, owner: str, method: str) -> Column:
    """A static method (text, true) of the Unicode library within Spark, called in generated code; null for null."""
    spark = SparkSession.active()
    jvm = spark._jvm
    catalyst, utils = jvm.org.apache.spark.sql.catalyst.expressions, jvm.org.apache.spark.sql.classic.ExpressionUtils
    of, seq = jvm.java.lang.Class.forName, lambda *xs: jvm.org.apache.spark.api.python.PythonUtils.toSeq(list(xs))
    ddl = jvm.org.apache.spark.sql.types.DataType.fromDDL
    java, none = jvm.org.apache.spark.sql.types.ObjectType(of("java.lang.String")), jvm.scala.Option.apply(None)
    text = catalyst.objects.Invoke(utils.expression(x._jc), "toString", java, seq(), seq(), True, True, True)
    made = catalyst.objects.StaticInvoke(of(owner), java, method, seq(text, catalyst.Literal.create(True, ddl("boolean"))), seq(), True, True, True, none)
    return Column(utils.column(catalyst.objects.StaticInvoke(of("org.apache.spark.unsafe.types.UTF8String"), ddl("string"), "fromString", seq(made), seq(), True, True, True, none)))


def nfkc(x: Column) -> Column:
    """Unicode's compatibility composition."""
    return F.when(x.rlike(_ASCII), x).otherwise(_unicode(x, "com.ibm.icu.text.Normalizer", "compose"))


def casefold(x: Column) -> Column:
    """Unicode's full case folding."""
    return F.when(x.rlike(_ASCII), F.lower(x)).otherwise(_unicode(x, "com.ibm.icu.lang.UCharacter", "foldCase"))


def clean_literal(x: Column) -> Column:
    """Authoritative text: NFKC, stripped, blank as null."""
    return F.nullif(trimmed(nfkc(x)), F.lit(""))


def clean_text(x: Column) -> Column:
    """Observed text: as clean_literal, and words that mean nothing are null."""
    t = trimmed(nfkc(x))
    return F.when(~F.lower(t).isin(*NULL_WORDS), t)


def fold(x: Column) -> Column:
    """Case-folded, anything but word characters and = : + & / . - as one blank."""
    return F.trim(F.regexp_replace(casefold(x), r"[^\p{L}\p{N}_=:+&/.-]+", " "))


def observed_key(x: Column) -> Column:
    return F.coalesce(fold(clean_text(x)), F.lit(""))


def reviewed_key(x: Column) -> Column:
    """Key of a reviewed rule's value: words such as Other count."""
    return F.coalesce(fold(clean_literal(x)), F.lit(""))


def combine_text(*parts: Column) -> Column:
    """Distinct cleaned parts, the first of each key kept, joined by bars."""
    both = F.filter(F.array(*[F.struct(clean_text(p).alias("t"), observed_key(p).alias("k")) for p in parts]), lambda s: s["t"].isNotNull())
    kept = F.filter(both, lambda s: F.lit(True))
    kept = F.aggregate(kept, F.array().cast("array<struct<t:string,k:string>>"), lambda acc, s: F.when(F.exists(acc, lambda a: a["k"] == s["k"]), acc).otherwise(F.array_append(acc, s)))
    return F.array_join(F.transform(kept, lambda s: s["t"]), " | ")


def truthy(x: Column) -> Column:
    """Loosely typed flags: 1, true, yes, y, t in any case; null is false."""
    return F.coalesce(F.lower(F.trim(x.cast("string"))).isin("1", "true", "yes", "y", "t"), F.lit(False))


def as_float(x: Column) -> Column:
    """Null where it is no number, or not a finite one to compare."""
    d = x.try_cast("double")
    return F.when(~F.isnan(d), d)


def split_codes(x: Column) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(x, F.lit("")), r"\|"), lambda c: F.trim(c)), lambda c: c != "")


def category_query(source: Column, value: Column) -> Column:
    """Label of a source as words to search with: paths and underscores opened, ``k=v`` as ``v k``."""
    osm = F.array_join(F.transform(F.split(value, r"\|"), lambda p: F.when(p.contains("="), F.concat_ws(" ", F.split_part(p, F.lit("="), F.lit(2)), F.split_part(p, F.lit("="), F.lit(1)))).otherwise(p)), " ")
    t = F.when(source == "osm", F.replace(osm, F.lit("_"), F.lit(" "))).when(source == "overture", F.replace(value, F.lit("_"), F.lit(" "))).otherwise(F.replace(value, F.lit(">"), F.lit(" ")))
    return F.trim(F.regexp_replace(t, r"\s+", " "))


def tag_map(value: Column) -> Column:
    """``k=v | k=v`` as a map; the last value of a key wins."""
    pairs = F.filter(F.transform(F.split(value, r"\|"), lambda p: F.trim(p)), lambda p: p.contains("="))
    each = F.transform(pairs, lambda p: F.struct(F.trim(F.split_part(p, F.lit("="), F.lit(1))).alias("k"), F.trim(F.split_part(p, F.lit("="), F.lit(2))).alias("v")))
    lasts = F.filter(F.transform(each, lambda s, i: F.struct(s["k"].alias("k"), s["v"].alias("v"), i.alias("i"))), lambda s: ~F.exists(F.slice(each, s["i"] + 2, F.size(each)), lambda o: o["k"] == s["k"]))
    return F.map_from_entries(F.transform(lasts, lambda s: F.struct(s["k"], s["v"])))


def joint_key(source: Column, field: Column, value: Column) -> Column:
    """Sixteen hex digits that name a label over all schemes."""
    bare = lambda c: trimmed(F.coalesce(c, F.lit("")))
    return F.substring(F.sha1(F.concat_ws("\x1f", F.lower(bare(source)), F.lower(bare(field)), bare(value))), 1, 16)


# codes of the three schemes -------------------------------------------------------------------------

#: Levels, shallow to deep, with the widths of their codes; sections of psic are letters. Fixed values.
LEVELS = {
    "psic": ("section", "division", "group", "class", "subclass"),
    "pcpc": ("section", "division", "group", "class", "subclass", "item"),
    "pscc": ("chapter", "heading", "hs_subheading", "ahtn_subheading", "commodity"),
}
WIDTHS = {"psic": (1, 2, 3, 4, 5), "pcpc": (1, 2, 3, 4, 5, 6), "pscc": (2, 4, 6, 8, 11)}


def code_text(x: Column) -> Column:
    """Codes as text, without the zeros that spreadsheets put behind a point."""
    return F.nullif(F.regexp_replace(F.trim(x), r"\.0+$", ""), F.lit(""))


def level_rank(scheme: Column, level: Column) -> Column:
    """0 for the topmost level; null for one that the scheme doesn't have."""
    out = F.lit(None).cast("int")
    for s, names in LEVELS.items():
        for i, n in enumerate(names):
            out = F.when((scheme == s) & (F.lower(level) == n), i).otherwise(out)
    return out


def infer_level(scheme: Column, code: Column) -> Column:
    """Level by the width of a code; a letter is a psic section only."""
    out = F.lit(None).cast("string")
    for s, names in LEVELS.items():
        for n, w in zip(names, WIDTHS[s]):
            shape = r"^[A-V]$" if (s, n) == ("psic", "section") else rf"^[0-9]{{{w}}}$"
            out = F.when((scheme == s) & code.rlike(shape), n).otherwise(out)
    return out


def pad_code(scheme: Column, level: Column, code: Column) -> Column:
    """Digits too short for their declared level get leading zeros; nothing is ever cut."""
    out = code
    for s, names in LEVELS.items():
        for n, w in zip(names, WIDTHS[s]):
            if (s, n) != ("psic", "section"):
                out = F.when((scheme == s) & (level == n) & code.rlike("^[0-9]+$") & (F.length(code) < w), F.lpad(code, w, "0")).otherwise(out)
    return out


def split_explanation(x: Column) -> Column:
    """Title, includes and excludes of an explanatory cell, by their markers in any case."""
    inc, exc = r"(?is)this (?:\w+ )?(?:also )?includes?:?", r"(?is)this (?:\w+ )?excludes?:?"
    part = lambda p: F.nullif(F.trim(F.regexp_extract(x, p, 1)), F.lit(""))
    return F.struct(part(rf"(?is)^(.*?)(?:{inc}|{exc}|$)").alias("title"), part(rf"{inc}(.*?)(?:{exc}|$)").alias("includes"), part(rf"{exc}(.*?)(?:{inc}|$)").alias("excludes"))


def blank_key_words(x: Column) -> Column:
    """Whether observed text of this kind would count as missing."""
    return observed_key(x) == ""
