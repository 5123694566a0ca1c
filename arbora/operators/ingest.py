"""Code lists as they are published: duplicates merged, parents derived, missing prefixes filled in."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arbora.functions.text import LEVELS, WIDTHS, infer_level
from arbora.operators.tree import SCOPE

TEXTS = ("title", "description", "includes", "excludes")


def merge_duplicates(nodes: DataFrame, order: str = "node_id") -> DataFrame:
    """One row per code: of each text the longest, the first on a tie; rows that disagree in level or
    parent are counted as conflicts."""
    longest = [F.max_by(F.trim(c), F.struct(F.length(F.trim(c)), -F.col(order))).alias(c) for c in TEXTS]
    differs = lambda c: F.min(c) != F.max(c)
    level, parent = F.lower(F.trim("level")), F.nullif(F.trim("parent_code"), F.lit(""))
    x = nodes.where("code is not null").withColumn("_l", level).withColumn("_p", parent)
    return x.groupBy(*SCOPE, "code").agg(*longest, F.min("_l").alias("level"), F.max("_p").alias("parent_code"), F.count("*").alias("n_rows"), F.coalesce(differs("_l") | differs("_p"), differs("_l"), differs("_p"), F.lit(False)).alias("conflict"))


def derive_parents(nodes: DataFrame, order: str = "node_id") -> DataFrame:
    """(scheme, version, code, parent, how): the parent that is given and there, else the longest listed
    prefix, else for psic divisions the last section before them.

    Prefixes meet codes by equality. The last section is looked up by its place in the list: a prefix
    maximum over sections and divisions only, of which a release has few."""
    one = nodes.where("code is not null").groupBy(*SCOPE, "code").agg(F.min(order).alias("_o"), F.max(F.nullif(F.trim("parent_code"), F.lit(""))).alias("_p"), F.min(F.lower("level")).alias("level"))
    codes = one.select(*SCOPE, F.col("code").alias("_x"))
    given = one.join(codes.withColumnRenamed("_x", "_p").withColumn("_there", F.lit(True)), [*SCOPE, "_p"], "left")
    cuts = one.where("code rlike '^[0-9]{2,}$'").select(*SCOPE, "code", F.explode(F.transform(F.sequence(F.lit(1), F.length("code") - 1), lambda n: F.col("code").substr(F.lit(1), n))).alias("_x"))
    prefix = cuts.join(codes, [*SCOPE, "_x"]).groupBy(*SCOPE, "code").agg(F.max_by("_x", F.length("_x")).alias("_prefix"))
    listed = Window.partitionBy(*SCOPE).orderBy("_o").rowsBetween(Window.unboundedPreceding, -1)
    tops = one.where("scheme = 'psic' and (code rlike '^[A-V]$' or code rlike '^[0-9]{2}$')")
    tops = tops.withColumn("_section", F.last(F.when(F.col("code").rlike("^[A-V]$"), F.col("code")), ignorenulls=True).over(listed)).where("code rlike '^[0-9]{2}$'").select(*SCOPE, "code", "_section")
    x = given.join(prefix, [*SCOPE, "code"], "left").join(tops, [*SCOPE, "code"], "left")
    parent = F.when(F.col("_there"), F.col("_p")).otherwise(F.coalesce("_prefix", "_section"))
    how = F.when(F.col("_there"), "given").when(F.col("_prefix").isNotNull(), "prefix").when(F.col("_section").isNotNull(), "section").otherwise("none")
    return x.select(*SCOPE, "code", parent.alias("parent"), how.alias("how"))


def complete_prefixes(nodes: DataFrame, scheme: str = "pscc") -> DataFrame:
    """(scheme, version, code, level): prefixes of listed codes, at the widths of the scheme, that are not
    listed themselves."""
    mine = nodes.where((F.col("scheme") == scheme) & F.col("code").rlike("^[0-9]+$")).select(*SCOPE, "code").distinct()
    cuts = F.transform(F.filter(F.array(*map(F.lit, WIDTHS[scheme])), lambda w: w < F.length("code")), lambda w: F.col("code").substr(F.lit(1), w))
    want = mine.select(*SCOPE, F.explode(cuts).alias("code")).distinct()
    return want.join(mine, [*SCOPE, "code"], "left_anti").withColumn("level", infer_level(F.col("scheme"), F.col("code")))


def from_matrix(cells: DataFrame, scheme: str, version: str) -> DataFrame:
    """Nodes of an official sheet whose row gives one code per level column and a description.

    cells: (sheet, row_no, col_no, value), columns in the order of the scheme's levels, text behind."""
    names = LEVELS[scheme]
    row = cells.where("trim(value) <> ''").groupBy("sheet", "row_no").agg(F.map_from_entries(F.collect_list(F.struct("col_no", F.trim("value")))).alias("m"))
    text = F.try_element_at("m", F.lit(len(names)))
    each = F.array(*[F.struct(F.lit(n).alias("level"), F.try_element_at("m", F.lit(i)).alias("code"), F.lit(i).alias("i")) for i, n in enumerate(names)])
    x = row.select("sheet", "row_no", text.alias("title"), F.posexplode(F.filter(each, lambda s: s["code"].isNotNull())).alias("p", "x"), each.alias("all"))
    fit = infer_level(F.lit(scheme), F.col("x.code")) == F.col("x.level")
    return x.where(fit).select(F.lit(scheme).alias("scheme"), F.lit(version).alias("version"), F.col("x.code").alias("code"), F.col("x.level").alias("level"), "title", "sheet", "row_no")
