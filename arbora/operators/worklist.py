"""Worklists of labels: counted, merged with the reviews there are, and looked at across schemes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arbora.functions.text import joint_key
from arbora.operators.evidence import SOURCES

REVIEW = ["mapping_kind", "codes", "match_type", "confidence", "notes"]


def category_counts(places: DataFrame) -> DataFrame:
    """(source, source_value, row_count) of raw category labels, blanks left out."""
    cats = F.array(*[F.struct(F.lit(s).alias("source"), F.trim(f"{s}_category").alias("source_value")) for s in SOURCES])
    return places.select(F.explode(cats).alias("x")).select("x.*").where("source_value <> ''").groupBy("source", "source_value").agg(F.count("*").alias("row_count"))


def inspect(places: DataFrame) -> DataFrame:
    """(source, n_labels, n_rows): distinct labels and rows that have one."""
    return category_counts(places).groupBy("source").agg(F.count("*").alias("n_labels"), F.sum("row_count").alias("n_rows"))


def top_categories(places: DataFrame, n: int = 20) -> DataFrame:
    """The n most frequent labels of each source, ties by label."""
    from pyspark.sql import Window

    w = Window.partitionBy("source").orderBy(F.desc("row_count"), "source_value")
    return category_counts(places).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def init(places: DataFrame, releases: dict[str, str]) -> DataFrame:
    """One row per label and scheme: source, source_value, source_field, joint_key, row_count, row_share, scheme, version."""
    total = places.agg(F.count("*").alias("n")).first()[0]
    each = F.array(*[F.struct(F.lit(s).alias("scheme"), F.lit(v).alias("version")) for s, v in releases.items()])
    x = category_counts(places).withColumn("source_field", F.lit("category")).withColumn("joint_key", joint_key(F.col("source"), F.col("source_field"), F.col("source_value")))
    return x.select("source", "source_value", "source_field", "joint_key", "row_count", (F.col("row_count") / F.lit(float(max(1, total)))).alias("row_share"), F.explode(each).alias("x")).select("*", "x.*").drop("x")


def refresh(fresh: DataFrame, existing: DataFrame) -> DataFrame:
    """Fresh counts with the reviews of existing rows of the same label, scheme and version, the last
    row of several counting; labels that are gone stay, with no count. Blank reviews don't overwrite."""
    key = ["source", "source_value", "source_field", "scheme", "version"]
    blank = lambda c: F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))
    old = existing.withColumn("source_field", F.coalesce(blank("source_field"), F.lit("category"))).where(F.coalesce(*[blank(c) for c in REVIEW]).isNotNull() & F.col("source_value").isNotNull())
    old = old.groupBy(*key).agg(F.max_by(F.struct(*[blank(c).alias(c) for c in REVIEW]), "entry_id").alias("r"))
    x = fresh.select(*key, "row_count", "row_share").join(old, key, "full")
    return x.select(*key, joint_key(F.col("source"), F.col("source_field"), F.col("source_value")).alias("joint_key"), F.coalesce("row_count", F.lit(0)).alias("row_count"), F.coalesce("row_share", F.lit(0.0)).alias("row_share"), "r.*")


def peers(work: DataFrame, preferred: dict[str, str]) -> DataFrame:
    """(entry_id, peer_scheme, peer_id): for each row, of each other scheme, the row of the same label
    that was reviewed, else of the preferred version, else comes first. One aggregation per label and
    scheme; no row meets all others of its label."""
    key = ["worklist_id", "joint_key"]
    x = work.withColumn("joint_key", joint_key(F.col("source"), F.coalesce("source_field", F.lit("category")), F.col("source_value"))).where("worklist_id is not null")
    reviewed = F.trim("mapping_kind") != ""
    pref = F.concat_ws(":", "scheme", "version").isin([f"{s}:{v}" for s, v in preferred.items()])
    order = F.struct((~F.coalesce(reviewed, F.lit(False))).cast("int"), (~pref).cast("int"), "entry_id")
    best = x.groupBy(*key, F.col("scheme").alias("peer_scheme")).agg(F.min_by("entry_id", order).alias("peer_id"))
    return x.select(*key, "scheme", "entry_id").join(best, key).where("peer_scheme <> scheme").select("entry_id", "peer_scheme", "peer_id")


def coverage(work: DataFrame) -> DataFrame:
    """(scheme, version, n_rows, reviewed_rows, occurrences, reviewed_occurrences, coded_occurrences)."""
    kind, codes = F.upper(F.trim("mapping_kind")), F.trim("codes")
    reviewed, coded = F.coalesce(kind != "", F.lit(False)), F.coalesce(kind.isin("EXACT", "SUBTREE", "UNION", "CLASS") & (codes != ""), F.lit(False))
    n = F.coalesce("row_count", F.lit(0))
    part = lambda c: F.sum(F.when(c, n).otherwise(0))
    return work.groupBy("scheme", "version").agg(F.count("*").alias("n_rows"), F.sum(reviewed.cast("bigint")).alias("reviewed_rows"), F.sum(n).alias("occurrences"), part(reviewed).alias("reviewed_occurrences"), part(coded).alias("coded_occurrences"))
