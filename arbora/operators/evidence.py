"""Evidence of places: which label came from where, and which sources depend on each other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arbora.functions.text import as_float, clean_text, truthy
from arbora.util import Stage

SOURCES = ("fsq", "overture", "osm")
DEFAULT_RELEASES = {"psic": "rev5", "pcpc": "2002", "pscc": "2022"}


def _col(df: DataFrame, name: str, kind: str = "string") -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def evidence(places: DataFrame, key: str = "place_row") -> DataFrame:
    """(key, source_ord, field_ord, source, field, value, dep_group): one row per informative label.
    fsq and overture share a lineage where the flag says so. Missing columns count as null."""
    shared = truthy(_col(places, "overture_has_foursquare_provenance"))
    items = []
    for i, s in enumerate(SOURCES):
        group = F.when(shared, "fsq-lineage").otherwise(s) if s != "osm" else F.lit(s)
        for j, f in enumerate(("category", "name")):
            items.append(F.struct(F.lit(i).alias("source_ord"), F.lit(j).alias("field_ord"), F.lit(s).alias("source"), F.lit(f).alias("field"), clean_text(_col(places, f"{s}_{f}")).alias("value"), group.alias("dep_group")))
    return places.select(key, F.explode(F.array(*items)).alias("x")).select(key, "x.*").where("value is not null")


def labels(places: DataFrame) -> DataFrame:
    """(source, field, value): the distinct labels of evidence, each spelling cleaned once."""
    raw = F.array(*[F.struct(F.lit(s).alias("source"), F.lit(f).alias("field"), _col(places, f"{s}_{f}").alias("value")) for s in SOURCES for f in ("category", "name")])
    x = Stage(places.select(F.explode(raw).alias("x")).select("x.*").where("value is not null").distinct()).df  # else Spark cleans before distinct
    return x.withColumn("value", clean_text(F.col("value"))).where("value is not null").distinct()


def suspicion(places: DataFrame) -> Column:
    """Reasons to doubt that the sources mean one place."""
    flag = lambda c, name: F.when(F.coalesce(c, F.lit(False)), F.lit(name))
    return F.array_compact(
        F.array(
            flag(truthy(_col(places, "completed_transitively")), "ENTITY_MATCH_SUSPECT_TRANSITIVE"),
            flag(as_float(_col(places, "cluster_max_pair_distance_m", "double")) >= 80, "ENTITY_MATCH_SUSPECT_DISTANCE"),
            flag(as_float(_col(places, "match_score_min", "double")) < 0.85, "ENTITY_MATCH_SUSPECT_LOW_MATCH_SCORE"),
        )
    )


def contract(places: DataFrame) -> DataFrame:
    """(canonical_id, problem): rows that break the input's contract: blank ids and repeated ones."""
    x = places.select(F.trim("canonical_id").alias("canonical_id"))
    blank = x.where("coalesce(canonical_id, '') = ''").select("canonical_id", F.lit("blank").alias("problem"))
    twice = x.where("canonical_id <> ''").groupBy("canonical_id").count().where("count > 1").select("canonical_id", F.lit("repeated").alias("problem"))
    return blank.unionByName(twice)
