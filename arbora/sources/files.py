"""Readers that declare their types and report everything wrong with a file at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arbora.operators import evidence

NODE_COLUMNS = ("scheme", "version", "code", "level", "title", "parent_code")
TEXT_COLUMNS = ("description", "includes", "excludes", "source_url")


class InputError(ValueError):
    """All problems of an input, one per line."""


def places(spark: SparkSession, path: str, id_column: str = "canonical_id") -> DataFrame:
    """Places from Parquet: an id column that is never blank and never repeated, and at least one label column."""
    df = spark.read.parquet(path)
    wrong = [] if id_column in df.columns else [f"no column {id_column}"]
    if not any(f"{s}_{f}" in df.columns for s in evidence.SOURCES for f in ("category", "name")):
        wrong.append("no label column")
    if not wrong:
        df = df.withColumn(id_column, F.col(id_column).cast("string"))
        wrong = [f"{r.problem}: {r.n} ids" for r in evidence.contract(df.withColumnRenamed(id_column, "canonical_id")).groupBy("problem").agg(F.count("*").alias("n")).collect()]
    if wrong:
        raise InputError("\n".join(wrong))
    return df


def taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """Nodes from Parquet or CSV, all text; blank parents are null."""
    df = spark.read.csv(path, header=True, inferSchema=False, multiLine=True, escape='"') if path.endswith(".csv") else spark.read.parquet(path)
    if lost := [c for c in NODE_COLUMNS if c not in df.columns]:
        raise InputError("\n".join(f"no column {c}" for c in lost))
    cols = [F.col(c).cast("string").alias(c) if c in df.columns else F.lit("").alias(c) for c in (*NODE_COLUMNS, *TEXT_COLUMNS)]
    order = F.col("node_id") if "node_id" in df.columns else F.monotonically_increasing_id().alias("node_id")
    out = df.select(order, *cols)
    return out.withColumn("scheme", F.lower("scheme")).withColumn("parent_code", F.nullif(F.trim("parent_code"), F.lit("")))


def crosswalks(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Review files as entries; entry_id keeps the order of files and lines. Text such as None stays text."""
    df = spark.read.csv(paths, header=True, inferSchema=False, multiLine=True, escape='"', enforceSchema=False)
    want = ("source", "source_value", "scheme", "version", "mapping_kind", "codes", "match_type", "confidence", "notes", "source_field", "unit_type", "establishment_status", "io_roles")
    cols = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in want]
    return df.select(F.monotonically_increasing_id().alias("entry_id"), *cols).withColumn("confidence", F.col("confidence").try_cast("double"))


def gold(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, inferSchema=False) if path.endswith(".csv") else spark.read.parquet(path)
