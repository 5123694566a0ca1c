"""Small helpers shared by the operators: loading, lineage cuts, null-safe scope keys."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space as Unicode has it, for Java regular expressions.
BLANKS = r"[\s\p{Z}\x{1c}-\x{1f}\x{85}]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trimmed(col: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(col, rf"^{BLANKS}++|{BLANKS}++$", "")


def blank_to_null(col: Column) -> Column:
    t = trimmed(col)
    return F.when(t != "", t)


def scope_key(cols: Iterable[str]) -> Column:
    """One never-null string for a tuple of columns; nulls equal each other."""
    return F.to_json(F.struct(*[F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(cols)]))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share. Only where the session names none (tests) is one made."""
    sc = spark.sparkContext
    if (at := sc.getCheckpointDir()) is None:
        at = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="arbora-")
        sc.setCheckpointDir(at)
        at = sc.getCheckpointDir()
    return at


class Stage:
    """A table written to the shared folder and read back: the lineage is cut, the plan runs once,
    and the loss of an executor costs nothing. ``drop()`` removes the files."""

    def __init__(self, df: DataFrame, parts: int | None = None):
        self.spark = df.sparkSession
        self.path = f"{shared_dir(self.spark)}/stage-{uuid.uuid4().hex}"
        (df.coalesce(parts) if parts else df).write.parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.path)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)


def new_name(df: DataFrame, stem: str) -> str:
    """A column name that no column of df has, in any case."""
    have = {c.lower() for c in df.columns}
    while stem.lower() in have:
        stem += "_"
    return stem
