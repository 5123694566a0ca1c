"""Records that differ only in formatting, collapsed and counted.

Each record becomes a multiset of (field name, normalized value) pairs. Every pair is hashed and the
hashes are added, which does not depend on order, so no field or part is ever sorted: equal multisets
have equal sums, twice over with two hash functions. Records group by that fingerprint; each is then
compared with its group's first record pair by pair (equal counts of every pair, again without
sorting). Where that comparison fails, two different records share a fingerprint, and the group falls
back to the exact text of its sorted pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arbora.util import trimmed


def letters_and_digits(x: Column) -> Column:
    return F.regexp_replace(F.lower(F.upper(x)), r"[^\p{L}\p{N}]", "")


def parts(x: Column, delimiters: str, normal) -> Column:
    """Normalized parts of a value without empty ones; null as none."""
    return F.filter(F.transform(F.split(F.coalesce(x, F.lit("")), delimiters), normal), lambda p: p != "")


def _sum(pairs: Column, seed: int) -> Column:
    # modulo 2^61 - 1 so that long multisets can't overflow
    return F.aggregate(pairs, F.lit(0).cast("long"), lambda a, p: F.pmod(a + F.pmod(F.xxhash64(F.lit(seed), p), F.lit((1 << 61) - 1)), F.lit((1 << 61) - 1)))


def same_multiset(a: Column, b: Column) -> Column:
    """Equal counts of every element, without sorting."""
    n = lambda xs, x: F.size(F.filter(xs, lambda y: y == x))
    return (F.size(a) == F.size(b)) & F.forall(F.array_distinct(a), lambda x: n(a, x) == n(b, x))


def collapse(rows: DataFrame, key: str, pairs: Column) -> DataFrame:
    """(keep_id, copy_id): every record that equals an earlier one, with the smallest key of its like.

    ``pairs`` is an array<string> of field-value pairs. The group's first key is a partially aggregated
    minimum, so a group may be any share of all rows."""
    x = rows.select(F.col(key).alias("_id"), pairs.alias("_pairs"))
    x = x.withColumn("_f1", _sum(F.col("_pairs"), 1)).withColumn("_f2", _sum(F.col("_pairs"), 2))
    groups = x.groupBy("_f1", "_f2").agg(F.min("_id").alias("_keep"), F.count("*").alias("_n")).where("_n > 1")
    firsts = groups.join(x.select(F.col("_id").alias("_keep"), F.col("_pairs").alias("_want")), "_keep").select("_f1", "_f2", "_keep", "_want")
    judged = x.join(firsts, ["_f1", "_f2"]).where("_id <> _keep").withColumn("_same", same_multiset(F.col("_pairs"), F.col("_want")))
    sure = judged.where("_same").select(F.col("_keep").alias("keep_id"), F.col("_id").alias("copy_id"))
    # records that only share a fingerprint: grouped by what they hold
    odd = judged.where("not _same").select("_id", F.to_json(F.array_sort("_pairs")).alias("_text"))
    first = odd.groupBy("_text").agg(F.min("_id").alias("_keep"))
    exact = odd.join(first, "_text").where("_id <> _keep").select(F.col("_keep").alias("keep_id"), F.col("_id").alias("copy_id"))
    return sure.unionByName(exact)


#: Commas, semicolons and bars of any width.
PARTS = r"[,;|，；｜、﹐﹔︔︐︱❘∣¦]"


def entry_pairs() -> Column:
    """Pairs of a crosswalk entry that make it the same record."""
    plain = [F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{c}="), F.col(c).cast("string"))) for c in ("worklist_id", "scheme", "version", "mapping_kind", "match_type", "source_field")]
    source = F.concat(F.lit("source="), letters_and_digits(F.coalesce("source", F.lit(""))))
    tagged = lambda name, xs: F.transform(xs, lambda p: F.concat(F.lit(f"{name}="), p))
    return F.concat(
        F.array_compact(F.array(*plain, source)),
        tagged("source_value", parts(F.col("source_value"), PARTS, letters_and_digits)),
        tagged("codes", parts(F.col("codes"), r"\|", trimmed)),
    )


def entry_copies(entries: DataFrame) -> DataFrame:
    """(keep_id, copy_id) of crosswalk entries with a non-blank source_value. A row without an
    entry_id can be neither kept nor named and is left out; empty tables give no rows."""
    return collapse(entries.where(F.col("entry_id").isNotNull() & (trimmed(F.col("source_value")) != "")), "entry_id", entry_pairs())


def entry_records(entries: DataFrame) -> DataFrame:
    """(entry_id, copies): one row per distinct record, copies counting itself."""
    ids = entries.where(F.col("entry_id").isNotNull() & (trimmed(F.col("source_value")) != "")).select("entry_id")
    pairs = entry_copies(entries)
    n = pairs.groupBy(F.col("keep_id").alias("entry_id")).agg(F.count("*").alias("n"))
    kept = ids.join(pairs.select(F.col("copy_id").alias("entry_id")), "entry_id", "left_anti")
    return kept.join(n, "entry_id", "left").select("entry_id", (F.coalesce("n", F.lit(0)) + 1).cast("bigint").alias("copies"))
