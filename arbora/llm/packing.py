"""Texts into containers of fixed capacity, by sum-of-squares packing.

Texts larger than a container are cut into full ones and a rest; nothing else is cut. Items are dealt
by a hash of their key over shards of about ``SHARD`` items, so that every shard is the same mixture
and no task grows with the corpus. A shard keeps only N[g], how many of its open containers have a gap
of g tokens, and puts each item where the sum of the squares of N becomes smallest, opening a new
container if that is the best place. The containers a shard leaves open are its only loss; they are
packed among each other once more, as whole items, over all shards together in shards of that size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arbora.util import Stage

CAPACITY = 2048
#: Items of one task, on average.
SHARD = 40_000


def sum_of_squares(sizes: list[int], capacity: int) -> list[int]:
    """The container of each item, in the order given. Every size is from 1 to capacity."""
    n = np.zeros(capacity + 1, dtype=np.int64)  # n[g]: open containers with a gap of g
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    out, made = [], 0
    far = np.iinfo(np.int64).max
    for s in sizes:
        # into a gap g: n[g] - 1 and n[g - s] + 1, where a gap of 0 isn't counted; costs halved, less 1
        cost = n[: capacity + 1 - s] - n[s:]
        cost[0] = -n[s] - 1  # fills it: nothing is added, so the sum falls by 2 n[s] - 1
        cost = np.where(n[s:] > 0, cost, far)
        k = int(cost.argmin())
        fresh = n[capacity - s] if s < capacity else -1
        # opening adds n[capacity - s] only
        if cost[k] == far or fresh < cost[k] + 1:
            c, made, gap = made, made + 1, capacity - s
        else:
            n[k + s] -= 1
            c, gap = stacks[k + s].pop(), k
        if gap:
            n[gap] += 1
            stacks[gap].append(c)
        out.append(c)
    return out


def _pack(capacity: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        some = frame[frame["size"] > 0].sort_values("rank", kind="stable")
        bins = pd.Series(sum_of_squares(some["size"].tolist(), capacity), index=some.index, dtype="int64")
        return pd.DataFrame({"id": frame["id"], "piece": frame["piece"], "size": frame["size"], "shard": frame["shard"], "bin": bins.reindex(frame.index, fill_value=0).astype("int64")})

    return run


def _shards(items: DataFrame, n: int, capacity: int, seed: int) -> DataFrame:
    h = F.xxhash64(F.lit(seed), "id", "piece")
    dealt = items.select("id", "piece", "size", F.pmod(h, F.lit(n)).alias("shard"), F.xxhash64(F.lit(seed + 1), "id", "piece").alias("rank"))
    kind = dict(items.dtypes)["id"]
    return dealt.groupBy("shard").applyInPandas(_pack(capacity), f"id {kind}, piece int, size int, shard bigint, bin bigint")


def pack(sizes: DataFrame, key: str, size: str, capacity: int = CAPACITY, shard: int = SHARD) -> DataFrame:
    """(key, piece, n_tokens, container): every item, cut only where it is larger than a container.

    piece counts from 0. Items of null or no size take no room and go with the first container of their
    shard. Keys must be unique; an empty table gives no rows."""
    s = F.coalesce(F.col(size).cast("int"), F.lit(0))
    cut = sizes.select(F.col(key).alias("id"), F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(s / capacity).cast("int") - 1, F.lit(0)))).alias("piece"), s.alias("s"))
    items = Stage(cut.select("id", "piece", F.least(F.lit(capacity), F.col("s") - F.col("piece") * capacity).alias("size"))).df
    n = max(1, -(-items.count() // shard))
    first = Stage(_shards(items, n, capacity, 7)).df
    fill = first.groupBy("shard", "bin").agg(F.sum("size").cast("int").alias("size"))
    # what the shards left open, packed once more as whole items
    left = Stage(fill.where((F.col("size") > 0) & (F.col("size") < capacity)).select(F.struct("shard", "bin").alias("id"), F.lit(0).alias("piece"), "size")).df
    again = _shards(left, max(1, -(-left.count() // shard)), capacity, 11)
    moved = again.select(F.col("id.shard").alias("shard"), F.col("id.bin").alias("bin"), F.concat_ws("-", F.lit("r"), F.col("shard"), F.col("bin")).alias("_to"))
    out = first.join(moved, ["shard", "bin"], "left")
    return out.select(F.col("id").alias(key), "piece", F.col("size").alias("n_tokens"), F.coalesce("_to", F.concat_ws("-", F.lit("c"), "shard", "bin")).alias("container"))
