"""Consensus of several walks down a tree, and a walker with a pluggable model."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def consensus(paths: DataFrame, key: str) -> DataFrame:
    """(key, code, agreement, flags): the deepest code on a majority of a row's paths.

    paths: (key, pass_no, path array from the root down; empty where a walk gave up)."""
    n = paths.groupBy(key).agg(F.count("*").alias("n"), F.max(F.size("path")).alias("longest"))
    votes = paths.select(key, F.posexplode("path").alias("i", "code")).groupBy(key, "code").agg(F.count("*").alias("votes"), F.max("i").alias("i"))
    won = votes.join(n, key).where(F.col("votes") >= F.floor(F.col("n") / 2) + 1).groupBy(key).agg(F.max_by(F.struct("code", "votes"), F.struct("i", "code")).alias("w"))
    x = n.join(won, key, "left")
    flags = F.array_compact(F.array(F.when(F.col("w").isNull(), F.when(F.col("longest") == 0, "INSUFFICIENT_AT_ROOT").otherwise("NO_CONSENSUS"))))
    return x.select(key, F.col("w.code").alias("code"), F.round(F.col("w.votes") / F.col("n"), 6).alias("agreement"), F.array_join(flags, "|").alias("flags"))


def lenient_json(reply: str) -> dict:
    """The first object in a reply, whatever stands around it; an empty one if there is none."""
    for m in re.finditer(r"\{.*?\}|\{.*\}", reply or "", re.S):
        try:
            out = json.loads(m.group())
        except ValueError:
            continue
        if isinstance(out, dict):
            return out
    return {}


def descend(children: dict[str | None, list[str]], ask: Callable[[str, list[str], int], str], text: str, passes: int = 3) -> list[list[str]]:
    """The paths of some passes. A decision is a child, STOP_HERE, INSUFFICIENT (takes the last step
    back) or anything else, which ends the walk."""
    out = []
    for n in range(passes):
        path: list[str] = []
        while options := children.get(path[-1] if path else None):
            said = lenient_json(ask(text, options, n)).get("decision")
            if said in options:
                path.append(said)
                continue
            if said == "INSUFFICIENT" and path:
                path.pop()
            break
        out.append(path)
    return out


def walk(rows: DataFrame, key: str, text: str, children: dict[str | None, list[str]], ask: Callable[[str, list[str], int], str], passes: int = 3) -> DataFrame:
    """(key, pass_no, path): the walks of every row, by Arrow batches; ``children`` is one release's tree."""
    kind = dict(rows.dtypes)[key]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            made = [(k, i, p) for k, t in zip(f[key], f[text]) for i, p in enumerate(descend(children, ask, t or "", passes))]
            yield pd.DataFrame(made, columns=[key, "pass_no", "path"])

    return rows.select(key, text).mapInPandas(run, f"{key} {kind}, pass_no int, path array<string>")
