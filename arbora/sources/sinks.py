"""Results as files: facts with JSON lists, the summary, its geometry metadata and a manifest."""

from __future__ import annotations

import json
from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arbora.operators.classify import stored


def write_facts(facts: DataFrame, path: str) -> None:
    """One row per place and scheme; well-formed when empty, as the types are those of the plan."""
    stored(facts).write.mode("overwrite").parquet(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", order: list[str] | None = None) -> None:
    """Parquet or CSV; CSV is one file with a header, in the order asked for."""
    if fmt == "csv":
        (df.orderBy(*order) if order else df).coalesce(1).write.mode("overwrite").csv(path, header=True, escape='"')
    else:
        df.write.mode("overwrite").parquet(path)


def worklist_order() -> list:
    return [F.desc("row_count"), "source", "source_value", "joint_key", "scheme", "version"]


def geo_metadata(part: str, geo: dict, keep: list[str]) -> str:
    """Puts the geo footer on a written Parquet part, for the columns it kept; says how it went."""
    try:
        import pyarrow.parquet as pq

        t = pq.read_table(part)
        columns = {c: {k: v for k, v in m.items() if k != "covering"} for c, m in geo.get("columns", {}).items() if c in keep}
        if not columns:
            return "not_applicable"
        meta = {**(t.schema.metadata or {}), b"geo": json.dumps({**geo, "columns": columns}, sort_keys=True).encode()}
        pq.write_table(t.replace_schema_metadata(meta), part, compression="zstd")
        return "preserved"
    except Exception as e:  # noqa: BLE001
        return f"failed:{type(e).__name__}"


def manifest(facts: DataFrame, inputs: dict[str, str], outputs: dict[str, str]) -> dict:
    """Counts by scheme and status, from one small aggregate."""
    counts: dict[str, dict[str, int]] = {}
    for r in facts.groupBy("scheme", "status").count().collect():
        counts.setdefault(r.scheme, {})[r.status] = r["count"]
    return {"created_at": datetime.now(UTC).isoformat(), "inputs": inputs, "outputs": outputs, "schemes": counts}
