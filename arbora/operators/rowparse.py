"""Delimited text rows that fail to parse, with the first thing that is wrong.

A schema is a list of fields, each with a pattern for its trimmed value in any case. From it comes one
anchored pattern for whole rows, which nearly all rows pass; only failures meet the second set, patterns
for ever longer prefixes of fields, of which the first that fails names the broken field. Quantifiers
are possessive, so a row is read once however long it is.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arbora.util import BLANKS, trimmed

#: A field of any content: wrapped in quotes, a quote within doubled, or free of quotes and commas.
ANY = r'(?:"[^"]*+(?:""[^"]*+)*+"|[^",]*+)'


@dataclass(frozen=True)
class Field:
    name: str
    #: Pattern of a valid value, without blanks around it; None takes any. Blank values always pass.
    value: str | None = None


#: A plain or scientific decimal number from 0 to 1; exponents are checked by value behind the pattern.
UNIT = r"[+-]?(?:[0-9]++(?:\.[0-9]*+)?|\.[0-9]++)(?:e[+-]?[0-9]++)?"
KINDS = "EXACT|SUBTREE|UNION|NOT_ACTIVITY|UNCODEABLE|CLASS"
ENTRY_FIELDS = [
    *[Field(n) for n in ("source", "source_value", "row_count", "row_share", "scheme", "version")],
    Field("mapping_kind", KINDS), Field("codes"), Field("match_type"), Field("confidence", UNIT), Field("notes"), Field("source_field", "category|name"),
]


def _field(f: Field) -> str:
    if f.value is None:
        return ANY
    b = f"{BLANKS}*+"
    return f'(?:"{b}(?:{f.value})?{b}"|{b}(?:{f.value})?{b})'


def row_pattern(fields: list[Field]) -> str:
    return "(?si)^" + ",".join(map(_field, fields)) + r"\z"


def prefix_pattern(fields: list[Field], k: int) -> str:
    """Rows of the right shape whose first k + 1 fields are valid."""
    shape = [_field(f) if i <= k else ANY for i, f in enumerate(fields)]
    return "(?si)^" + ",".join(shape) + r"\z"


def parse_rows(lines: DataFrame, line: str, fields: list[Field], ranges: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """lines + reason (null if valid) + values, the array of trimmed field texts of valid rows, null where blank.

    reason is ``quoting``, ``columns`` or the name of the first broken field; ``ranges`` bounds numeric
    fields. Null and blank lines fail by their columns."""
    x = F.coalesce(F.col(line), F.lit(""))
    n = len(fields)
    reason: Column = F.when(~x.rlike(f"(?s)^{ANY}(?:,{ANY})*+\\z"), "quoting").when(~x.rlike(f"(?s)^{ANY}(?:,{ANY}){{{n - 1}}}\\z"), "columns")
    number = lambda i: F.get(_values(x), i).try_cast("double")
    for i, f in enumerate(fields):
        if f.value is not None:
            bad = ~x.rlike(prefix_pattern(fields, i))
            if f.name in (ranges or {}):
                lo, hi = ranges[f.name]
                bad = bad | (F.get(_values(x), i).isNotNull() & ~F.coalesce(number(i).between(lo, hi), F.lit(False)))
            reason = reason.when(bad, f.name)
    whole = x.rlike(row_pattern(fields))
    for name, (lo, hi) in (ranges or {}).items():
        i = [f.name for f in fields].index(name)
        whole = whole & (F.get(_values(x), i).isNull() | F.coalesce(number(i).between(lo, hi), F.lit(False)))
    return lines.withColumn("reason", F.when(~whole, reason)).withColumn("values", F.when(F.col("reason").isNull(), _values(x)))


def _values(x: Column) -> Column:
    """Texts of the fields of a well-quoted row, trimmed, quotes taken off, blank ones null."""
    raw = F.regexp_extract_all(x, F.lit(f"(?s)(?:^|,)({ANY})"), 1)
    bare = lambda v: F.when(v.startswith('"'), F.replace(v.substr(F.lit(2), F.length(v) - 2), F.lit('""'), F.lit('"'))).otherwise(v)
    return F.transform(raw, lambda v: F.nullif(trimmed(bare(v)), F.lit("")))


def entry_lines(lines: DataFrame) -> DataFrame:
    return parse_rows(lines, "raw_line", ENTRY_FIELDS, {"confidence": (0.0, 1.0)})


def loaded_entries(lines: DataFrame) -> DataFrame:
    """(line_id, the twelve fields): the valid rows, typed; CLASS stays as written but in upper case."""
    v = lambda i: F.get("values", i)
    typed = {"row_count": "bigint", "row_share": "double", "confidence": "double"}
    shaped = {"mapping_kind": F.upper, "source_field": F.lower}
    cols = [(v(i).try_cast(typed[f.name]) if f.name in typed else shaped.get(f.name, lambda c: c)(v(i))).alias(f.name) for i, f in enumerate(ENTRY_FIELDS)]
    return entry_lines(lines).where("reason is null").select("line_id", *cols)
