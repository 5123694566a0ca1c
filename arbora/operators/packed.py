"""Several values packed in one field: one row per value, with its position.

Quoted spans become indexed placeholders between two private-use characters; those characters, where
the text itself has them, are first written as an escape, so no placeholder can collide with text. What
remains is split at delimiters, the spans are restored by array lookup, and the pieces are exploded
with their positions. All of it is built-in expressions, row by row: no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arbora.util import BLANKS, trimmed

OPEN, SHUT, ESCAPE = "\ue000", "\ue001", "\ue002"
#: What may stand before an opening quote and behind a closing one: an end, a bracket, a delimiter.
DELIMITERS = r",;|/&+:、，；｜／\n\r\t"
_BEFORE = rf"(?<![^\[({{{DELIMITERS}]{{1}})(?<![^\[({{{DELIMITERS} ] )"
_BEHIND = rf"(?={BLANKS}*+(?:$|[\])}}{DELIMITERS}]))"
#: A double-quoted span, with doubled or escaped quotes inside, or a single-quoted one.
QUOTED = rf'{_BEFORE}(?:"(?:[^"\\]|\\.|"")*+"|\'(?:[^\'\\]|\\.)*+\'){_BEHIND}'


def _escaped(x: Column) -> Column:
    for c, code in ((ESCAPE, "2"), (OPEN, "0"), (SHUT, "1")):
        x = F.replace(x, F.lit(c), F.lit(ESCAPE + code))
    return x


def _plain(x: Column) -> Column:
    for c, code in ((OPEN, "0"), (SHUT, "1"), (ESCAPE, "2")):
        x = F.replace(x, F.lit(ESCAPE + code), F.lit(c))
    return x


def let(x: Column, then: Callable[[Column], Column]) -> Column:
    """then(x) with x evaluated once, however often it is named there."""
    return F.element_at(F.transform(F.array(x), then), 1)


def _peeled(x: Column) -> Column:
    inner = lambda x, q: F.regexp_replace(F.regexp_replace(x, f"^{q}|{q}$", ""), r'\\(["\'\\])', "$1")
    return (
        F.when(x.rlike(r'(?s)^"(?:[^"\\]|\\.|"")*+"$'), F.replace(inner(x, '"'), F.lit('""'), F.lit('"')))
        .when(x.rlike(r"(?s)^'(?:[^'\\]|\\.)*+'$"), inner(x, "'"))
        .otherwise(x)
    )


def unquoted(x: Column) -> Column:
    """Without quotes around it, put on up to three times, and with inner quotes as they were."""
    for _ in range(3):
        x = let(trimmed(x), _peeled)
    return trimmed(x)


def _held(cell: Column, quoted: str) -> Column:
    """struct(spans, text): the quoted spans, and the text with their placeholders."""
    found = F.struct(F.regexp_extract_all(cell, F.lit(f"(?s)({quoted})"), 1).alias("spans"), F.split(cell, f"(?s){quoted}").alias("rest"))
    mark = lambda i, n: F.when(i < n, F.concat(F.lit(OPEN), i.cast("string"), F.lit(SHUT))).otherwise(F.lit(""))
    return let(found, lambda f: F.struct(f["spans"].alias("spans"), F.array_join(F.transform(f["rest"], lambda p, i: F.concat(_escaped(p), mark(i, F.size(f["spans"])))), "").alias("text")))


def _restored(piece: Column, spans: Column) -> Column:
    parts = F.split(piece, f"[{OPEN}{SHUT}]")  # text, index, text, index, ...
    return F.array_join(F.transform(parts, lambda p, i: F.when(i % 2 == 1, F.element_at(spans, p.try_cast("int") + 1)).otherwise(_plain(p))), "")


def split_packed(cell: Column, delimiters: str, quoted: str = QUOTED) -> Column:
    """array<string> of the pieces of a cell, quotes taken off, in order; blank pieces stay, so that a
    caller decides what holds a position. Null gives null."""
    return let(_held(cell, quoted), lambda h: F.transform(F.split(h["text"], delimiters), lambda p: unquoted(_restored(p, h["spans"]))))


#: Codes stand between anything but letters, digits, dots and the placeholders.
CODE_DELIMITERS = rf"(?i:{BLANKS}and{BLANKS})|[,;|/&+:、，；｜／]|{BLANKS}"


def packed_codes(cell: Column) -> Column:
    """Codes of a cell: digits, two or more, or one capital letter. Brackets around are taken off,
    counters such as ``1)`` and scores such as ``(0.33)`` are no codes."""
    bare = lambda x: F.regexp_replace(x, r"^[\[({]++|[\])}]++$", "")
    counters = F.regexp_replace(cell, rf"(?m)(^|[;,\s])\d{{1,3}}\)(?={BLANKS})", "$1")
    pieces = F.transform(split_packed(F.regexp_replace(counters, r"^\s*[\[{]|[\]}]\s*$", ""), CODE_DELIMITERS), lambda x: unquoted(bare(x)))
    return F.filter(pieces, lambda x: x.rlike(r"^(?:[0-9]{2,}|[A-Z])$"))


#: Delimiters of labels. Labels themselves hold commas, slashes and ampersands, so neighbouring pieces
#: are joined again where that gives a label of the list.
LABEL_DELIMITERS = r"[,;|/&+:、，；｜／\n\r\t]"


def packed_labels(rows: DataFrame, key: str, source: str, cell: str, labels: DataFrame) -> DataFrame:
    """(key, pos, item, n): the labels that a cell holds, in order, with how many they are.

    labels has (source, label). Each run of up to m pieces, with what stood between them, is looked up
    in the list by an equi-join, m following from the list (one more than the most delimiters in a
    label); a run inside a longer match is no value. Keys are unique; a null cell gives no rows."""
    listed = labels.select(F.col("source").alias("_source"), F.col("label").alias("_label")).distinct()
    most = listed.agg(F.max(F.size(F.split("_label", LABEL_DELIMITERS)))).first()[0] or 1
    x = F.regexp_replace(F.col(cell), rf"^{BLANKS}*+[\[{{(]|[\]}})]{BLANKS}*+$", "")
    parts = rows.where(F.col(cell).isNotNull()).select(F.col(key).alias("_key"), F.col(source).alias("_source"), _with_delimiters(x).alias("_parts"))
    parts = parts.where("size(_parts) > 0")
    # pieces stand at even places, delimiters between them at odd ones; a run covers pieces i .. i + k - 1
    runs = F.flatten(
        F.transform(
            F.sequence(F.lit(0), ((F.size("_parts") - 1) / 2).cast("int")),
            lambda i: F.transform(
                F.sequence(F.lit(1), F.least(F.lit(most), (F.size("_parts") + 1) / 2 - i).cast("int")),
                lambda k: F.struct(i.cast("int").alias("i"), k.alias("k"), unquoted(F.array_join(F.slice("_parts", (2 * i + 1).cast("int"), 2 * k - 1), "")).alias("item")),
            ),
        )
    )
    hits = parts.select("_key", "_source", F.explode(runs).alias("x")).select("_key", "_source", "x.i", "x.k", "x.item")
    hits = hits.join(listed.withColumnRenamed("_label", "item"), ["_source", "item"])
    inside = lambda a, b: (b.i <= a.i) & (b.i + b.k >= a.i + a.k) & (b.k > a.k)
    cells = hits.groupBy("_key").agg(F.array_sort(F.collect_list(F.struct("i", "k", "item"))).alias("_all"))
    cells = cells.select("_key", F.filter("_all", lambda a: ~F.exists("_all", lambda b: inside(a, b))).alias("_found"))
    return cells.select("_key", F.size("_found").alias("n"), F.posexplode("_found").alias("_pos", "_x")).select(F.col("_key").alias(key), (F.col("_pos") + 1).alias("pos"), F.col("_x.item").alias("item"), "n")


def _with_delimiters(x: Column) -> Column:
    """Pieces and the delimiters between them, in turn; quoted spans are one piece, kept by placeholders
    while the rest is split."""
    cut = lambda h: F.struct(h["spans"].alias("spans"), F.split(h["text"], LABEL_DELIMITERS).alias("pieces"), F.regexp_extract_all(h["text"], F.lit(f"({LABEL_DELIMITERS})"), 1).alias("between"))
    turn = lambda c: F.transform(c["pieces"], lambda p, i: F.when(i < F.size(c["between"]), F.array(_restored(p, c["spans"]), F.get(c["between"], i))).otherwise(F.array(_restored(p, c["spans"]))))
    return F.flatten(let(let(_held(x, QUOTED), cut), turn))


def audit_values(audit: DataFrame, reference: DataFrame) -> DataFrame:
    """(audit_id, field_name, pos, item) of the cells with two or more values."""
    labels = reference.where("kind = 'category'").select("source", "label")
    named = packed_labels(audit.select("audit_id", "source", "source_value"), "audit_id", "source", "source_value", labels)
    out = named.where("n > 1").select("audit_id", F.lit("source_value").alias("field_name"), "pos", "item")
    fields = F.array(*[F.struct(F.lit(c).alias("f"), packed_codes(F.col(c)).alias("v")) for c in ("suggested_codes", "candidate_codes")])
    codes = audit.select("audit_id", F.explode(fields).alias("x")).where(F.size("x.v") > 1)
    return out.unionByName(codes.select("audit_id", F.col("x.f").alias("field_name"), F.posexplode("x.v").alias("p", "item")).select("audit_id", "field_name", (F.col("p") + 1).alias("pos"), "item"))
