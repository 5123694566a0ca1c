import pytest
from pyspark.sql import functions as F

from arbora.operators import packed as p

LABELS = ["Trade > Plywood Nursery", "Eating, Drinking > Stall", "Trade > Food & Feed > Maker's Cabin", "Trade > Saddle \"Old Town\" Studio", "Travel/Transport > Bus", "Bus"]
A, B, C, D, E, X = LABELS


@pytest.mark.parametrize(
    ("cell", "want"),
    [
        (f"{A}, {B}", [A, B]), (f"{A};{B}|{C}", [A, B, C]), (f'["{A}", "{B}"]', [A, B]), (f"['{A}', \"{C}\"]", [A, C]), (f'"{A}","{D}"'.replace('"Old Town"', '""Old Town""'), [A, D]),
        (f'["{A}", "{D}"]'.replace('"Old Town"', '\\"Old Town\\"'), [A, D]), (f"{A}\n{B}\n{A}", [A, B, A]), (f"{E} / {X}", [E, X]), (f"{C} & {A}", [C, A]), (f"{D}; {A}", [D, A]), (f"{A} | | rubbish | {B}", [A, B]),
        (f"'{A}';'{B}'", [A, B]), (A, [A]), ("", []), ("nothing here, at all", []), (None, []), (f"0, {A}, {B}", [A, B]), ("x, " * 20000 + A + ", " + B, [A, B]),
    ],
)
def test_labels(spark, cell, want):
    rows = spark.createDataFrame([(1, "fsq", cell, "clash")], "id int, source string, cell string, pos string")
    labels = spark.createDataFrame([("fsq", x) for x in LABELS], "source string, label string")
    got = p.packed_labels(rows, "id", "source", "cell", labels).orderBy("pos").collect()
    assert [r.item for r in got] == want and [r.pos for r in got] == list(range(1, len(want) + 1)) and all(r.n == len(want) for r in got)


@pytest.mark.parametrize(
    ("cell", "want"),
    [
        ("12|345", ["12", "345"]), (" 12 ; 9 ; A", ["12", "A"]), ('"12", """34"""', ["12", "34"]), ("['12', '34']", ["12", "34"]), ("{12,34}", ["12", "34"]), ("12 (0.33), 34 (0.9)", ["12", "34"]),
        ("1) 12\n2) 34", ["12", "34"]), ("1) 12; 2) 34", ["12", "34"]), ("12 and 34", ["12", "34"]), ("(12) (34)", ["12", "34"]), ("12|-|n/a|34", ["12", "34"]), ("12、34｜56", ["12", "34", "56"]), ("12:34:A", ["12", "34", "A"]),
        ("12\r\n34", ["12", "34"]), ("12|12", ["12", "12"]), ("-", []), ("", []), (None, None),
    ],
)
def test_codes(spark, cell, want):
    assert spark.createDataFrame([(cell,)], "c string").select(p.packed_codes(F.col("c")).alias("v")).first().v == want


def test_empty_tables(spark):
    rows = spark.createDataFrame([], "id int, source string, cell string")
    assert p.packed_labels(rows, "id", "source", "cell", spark.createDataFrame([], "source string, label string")).count() == 0
