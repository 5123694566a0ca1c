import random
import re
from datetime import datetime as D

import pytest

from arbora.operators import orphans as o
from arbora.operators import rowparse as r


def test_orphans_by_time(spark):
    parents = spark.createDataFrame(
        [("a", D(2024, 1, 1), None), ("b", D(2024, 1, 1), D(2024, 2, 1)), ("b", D(2024, 3, 1), None), ("c", D(2024, 6, 1), None), ("d", None, None), (None, D(2024, 1, 1), None)], "k string, born timestamp_ntz, gone timestamp_ntz"
    )
    refs = [(1, "a", D(2024, 1, 1)), (2, "b", D(2024, 2, 1)), (3, "b", D(2024, 1, 31)), (4, "b", D(2024, 4, 1)), (5, "c", D(2024, 5, 1)), (6, "zz", D(2024, 5, 1)), (7, "c", None), (8, "zz", None), (9, "d", D(1990, 1, 1)), (10, None, D(2024, 1, 1)), (6, "zz", D(2024, 5, 1))]
    df = spark.createDataFrame([(*x, "clash") for x in refs], "id int, k string, at timestamp_ntz, _first string")
    got = sorted((x.id, x.reason) for x in o.orphans(df.drop("_first"), parents, ["k"], "at", "born", "gone").collect())
    assert got == [(2, "deleted"), (5, "late"), (6, "missing"), (6, "missing"), (8, "missing"), (10, "missing")]


def test_orphans_of_empty_tables(spark):
    parents = spark.createDataFrame([], "k string, born timestamp_ntz, gone timestamp_ntz")
    refs = spark.createDataFrame([(1, "a", D(2024, 1, 1))], "id int, k string, at timestamp_ntz")
    assert [x.reason for x in o.orphans(refs, parents, ["k"], "at", "born", "gone").collect()] == ["missing"]
    assert o.orphans(refs.limit(0), parents, ["k"], "at", "born", "gone").count() == 0


def automaton(v):
    """Character by character: the fields, or None for broken quoting."""
    fields, i = [], 0
    while True:
        if v[i : i + 1] == '"':
            j, buf = i + 1, ""
            while True:
                if j >= len(v):
                    return None
                if v[j] == '"':
                    if v[j + 1 : j + 2] == '"':
                        buf, j = buf + '"', j + 2
                        continue
                    break
                buf, j = buf + v[j], j + 1
            j += 1
            if j < len(v) and v[j] != ",":
                return None
        else:
            j = v.find(",", i)
            j = len(v) if j < 0 else j
            buf = v[i:j]
            if '"' in buf:
                return None
        fields.append(buf)
        if j >= len(v):
            return fields
        i = j + 1


def reason(v):
    f = automaton(v or "")
    if f is None:
        return "quoting"
    f = [x.strip() for x in f]
    if len(f) != 12:
        return "columns"
    if f[6].upper() not in ("", *r.KINDS.split("|")):
        return "mapping_kind"
    if f[9] and not (re.fullmatch(r"[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?", f[9], re.A | re.I) and 0 <= float(f[9]) <= 1):
        return "confidence"
    return None if f[11].lower() in ("", "category", "name") else "source_field"


def test_rows_against_an_automaton(spark):
    rnd = random.Random(3)
    bits = ["a", '"', ",", " ", "\n", '""', '"x,y"', "EXACT", "0.5", "name", "é"]
    lines = ["".join(rnd.choice(bits) for _ in range(rnd.randrange(30))) for _ in range(400)]
    good = ["osm", '"a, ""b"""', "1", "0.1", "psic", "rev5", " exact ", "12", "exact", "1e-1", '"x\ny"', "Category"]
    for i, alternatives in ((6, ["", "Class", "EXCAT", '" union "', "EXACT;UNION"]), (9, ["", "1", "1.0", "1.1", "-0", "9E-1", "1e400", "NaN", "٣", "0x1", "+.5", "5."]), (11, ["", "name ", "names", '"Name"'])):
        lines += [",".join(good[:i] + [x] + good[i + 1 :]) for x in alternatives]
    lines += [None, "", "   ", ",".join(good), ",".join(good) + ",", "x" * 300000, '"' + "y" * 300000, '""' * 100000]
    df = spark.createDataFrame(list(enumerate(lines)), "line_id int, raw_line string").withColumnRenamed("line_id", "id")
    got = {x.id: (x.reason, x["values"]) for x in r.entry_lines(df).collect()}
    for i, v in enumerate(lines):
        assert got[i][0] == reason(v), v and v[:200]
        if got[i][0] is None:
            assert got[i][1] == [x.strip() or None for x in automaton(v)]


@pytest.mark.parametrize("n", [0, 1])
def test_loading(spark, n):
    df = spark.createDataFrame([(7, 'osm,x,3,0.5,psic,rev5,class,"1|2",exact,1,,NAME')][:n], "line_id int, raw_line string")
    out = r.loaded_entries(df).collect()
    assert [(x.line_id, x.row_count, x.row_share, x.mapping_kind, x.codes, x.confidence, x.notes, x.source_field) for x in out] == [(7, 3, 0.5, "CLASS", "1|2", 1.0, None, "name")][:n]
