import json

import pytest

from arbora.operators import rowparse
from arbora.sources import files, pages, sinks
from arbora.streaming import arrivals


def test_pages():
    book = {"http://h/a": json.dumps({"results": [{"i": 1}], "next": "/b"}), "http://h/b": json.dumps([{"i": 2}])}
    assert [r["i"] for r in pages.pages("http://h/a", book.get)] == [1, 2]
    with pytest.raises(ValueError, match="twice"):
        list(pages.pages("http://h/a", lambda u: json.dumps({"results": [1], "next": "/a"})))
    with pytest.raises(ValueError, match="host"):
        list(pages.pages("http://h/a", lambda u: json.dumps({"results": [1], "next": "http://x/a"})))


def test_places_contract(spark, tmp_path):
    spark.createDataFrame([("a", "x"), ("a", "y"), (" ", "z")], "canonical_id string, fsq_name string").write.parquet(str(tmp_path / "p"))
    with pytest.raises(files.InputError, match="blank: 1 ids\nrepeated: 1 ids|repeated: 1 ids\nblank: 1 ids"):
        files.places(spark, str(tmp_path / "p"))


def test_taxonomy_and_rules_from_csv(spark, tmp_path):
    (tmp_path / "n.csv").write_text("scheme,version,code,level,title,parent_code\nPSIC,rev5,A,section,Other,\npsic,rev5,10,division,\"x, y\",A\n")
    got = {r.code: (r.scheme, r.title, r.parent_code) for r in files.taxonomy(spark, str(tmp_path / "n.csv")).collect()}
    assert got == {"A": ("psic", "Other", None), "10": ("psic", "x, y", "A")}
    (tmp_path / "c.csv").write_text("source,source_value,scheme,version,mapping_kind,codes,confidence\nfsq,None,psic,rev5,EXACT,10,0.5\n")
    r = files.crosswalks(spark, [str(tmp_path / "c.csv")]).first()
    assert (r.source_value, r.codes, r.confidence, r.match_type) == ("None", "10", 0.5, None)


def test_geo_metadata(spark, tmp_path):
    import pyarrow.parquet as pq

    spark.createDataFrame([(1, b"x")], "id int, geometry binary").coalesce(1).write.parquet(str(tmp_path / "g"))
    part = next(str(p) for p in (tmp_path / "g").iterdir() if p.suffix == ".parquet")
    assert sinks.geo_metadata(part, {"columns": {"geometry": {"encoding": "WKB", "covering": 1}}}, ["geometry"]) == "preserved"
    assert json.loads(pq.read_schema(part).metadata[b"geo"]) == {"columns": {"geometry": {"encoding": "WKB"}}}
    assert sinks.geo_metadata(part, {"columns": {}}, []) == "not_applicable" and sinks.geo_metadata("none", {}, []).startswith("failed:")


def test_stream_of_lines(spark, tmp_path):
    rows = [(1, "f", 1, "a,b"), (2, "f", 2, 'x"y'), (1, "f", 1, "a,b"), (3, "f", 3, ",".join(["x"] * 6 + ["EXACT", "1", "exact", "1", "", "name"]))]
    df = spark.createDataFrame(rows, "line_id long, file_name string, line_no long, raw_line string").selectExpr("*", "timestamp_ntz'2024-01-01' as received_at")
    df.write.parquet(str(tmp_path / "in"))
    arrivals.rejected_to(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination(60)
    want = {(r.line_id, r.reason) for r in rowparse.entry_lines(df).where("reason is not null").collect()}
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {(r.line_id, r.reason) for r in got} == want and len(got) == 2
