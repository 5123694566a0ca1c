import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("OFF")
    yield s
    s.stop()


#: A small forest: two sections, the first with three levels of branching below.
TOY = [
    ("A", "section", None), ("10", "division", "A"), ("101", "group", "10"), ("1011", "class", "101"), ("10111", "subclass", "1011"), ("10112", "subclass", "1011"), ("102", "group", "10"),
    ("1021", "class", "102"), ("10210", "subclass", "1021"), ("B", "section", None), ("20", "division", "B"), ("201", "group", "20"), ("2011", "class", "201"), ("20110", "subclass", "2011"),
]


@pytest.fixture(scope="session")
def toy_nodes(spark):
    rows = [(i, s, v, c, lv, f"Title {c}", p, "", "", "") for s, v in (("psic", "rev5"), ("pcpc", "2002")) for i, (c, lv, p) in enumerate(TOY)]
    return spark.createDataFrame(rows, "node_id long, scheme string, version string, code string, level string, title string, parent_code string, description string, includes string, excludes string").cache()


@pytest.fixture(scope="session")
def toy_tree(toy_nodes):
    from arbora.operators import tree

    return tree.prepare(toy_nodes).cache()
