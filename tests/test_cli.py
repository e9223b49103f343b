import json

import pytest

from ledgerlight import cli
from ledgerlight.functions import normalize as nz
from ledgerlight.functions import scorers
from ledgerlight.operators import build, evaluate
from ledgerlight.plans import synthetic
from pyspark.sql import functions as F


def lines(spark, *argv):
    return cli.run(spark, cli.parser().parse_args([str(a) for a in argv]))


@pytest.fixture()
def place(tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw/A001.csv").write_text("N,A001,Oak,1,1,7,ASHA,DEVI,MOHAN,,F,41,F\nN,A001,Oak,1,2,7,BALA,,MOHAN,,F,4x,M\n")
    (tmp_path / "areas.json").write_text(json.dumps([{"ac_code": "A001", "ac_name": "OAK", "district": "N", "total_parts": 1, "id": 5}]))
    return tmp_path


def test_build_search_audit(spark, place):
    build_it = ["build", "karnataka", place / "raw", place / "out", "--areas", place / "areas.json"]
    assert lines(spark, *build_it) == ["karnataka/A001"] and lines(spark, *build_it) == ["Nothing to do."]
    with pytest.raises(SystemExit, match="A009"):
        lines(spark, *build_it, "--ac", "A009")
    table = build.table_path(str(place / "out"))
    assert lines(spark, "search", table, "--name", "asha devi")[0].startswith("[100.0] ASHA DEVI (Father: MOHAN) A001/1 #1")
    assert lines(spark, "search", table, "--name", "qqqqqqq") == ["No matches."]
    assert "2025" in lines(spark, "verify", table, 1, "--ac", "A001", "--year", 2025)[0]
    report = json.loads(lines(spark, "audit", place / "raw", "--areas", place / "areas.json")[0])
    assert report["total_rows"] == 2 and report["anomaly_counts"] == {"non_numeric_age": 1}
    assert lines(spark, "migrate", place / "out") == ["0 names filled"]
    assert spark.read.parquet(build.table_path(str(place / "out"), patch=1)).count() == 2
    sizes = build.artefacts(spark, str(place / "out")).collect()
    assert [(r.state, r.ac_code, r.contract, r.patch) for r in sizes] == [("karnataka", "A001", "c1", 0)] and sizes[0].file_size_bytes > 0
    areas = spark.createDataFrame([("karnataka", "A001"), ("karnataka", "A002")], "state string, ac_code string")
    index = build.area_index(spark.read.parquet(table), spark.read.parquet(table), ["state", "ac_code"])
    row = build.state_coverage(index, areas, {"karnataka": "Karnataka"}, F.lit("now")).first()
    assert tuple(row) == ("karnataka", "Karnataka", 2, 1, "none", "now")


def test_evaluation_set(spark):
    cases = evaluate.dataset(spark).collect()
    assert len(cases) == evaluate.QUERIES and all(len(c.candidates) == len(set(c.candidates)) == evaluate.POOL and c.true_name in c.candidates and c.query != c.true_name.lower() for c in cases)
    near = lambda c, n: set(n.split()) & set(c.true_name.split())
    assert all(sum(bool(near(c, n)) for n in c.candidates if n != c.true_name) <= evaluate.HARD for c in cases)
    out = lines(spark, "evaluate")
    assert len(out) == len(scorers.ALGORITHMS) and float(out[0].split("mrr ")[1]) > 0.8


def test_sql_functions_and_tiers(spark):
    scorers.register_sql(spark)
    assert spark.sql("SELECT wratio('ravi', 'Ravi') AS a, jaro_winkler('x', NULL) AS b").first().asDict() == {"a": 100.0, "b": 0.0}
    stored = synthetic.rolls(spark, 2, per_area=10)
    assert synthetic.tier(spark, 2, stored).count() == 20
    assert synthetic.tier(spark, 3, stored).count() == 3 * synthetic.PER_AREA


def test_fonts(spark):
    rows = spark.createDataFrame([(["G24", "G25"],), (["G24", "GC2"],), (["G24", "space"],)], "names array<string>")
    got = [r[0] for r in rows.select(nz.font_characters(nz.glyph_numbers(F.col("names")))).collect()]
    assert got[0] == ["A", "B"] and got[1] == [chr(0xE024), chr(0xE0C2)] and got[2] is None
