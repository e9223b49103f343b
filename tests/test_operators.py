import json

import pytest
from pyspark.sql import functions as F

from ledgerlight.functions import normalize as nz
from ledgerlight.operators import audit, evaluate, layout, search, sequences
from ledgerlight.plans import synthetic
from ledgerlight.sources import rolls

SCHEMA = "id long, roll_year int, ac_code string, part_no int, serial_no int, full_name string, full_relative_name string, relation_label string, age int, gender string"


@pytest.fixture()
def roll(spark):
    rows = [
        (1, 2025, "A1", 0, 1, "Shivaram", "Mohan", "Father", 43, "M"),
        (2, 2025, "A1", 2, 2, "Shivram", "Mohan", "", 44, "M"),
        (3, 2025, "A1", 2, 3, "Lakshmi", "Mohan", "Mother", 43, "F"),
        (4, 2025, "A2", 2, 4, "Shivaram", "Mohan", None, None, "M"),
        (5, 2025, "A1", 2, 5, "Shivaram", "Mohan", "Father", 93, "M"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def ids(df):
    return [r.id for r in df.collect()]


def test_search_filters_threshold_and_order(roll):
    assert ids(search.search(roll, "Shivaram")) == [1, 4, 5, 2]
    assert ids(search.search(roll, "Shivaram", limit=2)) == [1, 4]
    assert ids(search.search(roll, "Shivaram", "Mohan", ac_codes=["A1"], gender="M", age=42)) == [1, 2]
    assert ids(search.search(roll, "Shivaram", part_no=0)) == [1]
    assert ids(search.search(roll, "Zzzznomatch")) == []
    with pytest.raises(ValueError):
        search.search(roll)
    with pytest.raises(ValueError, match="At most 5"):
        search.search(roll, "x", ac_codes=list("abcdef"))
    lines = [r.line for r in search.report(search.search(roll, "Shivaram", limit=4)).collect()]
    assert lines[0].startswith("[100.0] Shivaram (Father: Mohan) A1/0 #1") and "(?: Mohan)" in lines[-1]


def test_search_scores_each_row_once(roll):
    plan = search.search(roll, "Shivaram", ac_codes=["A1"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [") == 1 or plan.count("ArrowEvalPython") == 1
    assert "TakeOrderedAndProject" in plan


def test_distinct_names_are_scored_once(spark):
    rows = synthetic.rolls(spark, 2, per_area=600).withColumn("full_name", F.when(F.col("id") % 7 > 0, F.col("full_name")))
    one = search.score_once(rows, ["Ravi Rao", "Asha"], ["full_name", "full_relative_name"]).select("id", F.round("score", 6)).collect()
    two = rows.select("id", F.round(search.scorers.mean_score(["Ravi Rao", "Asha"], [F.col("full_name"), F.col("full_relative_name")]), 6)).collect()
    assert len(one) == 1200 and dict(map(tuple, one)) == dict(map(tuple, two))
    assert {r.score for r in search.score_once(rows, [None], ["full_name"]).select("score").collect()} == {None}


def test_latin_query_bridges_scripts(spark):
    rows = spark.createDataFrame([(1, "सुभाष", "subhASha", "", None)], "id long, full_name string, full_name_latin string, full_relative_name string, full_relative_name_latin string")
    rows = rows.withColumns({"ac_code": F.lit("A"), "age": F.lit(1), "gender": F.lit("M"), "part_no": F.lit(1)})
    assert ids(search.search(rows, "subhash")) == [1] and ids(search.search(rows, "subhash", script_bridge=False)) == []


def test_verification_notes(roll):
    record = search.Record("A1", "Shivaram", "Mohan", "M", 20, 2002)
    found, note = search.verify_record(roll, record, 2025)
    assert ids(found) == [1, 2] and note is None
    assert search.verify_record(roll, search.Record("A9", "x", "", "M", 20), 2025)[1] == search.NO_ROLL.format(year=2025, area="A9")
    assert search.verify_record(roll, search.Record("A1", "Shivaram", "", "M", 5), 2025)[1] == search.NO_MATCH.format(year=2025, area="A1", age=28)
    none, note = search.verify_record(roll, search.Record("A1", "Qqqq", "", "F", 20), 2025)
    assert ids(none) == [] and note is None
    assert search.verify_record(roll, search.Record("A1", "Shivaram", "", None, 20), 2025)[0].count() == 0
    assert search.expected_age(search.Record("A", "x"), 2025) == 23


def test_audit_kinds(spark):
    good = ["N", "A001", "Oak", "1", "1", "7", "ASHA", "", "RAO", "", "F", "41", "M"]
    change = lambda **k: [k.get(f, v) for f, v in zip(audit.FIELDS, good)]
    cols = [good, [], [" "], good[:5], good + [""], good + ["x"], change(ac_code="2", ac_name="elm", district="S", first_name="", part_no="", age="x", relation_code="w", gender="q", relative_name="�"), change(ac_code="1")]
    rows = spark.createDataFrame([("A001.csv", i, c) for i, c in enumerate(cols, 1)], "file string, line long, cols array<string>")
    meta = spark.createDataFrame([("A001", "OAK", "n")], "ac_code string, ac_name string, district string")
    got = {r.line: r.kinds for r in audit.anomalies(rows, meta).collect()}
    assert got[1] == [] and got[2] == got[3] == ["blank_line"] and got[4] == ["too_few_cols_5"] and got[5] == ["extra_empty_cols_14"] and got[6] == ["extra_nonempty_cols_14"] and got[8] == []
    assert got[7] == ["ac_code_mismatch", "ac_name_mismatch", "district_mismatch", "empty_first_name", "empty_part_no", "non_numeric_age", "unknown_relation_code", "unknown_gender", "decode_replacement_char"]
    report = audit.audit(rows, meta).select(F.to_json(F.struct("*")).alias("j")).first().j
    report = json.loads(report)
    assert report["total_rows"] == 6 and report["files_seen"] == 1 and report["anomaly_counts"]["blank_line"] == 2
    assert report["files_multi_ac_code"]["A001.csv"] == {"1": 1, "2": 1, "A001": 3} and report["files_nonstandard_colcount"]["A001.csv"] == {"13": 3, "14": 2, "5": 1}
    places = audit.samples(audit.anomalies(rows, meta), ["file", "line"], ["cols"], most=1)
    assert {(r.kind, r.line) for r in places.collect() if r.kind == "blank_line"} == {("blank_line", 2)}


def test_ranking_quality(spark):
    cases = spark.createDataFrame([("a", "x", ["x", "y"]), ("b", "y", ["x", "y"])], "query string, true_name string, candidates array<string>")
    perfect = evaluate.evaluate(cases, lambda q, c: ((q == "a") & (c == "x") | (q == "b") & (c == "y")).cast("double")).first()
    assert (perfect.recall_at_1, perfect.mrr, perfect.n) == (1.0, 1.0, 2)
    ties = evaluate.evaluate(cases, lambda q, c: F.lit(1.0)).first()
    assert (ties.recall_at_1, ties.recall_at_3, ties.mrr) == (0.5, 1.0, 0.75)
    metrics = spark.createDataFrame([("base", 0.5), ("new", 0.6), ("same", 0.5)], "name string, mrr double")
    assert {r.name: r.wins for r in evaluate.verdict(metrics, ["base"]).collect()} == {"base": False, "new": True, "same": False}
    made = spark.createDataFrame([("vinith pham",)], "n string").select(evaluate.corruptions(F.col("n")).alias("v")).first().v
    assert {"winith pham", "vynith pham", "vinit pham", "vinith fam", "vinithpham"} <= set(made) and "vinith pham" not in made
    near = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0], [0.0, 0.0])], "a array<double>, b array<double>, z array<double>").select(evaluate.cosine(F.col("a"), F.col("b")), evaluate.cosine(F.col("a"), F.col("z"))).first()
    assert near[0] == pytest.approx(2**-0.5) and near[1] is None


def test_array_sequences(spark):
    row = spark.range(1).select(
        sequences.chained(F.array(*[F.lit(x) for x in (10.0, 13.0, 16.1, 1.0)]), 3.0).alias("c"),
        sequences.anchored(F.array(*[F.lit(x) for x in (1.0, 4.0, 6.0, 6.1, 11.1)]), 5.0).alias("a"),
        sequences.upper_median(F.array(*[F.lit(x) for x in (4.0, 1.0, 3.0, 2.0)])).alias("m"),
        sequences.upper_median(F.array().cast("array<double>")).alias("none"),
        sequences.surrounding(F.array(F.lit(1.0), F.lit(5.0)), F.lit(5.0)).alias("open"),
        sequences.surrounding(F.array(F.lit(1.0), F.lit(5.0)), F.lit(1.0)).alias("both"),
    ).first()
    assert row.c == [1.0, 11.5, 16.1] and row.a == [[1.0, 4.0, 6.0], [6.1, 11.1]] and row.m == 3.0 and row.none == 0.0 and row.open is None and tuple(row.both) == (1.0, 5.0)


def test_gaps_prefer_inner_blanks(spark):
    rows = spark.createDataFrame([("p", 2, 3), ("p", 7, 8), ("q", 0, 9)], "k string, lo int, hi int")
    got = sequences.widest_gap(sequences.occupancy(rows, ["k"], "lo", "hi", 0, 9), ["k"])
    assert {r.k: r.centre for r in got.collect()} == {"p": 5.0, "q": 0.0}
    assert layout.gutter([0, 0, 1, 1, 0, 0, 0, 1, 1, 0]) == 5.0 and layout.gutter([2, 1, 1]) == 1.0


def test_ruled_pages(spark):
    words, edges = [], []
    for c in range(1, 9):
        words.append(("0001", 2, c, f"[{c}]", 100.0 * c + 40, 100.0 * c + 60, 10.0, 20.0, "Times"))
    edges += [("0001", 2, 100.0 * c + d, "v") for c in range(1, 10) for d in (0.0, 3.0)]
    line = lambda i, top, cells: [("0001", 2, i + c, t, 100.0 * (c + 1) + 10, 100.0 * (c + 1) + 30, top, top + 10, "DK-RAJ" if c in (2, 4) else "Times") for c, t in enumerate(cells)]
    raw = lambda h: bytes.fromhex(h).decode("latin-1")
    words += line(20, 30.0, ["1", "12", raw("45d6f2b1c9"), "प", raw("45f2d2"), "पु.", "41", "X/1"])
    words += line(40, 35.1, ["2", "13", "\xbc", "?", raw("45f2d2"), "म", "४५", "X/2"])
    words.append(("0001", 2, 60, "margin", 5.0, 9.0, 30.0, 40.0, "Times"))
    w = spark.createDataFrame(words, "part_id string, page_no int, word_idx int, text string, x0 double, x1 double, top double, bottom double, fontname string")
    e = spark.createDataFrame(edges, "part_id string, page_no int, x0 double, orientation string")
    rows = layout.ruled_rows(w, e)
    assert rows.count() == 3
    area = spark.createDataFrame([("HR47", "Place", "Shire")], "ac_code string, ac_name string, district string")
    got = rolls.REGISTRY["haryana"].source.normalized(rows.withColumns({"file": F.lit("HR47.zip"), "line": F.col("row_no").cast("long"), "locality": F.lit("here")}), area, 2002).orderBy("line").collect()
    assert [(r.part_no, r.serial_no, r.full_name, r.full_relative_name, r.relation_code, r.gender, r.age, r.local_ref, r.locality, r.remark) for r in got] == [
        (1, 1, "कुल", "की", "H", "M", 41, "12", "here", ""),
        (1, 2, "�", "की", "?", "F", 45, "13", "here", "undecodable glyph(s) 0xbc in column 3; unrecognized relation_code: '?'"),
    ]
    seven = w.where("text <> '[8]'")
    assert layout.ruled_rows(seven, e).count() == 0


def test_cover_pages(spark):
    words = [("0001", 1, 0, "तहसील", 310.0, 10.0), ("0001", 1, 1, "गोहाना", 400.0, 13.0), ("0001", 1, 2, "x", 10.0, 10.0), ("0002", 1, 0, "nothing", 310.0, 10.0)]
    w = spark.createDataFrame(words, "part_id string, page_no int, word_idx int, text string, x0 double, top double").withColumn("fontname", F.lit("Times"))
    assert {r.part_id: r.locality for r in layout.cover_locality(w).collect()} == {"0001": "गोहाना", "0002": ""}


def test_unruled_pages(spark):
    chars = []

    def put(part, page, top, items):
        for x, text in items:
            for k, c in enumerate(text):
                chars.append((part, page, len(chars), c, x + 5.0 * k, x + 5.0 * k + 4.5, top))

    heads = [(10, "1"), (60, "2"), (110, "3"), (210, "4"), (260, "5"), (360, "6"), (400, "7"), (440, "8")]
    put("1", 1, 5.0, [(10, "Village/Area/Road"), (130, ":")])
    put("1", 1, 15.0, [(10, "1)"), (30, "PARK"), (60, "STREET")])
    put("1", 2, 10.0, heads)
    put("1", 2, 20.0, [(10, "1"), (60, "4A"), (100, "ASHA"), (205, "FATHER"), (250, "RAO"), (360, "F"), (400, "41"), (430, "WB1")])
    put("1", 2, 20.2, [(10.2, "1")])  # struck twice
    put("1", 2, 30.0, [(100, "DEVI")])
    for k in (2, 3, 4):
        put("1", 2, 20.0 + 10.0 * k, [(10, str(k)), (100, "BALA"), (205, "M"), (250, "RAO"), (360, "M")])
    put("1", 2, 110.0, [(100, "FOOTER")])
    glyphs = lambda key: "".join(chr(0xE000 + int(g, 16)) for g in key.split("-"))
    put("1", 3, 20.0, [(10, glyphs("14")), (60, "5"), (100, glyphs("7F")), (205, glyphs("C2-7C-57-82-C1")), (250, "RAO"), (360, glyphs("7C-C6-D2")), (400, "4x"), (430, "WB2")])
    table = spark.createDataFrame(chars, "part_id string, page_no int, char_idx int, text string, x0 double, x1 double, top double")
    rows = layout.unruled_rows(table)
    area = spark.createDataFrame([("AC146", "Place", "Shire")], "ac_code string, ac_name string, district string")
    got = rolls.REGISTRY["west_bengal"].source.normalized(rows.withColumn("file", F.lit("AC146.zip")), area, 2002).orderBy("line").collect()
    assert [(r.serial_no, r.full_name, r.full_relative_name, r.relation_code, r.gender, r.age, r.local_ref, r.locality) for r in got] == [
        (1, "ASHA DEVI", "RAO", "F", "F", 41, "WB1", "PARK STREET"),
        *[(k, "BALA", "RAO", "M", "M", None, "", "PARK STREET") for k in (2, 3, 4)],
        (1, "", "", "F", "M", 4, "WB2", "PARK STREET"),
    ]
    assert got[4].remark == rolls.GlyphPartSource.unread + "; non-numeric age: '4x'"


def test_small_expressions(spark):
    row = spark.createDataFrame([("it's", "a\\b", "45_0", "\ue001\ue0ff")], "q string, b string, n string, g string").select(
        nz.quoted(F.col("q")).alias("q"), nz.quoted(F.col("b")).alias("b"), nz.integer(F.col("n"), "n")[0].alias("n"), nz.glyph_key(F.col("g")).alias("g"), nz.masked(F.col("g")).alias("m"), nz.filled(F.lit("12345"), 3).alias("z"), nz.filled(F.lit("7"), 3).alias("s"),
    ).first()
    assert tuple(row) == ('"it\'s"', "'a\\\\b'", 450, "01-FF", "??", "12345", "007")


def test_ordinal_of_wide_rows(spark):
    """A payload beside the order, and the adaptive planner free to coalesce: every row once, numbered 1 to n."""
    n = 300_000
    rows = spark.range(n).select(F.pmod(F.xxhash64("id"), F.lit(n * 7)).alias("at"), "id", F.repeat(F.sha2(F.col("id").cast("string"), 256), 12).alias("payload")).withColumnRenamed("id", "row")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    out = sequences.ordinal(rows, ["at", "row"])
    got = out.agg(F.count("*"), F.count_distinct("id"), F.min("id"), F.max("id"), F.count_if(F.length("payload") == 768)).first()
    assert tuple(got) == (n, n, 1, n, n)
    steps = out.select("id", "at").orderBy("id").toPandas()
    assert (steps["at"].diff().dropna() >= 0).all()
    assert sequences.ordinal(rows.limit(0), ["at", "row"]).collect() == []


def test_nearest_matches_brute_force(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    vectors = rng.integers(-3, 4, (300, 6)).astype(float)  # many ties
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(900, None), (901, [0.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = {}
    for r in evaluate.nearest(df, df.where("vec_id % 10 = 0 OR vec_id > 899"), "vec_id", "embedding", 5, block_bytes=400).collect():
        got.setdefault(r.query, set()).add((r.position, r.score))
    norm = np.sqrt((vectors**2).sum(axis=1))
    for q in range(0, 300, 10):
        if not norm[q]:
            assert q not in got
            continue
        score = {i: round(float(vectors[i] @ vectors[q] / norm[i] / norm[q]), 9) for i in range(300) if i != q and norm[i]}
        best = sorted(score, key=lambda i: (-score[i], i))[:5]
        assert {i for i, _ in got[q]} == set(best)


def test_grouped_scores_are_the_flat_ones(spark):
    rows = synthetic.rolls(spark, 3, per_area=500).withColumn("full_name", F.when(F.col("id") % 9 > 0, F.col("full_name")))
    for algorithm in ("wratio", "jaro_winkler"):
        scored = search.score_by_group(rows, ["Ravi Rao", "Asha"], ["full_name", "full_relative_name"], ["state", "ac_code"], algorithm)
        flat = rows.select("id", search.scorers.mean_score(["Ravi Rao", "Asha"], [F.col("full_name"), F.col("full_relative_name")], algorithm).alias("s")).collect()
        got = {r.id: r.score for r in scored.collect()}
        assert len(got) == 1500 and all(abs(got[r.id] - r.s) < 1e-9 for r in flat)
        times = search.group_times(scored, ["state", "ac_code"]).collect()
        assert len(times) == 3 and all(t.rows_n == 500 and t.spent_ms > 0 for t in times)
    assert {r.score for r in search.score_by_group(rows, [None], ["full_name"], ["ac_code"]).collect()} == {None}
    assert search.score_by_group(rows.limit(0), ["x"], ["full_name"], ["ac_code"]).collect() == []


def test_latin_forms_are_made_while_reading(spark):
    rows = spark.createDataFrame([(1, "सुभाष", None), (2, "Subhash", None), (3, "कमला", "subhASha")], "id long, full_name string, full_name_latin string").withColumn("full_relative_name", F.lit(""))
    rows = rows.withColumns({"ac_code": F.lit("A"), "age": F.lit(1), "gender": F.lit("M"), "part_no": F.lit(1)})
    assert sorted(ids(search.search(rows, "subhasha"))) == [1, 2, 3]
    assert ids(search.search(rows, "subhasha", script_bridge=False)) == [2]


def test_locality_steps():
    assert layout.after_label(["x", "Village / Area/ROAD", ":", "", "Town", ":"]) == ["Town", ":"]
    assert layout.after_label(["village/area/road:"]) == [] and layout.after_label(["Town"]) is None
    assert layout.without_marker(["1)", "Town"]) == ["Town"] and layout.without_marker(["1", "Town"]) == ["1", "Town"] and layout.without_marker([]) == []
    assert layout.is_readable(["a", "b"]) and not layout.is_readable([]) and not layout.is_readable(["a", ""]) and not layout.is_readable(["a\ue050"])


def test_double_strikes_match_all_pairs(spark):
    import random

    r = random.Random(5)
    rows = [(k, i, r.choice("ab"), r.randrange(60) / 8, r.randrange(4) / 4) for k in range(3) for i in range(60)]
    got = {(x.k, x.i) for x in layout.without_double_strikes(spark.createDataFrame(rows, "k int, i long, text string, x0 double, top double"), ["k"], "i").collect()}
    want = set()
    for k in range(3):
        kept = []
        for x in sorted((x for x in rows if x[0] == k), key=lambda x: (x[3], x[1])):
            if not any(y[2] == x[2] and abs(y[3] - x[3]) < 0.5 and abs(y[4] - x[4]) < 0.5 for y in kept):
                kept.append(x)
        want |= {(x[0], x[1]) for x in kept}
    assert got == want


def test_every_name_has_the_scalar_score(spark):
    from ledgerlight.plans import catalogue

    names = ["Red Plate", "plate red", "red", "re", "", "blue ring", "red plate of another kind of things", "Plate"]
    rows = spark.createDataFrame(list(enumerate(names)), "p_partkey long, p_name string")
    for r in rows.withColumn("score", F.round(search.scorers.score(F.col("p_name"), "Red Plate"), 6)).collect():
        assert r.score == pytest.approx(round(search.scorers.wratio("Red Plate", r.p_name), 6))
    assert "search_wratio_all" in catalogue.QUERIES
