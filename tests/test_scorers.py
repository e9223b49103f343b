import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlight.functions import scorers as s

WORDS = st.lists(st.sampled_from(["ravi", "kumar", "shivaram", "a", "of", "red", "सुभाष", "x_y", "Ö"]), max_size=5).map(" ".join)
TEXT = st.one_of(WORDS, st.text(max_size=12), st.none())


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


@given(st.text("abcd ", max_size=20), st.text("abcd ", max_size=20))
def test_lcs_is_the_longest_common_subsequence(a, b):
    assert s.lcs(a, b) == slow_lcs(a, b)


@settings(max_examples=150, deadline=None)
@given(st.one_of(WORDS, st.text(max_size=10)), st.lists(TEXT, max_size=8))
def test_array_forms_equal_scalar_forms(query, candidates):
    for _, scalar, many in s.ALGORITHMS.values():
        assert np.allclose(many(query, candidates), [scalar(query, c) for c in candidates])


def test_known_scores():
    assert s.wratio("Ravi Kumar", "ravi kumar") == 100
    assert s.wratio("Kumar Ravi", "Ravi Kumar") > 90
    assert s.wratio("subhASha", "subhash") == pytest.approx(93.3333, abs=1e-3)
    assert s.wratio("Shivaram", "Shivram") >= 70
    assert s.wratio("Zzzznomatch", "Shivaram") < 70
    assert s.jaro_winkler("Shivaram", "Shivram") > s.jaro_winkler("Shivaram", "Aramshiv")


def test_short_candidates_are_no_abbreviations():
    assert s.wratio("Ravi Kumar", "R") == s.ratio("ravi kumar", "r") < 30
    assert s.wratio("", "Ravi") == 0 and s.wratio("Ravi", None) == 0


def test_unknown_algorithm_names_the_choices():
    with pytest.raises(ValueError, match="wratio"):
        s.scalar("soundex")


def test_column_forms(spark):
    rows = spark.createDataFrame([(1, "Ravi Kumar", "Mohan"), (2, None, ""), (3, "Kumar Ravi", None)], "id int, name string, relative string")
    both = s.mean_score(["ravi kumar", "mohan"], [rows.name, rows.relative])
    got = {r.id: r.score for r in rows.select("id", both.alias("score")).collect()}
    assert got == {1: 100.0, 2: 0.0, 3: 47.5}
    none = rows.select(s.mean_score(["", None], [rows.name, rows.relative]).alias("score")).first()
    assert none.score is None
    pairs = rows.select("id", s.pair_score(rows.name, rows.relative, "ratio").alias("p")).collect()
    assert {r.id: round(r.p, 3) for r in pairs} == {1: round(s.ratio("ravi kumar", "mohan"), 3), 2: 100.0, 3: 0.0}
