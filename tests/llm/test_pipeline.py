import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import DATA, REPO
from ledgerlight.llm import mixing


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    out = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet")
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, f"{DATA}/sf0.001").write.parquet(str(out / name))
        docs = spark.read.parquet(str(out / name))
        tables.append(docs)
    return tables


def ids(df):
    return [r.doc_id for r in df.select("doc_id").collect()]


def test_stages_keep_columns_and_narrow(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "language", "near_duplicates", "mixing", "packing"]
    for df in stages[1:5]:
        assert df.columns == stages[0].columns
    assert set(ids(stages[3])) <= set(ids(stages[2])) <= set(ids(stages[1])) <= set(ids(stages[0]))
    assert set(ids(stages[4])) == set(ids(stages[3])) == set(ids(stages[5]))


def test_no_near_duplicate_is_left(stages):
    from test_neardup import brute

    rows = [(r.doc_id, r.text) for r in stages[2].collect()]
    _, component = brute(rows, 5, 80)
    assert sorted(ids(stages[3])) == sorted(i for i in component if component[i] == i)


def test_mixture_holds_its_limit(stages):
    words = lambda df: {r[0]: r[1] for r in df.groupBy("source").agg(F.sum(mixing.n_words(F.col("text")))).collect()}
    before, after = words(stages[3]), words(stages[4])
    assert all(before[s] <= after[s] <= 2 * before[s] for s in before)


def test_run_gives_the_same_rows(spark, stages):
    got = corpus_pipeline.run(spark, f"{DATA}/sf0.001")
    assert sorted(got.columns) == sorted(stages[5].columns)
    assert got.agg(F.sum("length")).first()[0] == stages[5].agg(F.sum("length")).first()[0]


CLASHING = "doc_id long, text string, lang string, source string, n_chars long, row int, score double, lang_pred string, q_words int, kept int, n__id int, key string, n int, id int, node int, component int, p_source string, mix_block int, ids int, pid int, mix__n int"


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_rows(spark, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    words = " ".join(f"the {chr(97 + i % 26)}{chr(97 + i // 26)}ing" for i in range(60))
    extra = (1, 2.0, "x", 3, 4, 5, "k", 6, 7, 8, 9, "p", 10, 11, 12, 13)
    rows = [(i, f"{words} {i} number {i} of the lot {i}", "en", "s", 1, *extra) for i in range(40)]
    rows += [(50, None, None, None, None, *[None] * 16), (51, "", "en", "s", 0, *extra), (52, "x " * 200_000, "en", None, 0, *extra), (None, words, None, "s", 0, *extra), (53, words, "de", "t", 0, *extra), (53, words, "de", "t", 0, *extra)]
    docs = spark.createDataFrame(rows, CLASHING)
    out = stage(spark, docs, "")
    got = out.collect()
    if name != "packing":
        assert out.columns == docs.columns
    want = {"quality": {None, 53} | set(range(40)), "mixing": {r[0] for r in rows}, "packing": {r[0] for r in rows}, "language": {None, 52, 53} | set(range(40))}
    if name in want:
        assert {r.doc_id for r in got} >= want[name] - {52}
    if name == "near_duplicates":
        assert sorted(r.doc_id for r in got) == [0, 50, 51, 52]  # 53, twice, and the row without id are near 0 to 39
    assert stage(spark, docs.limit(0), "").collect() == []


def test_the_rest_stands_without_this_folder(tmp_path):
    code = "import sys; sys.modules['ledgerlight.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; q = e.queries(); print(len(q), [n for n in q if n[:2] == 'op' or n == 'pipeline'])"
    out = subprocess.run([sys.executable, "-c", code], cwd=REPO, env=os.environ | {"PYTHONPATH": REPO}, capture_output=True, text=True, check=True).stdout
    assert out.strip().endswith("[]")
