"""Every registered query on the smallest scale, and those with SQL against it."""

import pytest
from llm_helpers import SF

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from check import compare, duck
from linepulse.llm import queries as registered
from linepulse.llm.common import table

NAMES = [*registered.QUERIES, "pipeline"]


def test_one_query_for_each_operator():
    assert [n.split("_")[0] for n in registered.QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert set(NAMES) <= set(queries())
    assert [f"op{i}" for i in (7, 2, 6, 3, 5)] and len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, name):
    state, rows, _, note = compare(spark, duck(SF), SF, name)
    assert state == ("ok" if name in oracle_sql() else "no-sql"), note
    assert rows > 0


def test_each_stage_keeps_the_columns_of_documents(spark):
    docs = table(spark, SF, "documents")
    before = docs.count()
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = step(spark, docs, SF)
        assert docs.columns == table(spark, SF, "documents").columns, name
    assert 0 < docs.count() <= 3 * before


def test_the_pipeline_takes_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, size int"
    rows = [(1, None, None, None, None, None, None), (None, "", "en", "a", 0, 1.0, 2), (2, "w " * 40_000, "en", "a", 1, None, 3)]
    for docs in (spark.createDataFrame([*rows, rows[2]], schema), spark.createDataFrame([], schema)):
        out = docs
        for _, step in corpus_pipeline.STAGES[:-1]:
            out = step(spark, out, SF)
            assert out.columns == docs.columns
        assert corpus_pipeline.STAGES[-1][1](spark, out, SF).count() == out.count()
