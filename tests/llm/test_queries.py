"""Registered queries of the subpackage: those with SQL against DuckDB, and the pipeline."""

import pytest

import corpus_pipeline
from ledgerspark.llm import queries
from verification import compare


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_matches_sql(spark, sf_dir, name):
    mine = queries.queries()[name](spark, sf_dir)
    result = compare.connect(sf_dir).execute(queries.oracle_sql()[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(mine.columns)
    assert compare._rows(mine.columns, mine.collect()) == compare._rows(names, result.fetchall())


def test_one_query_for_each_operator():
    assert [n.split("_")[0] for n in queries.queries()] == [f"op{i}" for i in range(1, 14)]


def test_stages_keep_the_columns_of_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == columns, name
        docs = corpus_pipeline.shared.store(out, name)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert 0 < last.count() == docs.count()
    assert sorted(map(tuple, last.collect())) == sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect()))
