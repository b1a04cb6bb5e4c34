import os

import pytest

import corpus_pipeline
from shelfrank.llm import queries
from tests.llm.frames import OWN

FOLDER = "/root/testdata/sf0.001"


def test_every_operator_has_one_query():
    assert sorted(int(q[2:].split("_")[0]) for q in queries.QUERIES) == list(range(1, 14))
    assert set(queries.ORACLES) <= set(queries.QUERIES)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")
def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    n = docs.count()
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, FOLDER).cache()
        assert docs.columns == OWN and 0 < docs.count() < n
        n = docs.count()
    mixed = corpus_pipeline.STAGES[3][1](spark, docs, FOLDER).cache()
    assert mixed.columns == OWN
    pieces = corpus_pipeline.STAGES[4][1](spark, mixed, FOLDER).cache()
    assert pieces.where("piece = 0").count() == mixed.count()
    whole = corpus_pipeline.run(spark, FOLDER)
    assert whole.agg({"length": "sum"}).first()[0] == pieces.agg({"length": "sum"}).first()[0]


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_agree_with_their_sql(spark, name):
    import duckdb

    from compare import difference

    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    got = queries.QUERIES[name](spark, FOLDER).toPandas()
    assert difference(got, con.execute(queries.ORACLES[name]).df()) is None
