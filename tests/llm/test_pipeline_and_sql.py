"""Queries with SQL agree with it; the pipeline's stages take effect and handle edge rows."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tidemark.llm.sql import SQL
from tools.oracle_check import duck, rows_of


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    cur = duck(SF_SMALL).execute(SQL[name])
    cols = [d[0] for d in cur.description]
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(cols, cur.fetchall())


def test_pipeline_stages(spark):
    import corpus_pipeline as C
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    edge = spark.createDataFrame([(None, None, None, None, None), (10 ** 6, "", "en", "src0", 0),
                                  (10 ** 6, "", "en", "src0", 0)], docs.schema)
    for at, start in ((SF_SMALL, docs.unionByName(edge)), (SF_SMALL, docs.limit(0))):
        now = start
        for k, (_, stage) in enumerate(C.STAGES):
            before, now = now.count(), C.written(stage(spark, now, at), "t")
            assert k == len(C.STAGES) - 1 or now.columns == docs.columns
            assert before or not now.count()
        assert now.where("not round_trip").count() == 0
