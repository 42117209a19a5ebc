"""Each registered query against its SQL on the smallest data set."""

import glob
import os

import duckdb
import pytest

from __spark_entry__ import entry
from check import rows_of
from lumetric.oracles import ORACLES
from lumetric.registered import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
WITHOUT_SQL = {"model_comparison", "batch_score", "pca_embed", "vision_features_pca"}


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{path}'")
    return connection


def test_every_query_has_sql_or_is_listed():
    assert set(QUERIES) - set(ORACLES) == WITHOUT_SQL
    assert not set(ORACLES) - set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WITHOUT_SQL))
def test_query_equals_sql(spark, db, name):
    df = QUERIES[name](spark, FOLDER)
    db.execute(ORACLES[name])
    columns = [d[0] for d in db.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, db.fetchall())


def test_entry(spark):
    assert entry(spark).count() > 0
