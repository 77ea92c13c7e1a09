"""Every query with an oracle matches DuckDB at sf0.001 (row count, column
names, order-insensitive values)."""

import os
import sys

import duckdb
import pytest

from locations import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "scripts"))
import __spark_entry__ as E  # noqa: E402
from check_oracle import TABLES, digest  # noqa: E402
from postlake.plans.catalog import QUERIES  # noqa: E402

ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF_SMALL}/{t}.parquet'")
    return c


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.sql(ORACLE[name])
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(res.columns)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(res.columns, orows)[0]


#: A trained model's figures and a tokenizer's cuts: held against brute force in test_student.py and test_subwords.py.
NO_SQL = {"train_predict_rows", "self_train_steps", "truncate_subwords", "score_posts_subwords"}


def test_every_query_of_the_catalog_has_an_oracle():
    assert set(QUERIES) - NO_SQL <= set(ORACLE)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "text_clean" in df.columns
