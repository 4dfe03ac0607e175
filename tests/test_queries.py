"""Every registered query against its SQL counterpart."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from __spark_entry__ import entry
from changelake.oracle import ORACLES
from changelake.queries import QUERIES
from check import TYPES, rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    cursor = con.execute(ORACLES[name])
    types = {d[0]: TYPES.get(str(d[1]), str(d[1])) for d in cursor.description}
    assert dict(df.dtypes) == types
    want = pd.DataFrame(cursor.fetchall(), columns=list(types), dtype=object)
    got = pd.DataFrame([r.asDict() for r in df.collect()], columns=df.columns, dtype=object)
    assert len(got) > 0
    assert rows(got) == rows(want)
