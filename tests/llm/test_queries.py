"""Every query of the subpackage runs, and gives the rows of its SQL where it has one."""

from __future__ import annotations

import os

import duckdb
import pytest

from assay.llm.oracles import ORACLES
from assay.llm.queries import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "conversations"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    want = con.sql(ORACLES[name]).df()
    got = QUERIES[name](spark, SF_DIR).toPandas()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    got, want = (x[columns].sort_values(columns).reset_index(drop=True).fillna(-1) for x in (got, want))
    assert len(got) and len(got) == len(want) and (got == want).all().all()


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - ORACLES.keys()))
def test_query_runs_over_its_whole_table(spark, name):
    table, key = ("conversations", "conv_id") if name == "op6_chat_roles" else ("documents", "doc_id")
    rows = spark.read.parquet(f"{SF_DIR}/{table}.parquet")
    found = QUERIES[name](spark, SF_DIR).toPandas()
    assert set(found[key]) == {row[0] for row in rows.select(key).distinct().collect()}
    assert len(found) == rows.count() if table == "documents" else len(found) >= rows.count()


def test_one_query_an_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
