"""Every query with SQL gives the rows that DuckDB gives on the same tables."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in os.listdir(DATA):
        c.execute(f"CREATE VIEW {t.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{t}'")
    return c


def rows(df):
    return sorted((tuple(None if pd.isna(v) else v if isinstance(v, str) else float(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    ours, theirs = entry.queries()[name](spark, DATA).toPandas(), duck.sql(entry.oracle_sql()[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_captions_are_whole_texts(spark):
    got = {r.key: (r.caption, r.recorded) for r in entry.queries()["caption_mismatch"](spark, DATA).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    assert got and got == {k: ("x" + texts[k], texts[k]) for k in got} and max(len(t) for _, t in got.values()) > 40
