"""Every registered query against DuckDB, and shape checks for those without SQL."""

import os

import duckdb
import pytest

from ampledger.plans.catalog import ORACLES, QUERIES

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"create view {t} as select * from '{path}'")
    return con


def canonical(pdf):
    pdf = pdf[sorted(pdf.columns)].astype(object)
    pdf = pdf.where(pdf.notna(), None)

    def text(x):
        if isinstance(x, float):
            return repr(round(x, 9) + 0.0)
        return str(x)

    return sorted(tuple(text(x) for x in row) for row in pdf.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(name, spark, duck, sf_dir):
    mine = QUERIES[name](spark, sf_dir).toPandas()
    relation = duck.sql(ORACLES[name])
    theirs = relation.df()
    assert sorted(mine.columns) == sorted(theirs.columns)
    whole = {c for c, t in zip(relation.columns, relation.types) if str(t) in ("INTEGER", "BIGINT")}
    for c in whole:
        mine[c], theirs[c] = mine[c].astype("Int64"), theirs[c].astype("Int64")
    assert len(mine) > 0
    assert canonical(mine) == canonical(theirs)


@pytest.mark.parametrize("name", ["isolation_forest", "sequence_layer", "batch_score", "daily_anomaly_run"])
def test_one_row_per_reading(name, spark, sf_dir):
    result = QUERIES[name](spark, sf_dir)
    ids = result.select("event_id").distinct().count()
    assert result.count() == ids == spark.read.parquet(f"{sf_dir}/events.parquet").count()


def test_entry_has_rows(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
