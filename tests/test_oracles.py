"""Every registered query with SQL, on the smallest tables."""

import os

import duckdb
import pytest

import check
from __spark_entry__ import entry
from stockwave.plans.oracles import oracles
from stockwave.plans.queries import registry

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
LARGER = os.environ.get("TEST_LARGER_SF_DIR", "/root/testdata/sf0.01")
ON_LARGER = ("boosted_errors", "models_per_category", "category_registry", "category_forecast")  # on the smallest tables nearly every day has one order: nothing to learn
SQL = oracles()


@pytest.fixture(scope="module")
def con():
    connections = {folder: duckdb.connect() for folder in (FOLDER, LARGER)}
    for folder, connection in connections.items():
        for file in os.listdir(folder):
            if file.endswith(".parquet"):
                connection.execute(f"create view {file[:-8]} as select * from read_parquet('{folder}/{file}')")
    return connections


def test_every_sql_has_a_query():
    assert set(SQL) <= set(registry())
    assert set(registry()) - set(SQL) == {"sequence_regression", "gbt_forecast", "ensemble_forecast", "tuning_trials", "seasonal_forecast"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name, monkeypatch):
    folder = LARGER if name in ON_LARGER else FOLDER
    monkeypatch.setattr(check, "FOLDER", folder)
    line = check.compare(spark, con[folder], name, registry()[name], SQL[name])
    assert line.startswith("OK"), line


def test_entry_has_rows(spark):
    df = entry(spark)
    assert df.count() > 0 and len(df.columns) == 64
