import ast
import glob
import os

import duckdb
import pytest

import check
from stockwave.llm.queries import ORACLES, QUERIES

from samples import SF

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name, monkeypatch):
    monkeypatch.setattr(check, "FOLDER", SF)
    con = duckdb.connect()
    for file in os.listdir(SF):
        if file.endswith(".parquet"):
            con.execute(f"create view {file[:-8]} as select * from read_parquet('{SF}/{file}')")
    line = check.compare(spark, con, name, QUERIES[name], ORACLES[name])
    assert line.startswith("OK"), line


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_nothing_else_imports_the_subpackage():
    for path in glob.glob(f"{ROOT}/stockwave/**/*.py", recursive=True) + glob.glob(f"{ROOT}/tests/*.py"):
        if "/llm/" not in path:
            for node in ast.walk(ast.parse(open(path).read())):
                if isinstance(node, (ast.Import, ast.ImportFrom)):
                    names = [getattr(node, "module", None) or ""] + [a.name for a in node.names]
                    assert not any(n.startswith(("stockwave.llm", "corpus_pipeline")) for n in names), path
