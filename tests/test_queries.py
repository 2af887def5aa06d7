"""Every registered query of the library runs; those with SQL equal DuckDB on the same tables."""

import duckdb
import pytest

from termloom.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as from '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(name, spark, sf, duck, tmp_path):
    registry.QUERIES[name](spark, sf).write.parquet(f"{tmp_path}/out")
    found = f"'{tmp_path}/out/*.parquet'"
    if name in registry.ORACLE_SQL:
        columns = ", ".join(f'"{c}"' for c in sorted(duck.sql(f"from {found}").columns))
        a, b = f"select {columns} from {found}", f"select {columns} from ({registry.ORACLE_SQL[name]})"
        assert duck.sql(f"({a}) except all ({b})").fetchall() == [] == duck.sql(f"({b}) except all ({a})").fetchall()


def test_sql_names_queries():
    assert set(registry.ORACLE_SQL) <= set(registry.QUERIES)
