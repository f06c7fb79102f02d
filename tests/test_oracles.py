"""Every catalogued query against its SQL in DuckDB."""

import duckdb
import pytest

from tesserae.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([round(r[i], 6) if isinstance(r[i], float) else r[i] for i in order]) for r in rows)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, sf_dir, duck, name):
    df = catalog.QUERIES[name](spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    if name not in catalog.ORACLE_SQL:
        assert rows
        return
    found = duck.execute(catalog.ORACLE_SQL[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(df.columns)
    assert plain(df.columns, rows) == plain(columns, found.fetchall())
