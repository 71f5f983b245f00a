"""Each query of the engine on the smallest tables, against its SQL."""

import duckdb
import pytest

from caselattice.plans import queries

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(str([r[i] for i in order]) for r in rows)


@pytest.fixture(scope="module")
def db(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, sf_dir, db, name):
    found = queries.QUERIES[name](spark, sf_dir)
    rows = [tuple(r) for r in found.collect()]
    assert rows
    if name in queries.ORACLES:
        result = db.execute(queries.ORACLES[name])
        names = [c[0] for c in result.description]
        assert sorted(names) == sorted(found.columns)
        assert normal(names, result.fetchall()) == normal(found.columns, rows)


def test_flagship(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
