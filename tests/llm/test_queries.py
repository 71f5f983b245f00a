"""Each registered query on the smallest tables, against its SQL where there is one."""

import os

import duckdb
import pytest

from caselattice.llm import queries

TABLES = "documents pages benchmark labels".split()


def rows_of(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(str([values_i[i] for i in order]) for values_i in values)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, sf_dir, name):
    found = queries.QUERIES[name](spark, sf_dir)
    rows = [tuple(r) for r in found.collect()]
    assert rows or name == "op8_benchmark_leaks" and os.path.exists(sf_dir)
    if name in queries.ORACLES:
        db = duckdb.connect()
        for t in TABLES:
            db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
        result = db.execute(queries.ORACLES[name])
        names = [c[0] for c in result.description]
        assert sorted(names) == sorted(found.columns)
        assert rows_of(names, result.fetchall()) == rows_of(found.columns, rows)
