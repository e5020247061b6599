"""Every registered query of the library against its SQL."""

import duckdb
import pytest

from tidewell import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def normal(rows):
    return sorted(repr(tuple(round(x, 6) if isinstance(x, float) else x for x in r)) for r in rows)


def test_every_query_has_sql():
    assert set(catalog.queries()) - set(catalog.oracle_sql()) == {"op_partition_skew"}


def test_partitions_hold_all_rows(spark, sf):
    rows = [r["rows"] for r in catalog.queries()["op_partition_skew"](spark, sf).collect()]
    assert sum(rows) == spark.read.parquet(f"{sf}/orders.parquet").count() and len(rows) > 20 and max(rows) >= 0.35 * sum(rows) > 5 * sum(rows) / len(rows)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query(spark, sf, duck, name):
    rows = catalog.queries()[name](spark, sf)
    columns = sorted(rows.columns)
    want = duck.execute(catalog.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == columns
    got = normal(map(tuple, rows.select(*columns).collect()))
    assert got == normal(tuple(r[names.index(c)] for c in columns) for r in want.fetchall()) and got
