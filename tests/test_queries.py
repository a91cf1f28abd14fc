"""Every registered query with SQL agrees with it on the smallest tables, where these are at hand."""

from __future__ import annotations

import os

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


def rows_of(rows):
    def plain(v):
        return repr(v) if not isinstance(v, (list, tuple)) else tuple(map(plain, v))

    return sorted(tuple(plain(v) for v in r) for r in rows)


def test_gridded_queries(spark):
    import duckdb

    from terrafield.plans.catalog import ORACLE_SQL, QUERIES

    db = duckdb.connect()
    for f in os.listdir(SF):
        db.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{SF}/{f}')")
    wrong = []
    for name, sql in ORACLE_SQL.items():
        df = QUERIES[name](spark, SF)
        columns = sorted(df.columns)
        cursor = db.execute(sql)
        at = [[d[0] for d in cursor.description].index(c) for c in columns]
        want = rows_of([tuple(r[i] for i in at) for r in cursor.fetchall()])
        if rows_of(df.select(columns).collect()) != want:
            wrong.append(name)
    assert not wrong


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
