"""Queries that run over whole tables."""

import os

import pytest

import __spark_entry__ as entry
from thicket.plans import virtual as V

from .test_entry import SF, plain


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
def test_pixel_values_have_every_period(spark):
    import duckdb

    con = duckdb.connect()
    for t in ("lineitem", "events"):
        con.sql(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    df = entry.queries()["pixel_values"](spark, SF)
    rows = df.collect()
    assert len(rows) == con.execute(f"WITH {V.DENSE} SELECT count(*) FROM dense").fetchall()[0][0]
    out = con.execute(entry.oracle_sql()["pixel_values"])
    names = [c[0] for c in out.description]
    want = sorted(tuple(plain(r[names.index(c)]) for c in sorted(names)) for r in out.fetchall())
    assert sorted(tuple(plain(r[c]) for c in sorted(names)) for r in rows) == want
