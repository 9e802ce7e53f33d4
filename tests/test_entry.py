"""The registry, and its queries against their SQL on the smallest tables."""

import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def plain(v):
    if isinstance(v, float):
        return "~" if v != v else repr(v)
    return "~" if v is None else str(v)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
def test_queries_match_their_sql(spark):
    import duckdb

    from thicket.plans.registry import ORACLES

    con = duckdb.connect()
    for t in TABLES.split():
        con.sql(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    found = entry.queries()
    for name, sql in ORACLES.items():
        df = found[name](spark, SF)
        out = con.execute(sql)
        names = [c[0] for c in out.description]
        assert sorted(names) == sorted(df.columns), name
        want = sorted(tuple(plain(r[names.index(c)]) for c in sorted(names)) for r in out.fetchall())
        assert sorted(tuple(plain(r[c]) for c in sorted(names)) for r in df.collect()) == want, name


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", ["pixel_positions", "places"])
def test_suppliers_beyond_their_tile(spark, tmp_path, name):
    """Queries on suppliers whose numbers go beyond the 2400 lines of their tile."""
    import duckdb

    con, path = duckdb.connect(), f"{tmp_path}/supplier.parquet"
    con.sql(f"copy (select s_suppkey + shift as s_suppkey, * exclude s_suppkey from read_parquet('{SF}/supplier.parquet'), (values (0), (23950), (59900)) t(shift)) to '{path}'")
    con.sql(f"create view supplier as select * from read_parquet('{path}')")
    out, df = con.execute(entry.oracle_sql()[name]), entry.queries()[name](spark, str(tmp_path))
    names = [c[0] for c in out.description]
    want = sorted(tuple(plain(r[names.index(c)]) for c in sorted(names)) for r in out.fetchall())
    assert len(want) == 3 * spark.read.parquet(f"{SF}/supplier.parquet").count()
    assert sorted(names) == sorted(df.columns) and sorted(tuple(plain(r[c]) for c in sorted(names)) for r in df.collect()) == want


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
def test_entry(spark):
    assert entry.entry(spark).columns == ["iso", "cdm_period", "date", "count"]


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_core_stands_alone(tmp_path):
    """Without the optional folders the entry still imports, and nothing of the core imports them."""
    code = "import sys; sys.modules['thicket.llm'] = None; import __spark_entry__ as e; import thicket.plans.jobs, thicket.streaming.updates; print(len(e._core().QUERIES))"
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    assert out.returncode == 0 and int(out.stdout) > 30, out.stderr
