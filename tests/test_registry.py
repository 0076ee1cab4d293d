"""Every query of the library against its SQL in DuckDB, and the entry module without its optional part."""

import math
import subprocess
import sys
from pathlib import Path

import pandas as pd
import pytest

from gristlane.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


def plain(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return float(f"{v:.9g}")
    return v if isinstance(v, (bool, int)) else str(v)


def rows(frame, columns):
    return sorted((tuple(plain(v) for v in r) for r in frame[columns].itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_against_sql(spark, duck, name):
    got = registry.QUERIES[name](spark, SF).toPandas()
    want = duck.sql(registry.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    assert rows(got, columns) == rows(want, columns)


def test_entry_without_llm():
    """The entry module and all other queries do without the subpackage and the pipeline."""
    code = "import sys; sys.modules['gristlane.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; q = e.queries(); assert 'monitor_summary' in q and 'pipeline' not in q and not any(k.startswith('op1_') for k in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parent.parent, check=True)
