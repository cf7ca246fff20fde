"""Every operator against the same plan on the other engine, at the smallest size."""

from __future__ import annotations

import math
import os

import pytest

from fernwell import catalog

DATA = os.environ.get("FERNWELL_DATA", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(DATA):
        pytest.skip("no data")
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def shown(v) -> str:
    if v is None:
        return "~"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6g}"
    try:
        return f"{float(v):.6g}" if not isinstance(v, (str, bool)) else str(v)
    except (TypeError, ValueError):
        return str(v)


@pytest.mark.parametrize("key", sorted(catalog.oracle_sql()))
def test_same_rows(spark, duck, key):
    df = catalog.queries()[key](spark, DATA)
    cols = sorted(df.columns)
    got = sorted(tuple(shown(r[c]) for c in cols) for r in df.collect())
    rel = duck.sql(catalog.oracle_sql()[key])
    at = [rel.columns.index(c) for c in cols]
    assert sorted(rel.columns) == cols
    assert sorted(tuple(shown(r[i]) for i in at) for r in rel.fetchall()) == got
