"""Every registered query against its DuckDB SQL on the smallest tables
(the driver does the same at sf0.01)."""

import pytest

import __spark_entry__ as entry
from fraudmart.plans.queries import registry
from tests.conftest import SF
from tools.oracle_check import bag

#: the reference's own operators (those of fraudmart.llm are tested in tests/llm)
NAMES = sorted(registry())
SQL = {k: v for k, v in entry.oracle_sql().items() if k in NAMES}


def test_every_query_has_sql():
    assert set(SQL) == set(NAMES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF["0.001"])
    srows, scols = [tuple(r) for r in df.collect()], df.columns
    rel = duck(SF["0.001"]).sql(SQL[name])
    drows, dcols = rel.fetchall(), rel.columns
    assert sorted(scols) == sorted(dcols)
    order = sorted(scols)
    assert len(srows) == len(drows)
    assert bag(srows, scols, order) == bag(drows, dcols, order)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["event_dt", "passport", "fio", "phone", "event_type", "report_dt"]
    assert df.count() > 0
