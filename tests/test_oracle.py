"""Every registered query against its DuckDB oracle at sf0.01, and the
driver smoke entry at sf0.001."""

import os
import sys

import pytest

from conftest import SF001, SF0001

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(__file__)), "tools"))

import __spark_entry__ as ent  # noqa: E402
import oracle_check  # noqa: E402

NAMES = sorted(ent.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    return oracle_check.duck(SF001)


def test_every_query_has_an_oracle():
    own = {*ent.catalog.QUERIES, *ent.catalog_io.QUERIES}
    assert own <= set(ent.oracle_sql()) <= set(ent.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    problems, _, _ = oracle_check.compare(spark, SF001, name, ent.queries()[name],
                                          ent.oracle_sql()[name], duck)
    assert not problems, problems


def test_entry_smoke(spark):
    df = ent.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["date", "date_year_month", "step_count"]
    assert ent.entry(spark).schema == df.schema
    assert SF0001 in ent.SMOKE_SF_DIR
