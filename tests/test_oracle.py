"""Every registered query against its DuckDB oracle SQL (the driver's correctness gate), on the
smallest scale factor; ``tests/oracle_check.py`` runs the same comparison at any scale."""

import pytest

import __spark_entry__ as E
import oracle_check as OC
from listingflow.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def duck():
    return OC.duck_connect(SF)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(E.oracle_sql()) and set(NAMES) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    OC.SF_DIR = SF
    problems, rows, _, _ = OC.compare(spark, duck, name, E.queries()[name], E.oracle_sql()[name])
    assert not problems, problems


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["host", "pages", "valid_pages", "links", "max_title_len"]
    assert df.count() > 0
