"""Every registered query against its DuckDB oracle on the smallest tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from docmart.plans.queries import QUERIES
from oracle_harness import compare, constant_columns, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    """Every query of the reference's operators has SQL; those of the training-data operators are tested in their own folder."""
    _, problems = compare(spark, con, name, queries()[name], oracle_sql()[name], SF)
    assert not problems, problems


# These queries must show every value that their rules can give, blanks included.
CUED = {"label_dictionary", "url_classifier", "person_and_required_flags", "contact_extract", "max_level"}


@pytest.mark.parametrize("name", sorted(CUED))
def test_no_column_is_constant(spark, name):
    df = queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) >= 50 and constant_columns(df.columns, rows) == []


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0 and "CODIGO_TRAMITE" in df.columns


def test_no_order_of_a_customer_is_lost(spark):
    """Several orders of one customer with one priority are all cost items; the dearest is in the wide table."""
    items = queries()["wide_main_costs"](spark, SF).collect()
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    assert sorted((r["CODIGO_TRAMITE"], r["ID_PEDIDO"]) for r in items) == sorted(
        (r["o_custkey"], r["o_orderkey"]) for r in orders.select("o_custkey", "o_orderkey").collect())
    best, seen = {}, set()
    for r in items:
        at = r["CODIGO_TRAMITE"], r["CONCEPTO"]
        best[at] = max(best.get(at, 0), float(r["COSTO"]))
        seen.add(at)
    assert len(seen) < len(items)
    for r in queries()["wide_main_table"](spark, SF).collect():
        own = sorted(v for (c, _), v in best.items() if c == r["CODIGO_TRAMITE"])
        assert [float(x) for x in (r["MONTO_COSTO"] or "").split("|") if x] == own
