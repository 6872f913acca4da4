"""Stored tables answer like the lines they come from."""

from conftest import rows

from orderlens.plans import catalog, marts
from orderlens.plans.inputs import Inputs
from orderlens.sources.files import read_mart

FOLDER = "/root/testdata/sf0.001"


def test_the_stored_star_is_read_back(spark, tmp_path):
    fresh = Inputs(spark, FOLDER)
    marts.build_star(fresh.raw, str(tmp_path))
    stored = marts.StoredInputs(spark, FOLDER, str(tmp_path))
    for name in ("dim_products", "dim_date", "star_join"):
        columns = sorted(catalog.STAR[name](stored).columns)
        assert rows(catalog.STAR[name](stored), *columns) == rows(catalog.STAR[name](fresh), *columns)
    joined = catalog.STAR["star_join"](stored)
    # Dimensions come from their tables: no aggregate is left.
    assert "Aggregate" not in joined._jdf.queryExecution().executedPlan().toString()


def test_all_reports_of_a_group_are_written(spark, tmp_path):
    inputs = Inputs(spark, FOLDER)
    names = catalog.write_reports(inputs, str(tmp_path), ["profile"])
    assert names == list(catalog.GROUPS["profile"])
    for name in ("etl_audit", "monthly_volume"):
        columns = catalog.RAW[name](inputs).columns
        assert rows(read_mart(spark, str(tmp_path), name), *columns) == rows(catalog.RAW[name](inputs), *columns)
