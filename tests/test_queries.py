"""Every registered query against its SQL, on the smallest tables."""

import pytest
from oracle import compare

from vellum.plans import registry

SF = "/root/testdata/sf0.001"
TEXT = [n for n in registry.queries() if n.startswith(("uni_", "rx_", "stage_", "ocr_", "norm_", "pipeline_", "slice_"))]


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_equals_its_sql(spark, name):
    rows, differences = compare(spark, name, SF)
    assert not differences
    assert rows or name in ("oversized_columns", "ruled_vertical_runs")  # too few rows here


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_runs(spark, name):
    sf = SF.replace("0.001", "0.01") if name == "gutter_peaks" else SF  # too little ink there
    assert registry.queries()[name](spark, sf).count() > 0


@pytest.mark.parametrize("name", TEXT)
def test_is_not_vacuous(spark, name):
    assert registry.queries()[name](spark, SF).where("changed").count() > 0


def test_flagship(spark):
    assert registry.flagship(spark, SF).count() == 200
