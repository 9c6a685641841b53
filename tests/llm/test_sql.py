"""The SQL of the operators that have any, on the smallest tables."""

import pytest
from oracle import compare

from vellum.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_equals_its_sql(spark, name):
    rows, differences = compare(spark, name, SF)
    assert not differences and rows


def test_every_operator_is_registered():
    found = sorted(queries.queries(), key=lambda n: int(n[2:].split("_")[0]))
    assert [n.split("_")[0] for n in found] == [f"op{i}" for i in range(1, 11)]
