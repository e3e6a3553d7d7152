"""Every query of this part that has SQL against it in DuckDB."""

import pytest

from check import compare
from lakeload.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query(spark, name, sf):
    assert compare(spark, name, f"/root/testdata/sf{sf}").startswith("ok")


def test_one_query_for_each_operator():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]
