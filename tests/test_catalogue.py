import pytest

from partsieve.plans import catalogue
from tests.oracle import differences

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_oracle(spark, name):
    assert not differences(spark, name, catalogue.QUERIES[name], catalogue.ORACLES[name], SF)
