"""Every registered query of the engine's own operators against its SQL."""

import pytest
from oracle import connect, differences

from tesserae import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, con, name):
    assert name in registry.oracle_sql()
    assert differences(registry.queries()[name](spark, SF), con, registry.oracle_sql()[name]) == ""


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(registry.queries()) <= set(__spark_entry__.queries())
