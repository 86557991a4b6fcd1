"""Every registered query with an oracle must equal it; the flagship must have a stable shape."""

from __future__ import annotations

import pytest
from compare import differences, duck
from conftest import TINY

from __spark_entry__ import entry, oracle_sql, queries
from millwatch.oracles import ORACLES


@pytest.fixture(scope="module")
def con():
    return duck(TINY)


def test_oracles_belong_to_queries():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, con, name):
    assert differences(queries()[name](spark, TINY).toPandas(), con.execute(oracle_sql()[name]).df()) == ""


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["reading_id", "timestamp", "equipment_id", "alert_type", "severity", "message", "z_score"]
    assert df.count() > 0
