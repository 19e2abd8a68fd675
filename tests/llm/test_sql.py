"""Every training-data query with SQL against that SQL on the smallest tables."""

import pytest

from actaflow.llm.queries import ORACLES, QUERIES
from tests.test_queries import canonical, duck  # noqa: F401


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, base, name):  # noqa: F811
    got = QUERIES[name](spark, base)
    cur = duck.execute(ORACLES[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(got.columns)
    assert canonical(got.columns, got.collect()) == canonical(columns, cur.fetchall())
