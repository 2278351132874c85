"""The literal Spark SQL forms and the operators give the same rows."""

import pytest

from quarry.plans.catalog import CATALOG
from quarry.plans.check import digest
from quarry.plans.literal import LITERAL_SQL, literal_query

from conftest import SF001


@pytest.mark.parametrize("key", sorted(LITERAL_SQL))
def test_literal_equals_operator(spark, key):
    a = literal_query(spark, key, SF001)
    b = CATALOG[key](spark, SF001)
    ra, rb = [tuple(r) for r in a.collect()], [tuple(r) for r in b.collect()]
    assert len(ra) == len(rb)
    assert digest(a.columns, ra) == digest(b.columns, rb)
