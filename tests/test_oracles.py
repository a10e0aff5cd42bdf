import pytest

import __spark_entry__ as entry

from .compare import SF, duck, sparked

CORE = {k: v for k, v in entry.oracle_sql().items() if k in {**entry.disclosures.ORACLE, **entry.data_quality.ORACLE}}


@pytest.mark.parametrize("name", sorted(CORE))
def test_query_equals_sql(spark, name):
    names, rows = sparked(entry.queries()[name](spark, SF))
    want_names, want = duck(CORE[name])
    assert names == want_names
    assert rows == want, (list((rows - want).items())[:3], list((want - rows).items())[:3])


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
