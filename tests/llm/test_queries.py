import pytest

from plumbline.llm import queries


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_runs(spark, data, name):
    df = queries.QUERIES[name](spark, data)
    rows = df.collect()
    if name.endswith("_found"):
        assert len(set(map(tuple, rows))) == len(rows) and all(v is not None for r in rows for v in r)
