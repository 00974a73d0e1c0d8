import pytest

import compare
from cabstrata.llm import queries


@pytest.fixture(scope="module")
def duck(small):
    return compare.views(small)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_equals_its_twin(spark, small, duck, name):
    df = queries.QUERIES[name](spark, small)
    if name in queries.SQL:
        compare.check(df, duck, queries.SQL[name])
    else:
        assert df.count() >= 0


def test_found_columns(spark, small):
    assert set(queries.SQL) <= set(queries.QUERIES)
    assert queries.QUERIES["p2_found"](spark, small).dtypes == [("group_row_id", "bigint"), ("survivor_row_id", "bigint"), ("fare_row_id", "bigint")]
    assert queries.QUERIES["p8_ids"](spark, small).dtypes == [("doc_id", "bigint"), ("ids", "array<int>")]
    assert queries.QUERIES["p10_found"](spark, small).dtypes == [("doc_id_a", "bigint"), ("doc_id_b", "bigint")]
