import pytest

from helpers import SF, by_id, oracle_rows
from larder.llm.oracle import ORACLE
from larder.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    got, want = by_id(QUERIES[name](spark, SF)), oracle_rows(ORACLE[name])
    assert len(got) == len(want)
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    assert not wrong, wrong[:3]
