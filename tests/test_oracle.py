"""Every registered query against its DuckDB oracle at sf0.01: same columns,
same types, same rows, doubles bit for bit."""

import pytest

from paths import SF01
from oracle_check import compare

from tidemark.plans import registry as E

QUERIES = E.queries()
ORACLE = E.oracle_sql()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck01, name):
    problems = compare(spark, duck01, name, QUERIES[name], ORACLE[name], SF01, verbose=False)
    assert not problems, problems
