"""Every registered query of the library against its SQL on the smallest tables."""

import pytest
from parity import compare, connect

from __spark_entry__ import entry
from wavelens.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"
# Large bases and rare slices that the smallest tables do not have; they have rows at sf0.01.
EMPTY_ALLOWED = {
    "filter_min_base", "join_semi_whitelist", "result_faixas_salariais_descartadas", "survey_comparable", "survey_rank_profiles",
}


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("key", list(QUERIES))
def test_query(spark, duck, key):
    problem = compare(QUERIES[key].run(spark, SF_DIR), duck, QUERIES[key].sql)
    assert problem is None or (problem == "EMPTY" and key in EMPTY_ALLOWED)


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_query_has_a_check():
    assert all(query.sql for query in QUERIES.values())
