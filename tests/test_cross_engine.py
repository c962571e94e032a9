"""Every checked query against its SQL, on the smallest star."""

import pytest
from conftest import STAR

from __spark_entry__ import entry
from checks.compare import compare, star_connection
from checks.oracles import all_oracles
from checks.queries import all_queries

FOLDER = f"{STAR}/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return star_connection(FOLDER)


def test_every_query_has_sql():
    assert set(all_queries()) == set(all_oracles())


@pytest.mark.parametrize("name", list(all_queries()))
def test_engines_agree(spark, connection, name):
    assert compare(spark, connection, FOLDER, name) in ("", "agree, but empty")


def test_entry(spark):
    assert entry(spark).count() > 0
