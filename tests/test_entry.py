"""The driver contract, and every query against its SQL on the smallest tables."""

import re

import pytest

import __spark_entry__ as entry
from check_oracles import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


NAMES = [n for n in entry.queries() if n not in entry.LLM_QUERIES]


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(NAMES) <= set(entry.oracle_sql())
    assert not [n for n in NAMES if re.match(r"op\d|.*pipeline", n)]


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["id", "title"]
    assert df.count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, connection, name):
    assert compare(spark, connection, name, SF) is None
