"""Every registered query of the library against its comparison SQL on the smallest tables."""

import pytest
from compare import compare, duck

import __spark_entry__ as E
from schemaward.workload.catalogue import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(E.queries()[name](spark, SF), con, ORACLES[name]) is None


def test_entry(spark):
    assert E.entry(spark).count() > 0


def test_queries_leave_the_partition_count_alone(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    E.queries()["object_counts"](spark, "/root/testdata/sf0.1")
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
