"""Every query against its SQL oracle."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import connect, difference
from conftest import SF_DIR
from flowlantern.plans.oracle import ORACLE
from flowlantern.plans.queries import QUERIES


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


def test_every_query_of_the_tables_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_query_equals_oracle(spark, db, name):
    found = queries()[name](spark, SF_DIR).toPandas()
    assert len(found) > 0
    assert difference(found, db.sql(oracle_sql()[name]).df()) is None


def test_entry(spark):
    assert set(entry(spark).columns) >= {"src_ip", "vlan", "comportamento"}


@pytest.mark.parametrize("name", ["eve_time_parts", "silver", "alerts_limit", "flow_sessions"])
def test_results_do_not_follow_the_session_time_zone(spark, db, name):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        found = queries()[name](spark, SF_DIR).toPandas()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert difference(found, db.sql(oracle_sql()[name]).df()) is None
