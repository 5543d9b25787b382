"""Every registered query against its SQL on the smallest tables."""

import pytest

from packetmill.plans.queries import ORACLES, QUERIES
from tests.compare import connection, differences

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connection(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert differences(QUERIES[name](spark, FOLDER), con, ORACLES[name]) == ""


def test_equal_urls_of_an_analysis_stay_rows_of_their_own(spark, con, tmp_path):
    pages = con.sql("select page_id, url, html from pages union all select page_id + 50000, url || '#b', html from pages")
    pages.write_parquet(f"{tmp_path}/pages.parquet")
    name = "upsert_resource_candidates"
    other = connection(FOLDER)
    other.sql(f"create or replace view pages as select * from '{tmp_path}/pages.parquet'")
    assert differences(QUERIES[name](spark, str(tmp_path)), other, ORACLES[name]) == ""
