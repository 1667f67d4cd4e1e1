"""One member with a third of the encounters and one encounter with a third of the lines."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as contract
from starcheck.bind import STAR_SCHEMAS
from tests.test_oracles import ordered

SOURCE = "/root/testdata/sf0.001"
HOT = {
    "orders": "select * replace (if(o_orderkey % 3 = 0, 7, o_custkey) as o_custkey)",
    "lineitem": "select * replace (if(l_partkey % 3 = 0, 424, l_orderkey) as l_orderkey)",
}


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    connection = duckdb.connect()
    for table in STAR_SCHEMAS:
        select = HOT.get(table, "select *")
        connection.execute(f"copy ({select} from '{SOURCE}/{table}.parquet') to '{folder}/{table}.parquet' (format parquet)")
        connection.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return str(folder), connection


@pytest.mark.parametrize(
    "name",
    ["int_claims_unioned", "encounter_util", "int_member_chronic_flags", "readmission_flags", "mart_care_gaps",
     "primary_provider", "provider_spend", "provider_top_condition", "mart_provider_efficiency"],
)
def test_hot_keys_give_whole_results(spark, skewed, name):
    folder, duck = skewed
    df = contract.queries()[name](spark, folder)
    result = duck.execute(contract.oracle_sql()[name])
    columns = [column[0] for column in result.description]
    expected = [tuple(row[columns.index(c)] for c in df.columns) for row in result.fetchall()]
    assert ordered([tuple(row) for row in df.collect()]) == ordered(expected) and expected
