"""Queries on small tables of their own, against their SQL."""

import datetime

import duckdb
import pytest

import __spark_entry__ as e
from compare import normal, spark_rows


@pytest.fixture
def tables(spark, tmp_path):
    """Parts of one brand in one run, and the line items that name them."""
    day = datetime.date(1995, 3, 1)
    data = {
        "part": ("p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
                 [(k, f"n{k}", f"Brand#{1 + k % 2}", "TIN", 1, 901.0 + k) for k in (8, 10, 16, 18, 24, 32)]),
        "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate date, o_orderpriority string",
                   [(k, 8 + k % 2, "F", 10.0, day, "2-HIGH") for k in range(1, 5)]),
        "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double,"
                     " l_discount double, l_tax double, l_returnflag string",
                     [(1 + k % 4, k, 1, 1 + k % 3, 2.0, 2.0 * (901 + k), 0.0, 0.01, "N") for k in (8, 10, 16, 24, 32, 18)]),
    }
    con = duckdb.connect()
    for name, (schema, rows) in data.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    return str(tmp_path), con


def test_every_part_is_in_the_wide_list(spark, tables):
    path, con = tables
    got = e.queries()["spikeins_wide"](spark, path)
    values = [c for c in got.columns if c.endswith("_delta_to_expected_rt")]
    assert sum(row[c] is not None for row in got.collect() for c in values) == 6
    result = con.execute(e.oracle_sql()["spikeins_wide"])
    names = [c[0] for c in result.description]
    # The SQL has a column for each of 25 brands, of which two are there.
    here = [i for i, c in enumerate(names) if c in got.columns]
    assert spark_rows(got) == normal([names[i] for i in here], [tuple(row[i] for i in here) for row in result.fetchall()])
