"""Every bibliographic query against its SQL on DuckDB, over whole small tables."""

from __future__ import annotations

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from scholarlake.operators import reports
from scholarlake.plans import flow_queries, more_queries, registry, store_queries  # noqa: F401 - these register more

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        path = f"{SF}/{t}.parquet"
        con.execute(f"create view {t} as select * from '{path if os.path.isfile(path) else path + '/*.parquet'}'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if v != v else round(v, 9)
    return v


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    cur = duck.execute(registry.ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    want = sorted((tuple(plain(r[i]) for i in at) for r in cur.fetchall()), key=str)
    got = sorted((tuple(plain(v) for v in r) for r in df.select(*cols).collect()), key=str)
    assert got == want


def test_decimal_text_report_holds_all_rows_in_order(spark):
    got = [r["p_partkey"] for r in registry.QUERIES["all_by_decimal_text"](spark, SF).collect()]
    part = spark.read.parquet(f"{SF}/part.parquet").select("p_partkey", "p_retailprice").collect()
    assert len(part) > 100 and got == [r["p_partkey"] for r in sorted(part, key=lambda r: (-r["p_retailprice"], r["p_partkey"]))]
    texts = spark.createDataFrame([(i, f"{i % 60},5" if i % 4 else ("-", "x", None)[i % 3]) for i in range(240)], "k long, v string").repartition(5)
    rows = reports.all_by_decimal_text(texts, "v", F.asc("k")).collect()
    good = sorted((i for i in range(240) if i % 4), key=lambda i: (-(i % 60), i))
    assert [r["k"] for r in rows] == good + list(range(0, 240, 4)) and {r["number"] for r in rows[180:]} == {None}


def test_page_links_hold_each_address_once(spark):
    df = registry.QUERIES["page_links"](spark, SF)
    assert df.count() == df.select("page_id", "link").distinct().count() > 0
    assert df.where("link not like 'http%'").count() == 0
