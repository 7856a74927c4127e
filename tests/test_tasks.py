"""Pages of one small file are put together and parsed by all tasks of the cluster."""

import datetime

import pyspark.sql.functions as F
import pytest

from marquee import plans
from workload import queries as w


@pytest.fixture(scope="module")
def one_file(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    day = datetime.datetime(1999, 1, 1)
    customers = [(k, f"C{k}", "S") for k in range(200)]
    orders = [(k, k % 200, "O", day, "5-LOW") for k in range(2000)]
    spark.createDataFrame(customers, "c_custkey bigint, c_name string, c_mktsegment string").coalesce(1).write.parquet(
        f"{folder}/customer.parquet"
    )
    spark.createDataFrame(
        orders, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp, o_orderpriority string"
    ).coalesce(1).write.parquet(f"{folder}/orders.parquet")
    return folder


def tasks(df):
    return df.select(F.spark_partition_id()).distinct().count()


def test_pages_of_unmatched_tags(spark, one_file):
    rows = w.html_unmatched_tags(spark, one_file)
    assert rows.count() == 200
    assert tasks(rows) >= spark.sparkContext.defaultParallelism


def test_full_title_pages(spark, one_file):
    rows = w.detail_sections(spark, one_file)
    assert rows.count() == 200
    assert tasks(rows) >= spark.sparkContext.defaultParallelism


def test_title_pages_of_the_build(spark, one_file):
    built = plans.build_catalogue(w._list_pages(spark, one_file), w._title_pages(spark, one_file), "https://ex.example")
    assert built.merged.count() == 2000
    assert tasks(built.details) >= spark.sparkContext.defaultParallelism


def test_title_pages_of_each_year(spark, one_file):
    titles = w._title_pages(spark, one_file).withColumn("src_year", F.explode(F.array(F.lit(0), F.lit(1))))
    years = (F.col("page_id") % 2).cast("int")
    built = plans.build_catalogue(w._list_pages(spark, one_file).withColumn("src_year", years), titles, "https://ex.example")
    assert built.details.count() == 200  # the orders of a customer are on pages of one year here
    assert tasks(built.details) >= spark.sparkContext.defaultParallelism


def test_list_pages(spark, one_file):
    rows = w.listing_sections(spark, one_file)
    assert rows.count() == 1804
    assert tasks(rows) >= spark.sparkContext.defaultParallelism


def test_list_pages_hold_the_same_items(spark, one_file):
    """One page for every 50 keys, its items in the order of their text."""
    pages = {r["page_id"]: r["html"] for r in w._list_pages(spark, one_file).collect()}
    assert sorted(pages) == list(range(40))
    for page, html in pages.items():
        titles = [t.split(">")[1].split(".")[0] for t in html.split("<h3 ")[1:]]
        assert titles == sorted(str(k) for k in range(page * 50, page * 50 + 50))
