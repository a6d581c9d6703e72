"""The landing folders: no readable sale is lost from what is sent again."""

import datetime as dt
from decimal import Decimal

import pytest
from fixtures import bag
from pyspark.sql import functions as F

from tallymart.plans.registered import all_queries
from tallymart.sources import standin
from tallymart.sources.landing import TORN_TAX


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Four sales of one order: a sound one, two that come torn, of which one names no product, and one refused."""
    folder = str(tmp_path_factory.mktemp("tables"))
    day = dt.datetime(1998, 7, 4)
    rows = {
        "region": [(0, "EAST")],
        "nation": [(7, "UTOPIA", 0)],
        "customer": [(1, "Customer#000000001", 7)],
        "supplier": [(5, "Supplier#000000005", 7)],
        "part": [(2, "blue tea", 3.5), (3, None, 4.5)],
        "orders": [(9, 1, "P", "1-URGENT")],
        "lineitem": [
            (9, 2, 5, 1.0, 10.0, 0.01, "A", "O", day),
            (9, 2, 5, 2.0, 20.0, TORN_TAX, "A", "O", day),
            (9, 3, 5, 3.0, 40.0, TORN_TAX, "A", "O", day),
            (9, 2, 5, 4.0, 80.0, TORN_TAX, "R", "O", day),
        ],
    }
    for name, schema in standin.TABLES.items():
        spark.createDataFrame(rows[name], schema).write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_torn_sales_sent_again_are_ingested_whole(spark, tables):
    found = all_queries()["ingest_sales"](spark, tables)
    assert bag(found, "product_name", "quantity", "total_cost") == sorted(
        [("blue tea", 1, Decimal("10.00")), ("blue tea", 2, Decimal("20.00")), (None, 3, Decimal("40.00"))], key=repr
    )


def test_torn_sales_sent_again_count_for_the_streamed_customer(spark, tables):
    found = all_queries()["stream_customer_mart"](spark, tables)
    assert bag(found, "customer_id", "sales_date_month", "total_sales") == [(1, "1998-07", Decimal("70.00"))]


def test_torn_sales_still_go_to_quarantine(spark, tables):
    found = all_queries()["quarantine_rows"](spark, tables).filter(F.col("columns") == "row_width")
    assert bag(found, "feed", "raw") == [("plain", '1,7,"blue tea'), ("plain", 'again",1998-07-04,5,3.50,2,20.00')]
