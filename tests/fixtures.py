"""Small literal tables in the shape of the real ones."""

import datetime as dt
from decimal import Decimal

from tallymart.schemas import FACT_SCHEMA
from tallymart.sources.dimensions import checked_dimensions

CUSTOMER_SCHEMA = "customer_id bigint, first_name string, last_name string, address string, pincode string" \
    ", phone_number string"
STORE_SCHEMA = "id bigint, address string, store_manager_name string"
SELLER_SCHEMA = "id bigint, first_name string, last_name string, manager_id bigint, is_manager string" \
    ", address string, pincode string"

HEADER = "customer_id,store_id,product_name,sales_date,sales_person_id,price,quantity,total_cost"


def fact(customer, store, seller, day, total, **other):
    return (
        customer,
        store,
        other.get("product", "sugar"),
        None if day is None else dt.date.fromisoformat(day),
        seller,
        Decimal("50.00"),
        1,
        None if total is None else Decimal(total),
        None,
    )


def facts(spark, rows):
    return spark.createDataFrame(rows, FACT_SCHEMA)


def customers(spark, ids=(1, 2, 3), extra=()):
    rows = [(i, f"Ann{i}", "Bell", "Town", "1000", f"91{i}") for i in ids]
    return spark.createDataFrame([*rows, *extra], CUSTOMER_SCHEMA)


def stores(spark, ids=(121, 122)):
    return spark.createDataFrame([(i, "Street", f"Manager {i}") for i in ids], STORE_SCHEMA)


def sellers(spark, ids=(1, 2, 3, 4), extra=()):
    rows = [(i, f"Sam{i}", "Till", 9, "N", "Road", "2000") for i in ids]
    return spark.createDataFrame([*rows, *extra], SELLER_SCHEMA)


def dimensions(spark, **tables):
    return checked_dimensions(
        tables.get("customers", customers(spark)),
        tables.get("stores", stores(spark)),
        tables.get("sellers", sellers(spark)),
        broadcast_bytes=tables.get("broadcast_bytes", 1 << 20),
    )


def bag(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(row) for row in picked.collect()), key=repr)
