"""Column contracts shared by every module."""

from __future__ import annotations

# The columns every raw sales file must carry, in fact order.
MANDATORY_COLUMNS = (
    "customer_id",
    "store_id",
    "product_name",
    "sales_date",
    "sales_person_id",
    "price",
    "quantity",
    "total_cost",
)

EXTRA_COLUMN = "additional_column"
FACT_COLUMNS = (*MANDATORY_COLUMNS, EXTRA_COLUMN)

# Money stays decimal from the first read: sums of binary floats depend on the
# order in which partitions arrive.
MONEY = "decimal(18,2)"

# The types of the fact columns.
FACT_TYPES = {
    "customer_id": "bigint",
    "store_id": "bigint",
    "product_name": "string",
    "sales_date": "date",
    "sales_person_id": "bigint",
    "price": MONEY,
    "quantity": "int",
    "total_cost": MONEY,
    EXTRA_COLUMN: "string",
}

# Table schemas as DDL; partition columns come last.
FACT_SCHEMA = ", ".join(f"{name} {kind}" for name, kind in FACT_TYPES.items())

# A typed row, its file, and why it was refused if it was.
CONFORMED_SCHEMA = f"{FACT_SCHEMA}, file_path string, failed_columns array<string>, raw_row string"

STORED_SCHEMA = f"{CONFORMED_SCHEMA}, run_id string, attempt int, row_status string, sales_month string"

# Raw lines of refused files.
REFUSED_SCHEMA = "raw_line string, file_path string, missing_columns array<string>, reason string"

# Pre-aggregated sales, the additive input of both monthly marts.
TOTALS_SCHEMA = (
    f"customer_id bigint, store_id bigint, sales_person_id bigint, total_cost {MONEY}"
    ", sales_month string"
)

# The columns of both monthly marts.
CUSTOMER_MONTH_SCHEMA = (
    f"customer_id bigint, full_name string, address string, phone_number string, total_sales {MONEY}"
    ", sales_date_month string"
)

SALES_INCENTIVE_SCHEMA = (
    f"store_id bigint, sales_person_id bigint, full_name string, total_sales {MONEY}, incentive {MONEY}"
    ", sales_month string"
)

LEDGER_SCHEMA = "file_path string, file_name string, status string, event_ts timestamp, run_id string, attempt int"

# Ledger states. A and I. E marks files refused by the header gate.
ACTIVE = "A"
INACTIVE = "I"
REFUSED = "E"
