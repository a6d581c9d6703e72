"""The same answers in ANSI SQL on the driver's tables, for the comparison run."""

from __future__ import annotations

_SALES = """
  SELECT o_custkey AS customer_id, CAST(s_nationkey AS BIGINT) AS store_id, p_name AS product_name,
         CAST(l_shipdate AS DATE) AS sales_date, l_suppkey AS sales_person_id,
         CAST(p_retailprice AS DECIMAL(18,2)) AS price, CAST(l_quantity AS INT) AS quantity,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS total_cost,
         strftime(CAST(l_shipdate AS DATE), '%Y-%m') AS sales_month,
         CAST(year(l_shipdate) AS INT) AS sales_year, l_tax AS tax,
         o_orderpriority AS channel, nullif(o_orderstatus, 'P') AS payment_mode,
         CASE WHEN l_returnflag = 'R' THEN 'partial' WHEN l_returnflag = 'N' THEN 'extended'
              WHEN l_linestatus = 'O' THEN 'plain' ELSE 'reversed' END AS feed
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey"""

_CUSTOMERS = """
  SELECT c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name,
         split_part(c_name, '#', 2) AS last_name, n_name AS address,
         CAST(100000 + c_nationkey AS VARCHAR) AS pincode,
         concat('91', lpad(CAST(c_custkey AS VARCHAR), 8, '0')) AS phone_number
  FROM customer JOIN nation ON c_nationkey = n_nationkey"""

_STORES = """
  SELECT CAST(n_nationkey AS BIGINT) AS id, r_name AS address,
         concat('Manager ', n_name) AS store_manager_name
  FROM nation JOIN region ON n_regionkey = r_regionkey"""

_SELLERS = """
  SELECT s_suppkey AS id, split_part(s_name, '#', 1) AS first_name, split_part(s_name, '#', 2) AS last_name,
         min(s_suppkey) OVER (PARTITION BY s_nationkey) AS manager_id,
         CASE WHEN s_suppkey = min(s_suppkey) OVER (PARTITION BY s_nationkey) THEN 'Y' ELSE 'N' END AS is_manager,
         n_name AS address, CAST(200000 + s_nationkey AS VARCHAR) AS pincode
  FROM supplier JOIN nation ON s_nationkey = n_nationkey"""

_ENRICHED = """
  SELECT f.customer_id, f.store_id, f.sales_person_id, f.sales_date, f.sales_month, f.total_cost,
         c.first_name AS customer_first_name, c.last_name AS customer_last_name,
         c.address AS customer_address, c.pincode AS customer_pincode, c.phone_number,
         s.address AS store_address, s.store_manager_name,
         t.first_name AS sales_person_first_name, t.last_name AS sales_person_last_name,
         t.manager_id, t.is_manager,
         t.address AS sales_person_address, t.pincode AS sales_person_pincode
  FROM facts f JOIN customers c ON f.customer_id = c.customer_id
  JOIN stores s ON f.store_id = s.id JOIN sellers t ON f.sales_person_id = t.id"""

_MONTHLY = """
  SELECT store_id, sales_person_id, concat_ws(' ', sales_person_first_name, sales_person_last_name) AS full_name,
         sales_month, CAST(sum(total_cost) AS DECIMAL(18,2)) AS total_sales
  FROM enriched GROUP BY ALL"""

_INCENTIVE = """
  SELECT store_id, sales_person_id, full_name, sales_month, total_sales,
         CAST(CASE WHEN rnk = 1 THEN round(total_sales * CAST(0.01 AS DECIMAL(4,2)), 2) ELSE 0 END
              AS DECIMAL(18,2)) AS incentive
  FROM (SELECT *, rank() OVER (PARTITION BY store_id, sales_month ORDER BY total_sales DESC NULLS LAST) AS rnk
        FROM monthly)"""

_ADDITIONAL = "CASE WHEN feed = 'extended' THEN concat_ws(', ', channel, payment_mode) END AS additional_column"
_UNREADABLE = "(feed = 'reversed' AND tax = 0)"
_TORN = "(feed = 'plain' AND tax = 0.08)"

# What ingestion leaves of the raw files: refused feeds and unreadable rows are gone.
_WHOLE = f"SELECT *, {_ADDITIONAL} FROM sales WHERE feed <> 'partial' AND NOT {_UNREADABLE}"
# Where torn lines are not sent again, they are gone as well.
_INGESTED = f"{_WHOLE} AND NOT {_TORN}"


def _with(select: str, facts: str = "SELECT * FROM sales") -> str:
    """A query over the shared definitions; DuckDB evaluates only those it uses."""
    parts = {
        "sales": _SALES,
        "facts": facts,
        "customers": _CUSTOMERS,
        "stores": _STORES,
        "sellers": _SELLERS,
        "enriched": _ENRICHED,
        "monthly": _MONTHLY,
        "mart": _INCENTIVE,
    }
    named = ",\n".join(f"{name} AS ({body})" for name, body in parts.items())
    return f"WITH {named}\n{select}"


_FACT_LIST = (
    "customer_id, store_id, product_name, sales_date, sales_person_id, price, quantity, total_cost, additional_column"
)
_SALES_KEYS = "customer_id, store_id, sales_date, sales_person_id, total_cost"

_MART = "SELECT * FROM mart"

_CUSTOMER_MONTHLY = """
  SELECT customer_id, concat_ws(' ', customer_first_name, customer_last_name) AS full_name,
         customer_address AS address, phone_number, sales_month AS sales_date_month,
         CAST(sum(total_cost) AS DECIMAL(18,2)) AS total_sales
  FROM enriched GROUP BY ALL"""

_ENRICHED_LIST = """
  SELECT customer_id, store_id, sales_person_id, sales_date, total_cost, customer_first_name, customer_last_name,
         customer_address, customer_pincode, phone_number, store_address, store_manager_name,
         sales_person_first_name, sales_person_last_name, manager_id, is_manager,
         sales_person_address, sales_person_pincode
  FROM enriched"""

_CUSTOMER_ROWS = """
  SELECT customer_id, customer_first_name AS first_name, customer_last_name AS last_name,
         customer_address AS address, customer_pincode AS pincode, phone_number, sales_date, total_cost
  FROM enriched"""

_SALES_ROWS = """
  SELECT store_id, sales_person_id, sales_person_first_name, sales_person_last_name, store_manager_name,
         manager_id, is_manager, sales_person_address, sales_person_pincode, sales_date, total_cost, sales_month
  FROM enriched"""

_PLAIN_HEADER = "customer_id|store_id|product_name|sales_date|sales_person_id|price|quantity|total_cost"
_REVERSED_HEADER = "|".join(reversed(_PLAIN_HEADER.split("|")))
_EXTENDED_HEADER = f"payment_mode|{_PLAIN_HEADER}|channel"
_PARTIAL_HEADER = _PLAIN_HEADER.replace("store_id|", "") + "|payment_mode"


def _line(header: str) -> str:
    """A row as its feed writes it, under a header whose names are apart by bars."""
    shown = {
        "product_name": f"CASE WHEN {_TORN} THEN concat('\"', product_name, chr(10), 'again\"') ELSE product_name END",
        "total_cost": f"CASE WHEN {_UNREADABLE} THEN 'n/a' ELSE CAST(total_cost AS VARCHAR) END",
        "payment_mode": "coalesce(payment_mode, '')",
    }
    return "concat(" + ", ',', ".join(shown.get(name, name) for name in header.split("|")) + ")"


_LINE = f"""CASE feed WHEN 'plain' THEN {_line(_PLAIN_HEADER)} WHEN 'reversed' THEN {_line(_REVERSED_HEADER)}
  WHEN 'extended' THEN {_line(_EXTENDED_HEADER)} ELSE {_line(_PARTIAL_HEADER)} END"""
_RAW_ROW = "concat('{" + ", ',".join(
    f'"{name}":"\', {"\'n/a\'" if name == "total_cost" else name}, \'"\'' for name in _REVERSED_HEADER.split("|")
) + ", '}')"


def all_oracles() -> dict[str, str]:
    return {
        "sales_incentive_mart": _with(_MART),
        "sales_incentive_mart_many_customers": _with(_MART),
        "customer_monthly_mart": _with(_CUSTOMER_MONTHLY),
        "customer_monthly_mart_many_customers": _with(_CUSTOMER_MONTHLY),
        "sales_monthly_total": _with(
            """SELECT store_id, sales_person_id, sales_month, CAST(sum(total_cost) AS DECIMAL(18,2)) AS total_sales
            FROM facts GROUP BY ALL"""
        ),
        "customer_daily_purchases": _with(
            """SELECT customer_id, concat_ws(' ', customer_first_name, customer_last_name) AS full_name, sales_date,
            CAST(sum(total_cost) AS DECIMAL(18,2)) AS total_spent, count(*) AS purchases
            FROM enriched GROUP BY ALL"""
        ),
        "distinct_customer_month": _with(
            """SELECT DISTINCT customer_id, concat_ws(' ', customer_first_name, customer_last_name) AS full_name,
            customer_address AS address, phone_number, sales_month AS sales_date_month FROM enriched"""
        ),
        "distinct_salesperson_month": _with(
            """SELECT DISTINCT store_id, sales_person_id,
            concat_ws(' ', sales_person_first_name, sales_person_last_name) AS full_name, sales_month FROM enriched"""
        ),
        "window_customer_month_sum": _with(
            """SELECT customer_id, sales_month, total_cost,
            CAST(sum(total_cost) OVER (PARTITION BY customer_id, sales_month) AS DECIMAL(18,2))
              AS total_sales_every_month_by_each_customer FROM facts"""
        ),
        "window_salesperson_month_sum": _with(
            """SELECT store_id, sales_person_id, sales_month, total_cost,
            CAST(sum(total_cost) OVER (PARTITION BY store_id, sales_person_id, sales_month) AS DECIMAL(18,2))
              AS total_sales_every_month FROM facts"""
        ),
        "rank_salesperson": _with(
            """SELECT *, CAST(rank() OVER (PARTITION BY store_id, sales_month ORDER BY total_sales DESC NULLS LAST)
            AS INT) AS rnk FROM monthly"""
        ),
        "dim_customer": _with("SELECT * FROM customers"),
        "dim_store": _with("SELECT * FROM stores"),
        "dim_sales_team": _with("SELECT * FROM sellers"),
        "dim_product": """SELECT p_partkey AS id, p_name AS name,
            CAST(p_retailprice AS DECIMAL(18,2)) AS current_price FROM part""",
        "join_customer": _with(
            f"""SELECT {_SALES_KEYS}, customer_first_name, customer_last_name, customer_address, customer_pincode,
            phone_number FROM enriched"""
        ),
        "join_store": _with(f"SELECT {_SALES_KEYS}, store_address, store_manager_name FROM enriched"),
        "join_sales_team": _with(
            f"""SELECT {_SALES_KEYS}, sales_person_first_name, sales_person_last_name, manager_id, is_manager,
            sales_person_address, sales_person_pincode FROM enriched"""
        ),
        "enriched_sales": _with(_ENRICHED_LIST),
        "enriched_sales_many_customers": _with(_ENRICHED_LIST),
        "customer_mart_rows": _with(_CUSTOMER_ROWS),
        "versioned_publish_flat": _with(_CUSTOMER_ROWS),
        "sales_mart_rows": _with(_SALES_ROWS),
        "mart_partition_read": _with(_SALES_ROWS),
        "versioned_publish": _with(f"SELECT *, CAST(1709359200000 AS BIGINT) AS run_epoch FROM ({_SALES_ROWS})"),
        "incentive_report": _with(
            """SELECT full_name AS sales_person_name, store_id AS sales_person_store_id, sales_month,
            total_sales AS total_billing, incentive AS total_incentive FROM mart"""
        ),
        "preview_limit": _with(
            f"""SELECT {_SALES_KEYS}, phone_number, store_manager_name FROM enriched
            ORDER BY sales_date, customer_id, store_id, sales_person_id, total_cost LIMIT 20"""
        ),
        "expr_month": """SELECT CAST(l_shipdate AS DATE) AS sales_date,
            strftime(CAST(l_shipdate AS DATE), '%Y-%m') AS sales_month,
            substring(CAST(CAST(l_shipdate AS DATE) AS VARCHAR), 1, 7) AS sales_month_sql FROM lineitem""",
        "expr_full_name": _with("SELECT customer_id, first_name || ' ' || last_name AS full_name FROM customers"),
        "expr_concat_ws": """SELECT o_orderkey,
            concat_ws(', ', o_orderpriority, nullif(o_orderstatus, 'P')) AS additional_column FROM orders""",
        "expr_incentive": """SELECT l_orderkey, CAST(l_extendedprice AS DECIMAL(18,2)) AS total_sales,
            CAST(CASE WHEN l_tax = 0 THEN round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(0.01 AS DECIMAL(4,2)), 2)
                 ELSE 0 END AS DECIMAL(18,2)) AS incentive FROM lineitem""",
        "file_inventory": _with(
            f"""SELECT feed, sales_year, true AS is_csv, CAST(sum(strlen({_LINE}) + 1) AS BIGINT) AS content_bytes
            FROM sales GROUP BY ALL
            UNION ALL SELECT 'notes', 0, false, CAST(sum(strlen(c_name) + 1) AS BIGINT) FROM customer"""
        ),
        "schema_gate": _with(
            f"""SELECT DISTINCT feed, sales_year,
            CASE feed WHEN 'plain' THEN '{_PLAIN_HEADER}' WHEN 'reversed' THEN '{_REVERSED_HEADER}'
                      WHEN 'extended' THEN '{_EXTENDED_HEADER}' ELSE '{_PARTIAL_HEADER}' END AS columns,
            CASE feed WHEN 'partial' THEN 'store_id' ELSE '' END AS missing_columns,
            CASE feed WHEN 'partial' THEN 'missing_columns' ELSE 'accepted' END AS verdict FROM sales"""
        ),
        "union_files": _with(
            f"""SELECT customer_id, store_id, product_name, sales_date, sales_person_id, price, quantity,
            CASE WHEN NOT {_UNREADABLE} THEN total_cost END AS total_cost, {_ADDITIONAL}
            FROM sales WHERE feed <> 'partial' AND NOT {_TORN}
            UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM sales, range(2) WHERE {_TORN}"""
        ),
        "ingest_sales": _with(f"SELECT {_FACT_LIST} FROM facts", _WHOLE),
        "quarantine_rows": _with(
            f"""SELECT feed, 'unreadable_fields' AS reason, 'total_cost' AS columns, {_RAW_ROW} AS raw
            FROM sales WHERE {_UNREADABLE}
            UNION ALL SELECT feed, 'unreadable_fields', 'row_width', unnest(string_split({_LINE}, chr(10)))
            FROM sales WHERE {_TORN}
            UNION ALL SELECT feed, 'missing_columns', 'store_id', {_LINE} FROM sales WHERE feed = 'partial'"""
        ),
        "ledger_latest": _with(
            """SELECT DISTINCT feed, sales_year, CASE feed WHEN 'extended' THEN 'A' ELSE 'I' END AS status,
            'run-1' AS run_id FROM sales WHERE feed <> 'partial'"""
        ),
        "ledger_open_files": _with(
            "SELECT DISTINCT feed, sales_year, 'run-1' AS run_id FROM sales WHERE feed = 'extended'"
        ),
        "ledger_pending_files": _with(
            "SELECT DISTINCT feed, sales_year FROM sales WHERE feed IN ('extended', 'partial')"
        ),
        "batch_run_sales_mart": _with(_MART, _INGESTED),
        "broken_stream_sales_mart": _with(_MART, _INGESTED),
        "stream_ingest": _with(f"SELECT {_FACT_LIST} FROM facts", _INGESTED),
        "stream_sales_mart": _with(_MART, _INGESTED),
        "stream_customer_mart": _with(_CUSTOMER_MONTHLY, _WHOLE),
    }
