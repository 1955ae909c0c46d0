"""Independent SQL statement of every registered query, for DuckDB.

Each query is a WITH-chain: the fixture views (same text as the Spark-side
adapters in ``tradewind.sources.testdata``), the staging step, then the
operator's own CTEs.  Only the CTEs a query references (transitively) are
emitted.  Output columns are cast to the same declared types as the Spark side.
"""

from __future__ import annotations

import re

# ---------------------------------------------------------------- helpers (SQL text)


def r(x: str, n: int) -> str:
    """Half-away-from-zero rounding on the double value (same spelling as Spark)."""
    s = f"{10 ** n}.0::DOUBLE"
    return f"(sign(CAST({x} AS DOUBLE)) * floor(abs(CAST({x} AS DOUBLE)) * {s} + 0.5::DOUBLE) / {s} + 0.0::DOUBLE)"


def tc(x: str) -> str:
    """Python str.title(); empty -> NULL."""
    return (f"array_to_string(list_transform(regexp_extract_all(NULLIF({x}, ''), '(\\p{{L}}+|[^\\p{{L}}]+)'), "
            f"lambda t: upper(t[1]) || lower(t[2:])), '')")


def label(x: str) -> str:
    return tc(f"replace({x}, '_', ' ')")


def d(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def mean(x: str, rows: str = "") -> str:
    """AVG(x) by its definition: over the known values alone, and exact up to the division."""
    return f"CAST(SUM({x}) {rows} AS DOUBLE) / COUNT({x}) {rows}"


def conform(schema: list[tuple[str, str]], src: str, order: str = "") -> str:
    cols = ", ".join(c if t == "KEY" else f"CAST({c} AS {t}) AS {c}" for c, t in schema)
    return f"SELECT {cols} FROM {src}" + (f" ORDER BY {order}" if order else "")


VALID = "order_status NOT IN ('canceled', 'unavailable')"

# ---------------------------------------------------------------- fixture views

CTES: dict[str, str] = {}


def cte(name: str, sql: str) -> None:
    CTES[name] = sql


cte("raw_sellers", """SELECT s_suppkey AS seller_id, CAST(s_suppkey % 97 AS VARCHAR) AS seller_zip_code_prefix,
  CONCAT('  ', LOWER(n_name), ' d''oeste ') AS seller_city, CONCAT(' ', LOWER(SUBSTR(r_name,1,2))) AS seller_state
  FROM supplier JOIN nation ON s_nationkey=n_nationkey JOIN region ON n_regionkey=r_regionkey""")
cte("raw_products", """SELECT p_partkey AS product_id,
  CASE WHEN p_size=13 THEN NULL ELSE LOWER(CONCAT(p_type,'_',REPLACE(p_brand,'#','_'))) END AS product_category_name,
  CASE WHEN p_size%10=0 THEN 'n/a' ELSE CAST(p_size AS VARCHAR) END AS product_weight_g,
  CAST(p_size AS VARCHAR) AS product_length_cm,
  CAST(p_retailprice / 100 AS VARCHAR) AS product_height_cm,
  CASE WHEN p_size%7=0 THEN '' ELSE CAST(p_size*2 AS VARCHAR) END AS product_width_cm,
  CAST(p_partkey % 6 AS VARCHAR) AS product_photos_qty
  FROM part""")
cte("category_translation", """SELECT DISTINCT LOWER(CONCAT(p_type,'_',REPLACE(p_brand,'#','_'))) AS product_category_name,
  LOWER(CONCAT('en_',p_type,'_',REPLACE(p_brand,'#','_'))) AS product_category_name_english FROM part WHERE p_type <> 'PROMO'""")
cte("raw_customers", """SELECT c_custkey AS customer_id, c_custkey - c_custkey % 2 AS customer_unique_id,
  LPAD(CAST(c_custkey % 97 AS VARCHAR),5,'0') AS customer_zip_code_prefix, CONCAT(' ',LOWER(n_name)) AS customer_city,
  CONCAT(LOWER(SUBSTR(n_name,1,2)),CAST(n_nationkey AS VARCHAR),' ') AS customer_state
  FROM customer JOIN nation ON c_nationkey=n_nationkey""")
cte("fx_orders", """SELECT o_orderkey AS order_id, o_custkey AS customer_id,
  CASE WHEN o_orderkey % 37 = 0 THEN 'canceled' WHEN o_orderkey % 61 = 0 THEN 'unavailable' WHEN o_orderstatus='F' THEN 'delivered'
       WHEN o_orderstatus='O' THEN 'shipped' ELSE 'processing' END AS order_status,
  o_orderdate + INTERVAL '1' MINUTE * (o_orderkey*37 % 1440) AS order_purchase_timestamp,
  CASE WHEN o_orderkey % 53 <> 0 THEN o_orderdate + INTERVAL '1' MINUTE * (o_orderkey*37 % 1440 + o_orderkey*13 % 3000) END AS order_approved_at,
  CAST(NULL AS TIMESTAMP) AS order_delivered_carrier_date,
  CASE WHEN o_orderstatus<>'P' THEN o_orderdate + INTERVAL '1' MINUTE * (o_orderkey*37 % 1440 + o_orderkey*101 % 50000) END AS order_delivered_customer_date,
  o_orderdate + INTERVAL '20' DAY AS order_estimated_delivery_date FROM orders""")
cte("fx_order_items", """SELECT l_orderkey AS order_id,
  ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber,l_partkey,l_suppkey,l_extendedprice,l_shipdate) AS order_item_id,
  l_partkey AS product_id, l_suppkey AS seller_id, CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
  CAST(ROUND(CAST(l_extendedprice AS DECIMAL(18,2))*CAST(l_tax AS DECIMAL(4,2)),2) AS DECIMAL(18,2)) AS freight_value FROM lineitem""")
cte("fx_order_payments", """SELECT l_orderkey AS order_id, CAST(l_linenumber AS VARCHAR) AS payment_sequential,
  MIN(l_returnflag) AS payment_type, CAST(MIN(l_quantity) AS INTEGER) AS payment_installments,
  SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS payment_value FROM lineitem GROUP BY l_orderkey, l_linenumber""")
cte("raw_geolocation", """SELECT LPAD(CAST(c_custkey % 89 AS VARCHAR),5,'0') AS geolocation_zip_code_prefix,
  CAST(c_acctbal/100 AS VARCHAR) AS geolocation_lat, CAST(-c_custkey AS VARCHAR) AS geolocation_lng FROM customer""")

# ---------------------------------------------------------------- staging

cte("s_sellers", f"""SELECT seller_id, LPAD(CAST(seller_zip_code_prefix AS VARCHAR), 5, '0') AS seller_zip_code,
  {tc('TRIM(seller_city)')} AS seller_city, UPPER(TRIM(seller_state)) AS seller_state FROM raw_sellers""")
cte("s_products", """SELECT product_id, product_category_name,
  TRY_CAST(product_weight_g AS INTEGER) AS product_weight_g, TRY_CAST(product_length_cm AS INTEGER) AS product_length_cm,
  TRY_CAST(product_height_cm AS INTEGER) AS product_height_cm, TRY_CAST(product_width_cm AS INTEGER) AS product_width_cm,
  TRY_CAST(product_photos_qty AS INTEGER) AS product_photos_qty
  FROM raw_products WHERE product_id IS NOT NULL""")
cte("s_translation", "SELECT product_category_name, product_category_name_english FROM category_translation")
cte("s_orders", "SELECT * FROM fx_orders WHERE order_purchase_timestamp IS NOT NULL")
cte("s_items", "SELECT * FROM fx_order_items WHERE order_id IN (SELECT order_id FROM s_orders)")
cte("s_payments", "SELECT * FROM fx_order_payments")
cte("s_customers", f"""SELECT customer_id, customer_unique_id, customer_zip_code_prefix,
  {tc('TRIM(customer_city)')} AS customer_city, UPPER(TRIM(customer_state)) AS customer_state FROM raw_customers""")
cte("s_geo", """SELECT geolocation_zip_code_prefix AS zip_code, TRY_CAST(geolocation_lat AS DOUBLE) AS lat,
  TRY_CAST(geolocation_lng AS DOUBLE) AS lng FROM raw_geolocation""")
cte("s_items_zero", """SELECT i.order_id, order_item_id, product_id, seller_id,
  CASE WHEN (seller_id*31 + YEAR(o_orderdate)*12 + MONTH(o_orderdate)) % 9 < 2 THEN CAST(0 AS DECIMAL(18,2)) ELSE price END AS price,
  CASE WHEN (seller_id*31 + YEAR(o_orderdate)*12 + MONTH(o_orderdate)) % 9 < 2 THEN CAST(0 AS DECIMAL(18,2)) ELSE freight_value END AS freight_value
  FROM s_items i JOIN orders ON i.order_id = o_orderkey""")

QUERIES: dict[str, str] = {}


def query(key: str, sql: str) -> None:
    QUERIES[key] = sql


def build(key: str) -> str:
    """WITH-chain of every CTE the query needs, in definition order."""
    body = QUERIES[key]
    names = list(CTES)
    needed: set[str] = set()
    frontier = [body]
    while frontier:
        text = frontier.pop()
        for n in names:
            if n not in needed and re.search(rf"\b{re.escape(n)}\b", text):
                needed.add(n)
                frontier.append(CTES[n])
    chain = ",\n".join(f"{n} AS (\n{CTES[n]}\n)" for n in names if n in needed)
    return f"WITH {chain}\n{body}" if chain else body


def all_sql() -> dict[str, str]:
    from tradewind import oracle_queries  # noqa: F401  (registers the per-operator SQL)
    return {k: build(k) for k in QUERIES}
