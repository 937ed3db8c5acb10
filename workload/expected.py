"""SQL for the stages of the load, straight from the test tables.

Each constant is a list of common table expressions; ``with_tables`` puts them before a query.
"""

from __future__ import annotations

LINES = """
part_names AS (SELECT p_partkey, p_name, p_type FROM part),
lines AS (
  SELECT l.*, p_name, p_type, CAST(l_quantity AS BIGINT) AS qty,
    md5(concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS BIGINT),
      CAST(round(l_extendedprice * 100) AS BIGINT), CAST(round(l_discount * 100) AS BIGINT),
      CAST(round(l_tax * 100) AS BIGINT), l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d'))) AS line_hash
  FROM lineitem l LEFT JOIN part_names ON l_partkey = p_partkey
)"""

DS1_DOCS = LINES + """,
per_order AS (SELECT l_orderkey AS k, min(l_suppkey) AS suppkey FROM lines GROUP BY 1),
ds1_docs AS (
  SELECT 'ds1-' || o_orderkey || '-v' || ver AS id, o_orderkey, ver,
    CASE WHEN o_orderkey % 97 <> 0 THEN CAST(o_orderkey AS VARCHAR) END AS invoice_no,
    CASE WHEN o_orderkey % 50 <> 0 THEN CAST(o_orderdate AS DATE) END AS invoice_date,
    s_name AS seller, c_name AS client, CAST(suppkey AS VARCHAR) AS seller_tax_id,
    CAST(o_custkey AS VARCHAR) AS client_tax_id, 'IB' || o_custkey || 'v' || ver AS iban,
    o_totalprice AS total_net_worth, CAST(NULL AS DOUBLE) AS total_vat,
    o_orderdate + to_days(CAST(ver - 1 AS INTEGER)) AS inserted_at,
    CASE WHEN o_orderkey % 17 = 0 THEN true WHEN o_orderkey % 19 = 0 THEN NULL ELSE false END AS exclude_from_silver
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN per_order ON o_orderkey = k LEFT JOIN supplier ON suppkey = s_suppkey
  CROSS JOIN (VALUES (1), (2)) AS versions(ver)
  WHERE ver = 1 OR o_orderkey % 5 = 0
)"""

SILVER1 = DS1_DOCS + """,
ds1_numbered AS (
  SELECT d.*, p_name AS item_desc, l_extendedprice AS item_net_price, qty AS item_qty, l_tax AS item_vat,
    coalesce(invoice_no, 'missingin') || '-' || coalesce(client_tax_id, 'missingcti') || '-'
      || coalesce(seller_tax_id, 'missingsti') AS unique_invoice_no,
    row_number() OVER (PARTITION BY id ORDER BY l_linenumber, line_hash) AS pos
  FROM ds1_docs d JOIN lines p ON o_orderkey = p.l_orderkey
  WHERE exclude_from_silver = false
),
ds1_ranked AS (
  SELECT *,
    unique_invoice_no || '-' || row_number() OVER (PARTITION BY invoice_no, client_tax_id, seller_tax_id
      ORDER BY item_desc ASC NULLS FIRST, inserted_at DESC, id, pos) AS unique_invoice_line_no,
    row_number() OVER (PARTITION BY unique_invoice_no ORDER BY inserted_at DESC, id, pos) AS line_rank,
    rank() OVER (PARTITION BY unique_invoice_no ORDER BY inserted_at DESC, id) AS doc_rank
  FROM ds1_numbered
),
silver1 AS (SELECT * FROM ds1_ranked WHERE line_rank = 1)"""

SILVER1_COLUMNS = """unique_invoice_line_no, unique_invoice_no, client, client_tax_id, iban, invoice_date, invoice_no,
  seller, seller_tax_id, total_net_worth, total_vat, item_desc, item_net_price, item_qty, item_vat"""

DS2_DOCS = """
ds2_docs AS (
  SELECT 'ds2-' || l_orderkey || '-' || line_hash AS id, c_name AS client, n_name AS client_address,
    CASE WHEN l_orderkey % 50 <> 0 THEN CAST(l_shipdate AS DATE) END AS invoice_date,
    l_discount AS discount, 'OR-' || l_orderkey AS order_id, l_tax AS shipping, p_name AS item_desc,
    l_extendedprice AS item_rate, CASE WHEN l_linenumber <> 6 THEN qty END AS item_qty,
    l_shipdate AS inserted_at,
    CASE WHEN l_orderkey % 17 = 0 THEN true WHEN l_orderkey % 19 = 0 THEN NULL ELSE false END AS exclude_from_silver
  FROM lines LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
)"""


def silver2(name: str, before: str = "2100-01-01", docs: str = "ds2_docs") -> str:
    """Source-2 lines as one run makes them from the documents inserted before a date."""
    return f"""
{name}_ranked AS (
  SELECT *, md5(order_id || '-' || item_desc) AS unique_invoice_line_no, md5(order_id || '-' || client) AS unique_invoice_no,
    row_number() OVER (PARTITION BY order_id, client ORDER BY inserted_at DESC, id) AS rn
  FROM {docs} WHERE exclude_from_silver = false AND inserted_at < TIMESTAMP '{before}'
),
{name} AS (SELECT * FROM {name}_ranked WHERE rn = 1)"""


SILVER2_COLUMNS = """unique_invoice_line_no, unique_invoice_no, client, client_address, invoice_date, discount, order_id,
  shipping, item_desc, item_rate, item_qty"""

GOLD = SILVER1 + "," + DS2_DOCS + "," + silver2("silver2") + """,
dim_vendor AS (
  SELECT '1' AS data_source_id, client_tax_id || '-1' AS vendor_no_id, client_tax_id AS vendor_no,
    client AS vendor_desc, '' AS vendor_address
  FROM (SELECT *, row_number() OVER (PARTITION BY client_tax_id ORDER BY client NULLS FIRST) AS rn FROM silver1)
  WHERE rn = 1
  UNION ALL
  SELECT '2', md5('ds2-superstore-vendor-2'), 'ds2-superstore-vendor', 'SuperStore', 'Ozark Highlands Road, St. Louis'
  WHERE EXISTS (SELECT 1 FROM silver2)
),
dim_buyer AS (
  SELECT '1' AS data_source_id, seller_tax_id || '-1' AS buyer_no_id, seller_tax_id AS buyer_no,
    seller AS buyer_desc, '' AS buyer_address
  FROM (SELECT *, row_number() OVER (PARTITION BY seller_tax_id ORDER BY seller NULLS FIRST) AS rn FROM silver1)
  WHERE rn = 1
  UNION ALL
  SELECT '2', md5('2-' || client || '-' || client_address), md5(client || '-' || client_address), client, client_address
  FROM (SELECT DISTINCT client, client_address FROM silver2)
),
fact AS (
  SELECT md5('1-' || unique_invoice_line_no) AS row_id, '1' AS data_source_id, unique_invoice_line_no, unique_invoice_no,
    client_tax_id || '-1' AS vendor_no_id, seller_tax_id || '-1' AS buyer_no_id,
    round(item_net_price * item_qty, 3) AS spend, iban, invoice_date, invoice_no, item_desc, item_net_price, item_qty
  FROM (SELECT *, row_number() OVER (PARTITION BY unique_invoice_line_no ORDER BY client NULLS FIRST) AS rn FROM silver1)
  WHERE rn = 1
  UNION ALL
  SELECT md5('2-' || unique_invoice_line_no), '2', unique_invoice_line_no, unique_invoice_no,
    md5('ds2-superstore-vendor-2'), md5('2-' || client || '-' || client_address),
    round(item_rate * item_qty, 3), '', invoice_date, order_id, item_desc, item_rate, item_qty
  FROM (SELECT * EXCLUDE (rn), row_number() OVER (PARTITION BY unique_invoice_line_no ORDER BY item_rate NULLS FIRST) AS rn
        FROM silver2)
  WHERE rn = 1
)"""

MODEL = GOLD + """,
model AS (
  SELECT invoice_date, spend, item_qty, buyer_desc, vendor_desc
  FROM fact LEFT JOIN dim_buyer b ON fact.buyer_no_id = b.buyer_no_id
  LEFT JOIN dim_vendor v ON fact.vendor_no_id = v.vendor_no_id
),
dated AS (SELECT * FROM model WHERE invoice_date IS NOT NULL)"""


def with_tables(tables: str, select: str) -> str:
    return f"WITH {tables}\n{select}"
