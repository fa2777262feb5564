"""The same queries in SQL for DuckDB, written independently of the Spark code."""

from __future__ import annotations

# The product codes, prices, names, list prices and constants of the specification.
_RAW = """
joined AS (
  SELECT *, (l_orderkey * 37 + l_linenumber * 61) % 86400 AS s
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
raw_orders AS (
  SELECT l_orderkey AS id,
         printf('C%06d', o_custkey) AS csmcode,
         strftime(o_orderdate, '%y/%m/%d') AS orddate,
         printf('%02d:%02d:%02d', s // 3600, (s % 3600) // 60, s % 60) AS ordtime,
         (['AJA001', 'SOK001', 'DUN001', 'LOT001', 'PEM001',
           'BAB001', 'MAI001', 'SMA001', 'UMI001', 'ZZZ999'])[l_partkey % 10 + 1] AS prdtid,
         CAST(l_quantity AS INTEGER) AS quantity,
         row_number() OVER (
           PARTITION BY l_orderkey
           ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
                    l_discount, l_tax, l_shipdate) AS seq
  FROM joined
)"""

_ORDERS = """,
prices(code, price) AS (
  VALUES ('AJA001', 1250), ('SOK001', 1230), ('DUN001', 1180), ('LOT001', 1200),
         ('PEM001', 1250), ('BAB001', 1210), ('MAI001', 1190), ('SMA001', 1190),
         ('UMI001', 1215)
),
enriched AS (
  SELECT id, csmcode,
         CAST(strptime(orddate, '%y/%m/%d') AS DATE) AS orddate,
         ordtime, prdtid, quantity,
         CAST(quantity * 24 AS INTEGER) AS weight,
         CAST(price * quantity AS INTEGER) AS amount,
         strptime(orddate || ' ' || ordtime, '%y/%m/%d %H:%M:%S') AS eventtime,
         seq
  FROM raw_orders LEFT JOIN prices ON code = prdtid
)"""

_PRICED = """,
priced AS (
  SELECT *, strftime(eventtime, '%Y-%m-%d %H:%M:%S') AS event_time
  FROM enriched WHERE amount IS NOT NULL
)"""

_RUNNING = """,
running AS (
  SELECT id, seq,
         CAST(sum(amount) OVER so_far AS BIGINT) AS amount,
         max(event_time) OVER so_far AS event_time
  FROM priced
  WINDOW so_far AS (PARTITION BY id ORDER BY seq ROWS UNBOUNDED PRECEDING)
)"""

_ORDER_COLUMNS = "id, csmcode, orddate, ordtime, prdtid, quantity, weight, amount, eventtime"

_PRODUCTS = """
SELECT prdtid AS id,
       CASE prdtid WHEN 'AJA001' THEN 'Ajab HB 2kg' WHEN 'SOK001' THEN 'Soko HB 2kg'
                   WHEN 'DUN001' THEN 'Dunia HB 2kg' WHEN 'LOT001' THEN 'Lotus HB 2kg'
                   WHEN 'PEM001' THEN 'Pembe HB 2kg' WHEN 'BAB001' THEN 'Baba Lao HB 2kg'
                   WHEN 'SMA001' THEN 'Smatta HB 2kg' WHEN 'UMI001' THEN 'Umi HB 2kg' END AS name,
       CAST(1500 AS INTEGER) AS stock, CAST(1000 AS INTEGER) AS restock,
       CAST(24 AS INTEGER) AS unitweight
FROM raw_orders"""

_PRICELIST = """
SELECT 'PRC1' AS id, prdtid, 'Bale' AS uom,
       CAST(CASE prdtid WHEN 'AJA001' THEN 1250 WHEN 'SOK001' THEN 1230 WHEN 'DUN001' THEN 1180
                        WHEN 'LOT001' THEN 1200 WHEN 'PEM001' THEN 1250 WHEN 'BAB001' THEN 1210
                        WHEN 'MAI001' THEN 1170 WHEN 'SMA001' THEN 1190 WHEN 'UMI001' THEN 1215
            END AS INTEGER) AS price
FROM raw_orders"""

_FIRST_SEEN = """
WITH placed AS (SELECT *, row_number() OVER () AS place FROM lineitem),
coded AS (
  SELECT place, (['AJA001', 'SOK001', 'DUN001', 'LOT001', 'PEM001',
                  'BAB001', 'MAI001', 'SMA001', 'UMI001', 'ZZZ999'])[l_partkey % 10 + 1] AS prdtid
  FROM placed JOIN orders ON l_orderkey = o_orderkey
)
SELECT prdtid, row_number() OVER (ORDER BY min(place)) AS first_seen FROM coded GROUP BY prdtid"""

_ORDER_MESSAGES = """
SELECT '{"id":' || id || ',"customer_code":"' || csmcode
       || '","orderdate":"' || strftime(orddate, '%Y-%m-%d')
       || '","ordertime":"' || ordtime || '","product_code":"' || prdtid
       || '","quantity":' || quantity || ',"weight":' || weight || ',"amount":' || amount
       || ',"event_time":"' || event_time || '"}' AS value
FROM priced"""

_SALES_MESSAGES = """
SELECT '{"id":' || id || ',"amount":' || amount || ',"event_time":"' || event_time || '"}' AS value
FROM running"""

_TOTALS = """
SELECT id, CAST(sum(amount) AS BIGINT) AS amount, max(event_time) AS event_time
FROM priced GROUP BY id"""


def _on_raw(select: str) -> str:
    return f"WITH {_RAW}\n{select}"


def _on_orders(select: str) -> str:
    return f"WITH {_RAW}{_ORDERS}\n{select}"


def _on_priced(select: str) -> str:
    return f"WITH {_RAW}{_ORDERS}{_PRICED}\n{select}"


def _on_running(select: str) -> str:
    return f"WITH {_RAW}{_ORDERS}{_PRICED}{_RUNNING}\n{select}"


SQL: dict[str, str] = {
    "raw_orders": _on_raw("SELECT * FROM raw_orders"),
    "raw_orders_long": _on_raw("SELECT * FROM raw_orders"),
    "orders": _on_orders(f"SELECT {_ORDER_COLUMNS} FROM enriched"),
    "order_weight": _on_orders("SELECT id, seq, weight FROM enriched"),
    "order_amount": _on_orders("SELECT id, seq, prdtid, amount FROM enriched"),
    "order_event_time": _on_orders("SELECT id, seq, eventtime FROM enriched"),
    "unpriced_orders": _on_orders(
        "SELECT id, seq, prdtid, quantity FROM enriched WHERE amount IS NULL"
    ),
    "orders_csv_roundtrip": _on_orders(f"SELECT {_ORDER_COLUMNS} FROM enriched"),
    "load_table": _on_raw(_PRICELIST),
    "products": _on_raw(_PRODUCTS),
    "pricelist": _on_raw(_PRICELIST),
    "distinct_products": _on_raw("SELECT DISTINCT prdtid FROM raw_orders"),
    "distinct_products_in_order": _FIRST_SEEN,
    "order_amount_joined": _on_orders("SELECT id, seq, prdtid, amount FROM enriched"),
    "load_table_once": _on_raw(_PRICELIST),
    "orders_csv_snapshot": _on_orders(f"SELECT {_ORDER_COLUMNS} FROM enriched"),
    "orders_head": _on_orders(f"SELECT {_ORDER_COLUMNS} FROM enriched ORDER BY id, seq LIMIT 10"),
    "order_messages": _on_priced(_ORDER_MESSAGES),
    "parsed_orders": _on_priced(
        "SELECT id, CAST(amount AS BIGINT) AS amount, event_time FROM priced"
    ),
    "order_totals": _on_priced(_TOTALS),
    "order_totals_stream": _on_priced(_TOTALS),
    "order_totals_paced": _on_priced(_TOTALS),
    "order_running_totals": _on_running("SELECT id, seq, amount, event_time FROM running"),
    "order_running_totals_long": _on_running("SELECT id, seq, amount, event_time FROM running"),
    "order_running_totals_stream": _on_running("SELECT id, seq, amount, event_time FROM running"),
    "sales_messages": _on_running(_SALES_MESSAGES),
    "sales_stream": _on_running(_SALES_MESSAGES),
    "sales_readback": _on_running(_SALES_MESSAGES),
}
