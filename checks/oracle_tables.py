"""The derived inventory tables in SQL: a WITH prefix for every comparison query.

Written from the mapping in the mart's description, independently of its Spark code. Quoted
labels and the numbers 37, 41, 82, 100, 193 and 1009 are fixed values of that mapping.
"""

TABLES_SQL = """
lines AS MATERIALIZED (
  SELECT b.okey * 1009 + b.lnum AS line_id, c.c_nationkey::BIGINT + 1 AS branch_id,
         b.part // 100 + 1 AS product_id, b.supplier_id, b.units, b.price, b.discount, b.flag, b.status, b.day
  FROM (SELECT l_orderkey AS okey, l_linenumber AS lnum, SUM(l_quantity)::BIGINT AS units,
               SUM(l_extendedprice::DECIMAL(18,2)) AS price,
               MAX(l_discount::DECIMAL(9,2) * 100)::BIGINT AS discount,
               MIN(l_partkey) AS part, MIN(l_suppkey) AS supplier_id, MIN(l_returnflag) AS flag,
               MIN(l_linestatus) AS status, MIN(l_shipdate)::DATE AS day
        FROM lineitem GROUP BY ALL) b, orders o, customer c
  WHERE o.o_orderkey = b.okey AND c.c_custkey = o.o_custkey),
branches AS (
  SELECT n_nationkey::BIGINT + 1 AS branch_id, n_name AS branch_name, r_name AS region
  FROM nation, region WHERE n_regionkey = r_regionkey),
suppliers AS (SELECT s_suppkey AS supplier_id, s_name AS supplier_name FROM supplier),
products AS (
  SELECT f.product_id, 'SKU-' || f.product_id AS sku, f.category || ' family ' || f.product_id AS product_name,
         f.category, f.product_id % 10 AS supplier_id, f.low AS unit_cost, f.high AS selling_price,
         10::BIGINT AS reorder_point, 50::BIGINT AS target_stock
  FROM (SELECT p_partkey // 100 + 1 AS product_id, arg_min(p_type, p_partkey) AS category,
               MIN(p_retailprice::DECIMAL(18,2)) AS low, MAX(p_retailprice::DECIMAL(18,2)) AS high
        FROM part GROUP BY 1) f),
sales AS (
  SELECT line_id AS sale_id, branch_id, product_id, day + INTERVAL 12 HOUR AS sale_time,
         greatest(1, units // 5)::BIGINT AS quantity, round(price * 0.2, 2)::DECIMAL(18,2) AS revenue
  FROM lines WHERE flag = 'N'),
supplier_orders AS (
  SELECT id AS supplier_order_id, branch_id, product_id, supplier_id,
         day - (id % 5 + 1)::INT AS order_date, day - (id % 4 - 1)::INT AS expected_delivery_date,
         day AS actual_delivery_date,
         CASE WHEN exact THEN units ELSE small END AS ordered_quantity,
         CASE WHEN exact THEN units ELSE greatest(1, small - units * discount // 200) END AS received_quantity
  FROM (SELECT *, line_id AS id, 0 IN (line_id % 37, line_id % 41) AS exact,
               greatest(1, units // 4)::BIGINT AS small FROM lines WHERE flag = 'A')),
cancellations AS (
  SELECT line_id AS cancellation_id, branch_id, product_id, day + INTERVAL 18 HOUR AS cancellation_time,
         greatest(1, units // 10)::BIGINT AS requested_quantity,
         ['OUT_OF_STOCK', 'SYSTEM_SHOWED_AVAILABLE'][(line_id % 2 + 1)::INT] AS reason
  FROM lines WHERE flag = 'R' AND status = 'F'),
opening AS (
  SELECT -(product_id * 1000 + branch_id) AS movement_id, branch_id, product_id,
         MIN(day) + INTERVAL 6 HOUR AS movement_time, 'INITIAL_STOCK' AS movement_type,
         (10 + product_id % 50)::BIGINT AS quantity, 'INIT-' || branch_id || '-' || product_id AS reference_id
  FROM lines GROUP BY branch_id, product_id),
sold AS (
  SELECT sale_id * 10 AS movement_id, branch_id, product_id, sale_time AS movement_time, 'SALE' AS movement_type,
         quantity, 'SALE-' || sale_id AS reference_id FROM sales),
corrected AS (
  SELECT line_id * 10 AS movement_id, branch_id, product_id, day + INTERVAL 20 HOUR AS movement_time,
         ['WASTE', 'POSITIVE_ADJUSTMENT', 'NEGATIVE_ADJUSTMENT'][(line_id % 3 + 1)::INT] AS movement_type,
         greatest(1, units // 10)::BIGINT AS quantity,
         CASE line_id % 2 WHEN 1 THEN 'ADJ-' || line_id END AS reference_id
  FROM lines WHERE flag = 'R' AND status = 'O'),
movements AS MATERIALIZED (
  SELECT * FROM opening UNION ALL SELECT * FROM sold UNION ALL SELECT * FROM corrected
  UNION ALL
  SELECT supplier_order_id * 10 + copy, branch_id, product_id, actual_delivery_date + INTERVAL 7 HOUR, 'DELIVERY',
         received_quantity, 'SUP-' || supplier_order_id
  FROM supplier_orders JOIN (VALUES (0, 1), (1, 41), (2, 82)) k(copy, needs)
    ON supplier_order_id % needs = 0 AND supplier_order_id % 37 <> 0),
counted AS MATERIALIZED (
  SELECT g.*, (31 * branch_id + 17 * product_id + (snapshot_date - DATE '1970-01-01')) % 193 = 0 AS loses
  FROM (SELECT DISTINCT branch_id, product_id, day + ahead::INT AS snapshot_date
        FROM lines, range(7) r(ahead)) g),
truth AS (
  SELECT branch_id, product_id, movement_time::DATE AS day,
         CASE WHEN movement_type IN ('SALE', 'WASTE', 'NEGATIVE_ADJUSTMENT') THEN -quantity ELSE quantity END AS change
  FROM movements WHERE movement_type <> 'DELIVERY'
  UNION ALL
  SELECT branch_id, product_id, actual_delivery_date, received_quantity FROM supplier_orders
  UNION ALL
  SELECT branch_id, product_id, snapshot_date, -6 FROM counted WHERE loses),
levels AS (
  SELECT branch_id, product_id, day, SUM(SUM(change)) OVER (PARTITION BY branch_id, product_id ORDER BY day) AS level
  FROM truth GROUP BY branch_id, product_id, day),
snapshots AS MATERIALIZED (
  SELECT (c.product_id * 1000 + c.branch_id) * 100000 + (c.snapshot_date - DATE '1970-01-01') AS snapshot_id,
         c.branch_id, c.product_id, c.snapshot_date, greatest(0, l.level)::BIGINT AS recorded_closing_stock
  FROM counted c ASOF JOIN levels l
    ON c.branch_id = l.branch_id AND c.product_id = l.product_id AND c.snapshot_date >= l.day),
known_issues AS (
  SELECT 'Duplicate inventory movement' AS issue_type, branch_id, product_id, actual_delivery_date AS issue_date
  FROM supplier_orders WHERE supplier_order_id % 41 = 0 AND supplier_order_id % 37 <> 0
  UNION ALL
  SELECT 'Missing delivery movement', branch_id, product_id, actual_delivery_date
  FROM supplier_orders WHERE supplier_order_id % 37 = 0
  UNION ALL
  SELECT 'Possible shrinkage or missing outflow', branch_id, product_id, snapshot_date FROM counted WHERE loses
  UNION ALL
  SELECT 'Phantom inventory', branch_id, product_id, cancellation_time::DATE
  FROM cancellations WHERE reason = 'SYSTEM_SHOWED_AVAILABLE')
"""
