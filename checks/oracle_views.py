"""The analyses in SQL, each stated differently from the Spark operators.

Look-ups use as-of joins, positions use ordered lists, runs use start flags, ranks use
counts of better rows, and look-backs use four joins. Ratios are rounded in whole numbers,
half away from zero, so a tie does not depend on how a double is stored. Quoted labels and
the bounds 5, 10 and 25 are fixed values.
"""


def half_up(part: str, whole: str) -> str:
    """SQL for the ratio of two whole numbers to two places, from integers alone."""
    return f"(sign({part}) * ((200 * abs({part}) + {whole})::BIGINT // (2 * {whole})::BIGINT) / 100.0::DOUBLE)"


_RATES = {
    "on_time": half_up("100 * COUNT(*) FILTER (delay <= 0)", "COUNT(*)"),
    "fill": half_up("100 * SUM(received_quantity)", "SUM(ordered_quantity)"),
    "delay": half_up("SUM(delay)", "COUNT(*)"),
    "issues": half_up("100 * s.issue_count", "s.snapshots"),
}

VIEWS_SQL = f"""
v_daily_sales AS MATERIALIZED (
  SELECT branch_id, product_id, sale_time::DATE AS sale_date, SUM(quantity)::BIGINT AS units_sold,
         SUM(revenue) AS revenue
  FROM sales GROUP BY ALL),
v_daily_movements AS MATERIALIZED (
  SELECT branch_id, product_id, movement_time::DATE AS movement_date,
         coalesce(SUM(quantity) FILTER (movement_type IN ('INITIAL_STOCK', 'DELIVERY', 'POSITIVE_ADJUSTMENT')), 0)::BIGINT
           AS inflow_quantity,
         coalesce(SUM(quantity) FILTER (movement_type IN ('SALE', 'WASTE', 'NEGATIVE_ADJUSTMENT')), 0)::BIGINT
           AS outflow_quantity,
         (inflow_quantity - outflow_quantity)::BIGINT AS net_movement
  FROM movements GROUP BY ALL),
copy_lists AS MATERIALIZED (
  SELECT branch_id, product_id, movement_time::DATE AS issue_date, list(movement_id ORDER BY movement_id) AS ids
  FROM movements
  GROUP BY branch_id, product_id, movement_time, movement_type, quantity, ifnull(reference_id, '')
  HAVING len(ids) > 1),
v_duplicates AS MATERIALIZED (
  SELECT m.*, n.position::BIGINT AS duplicate_number
  FROM movements m JOIN (SELECT unnest(ids) AS id, generate_subscripts(ids, 1) AS position FROM copy_lists) n
    ON n.id = m.movement_id
  WHERE n.position >= 2),
v_duplicate_days AS (
  SELECT branch_id, product_id, issue_date, SUM(len(ids) - 1)::BIGINT AS duplicate_count
  FROM copy_lists GROUP BY ALL),
v_delivery_days AS (
  SELECT branch_id, product_id, actual_delivery_date AS issue_date, COUNT(*) AS delivery_count
  FROM supplier_orders GROUP BY ALL),
v_previous AS (
  SELECT s.*, p.recorded_closing_stock AS previous_recorded_stock
  FROM snapshots s ASOF LEFT JOIN snapshots p
    ON p.branch_id = s.branch_id AND p.product_id = s.product_id AND s.snapshot_date > p.snapshot_date),
v_recon AS MATERIALIZED (
  SELECT s.snapshot_id, s.branch_id, b.branch_name, s.product_id, p.sku, p.product_name, p.category,
         s.snapshot_date, s.recorded_closing_stock, s.previous_recorded_stock,
         ifnull(m.inflow_quantity, 0) AS inflow_quantity, ifnull(m.outflow_quantity, 0) AS outflow_quantity,
         ifnull(m.net_movement, 0) AS net_movement,
         ifnull(s.previous_recorded_stock, 0) + ifnull(m.net_movement, 0) AS expected_closing_stock,
         s.recorded_closing_stock - expected_closing_stock AS stock_difference,
         CASE WHEN stock_difference = 0 THEN 'Reconciled'
              WHEN stock_difference > 0 THEN 'Recorded stock exceeds ledger'
              ELSE 'Ledger exceeds recorded stock' END AS reconciliation_status
  FROM v_previous s
  JOIN branches b USING (branch_id) JOIN products p USING (product_id)
  LEFT JOIN v_daily_movements m
    ON m.branch_id = s.branch_id AND m.product_id = s.product_id AND m.movement_date = s.snapshot_date),
v_issues AS MATERIALIZED (
  SELECT r.*, ifnull(d.duplicate_count, 0) AS duplicate_movement_count,
         CASE WHEN abs(stock_difference) < 5 THEN 'Low' WHEN abs(stock_difference) < 10 THEN 'Medium'
              WHEN abs(stock_difference) < 25 THEN 'High' ELSE 'Critical' END AS issue_severity,
         CASE WHEN stock_difference > 0
              THEN CASE WHEN inflow_quantity = 0
                             AND (r.branch_id, r.product_id, r.snapshot_date) IN
                                 (SELECT (branch_id, product_id, actual_delivery_date) FROM supplier_orders)
                        THEN 'Missing delivery movement' ELSE 'Possible unrecorded inflow or count error' END
              ELSE CASE WHEN d.duplicate_count IS NOT NULL THEN 'Duplicate inventory movement'
                        ELSE 'Possible shrinkage or missing outflow' END END AS probable_issue
  FROM v_recon r LEFT JOIN v_duplicate_days d
    ON d.branch_id = r.branch_id AND d.product_id = r.product_id AND d.issue_date = r.snapshot_date
  WHERE reconciliation_status <> 'Reconciled'),
v_cancelled_any AS (
  SELECT branch_id, product_id, cancellation_time::DATE AS cancellation_date,
         SUM(requested_quantity)::BIGINT AS cancelled_quantity
  FROM cancellations GROUP BY ALL),
v_cancelled_shown AS (
  SELECT branch_id, product_id, cancellation_time::DATE AS cancellation_date,
         SUM(requested_quantity)::BIGINT AS cancelled_quantity
  FROM cancellations WHERE reason = 'SYSTEM_SHOWED_AVAILABLE' GROUP BY ALL),
v_phantom AS MATERIALIZED (
  SELECT c.branch_id, b.branch_name, c.product_id, p.sku, p.product_name, p.category, s.snapshot_date,
         s.recorded_closing_stock, c.cancelled_quantity,
         round(c.cancelled_quantity * p.selling_price, 2) AS directly_observed_lost_revenue
  FROM v_cancelled_shown c, snapshots s, branches b, products p
  WHERE s.branch_id = c.branch_id AND s.product_id = c.product_id AND s.snapshot_date = c.cancellation_date
    AND b.branch_id = c.branch_id AND p.product_id = c.product_id AND s.recorded_closing_stock > 0),
v_stockout_days AS MATERIALIZED (
  SELECT s.branch_id, b.branch_name, s.product_id, p.sku, p.product_name, p.category,
         s.snapshot_date AS stockout_date, s.recorded_closing_stock, s.cancelled_quantity
  FROM (SELECT snapshots.*, cancelled_quantity FROM snapshots JOIN v_cancelled_any c
          ON (c.branch_id, c.product_id, c.cancellation_date) =
             (snapshots.branch_id, snapshots.product_id, snapshots.snapshot_date)
        UNION ALL
        SELECT z.*, 0 FROM snapshots z ANTI JOIN v_cancelled_any c
          ON (c.branch_id, c.product_id, c.cancellation_date) = (z.branch_id, z.product_id, z.snapshot_date)
        WHERE z.recorded_closing_stock = 0) s
  JOIN branches b USING (branch_id) JOIN products p USING (product_id)),
v_stockout_periods AS MATERIALIZED (
  SELECT branch_id, branch_name, product_id, sku, product_name, category, MIN(stockout_date) AS stockout_start,
         MAX(stockout_date) AS stockout_end, MAX(stockout_date) - MIN(stockout_date) + 1 AS stockout_days,
         SUM(cancelled_quantity)::BIGINT AS cancelled_quantity
  FROM (SELECT *, SUM(starts) OVER (PARTITION BY branch_id, product_id ORDER BY stockout_date) AS run
        FROM (SELECT d.*, CASE WHEN y.branch_id IS NULL THEN 1 ELSE 0 END AS starts
              FROM v_stockout_days d LEFT JOIN v_stockout_days y
                ON y.branch_id = d.branch_id AND y.product_id = d.product_id AND y.stockout_date + 1 = d.stockout_date))
  GROUP BY branch_id, branch_name, product_id, sku, product_name, category, run),
v_expected AS MATERIALIZED (
  SELECT d.*, ifnull(t.units_sold, 0) AS actual_units_sold,
         (ifnull(w1.units_sold, 0) + ifnull(w2.units_sold, 0) + ifnull(w3.units_sold, 0) + ifnull(w4.units_sold, 0))
           AS four_weeks
  FROM v_stockout_days d
  LEFT JOIN v_daily_sales t ON (t.branch_id, t.product_id, t.sale_date) = (d.branch_id, d.product_id, d.stockout_date)
  LEFT JOIN v_daily_sales w1 ON (w1.branch_id, w1.product_id, w1.sale_date) = (d.branch_id, d.product_id, d.stockout_date - 7)
  LEFT JOIN v_daily_sales w2 ON (w2.branch_id, w2.product_id, w2.sale_date) = (d.branch_id, d.product_id, d.stockout_date - 14)
  LEFT JOIN v_daily_sales w3 ON (w3.branch_id, w3.product_id, w3.sale_date) = (d.branch_id, d.product_id, d.stockout_date - 21)
  LEFT JOIN v_daily_sales w4 ON (w4.branch_id, w4.product_id, w4.sale_date) = (d.branch_id, d.product_id, d.stockout_date - 28)),
v_lost AS MATERIALIZED (
  SELECT e.* EXCLUDE (four_weeks, quarters), four_weeks / 4 AS expected_units,
         (quarters * 0.25)::DECIMAL(18,2) AS estimated_lost_units,
         round(quarters * 0.25 * p.selling_price, 2)::DECIMAL(18,2) AS estimated_lost_revenue,
         round(quarters * 0.25 * (p.selling_price - p.unit_cost), 2)::DECIMAL(18,2) AS estimated_lost_gross_profit
  FROM (SELECT *, list_max([4 * cancelled_quantity, four_weeks - 4 * actual_units_sold, 0]) AS quarters
        FROM v_expected) e JOIN products p USING (product_id)),
v_suppliers AS MATERIALIZED (
  SELECT supplier_id, ANY_VALUE(supplier_name) AS supplier_name, COUNT(*) AS total_orders,
         COUNT(*) FILTER (delay > 0) AS late_orders,
         {_RATES['on_time']} AS on_time_delivery_rate,
         {_RATES['fill']} AS fill_rate,
         {_RATES['delay']} AS average_delay_days
  FROM (SELECT *, actual_delivery_date - expected_delivery_date AS delay FROM supplier_orders)
  JOIN suppliers USING (supplier_id) GROUP BY supplier_id),
v_branch_sums AS (
  SELECT branch_id, COUNT(*) AS snapshots, COUNT(*) FILTER (stock_difference <> 0) AS issue_count,
         SUM(abs(stock_difference))::BIGINT AS absolute_stock_difference
  FROM v_recon GROUP BY branch_id),
v_branch_base AS MATERIALIZED (
  SELECT b.branch_id, b.branch_name, b.region, s.snapshots, s.issue_count,
         {_RATES['issues']} AS reconciliation_issue_rate,
         s.absolute_stock_difference,
         (SELECT COUNT(*) FROM v_phantom p WHERE p.branch_id = b.branch_id) AS phantom_incidents,
         ifnull((SELECT SUM(estimated_lost_revenue) FROM v_lost l WHERE l.branch_id = b.branch_id), 0)
           AS estimated_lost_revenue,
         ifnull((SELECT SUM(estimated_lost_gross_profit) FROM v_lost l WHERE l.branch_id = b.branch_id), 0)
           AS estimated_lost_gross_profit
  FROM branches b JOIN v_branch_sums s USING (branch_id)),
v_health AS MATERIALIZED (
  SELECT h.*, 1 + (SELECT COUNT(*) FROM v_branch_base o
                   WHERE o.estimated_lost_revenue > h.estimated_lost_revenue
                      OR (o.estimated_lost_revenue = h.estimated_lost_revenue AND o.issue_count > h.issue_count))
              AS risk_rank
  FROM v_branch_base h),
v_unbooked AS MATERIALIZED (
  SELECT * FROM supplier_orders
  WHERE supplier_order_id NOT IN
    (SELECT substr(reference_id, 5)::BIGINT FROM movements
     WHERE movement_type = 'DELIVERY' AND starts_with(reference_id, 'SUP-'))),
v_quality AS (
  SELECT 'Duplicate inventory movement' AS issue_type, movement_id AS record_id, branch_id, product_id,
         movement_time::DATE AS issue_date FROM v_duplicates
  UNION ALL BY NAME
  SELECT 'Delivered supplier order without movement' AS issue_type, supplier_order_id AS record_id, branch_id,
         product_id, actual_delivery_date AS issue_date FROM v_unbooked),
v_detected AS (
  SELECT 'Phantom inventory' AS issue_type, branch_id, product_id, snapshot_date AS issue_date FROM v_phantom
  UNION SELECT 'Duplicate inventory movement', branch_id, product_id, issue_date FROM copy_lists
  UNION SELECT 'Missing delivery movement', branch_id, product_id, actual_delivery_date FROM v_unbooked
  UNION SELECT probable_issue, branch_id, product_id, snapshot_date FROM v_issues
        WHERE probable_issue = 'Possible shrinkage or missing outflow'),
v_validation AS MATERIALIZED (
  SELECT k.issue_type, COUNT(*) AS expected_issues, COUNT(d.issue_type) AS detected_issues,
         round_even(100 * COUNT(d.issue_type)::DOUBLE / COUNT(*), 2) AS detection_rate
  FROM known_issues k LEFT JOIN v_detected d
    ON (d.issue_type, d.branch_id, d.product_id, d.issue_date) = (k.issue_type, k.branch_id, k.product_id, k.issue_date)
  GROUP BY k.issue_type)
"""
