"""One SQL statement per checked query."""

from checks.broken import broken_sql
from checks.oracle_tables import TABLES_SQL
from checks.oracle_views import VIEWS_SQL, half_up
from checks.summaries import summaries_sql
from stockrecon.schemas import RESULTS, TABLES

_PREFIX = f"WITH {TABLES_SQL}, {VIEWS_SQL}, {broken_sql()}"

# Money leaves as DOUBLE, counts as BIGINT.
_SALES = "sale_id, branch_id, product_id, sale_time, quantity, revenue::DOUBLE AS revenue"
_PHANTOM = "* REPLACE (directly_observed_lost_revenue::DOUBLE AS directly_observed_lost_revenue)"
_LOST = (
    "* REPLACE (expected_units::DOUBLE AS expected_units, estimated_lost_units::DOUBLE AS estimated_lost_units,"
    " estimated_lost_revenue::DOUBLE AS estimated_lost_revenue,"
    " estimated_lost_gross_profit::DOUBLE AS estimated_lost_gross_profit)"
)
_HEALTH = (
    "* REPLACE (estimated_lost_revenue::DOUBLE AS estimated_lost_revenue,"
    " estimated_lost_gross_profit::DOUBLE AS estimated_lost_gross_profit)"
)
_PRODUCTS = "* REPLACE (unit_cost::DOUBLE AS unit_cost, selling_price::DOUBLE AS selling_price)"
_PERIODS = "* REPLACE (stockout_days::BIGINT AS stockout_days)"

_BODIES = {
    # sources and sinks
    "S1_scan_csv_branches": "SELECT * FROM branches",
    "S1_scan_csv_suppliers": "SELECT * FROM suppliers",
    "S1_scan_csv_products": f"SELECT {_PRODUCTS} FROM products",
    "S1_scan_csv_sales": f"SELECT {_SALES} FROM sales",
    "S1_scan_csv_supplier_orders": "SELECT * FROM supplier_orders",
    "S1_scan_csv_movements": "SELECT * FROM movements",
    "S1_scan_csv_snapshots": "SELECT * FROM snapshots",
    "S1_scan_csv_cancellations": "SELECT * FROM cancellations",
    "S2_scan_known_issues": "SELECT * FROM known_issues",
    "S6_register_views": """
        SELECT region, category, COUNT(*) AS issue_count,
               SUM(abs(stock_difference))::BIGINT AS units_affected
        FROM v_issues NATURAL JOIN branches GROUP BY ALL""",
    "S9_write_validation": "SELECT * FROM v_validation",
    "S10_row_counts": """
        FROM (SELECT 'branches' AS name, COUNT(*) AS rows FROM branches)
        UNION ALL SELECT 'suppliers', COUNT(*) FROM suppliers
        UNION ALL SELECT 'products', COUNT(*) FROM products
        UNION ALL SELECT 'sales', COUNT(*) FROM sales
        UNION ALL SELECT 'supplier_orders', COUNT(*) FROM supplier_orders
        UNION ALL SELECT 'movements', COUNT(*) FROM movements
        UNION ALL SELECT 'snapshots', COUNT(*) FROM snapshots
        UNION ALL SELECT 'cancellations', COUNT(*) FROM cancellations""",
    # integrity
    "Q1_model_rules": """
        SELECT 'Q1' AS rule_id, table_name, id::VARCHAR AS record_id, key || ': ' || COUNT(*) || ' rows' AS detail
        FROM (SELECT 'branches' AS table_name, 'branch_id' AS key, branch_id AS id FROM broken_branches
              UNION ALL SELECT 'suppliers', 'supplier_id', supplier_id FROM broken_suppliers
              UNION ALL SELECT 'products', 'product_id', product_id FROM broken_products
              UNION ALL SELECT 'sales', 'sale_id', sale_id FROM broken_sales
              UNION ALL SELECT 'supplier_orders', 'supplier_order_id', supplier_order_id FROM broken_supplier_orders
              UNION ALL SELECT 'movements', 'movement_id', movement_id FROM broken_movements
              UNION ALL SELECT 'snapshots', 'snapshot_id', snapshot_id FROM broken_snapshots
              UNION ALL SELECT 'cancellations', 'cancellation_id', cancellation_id FROM broken_cancellations)
        GROUP BY table_name, key, id HAVING COUNT(*) > 1 OR id IS NULL""",
    "Q2_model_rules": """
        SELECT 'Q2' AS rule_id, table_name, id AS record_id, cols || ': ' || COUNT(*) || ' rows' AS detail
        FROM (SELECT 'branches' AS table_name, 'branch_name' AS cols, branch_name AS id FROM broken_branches
              UNION ALL SELECT 'suppliers', 'supplier_name', supplier_name FROM broken_suppliers
              UNION ALL SELECT 'products', 'sku', sku FROM broken_products
              UNION ALL SELECT 'snapshots', 'branch_id, product_id, snapshot_date',
                               branch_id || ', ' || product_id || ', ' || snapshot_date FROM broken_snapshots)
        WHERE id IS NOT NULL GROUP BY table_name, cols, id HAVING COUNT(*) > 1""",
    "Q3_model_rules": """
        SELECT 'Q3' AS rule_id, table_name, id::VARCHAR AS record_id, unnest(missing) || ' is null' AS detail
        FROM (
          SELECT 'branches' AS table_name, branch_id AS id, list_filter([
              CASE WHEN branch_name IS NULL THEN 'branch_name' END,
              CASE WHEN region IS NULL THEN 'region' END], lambda x: x IS NOT NULL) AS missing FROM broken_branches
          UNION ALL SELECT 'suppliers', supplier_id, list_filter([
              CASE WHEN supplier_name IS NULL THEN 'supplier_name' END], lambda x: x IS NOT NULL) FROM broken_suppliers
          UNION ALL SELECT 'products', product_id, list_filter([
              CASE WHEN sku IS NULL THEN 'sku' END, CASE WHEN product_name IS NULL THEN 'product_name' END,
              CASE WHEN category IS NULL THEN 'category' END, CASE WHEN supplier_id IS NULL THEN 'supplier_id' END,
              CASE WHEN unit_cost IS NULL THEN 'unit_cost' END,
              CASE WHEN selling_price IS NULL THEN 'selling_price' END,
              CASE WHEN reorder_point IS NULL THEN 'reorder_point' END,
              CASE WHEN target_stock IS NULL THEN 'target_stock' END], lambda x: x IS NOT NULL) FROM broken_products
          UNION ALL SELECT 'sales', sale_id, list_filter([
              CASE WHEN branch_id IS NULL THEN 'branch_id' END, CASE WHEN product_id IS NULL THEN 'product_id' END,
              CASE WHEN sale_time IS NULL THEN 'sale_time' END, CASE WHEN quantity IS NULL THEN 'quantity' END,
              CASE WHEN revenue IS NULL THEN 'revenue' END], lambda x: x IS NOT NULL) FROM broken_sales
          UNION ALL SELECT 'supplier_orders', supplier_order_id, list_filter([
              CASE WHEN branch_id IS NULL THEN 'branch_id' END, CASE WHEN product_id IS NULL THEN 'product_id' END,
              CASE WHEN supplier_id IS NULL THEN 'supplier_id' END, CASE WHEN order_date IS NULL THEN 'order_date' END,
              CASE WHEN expected_delivery_date IS NULL THEN 'expected_delivery_date' END,
              CASE WHEN actual_delivery_date IS NULL THEN 'actual_delivery_date' END,
              CASE WHEN ordered_quantity IS NULL THEN 'ordered_quantity' END,
              CASE WHEN received_quantity IS NULL THEN 'received_quantity' END], lambda x: x IS NOT NULL)
            FROM broken_supplier_orders
          UNION ALL SELECT 'movements', movement_id, list_filter([
              CASE WHEN branch_id IS NULL THEN 'branch_id' END, CASE WHEN product_id IS NULL THEN 'product_id' END,
              CASE WHEN movement_time IS NULL THEN 'movement_time' END,
              CASE WHEN movement_type IS NULL THEN 'movement_type' END,
              CASE WHEN quantity IS NULL THEN 'quantity' END], lambda x: x IS NOT NULL) FROM broken_movements
          UNION ALL SELECT 'snapshots', snapshot_id, list_filter([
              CASE WHEN branch_id IS NULL THEN 'branch_id' END, CASE WHEN product_id IS NULL THEN 'product_id' END,
              CASE WHEN snapshot_date IS NULL THEN 'snapshot_date' END,
              CASE WHEN recorded_closing_stock IS NULL THEN 'recorded_closing_stock' END], lambda x: x IS NOT NULL)
            FROM broken_snapshots
          UNION ALL SELECT 'cancellations', cancellation_id, list_filter([
              CASE WHEN branch_id IS NULL THEN 'branch_id' END, CASE WHEN product_id IS NULL THEN 'product_id' END,
              CASE WHEN cancellation_time IS NULL THEN 'cancellation_time' END,
              CASE WHEN requested_quantity IS NULL THEN 'requested_quantity' END,
              CASE WHEN reason IS NULL THEN 'reason' END], lambda x: x IS NOT NULL) FROM broken_cancellations)""",
    "Q4_model_rules": """
        SELECT 'Q4' AS rule_id, 'movements' AS table_name, movement_id::VARCHAR AS record_id,
               'movement_type IN (''INITIAL_STOCK'', ''DELIVERY'', ''POSITIVE_ADJUSTMENT'', ''SALE'', ''WASTE'', ''NEGATIVE_ADJUSTMENT'')' AS detail
        FROM broken_movements ANTI JOIN (VALUES ('INITIAL_STOCK'), ('DELIVERY'), ('SALE'), ('WASTE'),
          ('POSITIVE_ADJUSTMENT'), ('NEGATIVE_ADJUSTMENT')) k(kind) ON kind = movement_type
        WHERE movement_type IS NOT NULL
        UNION ALL
        SELECT 'Q4', 'cancellations', cancellation_id::VARCHAR,
               'reason IN (''OUT_OF_STOCK'', ''SYSTEM_SHOWED_AVAILABLE'')' FROM broken_cancellations
        WHERE NOT (reason = 'OUT_OF_STOCK' OR reason = 'SYSTEM_SHOWED_AVAILABLE')""",
    "Q5_model_rules": """
        SELECT 'Q5' AS rule_id, 'products' AS table_name, product_id::VARCHAR AS record_id, 'unit_cost >= 0' AS detail
        FROM broken_products WHERE unit_cost < 0
        UNION ALL SELECT 'Q5', 'products', product_id::VARCHAR, 'reorder_point >= 0' FROM broken_products
                  WHERE reorder_point < 0
        UNION ALL SELECT 'Q5', 'sales', sale_id::VARCHAR, 'quantity > 0' FROM broken_sales WHERE quantity <= 0
        UNION ALL SELECT 'Q5', 'sales', sale_id::VARCHAR, 'revenue >= 0' FROM broken_sales WHERE revenue < 0
        UNION ALL SELECT 'Q5', 'supplier_orders', supplier_order_id::VARCHAR, 'ordered_quantity > 0'
                  FROM broken_supplier_orders WHERE ordered_quantity <= 0
        UNION ALL SELECT 'Q5', 'supplier_orders', supplier_order_id::VARCHAR, 'received_quantity > 0'
                  FROM broken_supplier_orders WHERE received_quantity <= 0
        UNION ALL SELECT 'Q5', 'movements', movement_id::VARCHAR, 'quantity > 0' FROM broken_movements WHERE quantity <= 0
        UNION ALL SELECT 'Q5', 'cancellations', cancellation_id::VARCHAR, 'requested_quantity > 0'
                  FROM broken_cancellations WHERE requested_quantity <= 0""",
    "Q6_model_rules": """
        SELECT 'Q6' AS rule_id, 'products' AS table_name, product_id::VARCHAR AS record_id,
               'selling_price >= unit_cost' AS detail FROM broken_products WHERE selling_price < unit_cost
        UNION ALL SELECT 'Q6', 'products', product_id::VARCHAR, 'target_stock >= reorder_point' FROM broken_products
                  WHERE target_stock < reorder_point""",
    "Q7_model_rules": """
        SELECT 'Q7' AS rule_id, child AS table_name, id::VARCHAR AS record_id,
               key || ' ' || value || ' not in ' || parent AS detail
        FROM (SELECT 'products' AS child, 'suppliers' AS parent, 'supplier_id' AS key, product_id AS id,
                     supplier_id AS value FROM broken_products
              UNION ALL SELECT 'sales', 'branches', 'branch_id', sale_id, branch_id FROM broken_sales
              UNION ALL SELECT 'sales', 'products', 'product_id', sale_id, product_id FROM broken_sales
              UNION ALL SELECT 'supplier_orders', 'branches', 'branch_id', supplier_order_id, branch_id
                        FROM broken_supplier_orders
              UNION ALL SELECT 'supplier_orders', 'products', 'product_id', supplier_order_id, product_id
                        FROM broken_supplier_orders
              UNION ALL SELECT 'supplier_orders', 'suppliers', 'supplier_id', supplier_order_id, supplier_id
                        FROM broken_supplier_orders
              UNION ALL SELECT 'movements', 'branches', 'branch_id', movement_id, branch_id FROM broken_movements
              UNION ALL SELECT 'movements', 'products', 'product_id', movement_id, product_id FROM broken_movements
              UNION ALL SELECT 'snapshots', 'branches', 'branch_id', snapshot_id, branch_id FROM broken_snapshots
              UNION ALL SELECT 'snapshots', 'products', 'product_id', snapshot_id, product_id FROM broken_snapshots
              UNION ALL SELECT 'cancellations', 'branches', 'branch_id', cancellation_id, branch_id FROM broken_cancellations
              UNION ALL SELECT 'cancellations', 'products', 'product_id', cancellation_id, product_id
                        FROM broken_cancellations)
        WHERE value IS NOT NULL AND (parent, value) NOT IN (
          SELECT ('branches', branch_id) FROM broken_branches UNION ALL SELECT ('products', product_id) FROM broken_products
          UNION ALL SELECT ('suppliers', supplier_id) FROM broken_suppliers)""",
    "Q1_repeated_line_keys": """
        SELECT 'Q1' AS rule_id, 'lineitem' AS table_name, l_orderkey || ', ' || l_linenumber AS record_id,
               'l_orderkey, l_linenumber: ' || COUNT(*) || ' rows' AS detail
        FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) <> 1""",
    "Q2_repeated_delivery_days": """
        SELECT 'Q2' AS rule_id, 'supplier_orders' AS table_name,
               branch_id || ', ' || product_id || ', ' || issue_date AS record_id,
               'branch_id, product_id, actual_delivery_date: ' || delivery_count || ' rows' AS detail
        FROM v_delivery_days WHERE delivery_count >= 2""",
    "Q3_missing_references": """
        SELECT 'Q3' AS rule_id, 'movements' AS table_name, movement_id::VARCHAR AS record_id,
               'reference_id is null' AS detail
        FROM movements WHERE reference_id IS NULL""",
    "Q4_unlisted_types": """
        SELECT 'Q4' AS rule_id, 'movements' AS table_name, movement_id::VARCHAR AS record_id,
               'movement_type IN (''INITIAL_STOCK'', ''DELIVERY'', ''SALE'', ''POSITIVE_ADJUSTMENT'')' AS detail
        FROM movements WHERE movement_type = 'WASTE' OR movement_type = 'NEGATIVE_ADJUSTMENT'""",
    "Q5_out_of_range_sales": """
        SELECT 'Q5' AS rule_id, 'sales' AS table_name, sale_id::VARCHAR AS record_id, 'quantity >= 2' AS detail
        FROM sales WHERE quantity < 2
        UNION ALL
        SELECT 'Q5', 'sales', sale_id::VARCHAR, 'revenue <= 15000' FROM sales WHERE revenue > 15000""",
    "Q6_expected_before_order": """
        SELECT 'Q6' AS rule_id, 'supplier_orders' AS table_name, supplier_order_id::VARCHAR AS record_id,
               'expected_delivery_date >= order_date' AS detail
        FROM supplier_orders WHERE expected_delivery_date < order_date""",
    "Q7_suppliers_without_product": """
        SELECT 'Q7' AS rule_id, 'supplier_orders' AS table_name, supplier_order_id::VARCHAR AS record_id,
               'supplier_id ' || o.supplier_id || ' not in products' AS detail
        FROM supplier_orders o LEFT JOIN (SELECT DISTINCT supplier_id FROM products) p
          ON p.supplier_id = o.supplier_id
        WHERE p.supplier_id IS NULL""",
    # expressions and filters
    "P18_filter_options": "SELECT issue_severity FROM v_issues GROUP BY issue_severity",
    "P8_filter_in": """
        SELECT snapshot_id, issue_severity, probable_issue FROM v_issues
        WHERE stock_difference NOT BETWEEN -9 AND 9""",
    "P11_signed_quantity": """
        SELECT movement_id, CASE WHEN sign > 0 THEN quantity ELSE 0 END AS inflow,
               CASE WHEN sign < 0 THEN quantity ELSE 0 END AS outflow, sign * quantity AS net
        FROM movements JOIN (VALUES ('INITIAL_STOCK', 1), ('DELIVERY', 1), ('POSITIVE_ADJUSTMENT', 1), ('SALE', -1),
          ('WASTE', -1), ('NEGATIVE_ADJUSTMENT', -1)) k(kind, sign) ON kind = movement_type""",
    "X_order_expressions": f"""
        SELECT supplier_order_id, 'SUP-' || supplier_order_id AS reference,
               (actual_delivery_date - INTERVAL 1 WEEK)::DATE AS week_before,
               (actual_delivery_date - to_days((supplier_order_id % 100)::INT))::DATE AS island,
               date_diff('day', expected_delivery_date, actual_delivery_date) AS delay,
               (delay > 0)::BIGINT AS late, (delay <= 0)::BIGINT AS on_time,
               {half_up('100 * received_quantity', 'ordered_quantity')} AS fill,
               round_even(received_quantity / 8, 2) AS eighths
        FROM supplier_orders""",
    # joins
    "J1_with_dims": f"""
        SELECT {_SALES}, branch_name, sku, product_name, category FROM sales
        JOIN branches USING (branch_id) JOIN products USING (product_id)""",
    "J2_join_bpd": """
        SELECT s.*, c.cancelled_quantity FROM v_cancelled_any c, snapshots s
        WHERE c.branch_id = s.branch_id AND c.product_id = s.product_id AND c.cancellation_date = s.snapshot_date""",
    "J3_left_join_zero": """
        SELECT s.*, (SELECT coalesce(SUM(q.quantity), 0)::BIGINT FROM sales q
                     WHERE q.branch_id = s.branch_id AND q.product_id = s.product_id
                       AND q.sale_time::DATE = s.snapshot_date) AS units_sold
        FROM snapshots s""",
    "J4_assemble_branch": f"SELECT {_HEALTH} FROM v_branch_base",
    "J5_expected_units": """
        SELECT branch_id, product_id, stockout_date, actual_units_sold, four_weeks / 4 AS expected_units
        FROM v_expected""",
    "J7_orders_without_movement": "SELECT * FROM v_unbooked",
    "J8_flag_matches": """
        SELECT k.*, EXISTS (FROM v_detected d WHERE d.issue_type = k.issue_type AND d.branch_id = k.branch_id
                            AND d.product_id = k.product_id AND d.issue_date = k.issue_date)::BIGINT AS detected
        FROM known_issues k""",
    "J9_one_row": """
        SELECT (SELECT SUM(quantity)::BIGINT FROM sales) AS units_sold,
               (SELECT SUM(revenue)::DOUBLE FROM sales) AS revenue,
               (SELECT MAX(snapshot_date) FROM snapshots) AS last_snapshot,
               (SELECT COUNT(*) FROM suppliers) AS suppliers""",
    # aggregations
    "A3_duplicate_days": """
        SELECT branch_id, product_id, movement_time::DATE AS issue_date, COUNT(*) AS duplicate_count
        FROM v_duplicates GROUP BY ALL""",
    "A4_delivery_days": "SELECT * FROM v_delivery_days",
    "A5_cancelled_by_day_shown": "SELECT * FROM v_cancelled_shown",
    "A6_cancelled_by_day": "SELECT * FROM v_cancelled_any",
    "A10_branch_reconciliation": "SELECT * FROM v_branch_sums",
    "A11_branch_phantom": "SELECT branch_id, COUNT(*) AS phantom_incidents FROM v_phantom GROUP BY branch_id",
    "A12_branch_lost": """
        SELECT branch_id, SUM(estimated_lost_revenue)::DOUBLE AS estimated_lost_revenue,
               SUM(estimated_lost_gross_profit)::DOUBLE AS estimated_lost_gross_profit
        FROM v_lost GROUP BY branch_id""",
    # windows and sets
    "W1_previous_stock": "SELECT * FROM v_previous",
    "W2_number_duplicates": """
        SELECT m.*, ifnull(n.position, 1)::BIGINT AS duplicate_number
        FROM movements m LEFT JOIN (SELECT unnest(ids) AS id, generate_subscripts(ids, 1) AS position FROM copy_lists) n
          ON n.id = m.movement_id""",
    "W3_number_days": """
        SELECT branch_id, product_id, unnest(days) AS stockout_date, generate_subscripts(days, 1)::BIGINT AS row_number
        FROM (SELECT branch_id, product_id, list(stockout_date ORDER BY stockout_date) AS days
              FROM v_stockout_days GROUP BY ALL)""",
    "W4_risk_rank": """
        SELECT h.branch_id, h.money::DOUBLE AS estimated_lost_revenue,
               (SELECT COUNT(*) + 1 FROM rounded o WHERE (o.money, o.issue_count) > (h.money, h.issue_count)) AS risk_rank
        FROM rounded h""",
    "U2_demand_by_day": """
        SELECT branch_id, product_id, sale_date + ahead AS stockout_date,
               SUM(units_sold) FILTER (ahead = 0)::BIGINT AS actual_units_sold,
               SUM(units_sold) FILTER (ahead <> 0)::BIGINT AS lookback_units
        FROM v_daily_sales, (VALUES (0), (7), (14), (21), (28)) a(ahead) GROUP BY ALL""",
    "U3_union_distinct": "SELECT * FROM v_detected",
    # views
    "V1_daily_sales": "SELECT * REPLACE (revenue::DOUBLE AS revenue) FROM v_daily_sales",
    "V2_daily_movements": "SELECT * FROM v_daily_movements",
    "V3_duplicate_movements": "SELECT * FROM v_duplicates",
    "V4_inventory_reconciliation": "SELECT * FROM v_recon",
    "V5_reconciliation_issues": "SELECT * FROM v_issues",
    "V6_phantom_inventory": f"SELECT {_PHANTOM} FROM v_phantom",
    "V7_stockout_days": "SELECT * FROM v_stockout_days",
    "V8_stockout_periods": f"SELECT {_PERIODS} FROM v_stockout_periods",
    "V9_lost_sales_estimate": f"SELECT {_LOST} FROM v_lost",
    "V10_supplier_performance": "SELECT * FROM v_suppliers",
    "V11_branch_inventory_health": f"SELECT {_HEALTH} FROM v_health",
    "V12_data_quality_issues": "SELECT * FROM v_quality",
    # reports
    "R1_issue_mix": """
        SELECT probable_issue, issue_severity, COUNT(*) AS issue_count,
               SUM(abs(stock_difference))::BIGINT AS units_affected
        FROM v_issues GROUP BY ALL""",
    "R2_phantom_by_value": f"SELECT {_PHANTOM} FROM v_phantom",
    "R3_longest_stockouts": f"SELECT {_PERIODS} FROM v_stockout_periods",
    "R4_supplier_league": "SELECT * FROM v_suppliers",
    "R5_branch_ranking": f"SELECT {_HEALTH} FROM v_health",
    "R6_validation_summary": "SELECT * FROM v_validation",
    "R7_top_branches": """
        SELECT branch_name, estimated_lost_revenue::DOUBLE AS estimated_lost_revenue FROM v_health
        ORDER BY risk_rank, branch_id LIMIT 10""",
    "R8_supplier_on_time": "SELECT supplier_name, on_time_delivery_rate FROM v_suppliers",
    "R9_cause_counts": "SELECT probable_issue, COUNT(*) AS issue_count FROM v_issues GROUP BY ALL",
    "R10_category_lost_revenue": """
        SELECT category, SUM(estimated_lost_revenue)::DOUBLE AS estimated_lost_revenue FROM v_lost GROUP BY ALL""",
    "R11_executive_kpis": """
        SELECT (SELECT COUNT(*) FROM snapshots) AS snapshots, (SELECT COUNT(*) FROM v_issues) AS issues,
               (SELECT COUNT(*) FROM v_phantom) AS phantom, (SELECT COUNT(*) FROM v_duplicates) AS duplicates,
               (SELECT ifnull(SUM(estimated_lost_revenue), 0)::DOUBLE FROM v_lost) AS lost_revenue""",
    "R12_dashboard_kpis": """
        SELECT COUNT(*) AS issue_count, (SELECT COUNT(*) FROM v_phantom) AS phantom_cases,
               (SELECT SUM(estimated_lost_revenue)::DOUBLE FROM v_lost) AS lost_revenue,
               (SELECT AVG(detection_rate) FROM v_validation) AS average_detection,
               (SELECT AVG(on_time_delivery_rate) FROM v_suppliers) AS average_on_time
        FROM v_issues WHERE abs(stock_difference) >= 10""",
    "R13_branch_filter": f"""
        SELECT {_HEALTH} FROM v_health WHERE branch_id - 1 IN (1, 7, 20)""",
    "R14_severity_mix": """
        SELECT issue_severity, COUNT(*) AS issue_count FROM v_issues WHERE abs(stock_difference) >= 5 GROUP BY ALL""",
    "R15_top_phantom": f"""
        SELECT {_PHANTOM} FROM v_phantom
        ORDER BY v_phantom.directly_observed_lost_revenue DESC, branch_id, product_id, snapshot_date LIMIT 100""",
    "R15_top_differences": """
        SELECT *, abs(stock_difference) AS absolute_difference FROM v_issues
        ORDER BY absolute_difference DESC, branch_id, product_id, snapshot_date LIMIT 100""",
    "R16_supplier_fill": "SELECT supplier_name, fill_rate FROM v_suppliers",
    "R17_branch_risk_table": """
        SELECT risk_rank, branch_name, issue_count, phantom_incidents,
               estimated_lost_revenue::DOUBLE AS estimated_lost_revenue FROM v_health""",
    "O1_largest_differences": "SELECT * FROM v_issues",
    "O4_lost_by_value": f"SELECT {_LOST} FROM v_lost",
    "O11_order_for_chart": "SELECT probable_issue, COUNT(*) AS issue_count FROM v_issues GROUP BY ALL",
    "O8_top_12_branches": f"SELECT {_HEALTH} FROM v_health ORDER BY risk_rank, branch_id LIMIT 12",
    "O9_top_20_phantom": f"""
        SELECT {_PHANTOM} FROM v_phantom
        ORDER BY v_phantom.directly_observed_lost_revenue DESC, branch_id, product_id, snapshot_date LIMIT 20""",
}

_BODIES["O12_first_offenders"] = f"""
    SELECT * FROM ({_BODIES["Q5_model_rules"]} UNION ALL {_BODIES["Q7_model_rules"]})
    ORDER BY rule_id, table_name, record_id, detail LIMIT 10"""

# Stored sets: their rows before they were stored.
_SETS = {
    "inventory_reconciliation": "FROM v_recon",
    "reconciliation_issues": "FROM v_issues",
    "phantom_inventory": "FROM v_phantom",
    "stockout_periods": "FROM v_stockout_periods",
    "lost_sales_estimate": "FROM v_lost",
    "supplier_performance": "FROM v_suppliers",
    "branch_inventory_health": "FROM v_health",
    "data_quality_issues": "FROM v_quality",
}


def _results(*names: str) -> str:
    return summaries_sql({name: (_SETS[name], RESULTS[name]) for name in names})


_BODIES |= {
    "S3_read_result": _results(
        "reconciliation_issues", "phantom_inventory", "stockout_periods", "lost_sales_estimate",
        "supplier_performance", "branch_inventory_health",
    ),
    "S5_load_tables": summaries_sql(
        {f"{name}{kind}": (f"FROM {name}", schema) for kind in ("", " (csv)") for name, schema in TABLES.items()}
    ),
    "S7_export_all": _results(*_SETS),
    "S8_export_published": summaries_sql(
        {
            "branch_inventory_health": (
                "FROM v_health ORDER BY risk_rank, branch_id LIMIT 12", RESULTS["branch_inventory_health"]
            ),
            "supplier_performance": ("FROM v_suppliers", RESULTS["supplier_performance"]),
            "phantom_inventory_examples": (
                "FROM v_phantom ORDER BY directly_observed_lost_revenue DESC, branch_id, product_id, snapshot_date"
                " LIMIT 20",
                RESULTS["phantom_inventory"],
            ),
            "validation_summary": ("FROM v_validation", RESULTS["validation_summary"]),
        }
    ),
}


def _positions(rows: str, order: str, columns: str) -> str:
    return f"""SELECT row_number() OVER (ORDER BY {order}) AS position, {columns} FROM {rows}
        QUALIFY position <= 25"""


_DAY = "branch_id, product_id, snapshot_date"
_BODIES |= {
    "O1_positions": _positions("v_issues", f"abs(stock_difference) DESC, {_DAY}", _DAY),
    "O2_positions": _positions("v_phantom", f"directly_observed_lost_revenue DESC, {_DAY}", _DAY),
    "O3_positions": _positions(
        "v_stockout_periods",
        "stockout_days DESC, cancelled_quantity DESC, branch_id, product_id, stockout_start",
        "branch_id, product_id, stockout_start",
    ),
    "O4_positions": _positions(
        "v_lost",
        "estimated_lost_revenue DESC, branch_id, product_id, stockout_date",
        "branch_id, product_id, stockout_date",
    ),
    "O5_positions": _positions("v_suppliers", "on_time_delivery_rate, fill_rate, supplier_id", "supplier_id"),
    "O6_positions": _positions("v_health", "risk_rank, branch_id", "branch_id"),
    "O11_positions": _positions(
        "(SELECT probable_issue, COUNT(*) AS n FROM v_issues GROUP BY ALL)", "n DESC, probable_issue", "probable_issue"
    ),
}

# A page of each order, and the dashboard from stored tables.
for _number in (1, 2, 3, 4):
    _whole = _BODIES[f"O{_number}_positions"]
    _BODIES[f"O{_number}_page"] = f"""SELECT * REPLACE (position - 1 AS position)
        FROM ({_whole.replace('QUALIFY position <= 25', 'QUALIFY position BETWEEN 101 AND 160')})"""
_BODIES |= {
    "R1_from_stored": _BODIES["R1_issue_mix"],
    "R9_from_stored": _BODIES["R9_cause_counts"],
    "R12_from_stored": _BODIES["R12_dashboard_kpis"],
    "R13_mix_of_branches": """
        SELECT probable_issue, issue_severity, COUNT(*) AS issue_count,
               SUM(abs(stock_difference))::BIGINT AS units_affected
        FROM v_issues WHERE branch_id - 1 IN (1, 7, 20) GROUP BY ALL""",
    "R14_from_stored": _BODIES["R14_severity_mix"],
    "R17_from_stored": _BODIES["R17_branch_risk_table"],
}

# Loads of new days and refreshed tables end in the rows of a single load.
for _entry in ("V4", "V5", "V6", "V7", "V8", "V9", "V11"):
    (_whole,) = (name for name in _BODIES if name.startswith(f"{_entry}_"))
    _BODIES[f"{_entry}_in_two_loads"] = _BODIES[_whole]
_BODIES["S5_refresh_that_breaks_off"] = summaries_sql({name: (f"FROM {name}", schema) for name, schema in TABLES.items()})
_BODIES["S10_rows_counted_while_written"] = _BODIES["S10_row_counts"]

# Further common tables of single queries.
_EXTRA = {
    "W4_risk_rank": """, rounded AS MATERIALIZED (
        SELECT branch_id, issue_count, (floor(estimated_lost_revenue / 100000) * 100000)::BIGINT AS money
        FROM v_branch_base)""",
}


def all_oracles() -> dict[str, str]:
    return {name: f"{_PREFIX}{_EXTRA.get(name, '')}\n{body}" for name, body in _BODIES.items()}
