"""Fixed values of the stock data model.

These strings and numbers are part of the results and of the input format, so they
are stated here once, plainly, and used everywhere else by name.
"""

# Movement types, by the sign they carry in the ledger.
INITIAL_STOCK = "INITIAL_STOCK"
DELIVERY = "DELIVERY"
POSITIVE_ADJUSTMENT = "POSITIVE_ADJUSTMENT"
SALE = "SALE"
WASTE = "WASTE"
NEGATIVE_ADJUSTMENT = "NEGATIVE_ADJUSTMENT"
INFLOW_TYPES = (INITIAL_STOCK, DELIVERY, POSITIVE_ADJUSTMENT)
OUTFLOW_TYPES = (SALE, WASTE, NEGATIVE_ADJUSTMENT)
MOVEMENT_TYPES = INFLOW_TYPES + OUTFLOW_TYPES

# Reasons of a cancelled sale.
OUT_OF_STOCK = "OUT_OF_STOCK"
SYSTEM_SHOWED_AVAILABLE = "SYSTEM_SHOWED_AVAILABLE"
CANCELLATION_REASONS = (OUT_OF_STOCK, SYSTEM_SHOWED_AVAILABLE)

# Reference of a delivery to its supplier order.
SUPPLIER_REFERENCE_PREFIX = "SUP-"

# Outcome of comparing the recorded stock with the ledger.
RECONCILED = "Reconciled"
RECORDED_EXCEEDS = "Recorded stock exceeds ledger"
LEDGER_EXCEEDS = "Ledger exceeds recorded stock"

# Severity by the absolute difference in units, largest bound first.
SEVERITY_BOUNDS = (("Critical", 25), ("High", 10), ("Medium", 5))
LOWEST_SEVERITY = "Low"

# Issue types.
DUPLICATE_MOVEMENT = "Duplicate inventory movement"
MISSING_DELIVERY = "Missing delivery movement"
SHRINKAGE = "Possible shrinkage or missing outflow"
UNRECORDED_INFLOW = "Possible unrecorded inflow or count error"
PHANTOM = "Phantom inventory"
ORDER_WITHOUT_MOVEMENT = "Delivered supplier order without movement"

# Expected demand is the mean of this many earlier weeks, missing days as 0.
LOOKBACK_WEEKS = 4
