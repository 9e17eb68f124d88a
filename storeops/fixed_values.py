"""Lists, names and constants that the results depend on, kept in one place as plain text."""

# Spelling (upper case, trimmed) -> store id.
STORE_ALIASES = [
    ("DOWNTOWN ROBSON", "L01"),
    ("DT ROBSON", "L01"),
    ("ROBSON ST", "L01"),
    ("KITSILANO", "L02"),
    ("KITS", "L02"),
    ("METROTOWN", "L03"),
    ("RICHMOND CENTRE", "L04"),
    ("RICHMOND CENTER", "L04"),
    ("RMD CENTRE", "L04"),
    ("GUILDFORD", "L05"),
    ("SURREY - GUILDFORD", "L05"),
    ("COQUITLAM CENTRE", "L06"),
    ("COQUITLAM CTR", "L06"),
    ("COQUITLAM", "L06"),
    ("LONSDALE", "L07"),
    ("N. VAN LONSDALE", "L07"),
    ("WILLOWBROOK", "L08"),
    ("LANGLEY WILLOWBROOK", "L08"),
    ("COLUMBIA SQUARE", "L09"),
    ("COLUMBIA SQ", "L09"),
    ("NEW WEST", "L09"),
    ("SEVENOAKS", "L10"),
    ("ABBOTSFORD SEVENOAKS", "L10"),
]

# Spelling (upper case, trimmed) -> role.
ROLE_ALIASES = [
    ("SERVER", "Server"),
    ("HOST", "Host"),
    ("BARTENDER", "Bartender"),
    ("LINE COOK", "Line Cook"),
    ("COOK - LINE", "Line Cook"),
    ("PREP COOK", "Prep Cook"),
    ("DISHWASHER", "Dishwasher"),
    ("DISH", "Dishwasher"),
    ("MANAGER", "Manager"),
]

# Statutory holidays of the published period.
HOLIDAYS = [
    ("2025-01-01", "New Year's Day"),
    ("2025-02-17", "Family Day"),
    ("2025-04-18", "Good Friday"),
    ("2025-05-19", "Victoria Day"),
    ("2025-07-01", "Canada Day"),
    ("2025-08-04", "B.C. Day"),
    ("2025-09-01", "Labour Day"),
    ("2025-09-30", "Truth and Reconciliation Day"),
    ("2025-10-13", "Thanksgiving"),
    ("2025-11-11", "Remembrance Day"),
    ("2025-12-25", "Christmas Day"),
    ("2026-01-01", "New Year's Day"),
    ("2026-02-16", "Family Day"),
    ("2026-04-03", "Good Friday"),
    ("2026-05-18", "Victoria Day"),
    ("2026-07-01", "Canada Day"),
    ("2026-08-03", "B.C. Day"),
]

# Rows each extract must land with.
EXPECTED_LOADS = [
    ("POS_SALES", 554747),
    ("POS_COVERS_HOURLY", 96160),
    ("TIMECLOCK", 224777),
    ("PURCHASING", 44813),
    ("INVENTORY_COUNTS", 38280),
    ("WASTE_LOG", 37840),
    ("REF_LOCATIONS", 10),
    ("REF_MENU", 29),
    ("REF_INGREDIENTS", 44),
    ("REF_RECIPES", 131),
    ("REF_EMPLOYEES", 842),
]

# The published calendar.
CALENDAR_START = "2025-01-05"
CALENDAR_END = "2026-08-30"

# Check id, area, name, rule.
QUALITY_RULES = [
    (1, "POS sales", "Duplicate rows removed", "FIXED"),
    (2, "POS sales", "Dates in DD-MON-YYYY format standardised", "FIXED"),
    (3, "POS sales", "Missing net_sales rebuilt as gross - discounts - comps", "FIXED"),
    (4, "POS sales", "Unparseable business dates", "MUST_BE_ZERO"),
    (5, "POS sales", "Item names that do not match the menu master (ignoring case/spaces)", "MUST_BE_ZERO"),
    (6, "POS sales", "Sales rows for menu items not in the menu master", "MUST_BE_ZERO"),
    (7, "POS sales", "Rows where net <> gross - discounts - comps (> $0.01)", "MUST_BE_ZERO"),
    (8, "POS sales", "Store-days where hourly sales <> item sales (> $1)", "MUST_BE_ZERO"),
    (9, "Master data", "Store-name variants mapped to master (rows across all extracts)", "FIXED"),
    (10, "Master data", "Rows with a store name that could not be mapped (all facts)", "MUST_BE_ZERO"),
    (11, "Labour", "Duplicate timeclock rows removed", "FIXED"),
    (12, "Labour", 'Role labels standardised (e.g. "LINE COOK", "Cook - Line")', "FIXED"),
    (13, "Labour", "Missed clock-outs set to scheduled end (flagged)", "FIXED"),
    (14, "Labour", "Shifts with a role that could not be mapped", "MUST_BE_ZERO"),
    (15, "Labour", "Shifts ending before they start", "MUST_BE_ZERO"),
    (16, "Labour", "Shifts for employees not in the employee master", "MUST_BE_ZERO"),
    (17, "Labour", "Employees with two shifts on the same day", "MUST_BE_ZERO"),
    (18, "Inventory", "Duplicate purchase lines removed", "FIXED"),
    (19, "Inventory", "Produce lines received in lb converted to kg", "FIXED"),
    (20, "Inventory", "Purchase unit <> ingredient master unit (after conversion)", "MUST_BE_ZERO"),
    (21, "Inventory", "Purchase lines with a supplier not in the master list", "MUST_BE_ZERO"),
    (22, "Inventory", "Negative inventory counts", "MUST_BE_ZERO"),
    (23, "Inventory", "Usage weeks missing an opening or closing count", "MUST_BE_ZERO"),
    (24, "Inventory", "Food-cost bridge does not add up (> $0.05)", "MUST_BE_ZERO"),
]

# Headline thresholds and targets.
WORST_DAY_LABOUR_LIMIT = 0.38
LEAK_LIMIT = 0.15
OVER_USE_LIMIT = 0.03
LABOUR_LIMIT = 0.305
LABOUR_TARGET = 0.30
FOOD_COST_TARGET = 0.285
AVG_CHECK_TARGET = 24.00

# Sentences with the slots the figures go into.
STORE_FIGURES = (
    "Labour {labour}% (target 30.0%, chain {chain_labour}%). Worst day: {worst_day} at {worst_day_labour}%. "
    "Food cost {food}% (target 28.5%). Over-use (waste + unexplained) {over_use}% of recipe cost. "
    "Biggest unexplained ingredient since {since}: {leak}, used {leak_over}% over recipe vs "
    "{leak_chain}% chain-wide (${leak_cost})."
)
CHAIN_FIGURES = (
    "Chain labour {labour}% (target 30.0%). Food cost {food}% (target 28.5%). "
    "Gap between recipe cost and actual food cost: ${gap}, of which {price_share}% is supplier price. "
    "Worst store-day for labour: {store} on {worst_day} at {worst_day_labour}%. "
    "Biggest single ingredient leak: {leak_store} {leak}, {leak_over}% over recipe since {since}."
)
