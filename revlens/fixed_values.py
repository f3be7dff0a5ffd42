"""Fixed values the results depend on, stated once.

# These must equal the reports' own definitions for the results
# to match; they are data, not tuning knobs.
"""

# Fiscal year starts in September: FY N runs from Sep 1 of N-1 to Aug 31 of N.
FY_START_MONTH = 9

# Money lines and report totals are shown in millions.
MILLION = 1_000_000

# Report-SQL forecast accuracy: 0 when the absolute error exceeds this percentage.
ACCURACY_CAP_PCT = 100

# Rounding digits of the report SQL.
MONEY_DIGITS = 2
NET_ERROR_PCT_DIGITS = 1
ABS_ERROR_PCT_DIGITS = 2
ACCURACY_DIGITS = 2
POST_INVOICE_PCT_DIGITS = 4

# Stock-risk labels: forecast above actual (excess inventory), below (out of stock).
RISK_EXCESS_INVENTORY = "EI"
RISK_OUT_OF_STOCK = "OOS"

# P&L line items in display order (order, description).
PL_ROWS = [
    (1, "Gross Sales"), (2, "Pre Invoice Deduction"), (3, "Net Invoice Sales"),
    (4, "Post Invoice Deduction"), (5, "Post Invoice Other Deduction"),
    (6, "Total Post Invoice Deduction"), (7, "Net Sales"), (8, "Manufacturing Cost"),
    (9, "Freight Cost"), (10, "Other Cost"), (11, "Total COGS"), (12, "Gross Margin"),
    (13, "Gross Margin %"), (14, "GM / Unit"), (15, "Operational Expense"),
    (16, "Net Profit"), (17, "Net Profit %"),
]

# P&L lines that have a target, and the label of the statement's total line.
PL_TARGET_LINES = (7, 12, 13, 17)
PL_TOTAL_LABEL = "Total"
