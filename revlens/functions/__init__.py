"""Scalar Column expressions: fiscal calendar, division/rounding rules, lists, text."""

from revlens.functions.arith import (blank_sub, divide, money, round_ratio, sql_div,
                                     to_double)
from revlens.functions.fiscal import (FY_START_MONTH, fiscal_quarter, fiscal_year,
                                      fiscal_year_bounds, fiscal_year_filter)
from revlens.functions.sets import code_in_list, parse_code_list, restrict_to_codes
from revlens.functions.text import equals_ci

__all__ = [
    "FY_START_MONTH", "blank_sub", "code_in_list", "divide", "equals_ci", "fiscal_quarter",
    "fiscal_year", "fiscal_year_bounds", "fiscal_year_filter", "money", "parse_code_list",
    "restrict_to_codes", "round_ratio", "sql_div", "to_double",
]
