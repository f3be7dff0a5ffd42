"""Preconditions of the reports, as checks that fail."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.functions.fiscal import FY_START_MONTH, fiscal_year
from revlens.operators.forecast import KEYS, key_duplicates


def require_unique_keys(df: DataFrame, name: str, keys: list[str] | None = None) -> None:
    """Raise ValueError when a key of ``df`` repeats (joins on it would multiply rows)."""
    found = key_duplicates(df, keys).first()
    if found is not None:
        raise ValueError(f"{name}: key {tuple(found[k] for k in keys or KEYS)} occurs {found['count']} times")


def require_stored_fiscal_year(df: DataFrame, name: str, start_month: int = FY_START_MONTH) -> None:
    """Raise ValueError when a stored fiscal_year isn't the fiscal year of the row's date."""
    wrong = df.filter(~F.col("fiscal_year").eqNullSafe(fiscal_year("date", start_month))).first()
    if wrong is not None:
        raise ValueError(f"{name}: fiscal_year {wrong['fiscal_year']} stored for {wrong['date']}")


def check_facts(t) -> None:
    """Both checks on the three facts of the (date, product, customer) grain."""
    for name in ("fact_sales_monthly", "fact_forecast_monthly", "fact_post_invoice_deductions"):
        require_unique_keys(getattr(t, name), name)
        require_stored_fiscal_year(getattr(t, name), name)
