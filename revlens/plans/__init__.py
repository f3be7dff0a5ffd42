"""Plan-level helpers: bounded joins and plan inspection."""

from revlens.plans.joins import attach_row, join_totals, null_safe_join

__all__ = ["attach_row", "join_totals", "null_safe_join"]
