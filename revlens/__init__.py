"""revlens: commercial performance reports (revenue waterfall, contribution,
rankings, forecast accuracy, P&L, market share) as Spark DataFrame operators."""

__version__ = "0.1.0"
