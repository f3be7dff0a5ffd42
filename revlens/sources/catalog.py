"""SQL surface: the star, the waterfall layers, the fiscal functions and the procedures by name.

``register(spark, star)`` makes names for one session: temp views for every star
table, the four waterfall layers (``gross_sales``, ``sales_preinv_discount``,
``sales_postinv_discount``, ``net_sales``) and the unified ``fact_actual_est``,
the scalar functions ``get_fiscal_year(date)`` and ``get_fiscal_quarter(date)``,
and the parameterised procedures as table functions:

* ``get_monthly_gross_sales_for_customer(code)``
* ``get_monthly_gross_sales_for_customer_multi('7,8,9')``
* ``get_forecast_accuracy(1997)``

``publish(spark, database)`` stores the same names in a database saved with
``Star.save_tables``, where they outlive the session: any later session reads
``net_sales`` or calls a procedure by name. All bodies are SQL, so Catalyst
inlines them: a fiscal year given by the caller prunes the partitions of every
fact, and no Python runs.

Procedures return rows in no order; the caller orders them. Table functions
can't be called with a database name: ``USE`` the database first.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from revlens.fixed_values import (ABS_ERROR_PCT_DIGITS, ACCURACY_CAP_PCT, ACCURACY_DIGITS, NET_ERROR_PCT_DIGITS,
                                  POST_INVOICE_PCT_DIGITS)
from revlens.functions.arith import RATIO_TYPE
from revlens.functions.fiscal import FY_START_MONTH, _shift
from revlens.operators.forecast import actual_vs_forecast
from revlens.operators.waterfall import CUSTOMER_ATTRS, PRODUCT_ATTRS, gross_sales, with_net_sales, with_post_invoice, with_pre_invoice
from revlens.sources.star import TABLES

LAYERS = ("gross_sales", "sales_preinv_discount", "sales_postinv_discount", "net_sales", "fact_actual_est")
PROCEDURES = ("get_monthly_gross_sales_for_customer", "get_monthly_gross_sales_for_customer_multi", "get_forecast_accuracy")


def scalar_functions(start_month: int) -> dict[str, str]:
    """Signature and body of each scalar function."""
    shifted = f"add_months(d, {_shift(start_month)})"
    return {
        "get_fiscal_year": f"(d DATE) RETURNS INT RETURN CAST(year({shifted}) AS INT)",
        "get_fiscal_quarter": f"(d DATE) RETURNS INT RETURN CAST(quarter({shifted}) AS INT)",
    }


def procedures(prefix: str, start_month: int) -> dict[str, str]:
    """Signature and body of each table function over the tables called ``<prefix><table>``.

    The stored fiscal year starts in September: with that start month the price
    join uses it, so that a year given as ``in_fiscal_year`` prunes the facts'
    partitions; with another one the year is computed from the date.
    """
    year = "s.fiscal_year" if start_month == FY_START_MONTH else f"{prefix}get_fiscal_year(s.date)"

    def monthly(name: str, parameter: str, condition: str) -> str:
        return (f"({parameter}, in_fiscal_year INT DEFAULT NULL) RETURNS TABLE (date DATE, monthly_sales DOUBLE) "
                f"RETURN SELECT s.date, CAST(SUM(ROUND(g.gross_price * s.sold_quantity, 2)) AS DOUBLE) "
                f"FROM {prefix}fact_sales_monthly s JOIN {prefix}fact_gross_price g "
                f"ON g.product_code = s.product_code AND g.fiscal_year = {year} "
                f"WHERE {condition} AND ({name}.in_fiscal_year IS NULL OR {year} = {name}.in_fiscal_year) GROUP BY s.date")

    one, multi, accuracy = PROCEDURES

    def pct(amount: str, digits: int) -> str:
        return f"ROUND(CAST(try_divide({amount} * 100.0, total_forecast_quantity) AS {RATIO_TYPE}), {digits})"

    sides = [f"(SELECT date, customer_code, product_code, {q} FROM {prefix}{t} WHERE fiscal_year = {accuracy}.in_fiscal_year)"
             for t, q in (("fact_sales_monthly", "sold_quantity"), ("fact_forecast_monthly", "forecast_quantity"))]
    per_customer = ("SELECT customer_code, SUM(sold_quantity) AS total_quantity, SUM(forecast_quantity) AS total_forecast_quantity, "
                    "SUM(forecast_quantity - sold_quantity) AS net_error, SUM(ABS(forecast_quantity - sold_quantity)) AS abs_error "
                    f"FROM {sides[0]} FULL OUTER JOIN {sides[1]} USING (date, customer_code, product_code) GROUP BY customer_code")
    rated = (f"SELECT *, {pct('net_error', NET_ERROR_PCT_DIGITS)} AS net_error_pct, {pct('abs_error', ABS_ERROR_PCT_DIGITS)} AS abs_error_pct "
             f"FROM ({per_customer})")
    return {
        one: monthly(one, "in_customer_code BIGINT", f"s.customer_code = {one}.in_customer_code"),
        multi: monthly(multi, "in_customer_codes STRING", f"find_in_set(CAST(s.customer_code AS STRING), {multi}.in_customer_codes) > 0"),
        accuracy: "(in_fiscal_year INT) RETURNS TABLE (customer_code BIGINT, total_quantity BIGINT, total_forecast_quantity BIGINT, "
                  "net_error BIGINT, net_error_pct DOUBLE, abs_error BIGINT, abs_error_pct DOUBLE, customer STRING, market STRING, "
                  "forecast_accuracy DOUBLE) RETURN SELECT e.customer_code, total_quantity, total_forecast_quantity, net_error, "
                  "CAST(net_error_pct AS DOUBLE), abs_error, CAST(abs_error_pct AS DOUBLE), c.customer, c.market, "
                  f"CAST(CASE WHEN abs_error_pct > {ACCURACY_CAP_PCT} THEN 0 ELSE ROUND(100.0 - abs_error_pct, {ACCURACY_DIGITS}) END AS DOUBLE) "
                  f"FROM ({rated}) e JOIN {prefix}dim_customer c ON c.customer_code = e.customer_code",
    }


def layer_views(database: str) -> dict[str, str]:
    """Body of each stored view.

    The post-invoice rows of a line lie in its own fiscal year, so that year is
    part of the join and prunes both facts. The unified table is the sales with
    their forecasts and, apart, the forecasts without sales: a filter on the
    year or on a key reaches the scans of both, which it can't through a full
    outer join; ``get_forecast_accuracy`` joins once.
    """
    def money(x: str) -> str:
        return f"CAST(ROUND({x}, 2) AS DECIMAL(20,2))"

    db = f"{database}."
    attrs = ", ".join([f"c.{x}" for x in CUSTOMER_ATTRS] + [f"p.{x}" for x in PRODUCT_ATTRS])
    keys = "f.date = s.date AND f.product_code = s.product_code AND f.customer_code = s.customer_code AND f.fiscal_year = s.fiscal_year"
    return {
        "gross_sales": f"SELECT s.date, s.fiscal_year, s.customer_code, s.product_code, {attrs}, s.sold_quantity, "
                       f"g.gross_price AS gross_price_per_item, {money('g.gross_price * s.sold_quantity')} AS gross_price_total "
                       f"FROM {db}fact_sales_monthly s "
                       f"JOIN {db}fact_gross_price g ON g.product_code = s.product_code AND g.fiscal_year = s.fiscal_year "
                       f"JOIN {db}dim_product p ON p.product_code = s.product_code "
                       f"JOIN {db}dim_customer c ON c.customer_code = s.customer_code",
        "sales_preinv_discount": f"SELECT s.*, d.pre_invoice_discount_pct FROM {db}gross_sales s "
                                 f"JOIN {db}fact_pre_invoice_deductions d ON d.customer_code = s.customer_code AND d.fiscal_year = s.fiscal_year",
        "sales_postinv_discount": f"SELECT s.*, {money('s.gross_price_total - s.gross_price_total * s.pre_invoice_discount_pct')} AS net_invoice_sale, "
                                  f"CAST(ROUND(f.discounts_pct + f.other_deductions_pct, {POST_INVOICE_PCT_DIGITS}) AS DECIMAL(5,4)) AS post_invoice_discount_pct "
                                  f"FROM {db}sales_preinv_discount s JOIN {db}fact_post_invoice_deductions f ON {keys}",
        "net_sales": f"SELECT *, {money('(1 - post_invoice_discount_pct) * net_invoice_sale')} AS net_sales FROM {db}sales_postinv_discount",
        "fact_actual_est": f"SELECT s.date, s.fiscal_year, s.product_code, s.customer_code, s.sold_quantity, f.forecast_quantity "
                           f"FROM {db}fact_sales_monthly s LEFT JOIN {db}fact_forecast_monthly f ON {keys} "
                           f"UNION ALL SELECT f.date, f.fiscal_year, f.product_code, f.customer_code, CAST(NULL AS BIGINT), f.forecast_quantity "
                           f"FROM {db}fact_forecast_monthly f LEFT ANTI JOIN {db}fact_sales_monthly s ON {keys}",
    }


def register_functions(spark: SparkSession, start_month: int = FY_START_MONTH) -> None:
    for name, body in scalar_functions(start_month).items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")


def register(spark: SparkSession, t, start_month: int = FY_START_MONTH) -> list[str]:
    """Register the functions, all views and the procedures in this session; returns the view names."""
    register_functions(spark, start_month)
    for name in TABLES:
        getattr(t, name).createOrReplaceTempView(name)
    gs = gross_sales(t)
    pre = with_pre_invoice(gs, t)
    post = with_post_invoice(pre, t)
    layers = {
        "gross_sales": gs,
        "sales_preinv_discount": pre,
        "sales_postinv_discount": post,
        "net_sales": with_net_sales(post),
        "fact_actual_est": actual_vs_forecast(t.fact_sales_monthly, t.fact_forecast_monthly),
    }
    for name, df in layers.items():
        df.createOrReplaceTempView(name)
    for name, body in procedures("", start_month).items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
    return list(TABLES) + list(layers)


def publish(spark: SparkSession, database: str, start_month: int = FY_START_MONTH) -> list[str]:
    """Store the functions, layer views and procedures in ``database`` (see ``Star.save_tables``); returns their names.

    They replace stored ones of the same name. The facts' keys have to be unique
    and their years those of their dates, as ``Star.build`` enforces.
    """
    names = []
    for name, body in scalar_functions(start_month).items():
        spark.sql(f"CREATE OR REPLACE FUNCTION {database}.{name}{body}")
        names.append(name)
    for name, body in layer_views(database).items():
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {body}")
        names.append(name)
    for name, body in procedures(f"{database}.", start_month).items():
        spark.sql(f"CREATE OR REPLACE FUNCTION {database}.{name}{body}")
        names.append(name)
    return names
