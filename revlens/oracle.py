"""DuckDB SQL for the fixture views, used to build the independent oracle queries.

The views reshape the driver's TPC-H-like tables into the star schema
(FIXTURES.md). Oracle queries inline the views they need as CTEs, so each
oracle string runs on a bare DuckDB connection with only the raw tables.
"""

from __future__ import annotations

# The fixture view definitions of FIXTURES.md, verbatim.
VIEWS: dict[str, str] = {
    "dim_customer": """SELECT CAST(c_custkey AS BIGINT) AS customer_code, 'ACCT-' || CAST(c_custkey % 40 AS VARCHAR(4)) AS customer, n_name AS market, r_name AS region, c_mktsegment AS channel
FROM customer
JOIN nation ON n_nationkey = c_nationkey
JOIN region ON r_regionkey = n_regionkey""",
    "dim_product": """SELECT p_partkey AS product_code, p_name AS product, p_type AS variant, p_type AS segment, p_brand AS division
FROM part""",
    "fact_sales_monthly": """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS date, CAST(year(o_orderdate + INTERVAL 4 MONTH) AS INT) AS fiscal_year, l_partkey AS product_code, o_custkey AS customer_code, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS sold_quantity
FROM lineitem
JOIN orders ON o_orderkey = l_orderkey
GROUP BY 1, 2, 3, 4""",
    "dim_fiscal_year": """SELECT DISTINCT CAST(year(o_orderdate + INTERVAL 4 MONTH) AS INT) AS fiscal_year
FROM orders""",
    "fact_gross_price": """SELECT p_partkey AS product_code, fiscal_year, CAST(CAST(p_retailprice AS DECIMAL(15,4)) * (100 + 2 * (fiscal_year - 1995)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(15,4)) AS gross_price
FROM part
CROSS JOIN dim_fiscal_year
WHERE (p_partkey + fiscal_year) % 97 <> 0""",
    "fact_pre_invoice_deductions": """SELECT c_custkey AS customer_code, fiscal_year, CAST((5 + (c_custkey * 13 + fiscal_year) % 21) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(5,4)) AS pre_invoice_discount_pct
FROM customer
CROSS JOIN dim_fiscal_year""",
    "fact_post_invoice_deductions": """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS date, l_partkey AS product_code, o_custkey AS customer_code, CAST(MIN(l_discount) AS DECIMAL(5,4)) AS discounts_pct, CAST(MIN(l_tax) AS DECIMAL(5,4)) AS other_deductions_pct, CAST(year(o_orderdate + INTERVAL 4 MONTH) AS INT) AS fiscal_year
FROM lineitem
JOIN orders ON o_orderkey = l_orderkey
GROUP BY 1, 2, 3, 6""",
    "fact_forecast_monthly": """SELECT date, fiscal_year, product_code, customer_code, CAST(GREATEST(sold_quantity + (customer_code * 7 + product_code * 3) % 21 - 10, 0) AS BIGINT) AS forecast_quantity
FROM fact_sales_monthly
WHERE (customer_code + product_code) % 10 <> 0
UNION ALL SELECT CAST(s.date + INTERVAL 1 MONTH AS DATE) AS date, CAST(year(s.date + INTERVAL 5 MONTH) AS INT) AS fiscal_year, s.product_code, s.customer_code, s.sold_quantity AS forecast_quantity
FROM fact_sales_monthly s
LEFT JOIN fact_sales_monthly n ON n.product_code = s.product_code AND n.customer_code = s.customer_code AND n.date = CAST(s.date + INTERVAL 1 MONTH AS DATE)
WHERE (s.customer_code + s.product_code) % 10 = 1 AND n.date IS NULL""",
    "marketshare": """SELECT CAST(year(o_orderdate + INTERVAL 4 MONTH) AS INT) AS fiscal_year, p_type AS category, p_brand AS manufacturer, CAST(SUM(CAST(l_extendedprice AS DECIMAL(15,2))) AS DECIMAL(25,2)) AS sales, CAST(SUM(SUM(CAST(l_extendedprice AS DECIMAL(15,2)))) OVER (PARTITION BY year(o_orderdate + INTERVAL 4 MONTH), p_type) AS DECIMAL(25,2)) AS total_market_sales
FROM lineitem
JOIN orders ON o_orderkey = l_orderkey
JOIN part ON p_partkey = l_partkey
GROUP BY year(o_orderdate + INTERVAL 4 MONTH), p_type, p_brand""",
    "expenses": """SELECT p_type AS category, p_size AS amount, p_partkey AS expense_id
FROM part""",
    "gross_sales": """SELECT s.date, s.fiscal_year, s.customer_code, s.product_code, c.customer, c.market, c.region, c.channel, p.product, p.variant, p.segment, p.division, s.sold_quantity, g.gross_price AS gross_price_per_item, CAST(ROUND(CAST(g.gross_price * s.sold_quantity AS DECIMAL(24,6)), 2) AS DECIMAL(20,2)) AS gross_price_total
FROM fact_sales_monthly s
JOIN dim_customer c ON c.customer_code = s.customer_code
JOIN dim_product p ON p.product_code = s.product_code
JOIN fact_gross_price g ON g.product_code = s.product_code AND g.fiscal_year = s.fiscal_year""",
    "sales_preinv_discount": """SELECT gs.*, pre.pre_invoice_discount_pct
FROM gross_sales gs
JOIN fact_pre_invoice_deductions pre ON pre.customer_code = gs.customer_code AND pre.fiscal_year = gs.fiscal_year""",
    "sales_postinv_discount": """SELECT s.*, CAST(ROUND(CAST((1 - s.pre_invoice_discount_pct) * s.gross_price_total AS DECIMAL(28,6)), 2) AS DECIMAL(20,2)) AS net_invoice_sale, CAST(po.discounts_pct + po.other_deductions_pct AS DECIMAL(5,4)) AS post_invoice_discount_pct
FROM sales_preinv_discount s
JOIN fact_post_invoice_deductions po ON po.date = s.date AND po.product_code = s.product_code AND po.customer_code = s.customer_code""",
    "net_sales": """SELECT *, CAST(ROUND(CAST((1 - post_invoice_discount_pct) * net_invoice_sale AS DECIMAL(28,6)), 2) AS DECIMAL(20,2)) AS net_sales
FROM sales_postinv_discount""",
    "fact_actual_est": """SELECT s.date, s.fiscal_year, s.product_code, s.customer_code, s.sold_quantity, f.forecast_quantity
FROM fact_sales_monthly s
LEFT JOIN fact_forecast_monthly f ON f.date = s.date AND f.customer_code = s.customer_code AND f.product_code = s.product_code
UNION SELECT f.date, f.fiscal_year, f.product_code, f.customer_code, s.sold_quantity, f.forecast_quantity
FROM fact_forecast_monthly f
LEFT JOIN fact_sales_monthly s ON s.date = f.date AND s.customer_code = f.customer_code AND s.product_code = f.product_code""",
    "fact_actuals_estimates": """SELECT n.date, n.fiscal_year, n.customer_code, n.product_code, n.customer, n.market, n.region, n.channel, n.product, n.segment, n.division, n.sold_quantity, n.gross_price_total AS gross_sales_amount, CAST(n.gross_price_total - n.net_invoice_sale AS DECIMAL(20,2)) AS pre_invoice_deduction, n.net_invoice_sale AS net_invoice_sales_amount, CAST(ROUND(CAST(po.discounts_pct * n.net_invoice_sale AS DECIMAL(28,6)), 2) AS DECIMAL(20,2)) AS post_invoice_deduction, CAST(n.net_invoice_sale - n.net_sales - CAST(ROUND(CAST(po.discounts_pct * n.net_invoice_sale AS DECIMAL(28,6)), 2) AS DECIMAL(20,2)) AS DECIMAL(20,2)) AS post_invoice_other_deduction, n.net_sales AS net_sales_amount, CAST(ROUND(CAST(n.net_sales * (45 + n.product_code % 15) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(28,6)), 2) AS DECIMAL(20,2)) AS manufacturing_cost, CAST(ROUND(CAST(n.net_sales * (1 + n.customer_code % 5) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(28,6)), 2) AS DECIMAL(20,2)) AS freight_cost, CAST(ROUND(CAST(n.net_sales * CAST(0.005 AS DECIMAL(4,3)) AS DECIMAL(28,6)), 2) AS DECIMAL(20,2)) AS other_cost, CAST(ROUND(CAST(n.net_sales * (5 + n.customer_code % 12) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(28,6)), 2) AS DECIMAL(20,2)) AS ads_promotions, CAST(ROUND(CAST(n.net_sales * (15 + n.product_code % 20) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(28,6)), 2) AS DECIMAL(20,2)) AS other_operational_expense
FROM net_sales n
JOIN fact_post_invoice_deductions po ON po.date = n.date AND po.product_code = n.product_code AND po.customer_code = n.customer_code""",
    "ns_gm_target": """SELECT fiscal_year, market, CAST(ROUND(CAST(SUM(net_sales_amount) * (95 + length(market)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(32,6)), 2) AS DECIMAL(24,2)) AS ns_target, CAST(ROUND(CAST(SUM(net_sales_amount) * CAST(0.40 AS DECIMAL(3,2)) AS DECIMAL(32,6)), 2) AS DECIMAL(24,2)) AS gm_target, CAST(ROUND(CAST(SUM(net_sales_amount) * CAST(0.05 AS DECIMAL(3,2)) AS DECIMAL(32,6)), 2) AS DECIMAL(24,2)) AS np_target
FROM fact_actuals_estimates
WHERE fiscal_year >= 1996
GROUP BY fiscal_year, market""",
    "pl_rows": """SELECT *
FROM (VALUES (1, 'Gross Sales'), (2, 'Pre Invoice Deduction'), (3, 'Net Invoice Sales'), (4, 'Post Invoice Deduction'), (5, 'Post Invoice Other Deduction'), (6, 'Total Post Invoice Deduction'), (7, 'Net Sales'), (8, 'Manufacturing Cost'), (9, 'Freight Cost'), (10, 'Other Cost'), (11, 'Total COGS'), (12, 'Gross Margin'), (13, 'Gross Margin %'), (14, 'GM / Unit'), (15, 'Operational Expense'), (16, 'Net Profit'), (17, 'Net Profit %')) AS t(ord, description)""",
}

DEPENDS: dict[str, list[str]] = {
    "fact_gross_price": ["dim_fiscal_year"],
    "fact_pre_invoice_deductions": ["dim_fiscal_year"],
    "fact_forecast_monthly": ["fact_sales_monthly"],
    "gross_sales": ["fact_sales_monthly", "dim_customer", "dim_product", "fact_gross_price"],
    "sales_preinv_discount": ["gross_sales", "fact_pre_invoice_deductions"],
    "sales_postinv_discount": ["sales_preinv_discount", "fact_post_invoice_deductions"],
    "net_sales": ["sales_postinv_discount"],
    "fact_actual_est": ["fact_sales_monthly", "fact_forecast_monthly"],
    "fact_actuals_estimates": ["net_sales", "fact_post_invoice_deductions"],
    "ns_gm_target": ["fact_actuals_estimates"],
}


def _ordered(names) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        if n in out:
            return
        for d in DEPENDS.get(n, []):
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def with_views(body: str, *views: str, extra: list[tuple[str, str]] | None = None) -> str:
    """``WITH <needed views>, <extra ctes> <body>``."""
    ctes = [f"{n} AS (\n{VIEWS[n]}\n)" for n in _ordered(views)]
    ctes += [f"{n} AS (\n{sql}\n)" for n, sql in (extra or [])]
    return "WITH " + ",\n".join(ctes) + "\n" + body


# ---------------------------------------------------------------------------
# Oracle queries: plain SQL written from the report definitions, independent
# of the DataFrame code. Money stays DECIMAL and is cast to DOUBLE last;
# ratios that are rounded are fixed at DECIMAL(38,10) first.

FY, FY_PRIOR, CUSTOMER, CUSTOMER_LIST, BRAND, GM_TOLERANCE = 1997, 1996, 7, "7,8,9", "Brand#1", 0.001

_BASE = [("gross_sales", "gross_sales_amount"), ("pre_invoice_deduction", "pre_invoice_deduction"),
         ("net_invoice_sales", "net_invoice_sales_amount"), ("post_invoice_deduction", "post_invoice_deduction"),
         ("post_invoice_other_deduction", "post_invoice_other_deduction"), ("net_sales", "net_sales_amount"),
         ("manufacturing_cost", "manufacturing_cost"), ("freight_cost", "freight_cost"),
         ("other_cost", "other_cost"), ("ads_promotions", "ads_promotions"),
         ("other_operational_expense", "other_operational_expense"), ("sold_quantity", "sold_quantity")]
_MONEY = [n for n, _ in _BASE if n != "sold_quantity"] + ["total_cogs", "gross_margin", "operational_expense",
                                                          "net_profit", "ns_target", "gm_target", "np_target"]


def _div(a: str, b: str, alt: str = "CAST(0 AS DOUBLE)") -> str:
    return f"CASE WHEN ({b}) IS NULL OR ({b}) = 0 THEN {alt} ELSE CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) END"


def _sums(cond: str | None = None, suffix: str = "") -> str:
    parts = []
    for name, col in _BASE:
        expr = col if cond is None else f"CASE WHEN {cond} THEN {col} END"
        parts.append(f"SUM({expr}) AS {name}{suffix}")
    return ", ".join(parts)


def _badd(*terms: str, sign: str = "+") -> str:
    """Measure addition/subtraction: NULL only when every term is NULL."""
    all_null = " AND ".join(f"({t}) IS NULL" for t in terms)
    body = f" {sign} ".join(f"COALESCE({t}, 0)" for t in terms)
    return f"(CASE WHEN {all_null} THEN NULL ELSE {body} END)"


def _derived(x: str = "") -> str:
    cogs = _badd(f"manufacturing_cost{x}", f"freight_cost{x}", f"other_cost{x}")
    gm = _badd(f"net_sales{x}", cogs, sign="-")
    opex = f"(-{_badd(f'ads_promotions{x}', f'other_operational_expense{x}')})"
    np_ = _badd(gm, opex)
    return ", ".join([
        f"{cogs} AS total_cogs{x}", f"{gm} AS gross_margin{x}",
        f"{_div(gm, 'net_sales' + x)} AS gross_margin_pct{x}",
        f"{_div(gm, 'sold_quantity' + x)} AS gm_per_unit{x}",
        f"{opex} AS operational_expense{x}", f"{np_} AS net_profit{x}",
        f"{_div(np_, 'net_sales' + x)} AS net_profit_pct{x}"])


def _out(cols: list[str]) -> str:
    """Select list with money cast to DOUBLE and quantities to BIGINT."""
    res = []
    for c in cols:
        base = c[:-3] if c.endswith("_ly") else c
        if base in _MONEY:
            res.append(f"CAST({c} AS DOUBLE) AS {c}")
        elif base == "sold_quantity":
            res.append(f"CAST({c} AS BIGINT) AS {c}")
        else:
            res.append(c)
    return ", ".join(res)


def _mln(col: str) -> str:
    return f"ROUND(CAST(SUM({col}) / 1000000 AS DECIMAL(38,10)), 2)"


_GS_COLS = ["date", "fiscal_year", "customer_code", "product_code", "customer", "market", "region",
            "channel", "product", "variant", "segment", "division", "sold_quantity"]
_DEC = {"gross_price_per_item", "gross_price_total", "pre_invoice_discount_pct", "net_invoice_sale",
        "post_invoice_discount_pct", "net_sales"}


def _line_cols(extra: list[str]) -> str:
    return ", ".join(_GS_COLS + [f"CAST({c} AS DOUBLE) AS {c}" for c in extra])


def _lines_sql(src: str, dims: list[str], with_bm: str | None) -> str:
    """UNION ALL of the 17 P&L lines (+ total line) from a wide row source."""
    mln = "1000000.0"

    def d(c):
        return f"CAST({c} AS DOUBLE)"

    def vals(x):
        return [f"{d('gross_sales' + x)} / {mln}", f"{d('pre_invoice_deduction' + x)} / {mln}",
                f"{d('net_invoice_sales' + x)} / {mln}", f"{d('post_invoice_deduction' + x)} / {mln}",
                f"{d('post_invoice_other_deduction' + x)} / {mln}",
                _badd(f"{d('post_invoice_deduction' + x)} / {mln}", f"{d('post_invoice_other_deduction' + x)} / {mln}"),
                f"{d('net_sales' + x)} / {mln}", f"{d('manufacturing_cost' + x)} / {mln}",
                f"{d('freight_cost' + x)} / {mln}", f"{d('other_cost' + x)} / {mln}",
                f"{d('total_cogs' + x)} / {mln}", f"{d('gross_margin' + x)} / {mln}",
                f"gross_margin_pct{x} * 100", f"gm_per_unit{x}",
                f"{d('operational_expense' + x)} / {mln}", f"{d('net_profit' + x)} / {mln}",
                f"net_profit_pct{x} * 100"]

    cur = vals("") + [f"{d('net_sales')} / {mln}"]
    if with_bm == "ly":
        bms = vals("_ly") + [f"{d('net_sales_ly')} / {mln}"]
    elif with_bm == "target":
        bms = ["CAST(NULL AS DOUBLE)"] * 17 + [f"{d('ns_target')} / {mln}"]
        bms[6] = f"{d('ns_target')} / {mln}"
        bms[11] = f"{d('gm_target')} / {mln}"
        bms[12] = "gross_margin_pct_target * 100"
        bms[16] = "net_profit_pct_target * 100"
    else:
        bms = None
    dim_sel = "".join(f"{c}, " for c in dims)
    parts = []
    for i, v in enumerate(cur):
        ord_ = str(i + 1) if i < 17 else "CAST(NULL AS INTEGER)"
        bm = f", {bms[i]} AS bm" if bms else ""
        parts.append(f"SELECT {dim_sel}{ord_} AS ord, {v} AS value{bm} FROM {src}")
    return "\nUNION ALL ".join(parts)


def oracle_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    fyd = "year(s.date + INTERVAL 4 MONTH)"

    q["fiscal_calendar"] = """WITH span AS (SELECT CAST(MIN(o_orderdate) AS DATE) AS lo, CAST(MAX(o_orderdate) AS DATE) AS hi FROM orders),
days AS (SELECT CAST(UNNEST(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM span)
SELECT date, CAST(date_trunc('month', date) AS DATE) AS month, CAST(year(date + INTERVAL 4 MONTH) AS INT) AS fiscal_year, CAST(quarter(date + INTERVAL 4 MONTH) AS INT) AS fiscal_quarter FROM days"""

    q["product_gross_sales"] = with_views(f"""SELECT s.date, s.product_code, p.product, p.variant, s.sold_quantity, CAST(g.gross_price AS DOUBLE) AS gross_price, CAST(ROUND(g.gross_price * s.sold_quantity, 2) AS DOUBLE) AS gross_price_total
FROM fact_sales_monthly s JOIN dim_product p ON p.product_code = s.product_code
JOIN fact_gross_price g ON g.product_code = s.product_code AND g.fiscal_year = {fyd}
WHERE s.customer_code = {CUSTOMER} AND {fyd} = {FY} ORDER BY s.date""", "fact_sales_monthly", "dim_product", "fact_gross_price")

    monthly = f"""SELECT s.date, CAST(SUM(ROUND(g.gross_price * s.sold_quantity, 2)) AS DOUBLE) AS monthly_sales
FROM fact_sales_monthly s JOIN fact_gross_price g ON g.product_code = s.product_code AND g.fiscal_year = {fyd}
WHERE {{cond}} GROUP BY s.date ORDER BY s.date"""
    q["monthly_gross_sales"] = with_views(monthly.format(cond=f"s.customer_code = {CUSTOMER}"),
                                          "fact_sales_monthly", "fact_gross_price")
    q["monthly_gross_sales_multi"] = with_views(
        monthly.format(cond=f"list_contains(string_split('{CUSTOMER_LIST}', ','), CAST(s.customer_code AS VARCHAR))"),
        "fact_sales_monthly", "fact_gross_price")
    q["yearly_gross_sales"] = with_views(f"""SELECT CAST({fyd} AS INT) AS financial_year, CAST(ROUND(SUM(s.sold_quantity * g.gross_price), 2) AS DOUBLE) AS total_gross_sales
FROM fact_sales_monthly s JOIN fact_gross_price g ON g.product_code = s.product_code AND g.fiscal_year = {fyd}
WHERE s.customer_code = {CUSTOMER} GROUP BY 1 ORDER BY 1""", "fact_sales_monthly", "fact_gross_price")

    q["waterfall_gross"] = with_views(
        f"SELECT {_line_cols(['gross_price_per_item', 'gross_price_total'])} FROM gross_sales", "gross_sales")
    q["net_invoice_sale_fy"] = with_views(f"""SELECT date, product_code, product, variant, sold_quantity, CAST(gross_price_per_item AS DOUBLE) AS gross_price, CAST(gross_price_total AS DOUBLE) AS gross_price_total, CAST(pre_invoice_discount_pct AS DOUBLE) AS pre_invoice_discount_pct, CAST(ROUND(gross_price_total - gross_price_total * pre_invoice_discount_pct, 2) AS DOUBLE) AS net_invoice_sale
FROM sales_preinv_discount WHERE fiscal_year = {FY}""", "sales_preinv_discount")
    q["waterfall_net_invoice"] = with_views(
        f"SELECT {_line_cols(['gross_price_per_item', 'gross_price_total', 'pre_invoice_discount_pct'])}, "
        "CAST(ROUND(gross_price_total - gross_price_total * pre_invoice_discount_pct, 2) AS DOUBLE) AS net_invoice_sale "
        "FROM sales_preinv_discount", "sales_preinv_discount")
    post_cols = ["gross_price_per_item", "gross_price_total", "pre_invoice_discount_pct", "net_invoice_sale",
                 "post_invoice_discount_pct"]
    q["waterfall_post_invoice"] = with_views(f"SELECT {_line_cols(post_cols)} FROM sales_postinv_discount",
                                             "sales_postinv_discount")
    q["waterfall_net_sales"] = with_views(f"SELECT {_line_cols(post_cols + ['net_sales'])} FROM net_sales",
                                          "net_sales")

    def by(dims):
        d = ", ".join(dims)
        return with_views(f"SELECT {d}, CAST({_mln('net_sales')} AS DOUBLE) AS net_sales_mln FROM net_sales "
                          f"WHERE fiscal_year = {FY} GROUP BY {d} ORDER BY net_sales_mln DESC", "net_sales")

    q["net_sales_by_customer"] = by(["customer"])
    q["net_sales_by_customer_region"] = by(["customer", "region"])

    def contrib(dims, within, alias):
        d = ", ".join(dims)
        over = f"PARTITION BY {', '.join(within)}" if within else ""
        return with_views(
            f"SELECT {d}, CAST(net_sales_mln AS DOUBLE) AS net_sales_mln, CAST(ROUND(CAST(net_sales_mln * 100.0 / "
            f"SUM(net_sales_mln) OVER ({over}) AS DECIMAL(38,10)), 2) AS DOUBLE) AS {alias} FROM agg",
            "net_sales", extra=[("agg", f"SELECT {d}, {_mln('net_sales')} AS net_sales_mln FROM net_sales "
                                        f"WHERE fiscal_year = {FY} GROUP BY {d}")])

    q["customer_contribution"] = contrib(["customer"], [], "pct_contribution")
    q["customer_contribution_region"] = contrib(["customer", "region"], ["region"], "pct_by_region")
    q["market_contribution"] = contrib(["market"], [], "pct_contribution")
    q["top_products"] = with_views(f"""SELECT product, CAST({_mln('net_sales')} AS DOUBLE) AS net_sales_mln FROM net_sales
WHERE fiscal_year = {FY} GROUP BY product ORDER BY net_sales_mln DESC, product ASC LIMIT 5""", "net_sales")
    q["top_markets_per_region"] = with_views(
        "SELECT market, region, CAST(gross_sales_mln AS DOUBLE) AS gross_sales_mln, CAST(rnk AS INT) AS rnk FROM ranked WHERE rnk <= 2",
        "gross_sales", extra=[
            ("agg", f"SELECT market, region, {_mln('gross_price_total')} AS gross_sales_mln FROM gross_sales "
                    f"WHERE fiscal_year = {FY} GROUP BY market, region"),
            ("ranked", "SELECT *, DENSE_RANK() OVER (PARTITION BY region ORDER BY gross_sales_mln DESC) AS rnk FROM agg")])
    q["top_products_per_division"] = with_views(
        "SELECT division, product, CAST(total_quantity AS BIGINT) AS total_quantity, CAST(drank AS INT) AS drank FROM ranked WHERE drank <= 3",
        "fact_sales_monthly", "dim_product", extra=[
            ("agg", f"SELECT p.division, p.product, SUM(s.sold_quantity) AS total_quantity FROM fact_sales_monthly s "
                    f"JOIN dim_product p ON s.product_code = p.product_code WHERE s.fiscal_year = {FY} GROUP BY p.division, p.product"),
            ("ranked", "SELECT *, DENSE_RANK() OVER (PARTITION BY division ORDER BY total_quantity DESC) AS drank FROM agg")])
    q["ranking_compare"] = with_views(
        "SELECT category, amount, expense_id, CAST(rn AS INT) AS rn, CAST(rnk AS INT) AS rnk, CAST(drank AS INT) AS drank FROM ranked WHERE rn <= 4",
        "expenses", extra=[("ranked", """SELECT *, ROW_NUMBER() OVER (PARTITION BY category ORDER BY amount DESC NULLS LAST, expense_id) AS rn,
RANK() OVER (PARTITION BY category ORDER BY amount DESC NULLS LAST) AS rnk,
DENSE_RANK() OVER (PARTITION BY category ORDER BY amount DESC NULLS LAST) AS drank FROM expenses""")])

    q["expense_ranks"] = with_views("""SELECT category, amount, expense_id, ROW_NUMBER() OVER (PARTITION BY category ORDER BY amount DESC NULLS LAST, expense_id) AS rn,
RANK() OVER (PARTITION BY category ORDER BY amount DESC NULLS LAST) AS rnk, DENSE_RANK() OVER (PARTITION BY category ORDER BY amount DESC NULLS LAST) AS drank FROM expenses""", "expenses")
    q["actual_est"] = with_views("SELECT date, fiscal_year, product_code, customer_code, sold_quantity, forecast_quantity FROM fact_actual_est",
                                 "fact_actual_est")

    def accuracy(zero: bool) -> str:
        s, f = ("COALESCE(sold_quantity, 0)", "COALESCE(forecast_quantity, 0)") if zero else ("sold_quantity", "forecast_quantity")
        err = f"({f} - {s})"
        e = (f"SELECT customer_code, SUM({s}) AS total_quantity, SUM({f}) AS total_forecast_quantity, SUM({err}) AS net_error, "
             f"ROUND(CAST(SUM({err}) * 100.0 / NULLIF(SUM({f}), 0) AS DECIMAL(38,10)), 1) AS net_error_pct, "
             f"SUM(ABS({err})) AS abs_error, ROUND(CAST(SUM(ABS({err})) * 100.0 / NULLIF(SUM({f}), 0) AS DECIMAL(38,10)), 2) AS abs_error_pct "
             f"FROM fact_actual_est WHERE fiscal_year = {FY} GROUP BY customer_code")
        return with_views(
            """SELECT e.customer_code, CAST(total_quantity AS BIGINT) AS total_quantity, CAST(total_forecast_quantity AS BIGINT) AS total_forecast_quantity,
CAST(net_error AS BIGINT) AS net_error, CAST(net_error_pct AS DOUBLE) AS net_error_pct, CAST(abs_error AS BIGINT) AS abs_error,
CAST(abs_error_pct AS DOUBLE) AS abs_error_pct, c.customer, c.market,
CAST(CASE WHEN abs_error_pct > 100 THEN 0 ELSE ROUND(100.0 - abs_error_pct, 2) END AS DOUBLE) AS forecast_accuracy
FROM e JOIN dim_customer c USING (customer_code) ORDER BY forecast_accuracy DESC""",
            "fact_actual_est", "dim_customer", extra=[("e", e)])

    q["forecast_accuracy"] = accuracy(False)
    q["forecast_accuracy_zero"] = accuracy(True)
    for name in ("forecast_accuracy", "monthly_gross_sales", "monthly_gross_sales_multi"):
        q[f"call_{name}"] = q[name]  # the procedures by name
    q["accuracy_decline"] = with_views(
        f"""SELECT a.customer_code, c.customer AS customer_name, c.market, CAST(a.acc AS DOUBLE) AS forecast_acc_{FY_PRIOR}, CAST(b.acc AS DOUBLE) AS forecast_acc_{FY}
FROM acc a JOIN acc b ON a.customer_code = b.customer_code AND a.fiscal_year = {FY_PRIOR} AND b.fiscal_year = {FY}
JOIN dim_customer c ON c.customer_code = a.customer_code WHERE b.acc < a.acc""",
        "fact_actual_est", "dim_customer", extra=[
            ("fa", f"SELECT customer_code, fiscal_year, ROUND(CAST(SUM(ABS(forecast_quantity - sold_quantity)) * 100.0 / "
                   f"NULLIF(SUM(forecast_quantity), 0) AS DECIMAL(38,10)), 2) AS pct FROM fact_actual_est "
                   f"WHERE fiscal_year IN ({FY_PRIOR}, {FY}) GROUP BY customer_code, fiscal_year"),
            ("acc", "SELECT customer_code, fiscal_year, CASE WHEN pct > 100 THEN 0 ELSE ROUND(100.0 - pct, 2) END AS acc FROM fa")])

    pl_cols = ["gross_sales", "pre_invoice_deduction", "net_invoice_sales", "post_invoice_deduction",
               "post_invoice_other_deduction", "net_sales", "manufacturing_cost", "freight_cost", "other_cost",
               "total_cogs", "gross_margin", "gross_margin_pct", "sold_quantity", "gm_per_unit", "ads_promotions",
               "other_operational_expense", "operational_expense", "net_profit", "net_profit_pct"]
    fm = "fiscal_year, market"
    s_fm = ("s", f"SELECT {fm}, {_sums()} FROM fact_actuals_estimates GROUP BY {fm}")
    q["pl_measures"] = with_views(f"SELECT {fm}, {_out(pl_cols)} FROM d", "fact_actuals_estimates",
                                  extra=[s_fm, ("d", f"SELECT *, {_derived()} FROM s")])
    ly_keys = ("k", "SELECT fiscal_year, market FROM s UNION SELECT fiscal_year + 1, market FROM s "
                    "WHERE fiscal_year + 1 IN (SELECT fiscal_year FROM s)")
    ly_join = ("j", "SELECT k.fiscal_year, k.market, " + ", ".join(f"s.{n}, p.{n} AS {n}_ly" for n, _ in _BASE)
               + " FROM k LEFT JOIN s ON s.market = k.market AND s.fiscal_year = k.fiscal_year "
                 "LEFT JOIN s p ON p.market = k.market AND p.fiscal_year + 1 = k.fiscal_year")
    ly_d = ("d", f"SELECT *, {_derived()}, {_derived('_ly')} FROM j")
    q["pl_last_year"] = with_views(
        f"SELECT {fm}, {_out(['net_sales', 'net_sales_ly'])}, gross_margin_pct, gross_margin_pct_ly, net_profit_pct, net_profit_pct_ly, "
        "CAST(net_sales_ly AS DOUBLE) AS net_sales_bm, gross_margin_pct_ly AS gross_margin_pct_bm, net_profit_pct_ly AS net_profit_pct_bm FROM d",
        "fact_actuals_estimates", extra=[s_fm, ly_keys, ly_join, ly_d])
    def full_join(keys, targets, renamed="s"):
        """All groups of sums and of targets, NULL keys matching NULL keys."""
        on = " AND ".join(f"tg.{k} IS NOT DISTINCT FROM {renamed}.{k}" for k in keys)
        merged = ", ".join(f"COALESCE({renamed}.{k}, tg.{k}) AS {k}" for k in keys)
        return (f"SELECT {merged}, {renamed}.* EXCLUDE ({', '.join(keys)}), tg.ns_target, tg.gm_target, tg.np_target "
                f"FROM {renamed} FULL JOIN {targets} tg ON {on}")

    q["pl_vs_target"] = with_views(
        f"""SELECT {fm}, {_out(['net_sales', 'ns_target', 'gm_target', 'np_target'])}, gross_margin_pct, {_div('gm_target', 'ns_target')} AS gross_margin_pct_target,
net_profit_pct, {_div('np_target', 'ns_target')} AS net_profit_pct_target, CAST(ns_target AS DOUBLE) AS net_sales_bm,
{_div('gm_target', 'ns_target')} AS gross_margin_pct_bm, {_div('np_target', 'ns_target')} AS net_profit_pct_bm FROM d""",
        "fact_actuals_estimates", "ns_gm_target",
        extra=[s_fm, ("j", full_join(["fiscal_year", "market"], "ns_gm_target")), ("d", f"SELECT *, {_derived()} FROM j")])
    q["gm_gap_flag"] = with_views(
        f"""SELECT {fm}, gross_margin_pct, gross_margin_pct_ly AS gross_margin_pct_bm, gross_margin_pct_ly - gross_margin_pct AS gross_margin_pct_variance,
CASE WHEN gross_margin_pct_ly - gross_margin_pct >= {GM_TOLERANCE} THEN 1 ELSE 0 END AS gross_margin_pct_flag FROM d""",
        "fact_actuals_estimates", extra=[s_fm, ly_keys, ly_join, ly_d])

    def fc_sums(dims, dim_join):
        d = ", ".join(dims)
        return [
            ("q", """SELECT f.date, f.fiscal_year, f.customer_code, f.product_code, f.forecast_quantity AS fq, CAST(NULL AS BIGINT) AS aq
FROM fact_forecast_monthly f WHERE f.date <= (SELECT MAX(date) FROM fact_sales_monthly)
UNION ALL SELECT date, fiscal_year, customer_code, product_code, CAST(NULL AS BIGINT), sold_quantity FROM fact_sales_monthly"""),
            ("qd", f"SELECT q.*, x.* EXCLUDE (k) FROM q JOIN {dim_join}"),
            ("cells", f"SELECT {d}, date, product_code, SUM(fq) AS fq, SUM(aq) AS aq FROM qd GROUP BY {d}, date, product_code"),
            ("g", f"""SELECT {d}, SUM(fq) AS forecast_qty, SUM(aq) AS actual_qty,
SUM(ABS(CASE WHEN fq IS NULL AND aq IS NULL THEN NULL ELSE COALESCE(fq, 0) - COALESCE(aq, 0) END)) AS abs_error FROM cells GROUP BY {d}"""),
        ]

    def fc_derive(src, x=""):
        ne = f"(CASE WHEN forecast_qty{x} IS NULL AND actual_qty{x} IS NULL THEN NULL ELSE COALESCE(forecast_qty{x}, 0) - COALESCE(actual_qty{x}, 0) END)"
        aep = _div(f"abs_error{x}", f"forecast_qty{x}")
        return (f"SELECT *, {ne} AS net_error{x}, {_div(ne, 'forecast_qty' + x)} AS net_error_pct{x}, {aep} AS abs_error_pct{x}, "
                f"CASE WHEN ({aep}) IS NOT NULL AND ({aep}) <> 0 THEN 1.0 - ({aep}) END AS forecast_accuracy_pct{x}, "
                f"CASE WHEN {ne} > 0 THEN 'EI' WHEN {ne} < 0 THEN 'OOS' END AS risk{x} FROM {src}")

    cust_join = "(SELECT customer_code AS k, customer FROM dim_customer) x ON x.k = q.customer_code"
    seg_join = "(SELECT product_code AS k, segment FROM dim_product) x ON x.k = q.product_code"
    fc_views = ("fact_sales_monthly", "fact_forecast_monthly", "dim_customer", "dim_product")
    q["sc_measures"] = with_views(
        """SELECT fiscal_year, customer, CAST(forecast_qty AS BIGINT) AS forecast_qty, CAST(actual_qty AS BIGINT) AS actual_qty,
CAST(net_error AS BIGINT) AS net_error, net_error_pct, CAST(abs_error AS BIGINT) AS abs_error, abs_error_pct, forecast_accuracy_pct, risk FROM m""",
        *fc_views, extra=fc_sums(["fiscal_year", "customer"], cust_join) + [("m", fc_derive("g"))])

    def fc_ly(dim):
        return [("k", f"SELECT fiscal_year, {dim} FROM g UNION SELECT fiscal_year + 1, {dim} FROM g "
                      "WHERE fiscal_year + 1 IN (SELECT fiscal_year FROM g)"),
                ("j", f"""SELECT k.fiscal_year, k.{dim}, g.forecast_qty, g.actual_qty, g.abs_error, p.forecast_qty AS forecast_qty_ly, p.actual_qty AS actual_qty_ly, p.abs_error AS abs_error_ly
FROM k LEFT JOIN g ON g.{dim} = k.{dim} AND g.fiscal_year = k.fiscal_year LEFT JOIN g p ON p.{dim} = k.{dim} AND p.fiscal_year + 1 = k.fiscal_year"""),
                ("m1", fc_derive("j")), ("m", fc_derive("m1", "_ly"))]

    q["sc_last_year"] = with_views(
        "SELECT fiscal_year, customer, CAST(abs_error AS BIGINT) AS abs_error, CAST(abs_error_ly AS BIGINT) AS abs_error_ly, forecast_accuracy_pct, forecast_accuracy_pct_ly FROM m",
        *fc_views, extra=fc_sums(["fiscal_year", "customer"], cust_join) + fc_ly("customer"))
    q["risk_flags"] = with_views(
        """SELECT fiscal_year, segment, CAST(forecast_qty AS BIGINT) AS forecast_qty, CAST(actual_qty AS BIGINT) AS actual_qty,
CAST(net_error AS BIGINT) AS net_error, forecast_accuracy_pct, forecast_accuracy_pct_ly, risk FROM m""",
        *fc_views, extra=fc_sums(["fiscal_year", "segment"], seg_join) + fc_ly("segment"))

    def moved(a, b, name):
        return f"CASE WHEN {a} > {b} THEN 'up' WHEN {a} < {b} THEN 'down' WHEN {a} = {b} THEN 'flat' END AS {name}"

    def sc_kpis(dim, join):
        return with_views(
            f"""SELECT fiscal_year, {dim}, forecast_accuracy_pct, forecast_accuracy_pct_ly, {moved('forecast_accuracy_pct', 'forecast_accuracy_pct_ly', 'accuracy_direction')},
CAST(net_error AS BIGINT) AS net_error, CAST(net_error_ly AS BIGINT) AS net_error_ly, {moved('net_error', 'net_error_ly', 'net_error_direction')},
CAST(abs_error AS BIGINT) AS abs_error, CAST(abs_error_ly AS BIGINT) AS abs_error_ly, {moved('abs_error', 'abs_error_ly', 'abs_error_direction')}, risk, risk_ly FROM m""",
            *fc_views, extra=fc_sums(["fiscal_year", dim], join) + fc_ly(dim))

    q["sc_kpis_customer"] = sc_kpis("customer", cust_join)
    q["sc_kpis_segment"] = sc_kpis("segment", seg_join)

    path = ["region", "market", "customer"]

    def drill_level(n):
        """One level on its own: cells of that level from the rows, then the sum of their errors."""
        own = "".join(f"{c}, " for c in path[:n])
        shown = ", ".join(path[:n] + [f"CAST(NULL AS VARCHAR) AS {c}" for c in path[n:]])
        halves = ", ".join(f"SUM(CASE WHEN fiscal_year = {y} THEN fq END) AS forecast_qty{x}, SUM(CASE WHEN fiscal_year = {y} THEN aq END) AS actual_qty{x}, "
                           f"SUM(CASE WHEN fiscal_year = {y} THEN ABS(CASE WHEN fq IS NULL AND aq IS NULL THEN NULL ELSE COALESCE(fq, 0) - COALESCE(aq, 0) END) END) AS abs_error{x}"
                           for y, x in ((FY, ""), (FY_PRIOR, "_ly")))
        grouped = f" GROUP BY {', '.join(path[:n])}" if n else ""
        return (f"SELECT {shown}, {2 ** (len(path) - n) - 1} AS level, {halves} FROM (SELECT {own}fiscal_year, date, product_code, SUM(fq) AS fq, SUM(aq) AS aq "
                f"FROM qd WHERE fiscal_year IN ({FY}, {FY_PRIOR}) GROUP BY {own}fiscal_year, date, product_code){grouped}")

    place_join = "(SELECT customer_code AS k, region, market, customer FROM dim_customer) x ON x.k = q.customer_code"
    q["sc_drill"] = with_views(
        """SELECT region, market, customer, CAST(level AS INT) AS level, CAST(forecast_qty AS BIGINT) AS forecast_qty, CAST(actual_qty AS BIGINT) AS actual_qty, CAST(net_error AS BIGINT) AS net_error,
net_error_pct, CAST(abs_error AS BIGINT) AS abs_error, abs_error_pct, forecast_accuracy_pct, risk, CAST(abs_error_ly AS BIGINT) AS abs_error_ly, forecast_accuracy_pct_ly FROM m""",
        *fc_views, extra=fc_sums(["region"], place_join)[:2] + [
            ("levels", " UNION ALL ".join(drill_level(n) for n in range(len(path), -1, -1))), ("m1", fc_derive("levels")), ("m", fc_derive("m1", "_ly"))])

    q["market_share"] = with_views(
        f"""SELECT fiscal_year, manufacturer, CAST(SUM(sales) AS DOUBLE) AS sales, CAST(SUM(total_market_sales) AS DOUBLE) AS total_market_sales,
{_div('SUM(sales)', 'SUM(total_market_sales)')} AS market_share FROM marketshare GROUP BY fiscal_year, manufacturer""", "marketshare")
    own = f"lower(manufacturer) = lower('{BRAND}')"
    q["own_market_share"] = with_views(
        f"SELECT fiscal_year, {_div(f'SUM(CASE WHEN {own} THEN sales END)', f'SUM(CASE WHEN {own} THEN total_market_sales END)')} "
        "AS own_market_share FROM marketshare GROUP BY fiscal_year", "marketshare")

    q["pl_rows"] = with_views(
        "SELECT l.fiscal_year, l.ord, COALESCE(r.description, 'Total') AS description, l.value FROM lines l LEFT JOIN pl_rows r ON r.ord = l.ord",
        "fact_actuals_estimates", "pl_rows", extra=[
            ("s", f"SELECT fiscal_year, {_sums()} FROM fact_actuals_estimates GROUP BY fiscal_year"),
            ("d", f"SELECT *, {_derived()} FROM s"), ("lines", _lines_sql("d", ["fiscal_year"], None))])

    def prior_sums(dims):
        d = "".join(f"{c}, " for c in dims)
        grp = f" GROUP BY {', '.join(dims)}" if dims else ""
        return ("s", f"SELECT {d}{_sums(f'fiscal_year = {FY}')}, {_sums(f'fiscal_year = {FY_PRIOR}', '_ly')} "
                     f"FROM fact_actuals_estimates WHERE fiscal_year IN ({FY}, {FY_PRIOR}){grp}")

    matrix_sel = ("SELECT {d}l.ord, COALESCE(r.description, 'Total') AS description, value, bm, value - bm AS chg, "
                  + _div("value - bm", "bm") + " AS chg_pct FROM lines l LEFT JOIN pl_rows r ON r.ord = l.ord")
    q["pl_matrix"] = with_views(matrix_sel.format(d=""), "fact_actuals_estimates", "pl_rows", extra=[
        prior_sums([]), ("d", f"SELECT *, {_derived()}, {_derived('_ly')} FROM s"),
        ("lines", _lines_sql("d", [], "ly"))])
    market_targets = f"(SELECT * FROM ns_gm_target WHERE fiscal_year = {FY})"
    q["pl_matrix_target"] = with_views(matrix_sel.format(d="market, "), "fact_actuals_estimates", "pl_rows", "ns_gm_target", extra=[
        prior_sums(["market"]), ("j", full_join(["market"], market_targets)),
        ("d", f"""SELECT *, {_derived()}, {_div('gm_target', 'ns_target')} AS gross_margin_pct_target,
{_div('np_target', 'ns_target')} AS net_profit_pct_target FROM j"""),
        ("lines", _lines_sql("d", ["market"], "target"))])

    lv = "region, market, product"
    q["pl_drill"] = with_views(
        f"SELECT {lv}, CAST(level AS INT) AS level, {_out(['net_sales', 'gross_margin'])}, gross_margin_pct, CAST(net_profit AS DOUBLE) AS net_profit, net_profit_pct FROM d",
        "fact_actuals_estimates", extra=[
            ("leaf", f"SELECT {lv}, {_sums()} FROM fact_actuals_estimates WHERE fiscal_year = {FY} GROUP BY {lv}"),
            ("r", f"SELECT {lv}, GROUPING(region, market, product) AS level, "
                  + ", ".join(f"SUM({n}) AS {n}" for n, _ in _BASE) + f" FROM leaf GROUP BY ROLLUP ({lv})"),
            ("d", f"SELECT *, {_derived()} FROM r")])

    fy_fact = ("f", f"SELECT * FROM fact_actuals_estimates WHERE fiscal_year = {FY}")
    def performance(dim):
        return with_views(
            f"""SELECT g.{dim}, CAST(g.net_sales AS DOUBLE) AS net_sales, CAST(g.gross_margin AS DOUBLE) AS gross_margin, g.gross_margin_pct,
o.gross_margin_pct AS overall_gross_margin_pct, g.gross_margin_pct - o.gross_margin_pct AS gm_pct_vs_overall FROM g, o""",
            "fact_actuals_estimates", extra=[
                fy_fact, ("gs", f"SELECT {dim}, {_sums()} FROM f GROUP BY {dim}"),
                ("g", f"SELECT *, {_derived()} FROM gs"), ("os", f"SELECT {_sums()} FROM f"),
                ("o", f"SELECT *, {_derived()} FROM os")])

    def scorecard(dim, target=False):
        none = "CAST(NULL AS DOUBLE)"
        np_bm = _div("np_target", "ns_target", none) if target else "net_profit_pct_ly"
        gm_bm = _div("gm_target", "ns_target", none) if target else "gross_margin_pct_ly"
        joined = [("j", full_join([dim], market_targets))] if target else []
        return with_views(
            f"""SELECT {dim}, CAST(net_sales AS DOUBLE) AS net_sales, net_profit_pct, {np_bm} AS net_profit_pct_bm, net_profit_pct - {np_bm} AS net_profit_pct_change,
gross_margin_pct, {gm_bm} AS gross_margin_pct_bm, gross_margin_pct - {gm_bm} AS gross_margin_pct_change,
CASE WHEN (net_sales IS NULL AND net_sales_ly IS NOT NULL) OR net_profit_pct - {np_bm} < 0 THEN 1 ELSE 0 END AS decline_flag
FROM d""",
            "fact_actuals_estimates", *(["ns_gm_target"] if target else []),
            extra=[prior_sums([dim]), *joined, ("d", f"SELECT *, {_derived()}, {_derived('_ly')} FROM {'j' if target else 's'}")])

    def split(dim):
        return with_views(
            f"SELECT {dim}, CAST(net_sales AS DOUBLE) AS net_sales, {_div('net_sales', 'total_net_sales')} AS share FROM g, o",
            "fact_actuals_estimates", extra=[
                fy_fact, ("g", f"SELECT {dim}, SUM(net_sales_amount) AS net_sales FROM f GROUP BY {dim}"),
                ("o", "SELECT SUM(net_sales_amount) AS total_net_sales FROM f")])

    q["performance_matrix"] = performance("customer")
    q["performance_matrix_product"] = performance("product")
    q["segment_scorecard"] = scorecard("segment")
    q["segment_scorecard_market"] = scorecard("market")
    q["segment_scorecard_market_target"] = scorecard("market", target=True)
    q["revenue_split"] = split("channel")
    q["revenue_split_division"] = split("division")
    region_targets = f"""(SELECT m.region, SUM(t.ns_target) AS ns_target, SUM(t.gm_target) AS gm_target, SUM(t.np_target) AS np_target
FROM ns_gm_target t LEFT JOIN (SELECT DISTINCT market, region FROM dim_customer) m ON m.market = t.market WHERE t.fiscal_year = {FY} GROUP BY m.region)"""
    q["region_scorecard"] = with_views(
        f"""SELECT region, CAST(net_sales AS DOUBLE) AS net_sales, CAST(net_sales_ly AS DOUBLE) AS net_sales_ly, CAST(ns_target AS DOUBLE) AS net_sales_target,
gross_margin_pct, gross_margin_pct_ly, {_div('gm_target', 'ns_target')} AS gross_margin_pct_target,
net_profit_pct, net_profit_pct_ly, {_div('np_target', 'ns_target')} AS net_profit_pct_target
FROM d""",
        "fact_actuals_estimates", "ns_gm_target", "dim_customer", extra=[
            prior_sums(["region"]), ("j", full_join(["region"], region_targets)),
            ("d", f"SELECT *, {_derived()}, {_derived('_ly')} FROM j")])
    q["region_scorecard_lattice"] = q["region_scorecard"]
    q["kpi_trend"] = with_views(
        "SELECT date, CAST(net_sales AS DOUBLE) AS net_sales, gross_margin_pct, net_profit_pct, CAST(sold_quantity AS BIGINT) AS sold_quantity FROM d ORDER BY date",
        "fact_actuals_estimates", extra=[
            ("s", f"SELECT date, {_sums()} FROM fact_actuals_estimates GROUP BY date"), ("d", f"SELECT *, {_derived()} FROM s")])
    trend_none = "CAST(NULL AS DOUBLE)"
    kpis = {"net_sales": ("CAST(s.net_sales AS DOUBLE)", "CAST(p.net_sales AS DOUBLE)"),
            "gross_margin_pct": ("s.gross_margin_pct", "p.gross_margin_pct"), "net_profit_pct": ("s.net_profit_pct", "p.net_profit_pct")}
    cols = ", ".join(f"{a} AS {n}, {b} AS {n}_ly, CAST({a if n != 'net_sales' else 's.net_sales'} - {b if n != 'net_sales' else 'p.net_sales'} AS DOUBLE) AS {n}_change, {moved(a, b, n + '_direction')}"
                     for n, (a, b) in kpis.items())
    ratios = _derived().replace("CAST(0 AS DOUBLE)", trend_none)
    q["kpi_trend_ly"] = with_views(
        f"SELECT k.date, {cols} FROM k LEFT JOIN d s ON s.date = k.date LEFT JOIN d p ON CAST(p.date + INTERVAL 12 MONTH AS DATE) = k.date ORDER BY k.date",
        "fact_actuals_estimates", extra=[
            ("b", f"SELECT date, {_sums()} FROM fact_actuals_estimates GROUP BY date"), ("d", f"SELECT *, {ratios} FROM b"),
            ("k", "SELECT date FROM b")])
    cm = "channel, market"
    series = ", ".join(f"{x} AS {n}{y}" for n in ("net_sales", "gross_margin_pct", "net_profit_pct", "sold_quantity") for y, x in (
        ("", f"CAST({n} AS {'BIGINT' if n == 'sold_quantity' else 'DOUBLE'})"), ("_ly", f"CAST({n}_ly AS {'BIGINT' if n == 'sold_quantity' else 'DOUBLE'})")))
    q["kpi_series_channel_market"] = with_views(
        f"SELECT {cm}, date, {series} FROM d", "fact_actuals_estimates", extra=[
            ("months", """SELECT CAST(UNNEST(generate_series(date_trunc('month', MIN(o_orderdate)), date_trunc('month', MAX(o_orderdate)), INTERVAL 1 MONTH)) AS DATE) AS date FROM orders"""),
            ("s", f"SELECT {cm}, date, {_sums()} FROM fact_actuals_estimates GROUP BY {cm}, date"),
            ("shown", f"SELECT {cm}, date FROM s UNION SELECT {cm}, CAST(date + INTERVAL 12 MONTH AS DATE) FROM s WHERE CAST(date + INTERVAL 12 MONTH AS DATE) IN (SELECT date FROM months)"),
            ("k", f"SELECT {cm}, m.date FROM (SELECT {cm}, MIN(date) AS lo, MAX(date) AS hi FROM shown GROUP BY {cm}) b JOIN months m ON m.date BETWEEN lo AND hi"),
            ("j", "SELECT k.channel, k.market, k.date, " + ", ".join(f"s.{n}, p.{n} AS {n}_ly" for n, _ in _BASE)
             + " FROM k LEFT JOIN s ON s.channel = k.channel AND s.market = k.market AND s.date = k.date "
               "LEFT JOIN s p ON p.channel = k.channel AND p.market = k.market AND CAST(p.date + INTERVAL 12 MONTH AS DATE) = k.date"),
            ("d", f"SELECT *, {ratios}, {_derived('_ly').replace('CAST(0 AS DOUBLE)', trend_none)} FROM j")])
    lv = "region, market"
    q["pl_drill_ly"] = with_views(
        f"""SELECT {lv}, CAST(level AS INT) AS level, {_out(['net_sales', 'net_sales_ly'])}, gross_margin_pct, gross_margin_pct_ly, net_profit_pct, net_profit_pct_ly,
CAST(net_sales_ly AS DOUBLE) AS net_sales_bm, gross_margin_pct_ly AS gross_margin_pct_bm, net_profit_pct_ly AS net_profit_pct_bm FROM d""",
        "fact_actuals_estimates", extra=[
            ("leaf", f"SELECT {lv}, {_sums(f'fiscal_year = {FY}')}, {_sums(f'fiscal_year = {FY_PRIOR}', '_ly')} FROM fact_actuals_estimates WHERE fiscal_year IN ({FY}, {FY_PRIOR}) GROUP BY {lv}"),
            ("r", f"SELECT {lv}, GROUPING({lv}) AS level, " + ", ".join(f"SUM({n}{x}) AS {n}{x}" for n, _ in _BASE for x in ("", "_ly")) + f" FROM leaf GROUP BY ROLLUP ({lv})"),
            ("d", f"SELECT *, {_derived()}, {_derived('_ly')} FROM r")])
    none = "CAST(NULL AS DOUBLE)"
    q["pl_drill_target"] = with_views(
        f"""SELECT {lv}, CAST(level AS INT) AS level, CAST(net_sales AS DOUBLE) AS net_sales, gross_margin_pct, net_profit_pct, CAST(ns_target AS DOUBLE) AS net_sales_bm,
{_div('gm_target', 'ns_target', none)} AS gross_margin_pct_bm, {_div('np_target', 'ns_target', none)} AS net_profit_pct_bm FROM d""",
        "fact_actuals_estimates", "ns_gm_target", "dim_customer", extra=[
            ("leaf", f"SELECT {lv}, {_sums()} FROM fact_actuals_estimates WHERE fiscal_year = {FY} GROUP BY {lv}"),
            ("targets", f"""SELECT m.region, t.market, t.ns_target, t.gm_target, t.np_target FROM ns_gm_target t
LEFT JOIN (SELECT DISTINCT market, region FROM dim_customer) m ON m.market = t.market WHERE t.fiscal_year = {FY}"""),
            ("both_", full_join(["region", "market"], "targets", "leaf")),
            ("r", f"SELECT {lv}, GROUPING({lv}) AS level, " + ", ".join(f"SUM({n}) AS {n}" for n in [n for n, _ in _BASE] + ["ns_target", "gm_target", "np_target"]) + f" FROM both_ GROUP BY ROLLUP ({lv})"),
            ("d", f"SELECT *, {_derived()} FROM r")])
    spelling = ("spelling", """SELECT lower(market) AS folded, MIN(CASE WHEN customer_code % 2 = 1 THEN lower(market) ELSE market END) AS spelled
FROM dim_customer GROUP BY lower(market)""")
    q["market_contribution_caseless"] = with_views(
        "SELECT spelled AS market, CAST(net_sales_mln AS DOUBLE) AS net_sales_mln, CAST(ROUND(CAST(net_sales_mln * 100.0 / "
        "SUM(net_sales_mln) OVER () AS DECIMAL(38,10)), 2) AS DOUBLE) AS pct_contribution FROM agg JOIN spelling USING (folded)",
        "net_sales", "dim_customer", extra=[spelling, (
            "agg", f"SELECT lower(market) AS folded, {_mln('net_sales')} AS net_sales_mln FROM net_sales WHERE fiscal_year = {FY} GROUP BY lower(market)")])
    q["top_markets_per_region_caseless"] = with_views(
        "SELECT spelled AS market, region, CAST(gross_sales_mln AS DOUBLE) AS gross_sales_mln, CAST(rnk AS INT) AS rnk "
        "FROM ranked JOIN spelling USING (folded) WHERE rnk <= 2",
        "gross_sales", "dim_customer", extra=[
            spelling,
            ("agg", f"SELECT lower(market) AS folded, region, {_mln('gross_price_total')} AS gross_sales_mln FROM gross_sales "
                    f"WHERE fiscal_year = {FY} GROUP BY lower(market), region"),
            ("ranked", "SELECT *, DENSE_RANK() OVER (PARTITION BY region ORDER BY gross_sales_mln DESC) AS rnk FROM agg")])

    lacks = {"product": "dim_product x WHERE x.product_code = s.product_code", "customer": "dim_customer x WHERE x.customer_code = s.customer_code",
             "price": "fact_gross_price x WHERE x.product_code = s.product_code AND x.fiscal_year = s.fiscal_year",
             "pre_invoice": "fact_pre_invoice_deductions x WHERE x.customer_code = s.customer_code AND x.fiscal_year = s.fiscal_year",
             "post_invoice": "fact_post_invoice_deductions x WHERE x.date = s.date AND x.product_code = s.product_code AND x.customer_code = s.customer_code"}
    flags = ", ".join(f"NOT EXISTS (SELECT 1 FROM {x}) AS no_{k}" for k, x in lacks.items())
    first = "CASE " + " ".join(f"WHEN no_{k} THEN '{k}'" for k in lacks) + " ELSE 'kept' END"
    coverage_views = ("fact_sales_monthly", "dim_product", "dim_customer", "fact_gross_price", "fact_pre_invoice_deductions", "fact_post_invoice_deductions")
    steps = " UNION ALL ".join(
        f"""SELECT fiscal_year, '{k}' AS step, COUNT(*) FILTER (WHERE step = '{k}') AS lines, CAST(COALESCE(SUM(sold_quantity) FILTER (WHERE step = '{k}'), 0) AS BIGINT) AS quantity,
CAST(COALESCE(SUM(sold_quantity) FILTER (WHERE step = '{k}'), 0) AS DOUBLE) / CAST(SUM(sold_quantity) AS DOUBLE) AS share_of_quantity,
COUNT(*) FILTER (WHERE {no}) AS lines_lacking, CAST(COALESCE(SUM(sold_quantity) FILTER (WHERE {no}), 0) AS BIGINT) AS quantity_lacking FROM lines GROUP BY fiscal_year"""
        for k, no in [("kept", "FALSE"), *((k, f"no_{k}") for k in lacks)])
    marked = [("m", f"SELECT s.*, {flags} FROM fact_sales_monthly s"), ("lines", f"SELECT *, {first} AS step FROM m")]
    q["sales_coverage"] = with_views(steps, *coverage_views, extra=marked)
    q["unpriced_sales"] = with_views(
        f"SELECT product_code, COUNT(*) AS lines, CAST(SUM(sold_quantity) AS BIGINT) AS sold_quantity FROM lines WHERE step = 'price' AND fiscal_year = {FY} GROUP BY product_code",
        *coverage_views, extra=marked)
    return q
