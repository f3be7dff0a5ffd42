from pyspark.sql import functions as F

from revlens.operators.finance import monthly_gross_sales, product_gross_sales
from revlens.operators.waterfall import gross_sales, net_sales


def test_waterfall_identities(star):
    fact = star.fact_actuals_estimates
    bad = fact.filter(
        (F.col("gross_sales_amount") - F.col("pre_invoice_deduction") != F.col("net_invoice_sales_amount"))
        | (F.col("net_invoice_sales_amount") - F.col("post_invoice_deduction")
           - F.col("post_invoice_other_deduction") != F.col("net_sales_amount")))
    assert bad.count() == 0
    assert fact.count() == net_sales(star).count()


def test_inner_joins_drop_unpriced_sales(star):
    sales = star.fact_sales_monthly
    priced = gross_sales(star)
    unpriced = sales.join(star.fact_gross_price, ["product_code", "fiscal_year"], "left_anti").count()
    assert unpriced > 0 and priced.count() == sales.count() - unpriced


def test_total_net_sales_is_grouping_invariant(star):
    ns = net_sales(star, 1997)
    total = ns.agg(F.sum("net_sales")).first()[0]
    for dims in (["customer"], ["market"], ["product", "region"]):
        assert ns.groupBy(*dims).agg(F.sum("net_sales").alias("s")).agg(F.sum("s")).first()[0] == total


def test_monthly_sum_equals_line_totals(star):
    lines = product_gross_sales(star, 7, 1997)
    months = {r.date: r.monthly_sales for r in monthly_gross_sales(star, 7).collect()}
    for d, total in lines.groupBy("date").agg(F.sum("gross_price_total").alias("t")).collect():
        assert abs(months[d] - total) < 1e-6
