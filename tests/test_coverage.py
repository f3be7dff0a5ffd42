"""Lost and kept sales lines add up to all lines, whatever a line lacks."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import Tables
from revlens.operators.coverage import KEPT, STEPS, coverage_report, lost_lines
from revlens.operators.waterfall import net_sales
from revlens.plans.inspect import physical_plan, scans
from revlens.sources.star import Star

DAY = dt.date(1996, 9, 1)


@pytest.fixture(scope="module")
def small(spark):
    """Product 1 has all rows; 2 no price; 3 is unknown; customer 9 is unknown and without deductions."""
    lines = [(DAY, 1, 7, 10), (DAY, 2, 7, 20), (DAY, 3, 7, 30), (DAY, 1, 8, 40), (DAY, 1, 9, 50), (DAY, 3, 9, 60), (DAY, None, 7, 70), (DAY, 1, 7, None)]
    sales = spark.createDataFrame([(*x, 1997) for x in lines] + [(dt.date(1997, 9, 1), 1, 7, 5, 1998)],
                                  "date date, product_code bigint, customer_code bigint, sold_quantity bigint, fiscal_year int")
    price = spark.createDataFrame([(1, Decimal("1.5"), 1997), (1, Decimal("1.5"), 1997), (3, Decimal("2"), 1997)], "product_code bigint, gross_price decimal(15,4), fiscal_year int")
    pre = spark.createDataFrame([(7, Decimal("0.1"), 1997), (8, Decimal("0.1"), 1997), (7, Decimal("0.1"), 1998)], "customer_code bigint, pre_invoice_discount_pct decimal(5,4), fiscal_year int")
    post = spark.createDataFrame([(DAY, 1, 7), (DAY, 2, 7), (DAY, 3, 7), (DAY, 3, 9)], "date date, product_code bigint, customer_code bigint")
    post = post.withColumns({"discounts_pct": F.lit(Decimal("0.1")).cast("decimal(5,4)"), "other_deductions_pct": F.lit(Decimal("0.1")).cast("decimal(5,4)")})
    return Tables(fact_sales_monthly=sales, fact_gross_price=price, fact_pre_invoice_deductions=pre, fact_post_invoice_deductions=post,
                  dim_product=spark.createDataFrame([(1,), (2,)], "product_code bigint"), dim_customer=spark.createDataFrame([(7,), (8,)], "customer_code bigint"))


def test_by_hand(small):
    got = {(r.fiscal_year, r.step): (r.lines, r.quantity, r.lines_lacking, r.quantity_lacking) for r in coverage_report(small).collect()}
    assert got[1997, KEPT] == (2, 10, 0, 0)
    assert got[1997, "product"] == (3, 160, 3, 160)
    assert got[1997, "customer"] == (1, 50, 2, 110)
    assert got[1997, "price"] == (1, 20, 2, 90)
    assert got[1997, "pre_invoice"] == (0, 0, 2, 110)
    assert got[1997, "post_invoice"] == (1, 40, 3, 160)
    assert got[1998, "price"] == (1, 5, 1, 5) and got[1998, KEPT] == (0, 0, 0, 0)
    assert len(got) == 12
    assert {(r.product_code, r.customer_code, r.step) for r in lost_lines(small, 1997).collect()} == {
        (2, 7, "price"), (3, 7, "product"), (1, 8, "post_invoice"), (1, 9, "customer"), (3, 9, "product"), (None, 7, "product")}
    with pytest.raises(ValueError):
        lost_lines(small, step="tax")


def test_kept_lines_are_those_of_the_waterfall(star):
    got = coverage_report(star).collect()
    kept = {r.fiscal_year: (r.n, r.q) for r in net_sales(star).groupBy("fiscal_year").agg(F.count("*").alias("n"), F.sum("sold_quantity").alias("q")).collect()}
    assert {r.fiscal_year: (r.lines, r.quantity) for r in got if r.step == KEPT} == kept
    every = {r.fiscal_year: (r.n, r.q) for r in star.fact_sales_monthly.groupBy("fiscal_year").agg(F.count("*").alias("n"), F.sum("sold_quantity").alias("q")).collect()}
    for year, (n, q) in every.items():
        own = [r for r in got if r.fiscal_year == year]
        assert {r.step for r in own} == {KEPT, *STEPS}
        assert (sum(r.lines for r in own), sum(r.quantity for r in own)) == (n, q)
        assert sum(r.share_of_quantity for r in own) == pytest.approx(1)
    assert lost_lines(star, 1997).count() == sum(r.lines for r in got if r.fiscal_year == 1997 and r.step != KEPT)


def test_one_year_reads_one_year_and_the_sales_once(spark, tmp_path):
    path = str(tmp_path / "s")
    Star.build(spark, "/root/testdata/sf0.001", path)
    plan = coverage_report(Star.read(spark, path), 1997)
    facts = [s for s in scans(plan) if "PartitionFilters: [isnotnull(fiscal_year" in s]
    assert len(facts) == 4 and all("= 1997)" in s for s in facts)
    assert sum("sold_quantity" in s for s in scans(plan)) == 1
    assert "Cartesian" not in physical_plan(plan) and "NestedLoop" not in physical_plan(plan)
