"""Plan properties of every report: no Python UDFs, no raw rows funnelled into
one partition, fiscal-year predicates reaching the scans."""

import pytest

from revlens.reports import QUERIES
from revlens.plans.inspect import physical_plan, python_nodes, scans, unaggregated_single_partition

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_is_jvm_only_and_parallel(spark, name):
    df = QUERIES[name](spark, SF)
    assert python_nodes(df) == []
    assert unaggregated_single_partition(df) == []


def test_fiscal_year_prunes_stored_partitions(spark, tmp_path):
    from revlens.sources.star import Star
    path = str(tmp_path / "star")
    Star.build(spark, SF, path)
    df = QUERIES["net_sales_by_customer"](spark, path)
    sales_scan = [s for s in scans(df) if "sold_quantity:bigint" in s]
    assert sales_scan and "= 1997)" in sales_scan[0].split("PartitionFilters:")[1].split("]")[0]
    post_scan = [s for s in scans(df) if "discounts_pct" in s]
    assert post_scan and "= 1997)" in post_scan[0].split("PartitionFilters:")[1].split("]")[0]


def test_group_limit_before_shuffle(spark):
    df = QUERIES["top_markets_per_region"](spark, SF)
    assert "WindowGroupLimit" in physical_plan(df)
    df = QUERIES["ranking_compare"](spark, SF)
    assert "WindowGroupLimit" in physical_plan(df)


def test_top_n_without_full_sort(spark):
    assert "TakeOrderedAndProject" in physical_plan(QUERIES["top_products"](spark, SF))


def test_customer_list_pushed_to_scan(spark):
    df = QUERIES["monthly_gross_sales_multi"](spark, SF)
    assert any("In(o_custkey, [7,8,9])" in s for s in scans(df)), scans(df)


FY_REPORTS = ["product_gross_sales", "net_invoice_sale_fy", "net_sales_by_customer", "net_sales_by_customer_region",
              "customer_contribution", "customer_contribution_region", "market_contribution", "top_products",
              "top_markets_per_region", "top_products_per_division", "forecast_accuracy", "forecast_accuracy_zero",
              "accuracy_decline", "pl_matrix", "pl_matrix_target", "pl_drill", "performance_matrix",
              "segment_scorecard", "revenue_split", "region_scorecard", "performance_matrix_product",
              "segment_scorecard_market", "revenue_split_division"]
FY_TABLES = ("fact_sales_monthly", "fact_post_invoice_deductions", "fact_forecast_monthly", "fact_gross_price", "fact_pre_invoice_deductions",
             "fact_actuals_estimates", "marketshare", "ns_gm_target")


@pytest.fixture(scope="module")
def stored_star(spark):
    import shutil
    import tempfile

    from revlens.sources.star import Star
    path = tempfile.mkdtemp(prefix="rl", dir="/tmp")  # short path: scan locations print untruncated
    Star.build(spark, SF, path + "/s")
    yield path + "/s"
    shutil.rmtree(path, ignore_errors=True)


@pytest.mark.parametrize("name", FY_REPORTS)
def test_fiscal_year_reports_prune_every_partitioned_scan(spark, stored_star, name):
    df = QUERIES[name](spark, stored_star)
    checked = 0
    for scan in scans(df):
        table = next((t for t in FY_TABLES if f"/{t}]" in scan), None)
        if table is None:
            continue
        checked += 1
        filters = scan.split("PartitionFilters: [")[1].split("]")[0]
        assert "fiscal_year" in filters, f"{table} not pruned: {scan[:300]}"
    assert checked > 0


@pytest.mark.parametrize("name,most", [("net_sales_by_customer", 9), ("net_sales_by_customer_region", 9), ("customer_contribution", 18)])
def test_hash_exchanges_without_broadcasts(spark, stored_star, name, most):
    """Lines of one year move by product and by customer, never by year; sums by customer stay where the lines are."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        plan = physical_plan(QUERIES[name](spark, stored_star))
        assert plan.count("Exchange hashpartitioning") <= most, plan
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
