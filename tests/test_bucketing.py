"""Same-grain facts saved bucketed alike are joined without a shuffle."""

import uuid

from revlens.operators.forecast import actual_vs_forecast
from revlens.operators.waterfall import net_sales
from revlens.plans.inspect import physical_plan
from revlens.sources.star import Star


def test_bucketed_fact_joins_need_no_exchange(spark, star, tmp_path):
    db = f"revlens_{uuid.uuid4().hex[:8]}"
    star.save_tables(spark, db, buckets=4, location=str(tmp_path / db))
    t = Star.from_catalog(spark, db)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        joined = actual_vs_forecast(t.fact_sales_monthly, t.fact_forecast_monthly)
        plan = physical_plan(joined)
        assert "SortMergeJoin" in plan and "Exchange" not in plan, plan
        s = t.fact_sales_monthly.join(t.fact_post_invoice_deductions, ["date", "product_code", "customer_code"])
        plan = physical_plan(s)
        assert "SortMergeJoin" in plan and "Exchange" not in plan, plan
        assert joined.count() == actual_vs_forecast(star.fact_sales_monthly, star.fact_forecast_monthly).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert net_sales(t, 1997).count() == net_sales(star, 1997).count()
