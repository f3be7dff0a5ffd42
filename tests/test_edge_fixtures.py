"""Reports and oracles over a changed fixture: a region without a name, targets of markets that sold nothing."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

import oracle_compare
from conftest import SF_SMALL, Tables
from oracle_compare import _DUCK_TYPES, duck, rows_of
from revlens import oracle
from revlens.operators.contribution import contribution
from revlens.operators.measures import measures_with_prior, with_targets
from revlens.operators.pl import pl_drill_target
from revlens.plans.joins import null_safe_join
from revlens.reports import QUERIES
from revlens.sources import star as star_module

oracle_compare.STRICT = True

#: (fiscal year, market, targets): no sales in the year, or a market without customers.
MORE_TARGETS = [(1997, "ATLANTIS", "100.00", "40.00", "5.00"), (2001, "FRANCE", "7.00", "3.00", "1.00")]
WITH_TARGETS = ["pl_vs_target", "pl_matrix_target", "segment_scorecard_market_target", "region_scorecard", "pl_drill_target"]
BY_REGION = ["net_sales_by_customer_region", "customer_contribution_region", "top_markets_per_region", "pl_drill", "pl_drill_ly", *WITH_TARGETS]


@pytest.fixture(scope="module")
def changed(spark, tmp_path_factory):
    """The source tables with one region's name missing."""
    folder = str(tmp_path_factory.mktemp("changed") / uuid.uuid4().hex)
    os.makedirs(folder)
    for name in os.listdir(SF_SMALL):
        if name != "region.parquet":
            os.symlink(f"{SF_SMALL}/{name}", f"{folder}/{name}")
    region = spark.read.parquet(f"{SF_SMALL}/region.parquet").toPandas()
    region.loc[region.r_regionkey == 2, "r_name"] = None
    region.to_parquet(f"{folder}/region.parquet")
    return folder


@pytest.fixture
def more_targets(spark, monkeypatch):
    """Both sides' targets with rows that no sale backs."""
    real = star_module._targets
    money = "decimal(24,2)"

    def targets(fact):
        rows = spark.createDataFrame(MORE_TARGETS, "fiscal_year int, market string, ns_target string, gm_target string, np_target string")
        return real(fact).unionByName(rows.select("fiscal_year", "market", *[F.col(c).cast(money).alias(c) for c in ("ns_target", "gm_target", "np_target")]))

    monkeypatch.setattr(star_module, "_targets", targets)
    more = "".join(f" UNION ALL SELECT {fy}, '{m}', CAST({a} AS DECIMAL(24,2)), CAST({b} AS DECIMAL(24,2)), CAST({c} AS DECIMAL(24,2))" for fy, m, a, b, c in MORE_TARGETS)
    monkeypatch.setitem(oracle.VIEWS, "ns_gm_target", oracle.VIEWS["ns_gm_target"] + more)


@pytest.mark.parametrize("name", BY_REGION)
def test_report_matches_its_oracle(spark, changed, more_targets, name):
    frame = QUERIES[name](spark, changed)
    con = duck(changed)
    sql = oracle.oracle_queries()[name]
    types = {r[0]: _DUCK_TYPES.get(r[1], r[1]) for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    assert {f.name: f.dataType.simpleString() for f in frame.schema.fields} == types
    result = con.execute(sql)
    got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    assert got == rows_of([d[0] for d in result.description], result.fetchall())
    if "region" in frame.columns:
        assert any(r["region"] is None for r in frame.collect())
    if name in WITH_TARGETS and "market" in frame.columns:
        assert any(r["market"] == "ATLANTIS" for r in frame.collect())


def test_shares_inside_a_group_without_a_name(spark):
    rows = [("a", "x", 10), ("b", "x", 30), ("c", None, 5), ("d", None, 15)]
    df = spark.createDataFrame(rows, "customer string, region string, amount int").withColumn("v", F.col("amount").cast("decimal(12,2)"))
    got = {r.customer: float(r.pct_contribution) for r in contribution(df, "v", within=["region"]).collect()}
    assert got == {"a": 25.0, "b": 75.0, "c": 25.0, "d": 75.0}
    got = {r.customer: float(r.pct_contribution) for r in contribution(df, "v").collect()}
    assert got == {"a": 16.67, "b": 50.0, "c": 8.33, "d": 25.0}


@pytest.mark.parametrize("how", ["inner", "left", "full_outer"])
@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_null_safe_join(spark, how, threshold):
    a = spark.createDataFrame([(1, None, "p"), (None, None, "q"), (2, "x", "r")], "k int, g string, l string")
    b = spark.createDataFrame([(1, None, 10), (None, None, 20), (3, "y", 30)], "k int, g string, r int")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        got = null_safe_join(a, b, ["k", "g"], how)
        assert got.columns == ["k", "g", "l", "r"]
        want = [(1, None, "p", 10), (None, None, "q", 20)]
        want += [(2, "x", "r", None)] * (how != "inner") + [(3, "y", None, 30)] * (how == "full_outer")
        assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_targets_without_sales_by_hand(spark):
    from test_lapsed import fact

    targets = spark.createDataFrame([(1997, "sold", 10, 4, 1), (1997, "idle", 20, 8, 2), (1996, "kept", 5, 2, 1)], "fiscal_year int, market string, ns_target int, gm_target int, np_target int")
    customers = spark.createDataFrame([("sold", "sold"), ("kept", None)], "market string, region string")
    t = Tables(ns_gm_target=targets.selectExpr("fiscal_year", "market", *[f"CAST({c} AS DECIMAL(24,2)) AS {c}" for c in ("ns_target", "gm_target", "np_target")]), dim_customer=customers)
    f = fact(spark, [(1997, "sold", 100), (1996, "kept", 50)])
    out = {r.market: r for r in with_targets(measures_with_prior(f, ["market"], 1997), t, ["market"], fiscal_year=1997).collect()}
    assert set(out) == {"sold", "idle", "kept"}
    assert out["idle"].net_sales is None and out["idle"].ns_target == 20 and out["idle"].gross_margin_pct == 0 and out["idle"].net_profit_pct_target == 0.1
    assert out["kept"].ns_target is None and out["kept"].net_sales_ly == 50
    blank = {r.market: r for r in with_targets(measures_with_prior(f, ["market"], 1997), t, ["market"], fiscal_year=1997, blank_actual=True).collect()}
    assert blank["idle"].gross_margin_pct is None
    drill = {(r.region, r.market, r.level): r for r in pl_drill_target(f, t, ["region", "market"], 1997).collect()}
    assert drill[None, "idle", 0].net_sales_bm == 20 and drill[None, None, 3].net_sales_bm == 30
