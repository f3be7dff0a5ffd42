"""Text compared without case: groups, joins, ranks, targets and shares; what the plans show."""

import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, Tables
from revlens.functions.text import caseless, one_spelling, plain
from revlens.operators.contribution import contribution, net_sales_by
from revlens.operators.market import market_share, own_market_share
from revlens.operators.measures import measures, targets_at, with_targets
from revlens.operators.ranking import top_k_per_group
from revlens.plans.inspect import physical_plan, scans
from revlens.sources.star import Star


@pytest.fixture(scope="module")
def mixed(spark):
    """A star whose India customers are spelled in three ways, and its caseless form."""
    t = Star.from_source(spark, SF_SMALL)
    spell = F.when(F.col("market") == "INDIA", F.element_at(F.array(F.lit("India"), F.lit("INDIA"), F.lit("india")), (F.col("customer_code") % 3 + 1).cast("int")))
    t.dim_customer = t.dim_customer.withColumn("market", F.coalesce(spell, F.when(F.col("customer_code") % 2 == 0, F.initcap("market")), "market"))
    return t, t.caseless()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_groups_are_one_whatever_their_case(spark, star, mixed):
    split, folded = (net_sales_by(t, ["market"], 1997) for t in mixed)
    want = net_sales_by(star, ["market"], 1997)
    assert split.count() > want.count()
    got = plain(folded)
    assert dict(got.dtypes)["market"] == "string"
    assert rows(got.withColumn("market", F.upper("market"))) == rows(want.withColumn("market", F.upper("market")))
    spelled = {r.market for r in got.collect()}
    assert spelled <= {r.market for r in mixed[0].dim_customer.select("market").distinct().collect()}
    assert rows(got) == rows(plain(net_sales_by(mixed[0].caseless(), ["market"], 1997)))  # the same spelling every time
    shares = contribution(folded, "net_sales_mln", within=["market"]).collect()
    assert all(r.pct_contribution is None or float(r.pct_contribution) == 100 for r in shares)


def test_filters_joins_and_ranks(spark, mixed):
    t = mixed[1]
    assert t.dim_customer.where("market = 'iNdIa'").count() == mixed[0].dim_customer.where("lower(market) = 'india'").count()
    rows_ = [("a", "X", 3), ("b", "x", 2), ("c", "x", 1), ("d", None, 5)]
    df = caseless(spark.createDataFrame(rows_, "k string, g string, v int"), ["g"])
    got = {r.k: r.rnk for r in top_k_per_group(df, ["g"], "v", 2).collect()}
    assert got == {"a": 1, "b": 2, "d": 1}
    other = caseless(spark.createDataFrame([("x", 1), ("Y", 2)], "g string, w int"))
    assert df.join(other, "g").count() == 3


def test_targets_and_shares(spark):
    from test_lapsed import fact

    f = caseless(fact(spark, [(1997, "India", 100), (1997, "INDIA", 50), (1997, "France", 10)]))
    targets = spark.createDataFrame([(1997, "india", 10, 4, 1), (1997, "FRANCE", 20, 8, 2)], "fiscal_year int, market string, ns_target int, gm_target int, np_target int")
    t = Tables(ns_gm_target=caseless(targets.selectExpr("fiscal_year", "market", *[f"CAST({c} AS DECIMAL(24,2)) AS {c}" for c in ("ns_target", "gm_target", "np_target")])))
    assert targets_at(t, ["market"], 1997).count() == 2
    out = {r.market.lower(): r for r in plain(with_targets(measures(f, ["fiscal_year", "market"]), t, ["fiscal_year", "market"])).collect()}
    assert set(out) == {"india", "france"} and (out["india"].net_sales, out["india"].ns_target) == (150, 10)
    share = caseless(spark.createDataFrame([(1997, "c", "Brand#1", 3, 10), (1997, "c", "BRAND#1", 2, 10)], "fiscal_year int, category string, manufacturer string, sales int, total_market_sales int"))
    share = share.withColumns({c: F.col(c).cast("decimal(25,2)") for c in ("sales", "total_market_sales")})
    assert market_share(share, ["manufacturer"]).count() == 1
    assert own_market_share(share, ["fiscal_year"], "brand#1").first().own_market_share == 0.25


def test_one_spelling(spark):
    df = spark.createDataFrame([("b", "Xy"), ("B", "xY"), (None, "xy"), ("c", None), ("ß", "É"), ("ß", "é")], "p string, q string")
    got = rows(one_spelling(df))
    assert got == sorted([("B", "Xy"), ("B", "Xy"), (None, "Xy"), ("c", None), ("ß", "É"), ("ß", "É")], key=str)


def test_what_a_collation_does_to_plans(spark, tmp_path):
    """The note in functions.text: no pushed filter, sort aggregates; by codes both stay as they were."""
    path = str(tmp_path / uuid.uuid4().hex)
    spark.createDataFrame([(1, "India")], "code int, market string").write.parquet(path)
    df = spark.read.parquet(path)
    assert "EqualTo(market,India)" in scans(df.where("market = 'India'"))[0]
    folded = caseless(df)
    assert "EqualTo(market" not in scans(folded.where("market = 'india'"))[0].split("PushedFilters")[1]
    assert "SortAggregate" in physical_plan(folded.groupBy("market").count())
    by_code = folded.where("code = 1").groupBy("code").count()
    assert "EqualTo(code,1)" in scans(by_code)[0] and "SortAggregate" not in physical_plan(by_code)


def test_lines_are_summed_by_codes_before_a_collated_group(spark, mixed):
    plan = physical_plan(net_sales_by(mixed[1], ["market"], 1997))
    assert "keys=[customer_code" in plan
