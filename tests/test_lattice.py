"""Pages answered from stored sums equal those answered from the fact."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from revlens.operators import pages, pl
from revlens.plans.inspect import scans
from revlens.sources.lattice import AMOUNTS, Lattice, set_name
from revlens.sources.star import Star


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("l"))
    Star.build(spark, SF_SMALL, f"{path}/s")
    t = Star.read(spark, f"{path}/s")
    return t, Lattice.build(spark, t.fact_actuals_estimates, f"{path}/x"), f"{path}/x"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


PAGES = {
    "matrix": (["segment"], lambda f, t: pages.performance_matrix(f, ["segment"], 1997)),
    "scorecard": (["market"], lambda f, t: pages.segment_scorecard(f, ["market"], 1997, "target", t)),
    "region": (["region"], lambda f, t: pages.region_scorecard(f, t, 1997)),
    "split": (["division"], lambda f, t: pages.revenue_split(f, ["division"], 1997)),
    "trend": (["date"], lambda f, t: pages.kpi_trend(f)),
    "series": (["market", "date"], lambda f, t: pages.kpi_series(f, ["market"], t.dim_date)),
    "drill": (["region", "market"], lambda f, t: pl.pl_drill(f, ["region", "market"], 1997)),
    "statement": (["region", "channel"], lambda f, t: pl.pl_statement(f, t, 1997, ["region", "channel"])),
}


@pytest.mark.parametrize("page", sorted(PAGES))
def test_pages_are_equal_both_ways(stored, page):
    t, lattice, path = stored
    dims, ask = PAGES[page]
    chosen = lattice.choose(dims)
    assert chosen is not None and set(dims) <= chosen
    small = lattice.fact_for(dims)
    assert rows(ask(small, t)) == rows(ask(t.fact_actuals_estimates, t))
    assert small.count() < t.fact_actuals_estimates.count()


def test_the_smallest_table_that_holds_the_dims(stored):
    t, lattice, path = stored
    assert lattice.choose(["segment"]) == {"segment"} and lattice.choose(["segment", "fiscal_year"]) == {"segment"}
    assert lattice.choose(["division"]) == {"segment", "division"}
    assert lattice.choose(["market"]) == {"region", "market"} and lattice.choose(["market", "date"]) == {"region", "market", "date"}
    assert lattice.choose([]) == min(lattice.sizes, key=lattice.sizes.get)
    assert lattice.choose(["customer"]) is None and lattice.fact_for(["customer"]) is t.fact_actuals_estimates
    assert lattice.sizes[frozenset({"segment"})] == t.fact_actuals_estimates.select("segment", "fiscal_year").distinct().count()


def test_sums_that_cannot_be_summed_again_are_refused(stored):
    lattice = stored[1]
    assert lattice.choose(["market"], ["net_sales", "gross_margin_pct"]) is not None
    for measure in ("abs_error", "forecast_accuracy_pct", "customers"):
        with pytest.raises(ValueError):
            lattice.fact_for(["market"], ["net_sales", measure])


def test_reading_a_stored_lattice(spark, stored, tmp_path):
    t, lattice, path = stored
    again = Lattice.read(spark, path, t.fact_actuals_estimates)
    assert again.sizes == lattice.sizes
    scan = scans(pages.revenue_split(again.fact_for(["segment"]), ["segment"], 1997))[0]
    assert set_name(["segment"]) in scan or "segment" in scan
    assert "= 1997)" in scan.split("PartitionFilters:")[1] and "freight_cost" not in scan.split("ReadSchema")[1]
    none = Lattice.read(spark, str(tmp_path / "nothing"), t.fact_actuals_estimates)
    assert none.choose(["segment"]) is None
    with pytest.raises(ValueError):
        Lattice.build(spark, t.fact_actuals_estimates, str(tmp_path / "y"), [("colour",)])


def test_each_table_comes_from_the_smallest_that_contains_it(spark, stored, monkeypatch, tmp_path):
    t = stored[0]
    asked = []
    real = Lattice.choose
    monkeypatch.setattr(Lattice, "choose", lambda self, dims, measures=(): asked.append((frozenset(dims), real(self, dims, measures))) or asked[-1][1])
    Lattice.build(spark, t.fact_actuals_estimates, str(tmp_path / "z"), [("region",), ("region", "market"), ("region", "market", "date")])
    assert asked == [(frozenset({"region", "market", "date"}), None), (frozenset({"region", "market"}), frozenset({"region", "market", "date"})),
                     (frozenset({"region"}), frozenset({"region", "market"}))]
    assert sorted(os.listdir(tmp_path / "z")) == ["_sizes", "by_date_market_region", "by_market_region", "by_region"]
    total = t.fact_actuals_estimates.agg(*[F.sum(c) for c in AMOUNTS]).first()
    for name in ("by_region", "by_date_market_region"):
        assert spark.read.parquet(str(tmp_path / "z" / name)).agg(*[F.sum(c) for c in AMOUNTS]).first() == total
