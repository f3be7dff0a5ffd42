"""Reports parameterised by fiscal year, checked for other years than the default,
including FY1995 (partial, no prior year) and FY2001 (the last year)."""

import pytest

import oracle_compare
from oracle_compare import duck, rows_of
from revlens.oracle import oracle_queries
from revlens.operators import contribution as C
from revlens.operators import forecast as FC
from revlens.operators import pages as PG
from revlens.operators import pl as PL
from revlens.operators.output import decimals_to_double

SF = "/root/testdata/sf0.001"
oracle_compare.STRICT = True  # exact doubles, no rounding

CASES = {
    "forecast_accuracy": lambda t, fy: FC.forecast_accuracy(t, fy),
    "accuracy_decline": lambda t, fy: FC.accuracy_decline(t, fy - 1, fy),
    "net_sales_by_customer": lambda t, fy: decimals_to_double(C.net_sales_by(t, ["customer"], fy)),
    "pl_matrix": lambda t, fy: PL.pl_statement(t.fact_actuals_estimates, t, fy, benchmark="ly"),
    "pl_matrix_target": lambda t, fy: PL.pl_statement(t.fact_actuals_estimates, t, fy, dims=["market"],
                                                      benchmark="target"),
    "segment_scorecard": lambda t, fy: PG.segment_scorecard(t.fact_actuals_estimates, ["segment"], fy),
    "region_scorecard": lambda t, fy: PG.region_scorecard(t.fact_actuals_estimates, t, fy),
}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def _sql_for(name: str, fy: int) -> str:
    # the oracle strings use 1997 as the year and 1996 as the prior year only
    # (the fixture view of targets starts at FY1996 by definition: keep it)
    sql = oracle_queries()[name].replace("fiscal_year >= 1996", "__FIXTURE__")
    sql = sql.replace("1996", "__PRIOR__").replace("1997", str(fy)).replace("__PRIOR__", str(fy - 1))
    return sql.replace("__FIXTURE__", "fiscal_year >= 1996")


@pytest.mark.parametrize("fy", [1995, 1996, 2001])
@pytest.mark.parametrize("name", sorted(CASES))
def test_other_fiscal_years(star, con, name, fy):
    df = CASES[name](star, fy)
    res = con.execute(_sql_for(name, fy))
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    srows = [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(dcols)
    assert rows_of(df.columns, srows) == rows_of(dcols, drows)
