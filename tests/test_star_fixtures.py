"""Each star table derived with the DataFrame API equals its FIXTURES.md view in DuckDB."""

import pytest

from oracle_compare import duck, rows_of
from revlens.oracle import with_views
from revlens.sources.star import COLUMNS, TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", [n for n in TABLES if n != "dim_date"])
def test_table_equals_fixture_view(star, con, name):
    cols = [c for c, _ in COLUMNS[name]]
    sdf = getattr(star, name).select(*cols)
    res = con.execute(with_views(f"SELECT {', '.join(cols)} FROM {name}", name))
    duck_rows = res.fetchall()
    spark_rows = [tuple(r) for r in sdf.collect()]
    assert len(spark_rows) == len(duck_rows)
    assert rows_of(cols, spark_rows) == rows_of(cols, duck_rows)
