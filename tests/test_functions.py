import datetime as dt

from pyspark.sql import functions as F

from revlens.functions import (blank_sub, code_in_list, divide, equals_ci, fiscal_quarter, fiscal_year,
                               fiscal_year_bounds, fiscal_year_filter, parse_code_list, round_ratio, sql_div)


def test_fiscal_year_edges(spark):
    days = [dt.date(2020, 8, 31), dt.date(2020, 9, 1), dt.date(2020, 12, 31), dt.date(2021, 1, 1),
            dt.date(2020, 2, 29)]
    df = spark.createDataFrame([(d,) for d in days], "date date")
    got = {r.date: (r.fy, r.fq) for r in df.select("date", fiscal_year("date").alias("fy"),
                                                   fiscal_quarter("date").alias("fq")).collect()}
    assert got[dt.date(2020, 8, 31)] == (2020, 4)
    assert got[dt.date(2020, 9, 1)] == (2021, 1)
    assert got[dt.date(2020, 12, 31)] == (2021, 2)
    assert got[dt.date(2021, 1, 1)] == (2021, 2)
    assert got[dt.date(2020, 2, 29)] == (2020, 2)


def test_fiscal_year_other_start(spark):
    df = spark.createDataFrame([(dt.date(2020, 3, 31),), (dt.date(2020, 4, 1),)], "date date")
    got = [r[0] for r in df.select(fiscal_year("date", start_month=4)).orderBy("date").collect()]
    assert got == [2020, 2021]
    df = spark.createDataFrame([(dt.date(2020, 12, 31),), (dt.date(2021, 1, 1),)], "date date")
    assert [r[0] for r in df.select(fiscal_year("date", start_month=1)).collect()] == [2020, 2021]


def test_fiscal_year_filter_matches_function(spark):
    days = [dt.date(2019, 1, 1) + dt.timedelta(days=i) for i in range(0, 900, 7)]
    df = spark.createDataFrame([(d,) for d in days], "date date")
    a = {r.date for r in df.filter(fiscal_year("date") == 2020).collect()}
    b = {r.date for r in df.filter(fiscal_year_filter("date", 2020)).collect()}
    assert a == b and a
    assert fiscal_year_bounds(2020) == (dt.date(2019, 9, 1), dt.date(2020, 9, 1))


def test_fiscal_year_filter_is_pushed(spark, tmp_path):
    path = str(tmp_path / "d")
    spark.createDataFrame([(dt.date(2020, 1, 1),)], "date date").write.parquet(path)
    plan = spark.read.parquet(path).filter(fiscal_year_filter("date", 2020))._jdf.queryExecution() \
        .executedPlan().toString()
    assert "GreaterThanOrEqual(date" in plan and "LessThan(date" in plan


def test_code_list_exact_elements(spark):
    assert parse_code_list("7, 70") == ["7", " 70"]
    df = spark.createDataFrame([(7,), (70,), (77,)], "c bigint")

    def hits(codes):
        return sorted(r.c for r in df.filter(code_in_list("c", codes)).collect())

    assert hits("70,7") == [7, 70]
    assert hits("7, 70") == [7]          # ' 70' is not an element match
    assert hits("7") == [7]              # 7 is not in '70'
    assert hits([70, 77]) == [70, 77]
    assert hits(70) == [70]
    assert hits("") == []
    assert hits("07") == []              # text '07' never equals a code's text


def test_divide_and_blank_rules(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (1.0, None), (None, 2.0), (None, None)],
                               "a double, b double")
    rows = df.select(divide("a", "b", 0).alias("d"), blank_sub("a", "b").alias("s"),
                     sql_div("a", "b").alias("q")).collect()
    assert [r.d for r in rows] == [0.5, 0.0, 0.0, None, 0.0]
    assert [r.s for r in rows] == [-1.0, 1.0, 1.0, -2.0, None]
    assert [r.q for r in rows] == [0.5, None, None, None, None]


def test_round_half_away_on_decimals(spark):
    df = spark.createDataFrame([(1,)], "x int")
    r = df.select(round_ratio(F.lit(1.005).cast("decimal(10,3)"), 2).alias("a"),
                  round_ratio(F.lit(-1.005).cast("decimal(10,3)"), 2).alias("b")).first()
    assert float(r.a) == 1.01 and float(r.b) == -1.01


def test_equals_ci(spark):
    df = spark.createDataFrame([("Brand#1",), ("brand#1",), ("Brand#12",)], "m string")
    assert df.filter(equals_ci("m", "BRAND#1")).count() == 2


def test_code_list_edges_at_every_length(spark):
    from revlens.functions.sets import restrict_to_codes
    df = spark.createDataFrame([(0, "a"), (3, "b"), (7, "c"), (1500, "d")], "c bigint, v string").select("v", "c")
    odd = ["٣", "²", "-0", "9" * 30, "+7", " 7", "007", "", "-9223372036854775809"]
    for filler in (0, 1000, 1500):
        out = restrict_to_codes(df, "c", ",".join([*odd, "7", *map(str, range(10_000, 10_000 + filler))]))
        assert out.columns == ["v", "c"] and [r.c for r in out.collect()] == [7]
        by_column = restrict_to_codes(df, F.col("c"), ["7", *map(str, range(10_000, 10_000 + filler))])
        assert [r.v for r in by_column.collect()] == ["c"]
    assert restrict_to_codes(df, "c", ",".join(odd)).count() == 0
    assert restrict_to_codes(df, "c", "1500,9223372036854775807").count() == 1
