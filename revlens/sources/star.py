"""The sales / forecast star schema the reports run on.

``Star`` hands out a DataFrame per dimension, fact and support table. Tables
are opened lazily, on first use, so a report touching three tables never
lists or inspects the other ten. A star is derived from the driver's
TPC-H-like tables (``from_source``), read from a stored copy with fixed
schemas (``read``), or derived and stored in one go (``build``), with the
facts partitioned by ``fiscal_year`` so that fiscal-year filters prune files.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revlens.functions.arith import money
from revlens.functions.fiscal import FY_START_MONTH, fiscal_year, fiscal_year_bounds
from revlens.functions.text import caseless, one_spelling
from revlens.plans.joins import attach_row
from revlens.sources.raw import path_exists, read_table, remove_path

from revlens.fixed_values import PL_ROWS  # noqa: E402  (re-exported)

_MONEY_COLS = ("gross_sales_amount", "pre_invoice_deduction", "net_invoice_sales_amount",
               "post_invoice_deduction", "post_invoice_other_deduction", "net_sales_amount",
               "manufacturing_cost", "freight_cost", "other_cost", "ads_promotions",
               "other_operational_expense")

# Columns of the stored tables (partition column fiscal_year included), so a
# read needs no schema inference.
_K = [("date", "date"), ("product_code", "bigint"), ("customer_code", "bigint")]
COLUMNS: dict[str, list[tuple[str, str]]] = {
    "dim_customer": [("customer_code", "bigint"), ("customer", "string"), ("market", "string"),
                     ("region", "string"), ("channel", "string")],
    "dim_product": [("product_code", "bigint"), ("product", "string"), ("variant", "string"),
                    ("segment", "string"), ("division", "string")],
    "dim_date": [("date", "date")],
    "fact_sales_monthly": _K + [("sold_quantity", "bigint"), ("fiscal_year", "int")],
    "fact_forecast_monthly": _K + [("forecast_quantity", "bigint"), ("fiscal_year", "int")],
    "fact_gross_price": [("product_code", "bigint"), ("gross_price", "decimal(15,4)"), ("fiscal_year", "int")],
    "fact_pre_invoice_deductions": [("customer_code", "bigint"), ("pre_invoice_discount_pct", "decimal(5,4)"),
                                    ("fiscal_year", "int")],
    "fact_post_invoice_deductions": _K + [("discounts_pct", "decimal(5,4)"),
                                          ("other_deductions_pct", "decimal(5,4)"), ("fiscal_year", "int")],
    "marketshare": [("category", "string"), ("manufacturer", "string"), ("sales", "decimal(25,2)"),
                    ("total_market_sales", "decimal(25,2)"), ("fiscal_year", "int")],
    "expenses": [("category", "string"), ("amount", "int"), ("expense_id", "bigint")],
    "fact_actuals_estimates": [("date", "date"), ("customer_code", "bigint"), ("product_code", "bigint")]
    + [(c, "string") for c in ("customer", "market", "region", "channel", "product", "segment", "division")]
    + [("sold_quantity", "bigint")] + [(c, "decimal(20,2)") for c in _MONEY_COLS] + [("fiscal_year", "int")],
    "ns_gm_target": [("market", "string"), ("ns_target", "decimal(24,2)"), ("gm_target", "decimal(24,2)"),
                     ("np_target", "decimal(24,2)"), ("fiscal_year", "int")],
    "pl_rows": [("ord", "int"), ("description", "string")],
}
SCHEMAS: dict[str, str] = {t: ", ".join(f"{c} {ty}" for c, ty in cols) for t, cols in COLUMNS.items()}
TABLES = tuple(SCHEMAS)

# Facts of the (date, product, customer) grain, bucketed alike by save_tables.
_SAME_GRAIN = ("fact_sales_monthly", "fact_forecast_monthly", "fact_post_invoice_deductions")
BUCKET_KEY = ("date", "product_code", "customer_code")

# Tables partitioned by fiscal_year when written.
_FY_PARTITIONED = {"fact_sales_monthly", "fact_forecast_monthly", "fact_post_invoice_deductions", "fact_gross_price",
                   "fact_pre_invoice_deductions", "fact_actuals_estimates", "marketshare",
                   "ns_gm_target"}


# Tables of a row per product or customer (and year). Spark judges their size by compressed files of
# a row per product, before the years are attached, and would broadcast gigabytes.
_GROWING = {"dim_customer", "dim_product", "fact_gross_price", "fact_pre_invoice_deductions"}


def _pct(c) -> F.Column:
    """Whole-number percentage as a DECIMAL fraction: c * 0.01."""
    return c * F.lit(0.01).cast("decimal(3,2)")


class Star:
    """Named tables of the star; each attribute is a DataFrame opened on first use.

    Tables that grow with the data are joined by sort and merge, which spills, never broadcast.
    """

    def __init__(self, loaders: dict[str, Callable[[], DataFrame]]):
        missing = set(TABLES) - set(loaders)
        if missing:
            raise ValueError(f"missing tables: {sorted(missing)}")
        object.__setattr__(self, "_loaders", dict(loaders))
        object.__setattr__(self, "_frames", {})

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        frames = self._frames
        if name not in frames:
            df = self._loaders[name]()
            frames[name] = df.hint("merge") if name in _GROWING else df
        return frames[name]

    def __setattr__(self, name: str, df: DataFrame) -> None:
        if name not in TABLES:
            raise AttributeError(name)
        self._frames[name] = df

    # ------------------------------------------------------------------ build
    @classmethod
    def from_source(cls, spark: SparkSession, root: str) -> "Star":
        """Derive the star from the TPC-H-like tables under ``root`` (FIXTURES.md)."""
        memo: dict[str, DataFrame] = {}

        def once(key: str, make: Callable[[], DataFrame]) -> DataFrame:
            if key not in memo:
                memo[key] = make()
            return memo[key]

        def raw(name: str, cols: list[str]) -> DataFrame:
            return once("raw:" + name, lambda: read_table(spark, root, name, cols))

        def customer():
            return raw("customer", ["c_custkey", "c_nationkey", "c_mktsegment"])

        def part():
            return raw("part", ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"])

        def orders():
            # order dates are wall-clock timestamps: read them as such whatever
            # the session's time zone or timestamp inference settings
            return once("raw:orders", lambda: read_table(
                spark, root, "orders", schema="o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz"))

        def dim_customer():
            nation = raw("nation", ["n_nationkey", "n_name", "n_regionkey"])
            region = raw("region", ["r_regionkey", "r_name"])
            return (customer()
                    .join(nation, F.col("n_nationkey") == F.col("c_nationkey"))
                    .join(region, F.col("r_regionkey") == F.col("n_regionkey"))
                    .select(F.col("c_custkey").cast("bigint").alias("customer_code"),
                            F.concat(F.lit("ACCT-"), (F.col("c_custkey") % 40).cast("string"))
                            .alias("customer"),
                            F.col("n_name").alias("market"),
                            F.col("r_name").alias("region"),
                            F.col("c_mktsegment").alias("channel")))

        def dim_date():
            # every day from the first to the last order: prior periods need an unbroken calendar
            day = F.to_date("o_orderdate")
            return (orders().agg(F.min(day).alias("first"), F.max(day).alias("last")).where("first IS NOT NULL")
                    .select(F.explode(F.sequence("first", "last")).alias("date")))

        def dim_product():
            return part().select(F.col("p_partkey").alias("product_code"), F.col("p_name").alias("product"),
                                 F.col("p_type").alias("variant"), F.col("p_type").alias("segment"),
                                 F.col("p_brand").alias("division"))

        def lines():
            def make():
                lineitem = read_table(spark, root, "lineitem", ["l_orderkey", "l_partkey", "l_quantity",
                                                                "l_extendedprice", "l_discount", "l_tax"])
                return (lineitem.join(orders(), F.col("o_orderkey") == F.col("l_orderkey"))
                        .withColumn("date", F.trunc("o_orderdate", "month")))
            return once("lines", make)

        def monthly():
            # One aggregation of the order lines feeds monthly sales, post-invoice
            # deductions and market share: they share the (month, product,
            # customer) grain, and decimal sums can be summed again exactly. They are
            # dealt out by that grain alone (a month lies in one fiscal year), so that
            # two facts cut from it are joined where they lie.
            return once("monthly", lambda: (
                lines().groupBy("date", F.col("l_partkey").alias("product_code"),
                                F.col("o_custkey").alias("customer_code"))
                .agg(F.sum(F.col("l_quantity").cast("bigint")).cast("bigint").alias("sold_quantity"),
                     F.min("l_discount").cast("decimal(5,4)").alias("discounts_pct"),
                     F.min("l_tax").cast("decimal(5,4)").alias("other_deductions_pct"),
                     F.sum(F.col("l_extendedprice").cast("decimal(15,2)")).alias("extended_price"))
                .withColumn("fiscal_year", fiscal_year("date"))))

        def fy_set():
            # The set of fiscal years is one row (a global aggregate), so attaching
            # it to every part / customer is a broadcast of a single row.
            return once("fy_set", lambda: orders().agg(
                F.array_sort(F.collect_set(fiscal_year("o_orderdate"))).alias("fy_set")))

        def fact_gross_price():
            fy_step = F.col("fiscal_year") - F.lit(1995)
            return (attach_row(part().select("p_partkey", "p_retailprice"), fy_set())
                    .select(F.col("p_partkey").alias("product_code"),
                            F.explode("fy_set").alias("fiscal_year"), "p_retailprice")
                    .filter((F.col("product_code") + F.col("fiscal_year")) % 97 != 0)
                    .select("product_code", "fiscal_year",
                            _pct(F.col("p_retailprice").cast("decimal(15,4)")
                                 * (F.lit(100) + F.lit(2) * fy_step))
                            .cast("decimal(15,4)").alias("gross_price")))

        def fact_pre():
            return (attach_row(customer().select("c_custkey"), fy_set())
                    .select(F.col("c_custkey").alias("customer_code"),
                            F.explode("fy_set").alias("fiscal_year"))
                    .select("customer_code", "fiscal_year",
                            _pct(F.lit(5) + (F.col("customer_code") * 13 + F.col("fiscal_year")) % 21)
                            .cast("decimal(5,4)").alias("pre_invoice_discount_pct")))

        loaders = {
            "dim_customer": dim_customer,
            "dim_product": dim_product,
            "dim_date": dim_date,
            "fact_sales_monthly": lambda: _sales_of(monthly()),
            "fact_post_invoice_deductions": lambda: _post_of(monthly()),
            "fact_forecast_monthly": lambda: _forecast(star.fact_sales_monthly),
            "fact_gross_price": fact_gross_price,
            "fact_pre_invoice_deductions": fact_pre,
            "marketshare": lambda: _marketshare(monthly(), part()),
            "expenses": lambda: part().select(F.col("p_type").alias("category"),
                                              F.col("p_size").alias("amount"),
                                              F.col("p_partkey").alias("expense_id")),
            "fact_actuals_estimates": lambda: _actuals_estimates(star),
            "ns_gm_target": lambda: _targets(star.fact_actuals_estimates),
            "pl_rows": lambda: spark.createDataFrame(PL_ROWS, SCHEMAS["pl_rows"]),
        }
        star = cls(loaders)  # the derived-table loaders above refer to it lazily
        # kept for Star.build, which stages the order-line aggregate once
        object.__setattr__(star, "_monthly", monthly)
        object.__setattr__(star, "_part", part)
        # its targets are sums of its P&L fact, unless another table is put in their place
        object.__setattr__(star, "_derived", True)
        return star

    def derives_targets_from(self, fact: DataFrame) -> bool:
        """Whether this star's targets are sums of ``fact``, its P&L fact, that nobody has asked for yet."""
        return self.__dict__.get("_derived", False) and "ns_gm_target" not in self._frames and fact is self.fact_actuals_estimates

    @staticmethod
    def targets_of(fact: DataFrame) -> DataFrame:
        """The targets that belong to a P&L fact, or to stored sums of it by market."""
        return _targets(fact)

    # ------------------------------------------------------------------ io
    def write(self, path: str, mode: str = "overwrite") -> None:
        """Store every table as parquet; facts are partitioned by fiscal_year."""
        self.write_tables(path, list(TABLES), mode)

    def write_tables(self, path: str, names: list[str], mode: str = "overwrite") -> None:
        """Write tables; tables stored by year are rebalanced by year first, so a
        year is a few files of even size (a large year is split), and facts are
        sorted inside each task by their keys so parquet row-group statistics on
        customer / product are narrow and a one-customer filter skips most row
        groups. The completion marker goes first: a star that is being written,
        or whose writing failed, never counts as stored."""
        remove_path(SparkSession.active(), f"{_table_dir(path, TABLES[-1])}/_SUCCESS")
        for name in names:
            cols = [c for c, _ in COLUMNS[name]]
            df = getattr(self, name).select(*cols)
            keys = [k for k in ("fiscal_year", "customer_code", "product_code", "date") if k in cols]
            if name in _FY_PARTITIONED:
                df = df.hint("rebalance", "fiscal_year")
            if name.startswith("fact_") and "customer_code" in cols:
                df = df.sortWithinPartitions(*keys)
            writer = df.write.mode(mode)
            if name in _FY_PARTITIONED:
                writer = writer.partitionBy("fiscal_year")
            writer.parquet(_table_dir(path, name))

    @classmethod
    def build(cls, spark: SparkSession, root: str, path: str) -> "Star":
        """Derive the star from the source tables under ``root`` and store it at ``path``.

        Stages are written in dependency order and each later stage reads the
        stored tables of the earlier ones, so no table is recomputed and the
        lineage of the long derivations is cut at every stage. The stored facts
        must have unique keys and the fiscal year of their dates, else this fails.
        """
        remove_path(spark, _table_dir(path, TABLES[-1]))  # not stored until this build is done
        from revlens.operators.checks import check_facts

        t = cls.from_source(spark, root)
        # the order-line aggregate is staged once; three tables are cut from it
        staged = f"{path.rstrip('/')}/_staging_monthly"
        t._monthly().write.mode("overwrite").parquet(staged)
        monthly = spark.read.parquet(staged)
        t.fact_sales_monthly = _sales_of(monthly)
        t.fact_post_invoice_deductions = _post_of(monthly)
        t.marketshare = _marketshare(monthly, t._part())
        first = ["dim_customer", "dim_product", "dim_date", "fact_sales_monthly",
                 "fact_post_invoice_deductions", "fact_gross_price", "fact_pre_invoice_deductions",
                 "marketshare", "expenses"]
        t.write_tables(path, first)
        stored = cls.read(spark, path)
        for name in first:
            setattr(t, name, getattr(stored, name))
        t.write_tables(path, ["fact_forecast_monthly", "fact_actuals_estimates"])
        t.fact_actuals_estimates = stored.fact_actuals_estimates
        check_facts(stored)
        t.write_tables(path, ["ns_gm_target", "pl_rows"])  # pl_rows last: marks completion
        remove_path(spark, staged)
        return cls.read(spark, path)

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> "Star":
        """A star stored by ``write``; tables are opened on first use, with fixed schemas."""
        def loader(name: str) -> Callable[[], DataFrame]:
            return lambda: spark.read.schema(SCHEMAS[name]).parquet(_table_dir(path, name))
        return cls({name: loader(name) for name in TABLES})

    def save_tables(self, spark: SparkSession, database: str, buckets: int,
                    location: str | None = None, mode: str = "overwrite") -> None:
        """Save every table as a catalog table; the same-grain facts are bucketed.

        Sales, forecast and post-invoice facts share the (date, product,
        customer) grain and are joined on it. Bucketing all three into the
        same number of buckets on that key lets Spark join them bucket by
        bucket with no shuffle. Rows are hash-distributed on the bucket key
        before writing, so each bucket of each fiscal-year partition is one
        file. ``location`` places the database (e.g. on the shared file
        system); otherwise the session's warehouse folder is used.
        """
        loc = f" LOCATION '{location}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{loc}")
        for name in TABLES:
            cols = [c for c, _ in COLUMNS[name]]
            df = getattr(self, name).select(*cols)
            writer = None
            if name in _SAME_GRAIN:
                df = df.repartition(buckets, *BUCKET_KEY)
                writer = (df.write.mode(mode).format("parquet").bucketBy(buckets, *BUCKET_KEY)
                          .sortBy(*BUCKET_KEY))
            else:
                writer = df.write.mode(mode).format("parquet")
            if name in _FY_PARTITIONED:
                writer = writer.partitionBy("fiscal_year")
            writer.saveAsTable(f"{database}.{name}")

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str) -> "Star":
        """A star saved with ``save_tables`` (bucketing comes from the catalog)."""
        def loader(name: str) -> Callable[[], DataFrame]:
            return lambda: spark.table(f"{database}.{name}")
        return cls({name: loader(name) for name in TABLES})

    def caseless(self) -> "Star":
        """This star with text compared without case, as the reports' own engines do.

        Spellings of a dimension attribute that differ in case only become one;
        all text columns are collated, so that reports group, join, rank and
        filter by them without case. ``functions.text.plain`` turns a result's
        text back into ordinary strings.
        """
        def loader(name: str) -> Callable[[], DataFrame]:
            def load() -> DataFrame:
                df = getattr(self, name)
                return caseless(one_spelling(df) if name in ("dim_customer", "dim_product") else df)
            return load
        return Star({name: loader(name) for name in TABLES})

    def starting(self, month: int, years: list[int] | None = None) -> "Star":
        """This star with fiscal years that start in another month.

        The fiscal year of every dated fact follows from its dates; tables that
        name a fiscal year without dates (prices, customer discounts, targets,
        market share) are taken as they are, as the years of that calendar.
        All operators and sinks run on the result unchanged. ``years`` limits
        the dated facts to these years: by date and by the stored years that
        they touch, so that scans still skip the other years.
        """
        spans = [fiscal_year_bounds(y, month) for y in years or []]

        def loader(name: str) -> Callable[[], DataFrame]:
            def load() -> DataFrame:
                df = getattr(self, name)
                if not {"date", "fiscal_year"} <= set(df.columns):
                    return df
                if years is not None:
                    inside = [(F.col("date") >= F.lit(lo)) & (F.col("date") < F.lit(hi)) for lo, hi in spans]
                    touched = {stored_year(d) for lo, hi in spans for d in (lo, hi - timedelta(days=1))}
                    df = df.filter(F.col("fiscal_year").isin(sorted(touched))).filter(reduce(or_, inside, F.lit(False)))
                return df.withColumn("fiscal_year", fiscal_year("date", month))
            return load
        return Star({name: loader(name) for name in TABLES})

    @classmethod
    def is_stored(cls, spark: SparkSession, path: str) -> bool:
        """True when ``write`` completed at ``path`` (its last table has _SUCCESS)."""
        return path_exists(spark, f"{_table_dir(path, TABLES[-1])}/_SUCCESS")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Star":
        """A stored star at ``path`` if there is one, else derived from the source tables there."""
        return cls.read(spark, path) if cls.is_stored(spark, path) else cls.from_source(spark, path)


def stored_year(day: date) -> int:
    """The fiscal year that the stored facts give a day."""
    return day.year + (FY_START_MONTH > 1 and day.month >= FY_START_MONTH)


def _table_dir(path: str, name: str) -> str:
    return f"{path.rstrip('/')}/{name}"


def _forecast(sales: DataFrame) -> DataFrame:
    """Monthly forecasts: most sales get a perturbed forecast, some none, and some
    keys get a forecast one month after the sale where no sale exists."""
    mix = (F.col("customer_code") + F.col("product_code")) % 10
    later, following = F.add_months("date", 1), F.lead("date").over(Window.partitionBy("product_code", "customer_code").orderBy("date"))
    quantity = F.greatest(F.col("sold_quantity") + (F.col("customer_code") * 7 + F.col("product_code") * 3) % 21 - 10,
                          F.lit(0)).cast("bigint")
    row = lambda date, year, amount: F.struct(date.alias("date"), year.alias("fiscal_year"), amount.alias("forecast_quantity"))
    on_time = F.when(mix != 0, row(F.col("date"), F.col("fiscal_year"), quantity))
    late = F.when((mix == 1) & (F.col("following").isNull() | (F.col("following") > later)),
                  row(later, fiscal_year(later), F.col("sold_quantity")))
    rows = sales.withColumn("following", following).select(
        "product_code", "customer_code", F.inline(F.filter(F.array(on_time, late), lambda x: x.isNotNull())))
    return rows.select("date", "fiscal_year", "product_code", "customer_code", "forecast_quantity")


def _sales_of(monthly: DataFrame) -> DataFrame:
    return monthly.select("date", "fiscal_year", "product_code", "customer_code", "sold_quantity")


def _post_of(monthly: DataFrame) -> DataFrame:
    return monthly.select("date", "fiscal_year", "product_code", "customer_code", "discounts_pct",
                          "other_deductions_pct")


def _marketshare(monthly: DataFrame, part: DataFrame) -> DataFrame:
    """Sales per fiscal year x category x manufacturer and the category total."""
    by_brand = (monthly.join(part.select("p_partkey", "p_type", "p_brand"),
                             F.col("p_partkey") == F.col("product_code"))
                .groupBy("fiscal_year", F.col("p_type").alias("category"),
                         F.col("p_brand").alias("manufacturer"))
                .agg(F.sum("extended_price").cast("decimal(25,2)").alias("sales")))
    totals = (by_brand.groupBy("fiscal_year", "category")
              .agg(F.sum("sales").cast("decimal(25,2)").alias("total_market_sales")))
    return by_brand.join(totals, ["fiscal_year", "category"])


def _actuals_estimates(star: Star) -> DataFrame:
    """The P&L fact: every waterfall amount plus invented cost lines per sale."""
    from revlens.operators.waterfall import net_sales

    ns = net_sales(star)
    nis, net = F.col("net_invoice_sale"), F.col("net_sales")
    post = money(F.col("discounts_pct") * nis)
    pcode, ccode = F.col("product_code"), F.col("customer_code")
    return ns.select(
        "date", "fiscal_year", "customer_code", "product_code", "customer", "market", "region",
        "channel", "product", "segment", "division", "sold_quantity",
        F.col("gross_price_total").alias("gross_sales_amount"),
        (F.col("gross_price_total") - nis).cast("decimal(20,2)").alias("pre_invoice_deduction"),
        nis.alias("net_invoice_sales_amount"),
        post.alias("post_invoice_deduction"),
        (nis - net - post).cast("decimal(20,2)").alias("post_invoice_other_deduction"),
        net.alias("net_sales_amount"),
        money(_pct(net * (F.lit(45) + pcode % 15))).alias("manufacturing_cost"),
        money(_pct(net * (F.lit(1) + ccode % 5))).alias("freight_cost"),
        money(net * F.lit(0.005).cast("decimal(4,3)")).alias("other_cost"),
        money(_pct(net * (F.lit(5) + ccode % 12))).alias("ads_promotions"),
        money(_pct(net * (F.lit(15) + pcode % 20))).alias("other_operational_expense"),
    )


def _targets(fact: DataFrame) -> DataFrame:
    """Yearly net-sales / margin / profit targets per market from FY1996 on."""
    ns = F.sum("net_sales_amount")
    return (fact.filter(F.col("fiscal_year") >= 1996)
            .groupBy("fiscal_year", "market")
            .agg(money(_pct(ns * (F.lit(95) + F.length("market"))), 24).alias("ns_target"),
                 money(ns * F.lit(0.40).cast("decimal(3,2)"), 24).alias("gm_target"),
                 money(ns * F.lit(0.05).cast("decimal(3,2)"), 24).alias("np_target")))
