"""Revenue waterfall: gross sales -> net invoice sales -> net sales.

Each layer is a function of the star (or of the previous layer) returning a
lazy DataFrame that carries every dimension attribute, so reports can group
on any of them without joining the dimensions again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.fixed_values import POST_INVOICE_PCT_DIGITS
from revlens.functions.arith import money
from revlens.functions.fiscal import fiscal_year_filter

CUSTOMER_ATTRS = ["customer", "market", "region", "channel"]
PRODUCT_ATTRS = ["product", "variant", "segment", "division"]
POST_INVOICE_PCTS = ("discounts_pct", "other_deductions_pct")


def _sales(t, fiscal_year: int | None) -> DataFrame:
    sales = t.fact_sales_monthly
    if fiscal_year is not None:
        sales = sales.filter(F.col("fiscal_year") == fiscal_year)
    return sales


def _post_invoice(t, fiscal_year: int | None) -> DataFrame:
    """Post-invoice rows of one year: by the stored year, which prunes its partitions, or by
    the year's date range for a table without that column."""
    post = t.fact_post_invoice_deductions
    stored = "fiscal_year" in post.columns
    if fiscal_year is not None:
        post = post.filter(F.col("fiscal_year") == fiscal_year if stored else fiscal_year_filter("date", fiscal_year))
    return post.drop("fiscal_year") if stored else post


def gross_sales(t, fiscal_year: int | None = None, sales: DataFrame | None = None,
                extra: tuple[str, ...] = (), pre_invoice: bool = False) -> DataFrame:
    """Sales lines priced at the fiscal year's gross price (inner joins: a sale
    without a price row, customer or product is dropped).

    Columns: date, fiscal_year, customer_code, product_code, customer, market,
    region, channel, product, variant, segment, division, sold_quantity,
    gross_price_per_item, gross_price_total (plus ``extra`` columns of ``sales``).

    The tables of one code are joined first, so that the lines, of which there are
    far more, move once for products and prices and once for customers. With
    ``pre_invoice`` the customer's discount comes by that move, too, as the last
    column, and ``with_pre_invoice`` finds it there.
    """
    sales = sales if sales is not None else _sales(t, fiscal_year)
    products = t.dim_product.join(t.fact_gross_price, "product_code").hint("merge")
    customers, of_customer, pre = t.dim_customer, ["customer_code"], []
    if pre_invoice:
        customers = customers.join(t.fact_pre_invoice_deductions, "customer_code").hint("merge")
        of_customer, pre = ["customer_code", "fiscal_year"], ["pre_invoice_discount_pct"]
    joined = sales.join(products, ["product_code", "fiscal_year"]).join(customers, of_customer)
    return joined.select(
        "date", "fiscal_year", "customer_code", "product_code", *CUSTOMER_ATTRS, *PRODUCT_ATTRS,
        "sold_quantity", *extra,
        F.col("gross_price").alias("gross_price_per_item"),
        money(F.col("gross_price") * F.col("sold_quantity")).alias("gross_price_total"), *pre)


def with_pre_invoice(gs: DataFrame, t) -> DataFrame:
    """Attach the customer's pre-invoice discount fraction for the fiscal year, if ``gross_sales`` didn't."""
    if "pre_invoice_discount_pct" in gs.columns:
        return gs.select("customer_code", "fiscal_year", *[c for c in gs.columns if c not in ("customer_code", "fiscal_year")])
    return gs.join(t.fact_pre_invoice_deductions, ["customer_code", "fiscal_year"])


def net_invoice_sale() -> F.Column:
    """ROUND(gross - gross * pre_pct, 2) on exact decimals."""
    g = F.col("gross_price_total")
    return money(g - g * F.col("pre_invoice_discount_pct"))


def post_invoice_pct() -> F.Column:
    """ROUND(discounts_pct + other_deductions_pct, 4) as DECIMAL(5,4)."""
    total = F.col("discounts_pct") + F.col("other_deductions_pct")
    return F.round(total, POST_INVOICE_PCT_DIGITS).cast("decimal(5,4)")


def post_invoice_lines(t, fiscal_year: int | None = None) -> DataFrame:
    """Sales lines with their post-invoice fractions, before any dimension is joined.

    Both facts have the same (date, product, customer) grain, so this is a
    fact-to-fact equi-join on the narrowest rows there are: shuffled when large, and
    not at all when both facts are bucketed on that key (``Star.save_tables``) or
    were just grouped by it. Inner joins commute, so the rows equal those
    of the layer-by-layer composition.
    """
    return _sales(t, fiscal_year).join(_post_invoice(t, fiscal_year), ["date", "product_code", "customer_code"])


def with_post_invoice(pre: DataFrame, t, keep_components: bool = False,
                      fiscal_year: int | None = None) -> DataFrame:
    """Net invoice sale plus the post-invoice discount fraction (discounts + other).

    The post-invoice rows join ``pre`` on the (date, product, customer) grain,
    unless its lines brought them (``post_invoice_lines``). When the fiscal year is
    known, only that year's partition of the post-invoice side is read.
    """
    keys = ["date", "product_code", "customer_code"]
    if set(POST_INVOICE_PCTS) <= set(pre.columns):
        joined = pre.select(*keys, *[c for c in pre.columns if c not in (*keys, *POST_INVOICE_PCTS)], *POST_INVOICE_PCTS)
    else:
        joined = pre.join(_post_invoice(t, fiscal_year), keys)
    out = (joined
           .withColumn("net_invoice_sale", net_invoice_sale())
           .withColumn("post_invoice_discount_pct",
                       post_invoice_pct()))
    if not keep_components:
        out = out.drop(*POST_INVOICE_PCTS)
    return out


def with_net_sales(post: DataFrame) -> DataFrame:
    """net_sales = ROUND((1 - post_pct) * net_invoice_sale, 2)."""
    return post.withColumn(
        "net_sales", money((F.lit(1) - F.col("post_invoice_discount_pct")) * F.col("net_invoice_sale")))


def _discounted_lines(t, fiscal_year: int | None) -> DataFrame:
    """Sales lines with every table they need: post-invoice rows first, then products and prices, then customers and discounts."""
    gs = gross_sales(t, sales=post_invoice_lines(t, fiscal_year), extra=POST_INVOICE_PCTS, pre_invoice=True)
    return with_pre_invoice(gs, t)


def post_invoice_sales(t, fiscal_year: int | None = None, keep_components: bool = False) -> DataFrame:
    """The first three layers composed; Catalyst prunes what the caller does not use."""
    return with_post_invoice(_discounted_lines(t, fiscal_year), t, keep_components, fiscal_year)


def net_sales(t, fiscal_year: int | None = None, keep_components: bool = True) -> DataFrame:
    """All four layers composed; Catalyst prunes what the caller does not use."""
    out = (_discounted_lines(t, fiscal_year)
           .withColumn("net_invoice_sale", net_invoice_sale())
           .withColumn("post_invoice_discount_pct",
                       post_invoice_pct()))
    if not keep_components:
        out = out.drop(*POST_INVOICE_PCTS)
    return with_net_sales(out)


def net_sales_lines(t, fiscal_year: int | None = None, known_products: bool = True,
                    known_customers: bool = True) -> DataFrame:
    """date, fiscal_year, product_code, customer_code and net_sales of every line that has a price,
    a pre-invoice and post-invoice row, a product and a customer.

    No dimension attribute is joined to the lines: the small price and
    pre-invoice tables are cut to known products and customers instead, so
    the same lines drop out as in ``net_sales``. A caller that joins a
    dimension later drops them there and turns that cut off.
    """
    def of_year(df: DataFrame) -> DataFrame:
        # within one year the year is no join key, so that lines already dealt out by
        # customer or product stay where they are
        return df if fiscal_year is None else df.filter(F.col("fiscal_year") == fiscal_year).drop("fiscal_year")

    year = ["fiscal_year"] if fiscal_year is None else []
    price, pre = of_year(t.fact_gross_price), of_year(t.fact_pre_invoice_deductions)
    if known_products:
        price = price.join(t.dim_product.select("product_code"), "product_code", "left_semi")
    if known_customers:
        pre = pre.join(t.dim_customer.select("customer_code"), "customer_code", "left_semi")
    lines = post_invoice_lines(t, fiscal_year).join(price, ["product_code", *year]).join(pre, ["customer_code", *year])
    lines = (lines.withColumn("gross_price_total", money(F.col("gross_price") * F.col("sold_quantity")))
             .withColumn("net_invoice_sale", net_invoice_sale())
             .withColumn("post_invoice_discount_pct", post_invoice_pct()))
    return with_net_sales(lines).select("date", "fiscal_year", "product_code", "customer_code", "net_sales")


def net_invoice_sale_fy(t, fiscal_year: int) -> DataFrame:
    """Line-level net invoice sale for one fiscal year (pre-invoice step only)."""
    pre = with_pre_invoice(gross_sales(t, fiscal_year), t)
    return pre.select("date", "product_code", "product", "variant", "sold_quantity",
                      F.col("gross_price_per_item").alias("gross_price"), "gross_price_total",
                      "pre_invoice_discount_pct", net_invoice_sale().alias("net_invoice_sale"))

