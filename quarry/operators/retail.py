"""Retail reports over the order star schema (RET-01..09).

Plans aggregate the fact by its foreign key before joining a dimension, so
the fact is never the build side of a join and a hot customer or product is
collapsed by the map-side partial aggregate instead of landing in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.numeric import ratio, round_half_up
from quarry.sources.model import RetailModel

MONEY_SUM = "decimal(38,2)"


def exact_sum(c: Column | str, dtype: str = MONEY_SUM) -> Column:
    """SUM of a DECIMAL widened first, so billions of rows cannot overflow."""
    c = F.col(c) if isinstance(c, str) else c
    return F.sum(c.cast(dtype))


def mean_of(sum_col: Column, count_col: Column) -> Column:
    """Mean as exact sum / count in DOUBLE; independent of partitioning."""
    return ratio(sum_col, count_col)


def monthly_summary(m: RetailModel) -> DataFrame:
    """RET-01: month -> distinct orders, distinct customers, revenue, mean line.

    Lines are first reduced to one row per (month, order, customer) - map-side,
    about four lines per order - so the two distinct counts expand and
    shuffle order-level rows instead of line-level rows.
    """
    per_order = (m.orders
                 .groupBy(F.date_trunc("month", "order_date").cast("date").alias("month"),
                          "order_id", "customer_id")
                 .agg(exact_sum("total_amount").alias("rev"),
                      F.count("total_amount").alias("n")))
    return (per_order.groupBy("month")
            .agg(F.countDistinct("order_id").alias("order_count"),
                 F.countDistinct("customer_id").alias("customer_count"),
                 F.sum("rev").alias("revenue"),
                 F.sum("n").alias("_n"))
            .select("month", "order_count", "customer_count", "revenue",
                    mean_of(F.col("revenue"), F.col("_n")).alias("avg_order_value"))
            .orderBy("month"))


def _orders_by_customer(m: RetailModel) -> DataFrame:
    """Per customer: distinct orders, revenue, line count, first/last date.

    Two exact levels instead of a distinct aggregate: (customer, order) pairs
    first, then per customer; the count of pairs is the distinct order count.
    """
    pairs = (m.orders.groupBy("customer_id", "order_id")
             .agg(exact_sum("total_amount").alias("rev"), F.count("total_amount").alias("n"),
                  F.min("order_date").alias("lo"), F.max("order_date").alias("hi")))
    return (pairs.groupBy("customer_id")
            .agg(F.count("order_id").alias("total_orders"),
                 F.sum("rev").alias("total_revenue"),
                 F.sum("n").alias("_n"),
                 F.min("lo").alias("first_order"),
                 F.max("hi").alias("last_order")))


def customer_report(m: RetailModel) -> DataFrame:
    """RET-02: every customer (also without orders) with lifetime figures.

    The fact is aggregated per customer first (partial aggregation absorbs a
    hot customer), then joined to the dimension, whose key is unique.
    """
    per_customer = _orders_by_customer(m)
    c = m.customers.select("customer_id", "customer_name", "region", "segment")
    return (c.join(per_customer, "customer_id", "left")
            .select("customer_id", "customer_name", "region", "segment",
                    F.coalesce(F.col("total_orders"), F.lit(0)).cast("bigint").alias("total_orders"),
                    "total_revenue",
                    mean_of(F.col("total_revenue"), F.col("_n")).alias("avg_order_value"),
                    "first_order", "last_order")
            .orderBy(F.col("total_revenue").desc_nulls_last(), F.col("customer_id")))


def _orders_by_product(m: RetailModel) -> DataFrame:
    """Per product: distinct orders (count of (product, order) pairs),
    quantity and revenue."""
    pairs = (m.orders.groupBy("product_id", "order_id")
             .agg(F.sum("quantity").alias("qty"), exact_sum("total_amount").alias("rev")))
    return (pairs.groupBy("product_id")
            .agg(F.count("order_id").alias("times_ordered"),
                 F.sum("qty").alias("total_quantity_sold"),
                 F.sum("rev").alias("total_revenue")))


def product_performance(m: RetailModel) -> DataFrame:
    """RET-03: every product with distinct orders, quantity and revenue."""
    per_product = _orders_by_product(m)
    p = m.products.select("product_id", "product_name", "category", "unit_price")
    return (p.join(per_product, "product_id", "left")
            .select("product_id", "product_name", "category", "unit_price",
                    F.coalesce(F.col("times_ordered"), F.lit(0)).cast("bigint").alias("times_ordered"),
                    "total_quantity_sold", "total_revenue")
            .orderBy(F.col("total_revenue").desc_nulls_last(), F.col("product_id")))


def _order_lines(m: RetailModel, orders: DataFrame | None = None) -> DataFrame:
    f = m.orders if orders is None else orders
    c = m.customers.select("customer_id", "customer_name", "region")
    p = m.products.select("product_id", "product_name", "category")
    return f.join(c, "customer_id", "left").join(p, "product_id", "left")


DETAIL_COLUMNS = ["order_id", "customer_name", "region", "product_name", "category",
                  "quantity", "total_amount", "order_date", "status"]


def order_details(m: RetailModel, n: int = 20) -> DataFrame:
    """RET-04: the first ``n`` order lines with customer and product names.

    Only lines of the ``n`` smallest order keys can qualify, so the fact is
    cut to those keys (a scalar subquery over a top-n of one column) before
    the dimension joins; the sort then breaks ties on every column.
    """
    cut = m.orders.select("order_id").orderBy("order_id").limit(n) \
        .agg(F.max("order_id").alias("cut"))
    head = m.orders.filter(F.col("order_id") <= cut.scalar())
    return (_order_lines(m, head).select(*DETAIL_COLUMNS)
            .orderBy(*DETAIL_COLUMNS).limit(n))


def order_totals(m: RetailModel) -> DataFrame:
    """RET-05: global distinct counts, revenue, mean line, date range.

    Lines are reduced to one row per order and customer first, products to their
    keys, so no distinct aggregate expands the lines.
    """
    per_order = (m.orders.groupBy("order_id", "customer_id")
                 .agg(exact_sum("total_amount").alias("rev"), F.count("total_amount").alias("n"),
                      F.min("order_date").alias("lo"), F.max("order_date").alias("hi")))
    per_customer = (per_order.groupBy("customer_id")
                    .agg(F.sum("rev").alias("rev"), F.sum("n").alias("n"),
                         F.min("lo").alias("lo"), F.max("hi").alias("hi")))
    orders = per_order.select("order_id").distinct().agg(F.count("order_id").alias("total_orders"))
    products = m.orders.select("product_id").distinct().agg(F.count("product_id").alias("unique_products"))
    totals = per_customer.agg(F.count("customer_id").alias("unique_customers"),
                              F.sum("rev").alias("total_revenue"), F.sum("n").alias("_n"),
                              F.min("lo").alias("first_order"), F.max("hi").alias("last_order"))
    return (totals.withColumn("total_orders", orders.scalar())
            .withColumn("unique_products", products.scalar())
            .select("total_orders", "unique_customers", "unique_products", "total_revenue",
                    mean_of(F.col("total_revenue"), F.col("_n")).alias("avg_order_value"),
                    "first_order", "last_order"))


def top_customers(m: RetailModel, n: int = 10) -> DataFrame:
    """RET-06: the ``n`` customers with the highest revenue (a top-k report)."""
    return customer_report(m).orderBy(F.col("total_revenue").desc_nulls_last(),
                                      F.col("customer_id")).limit(n)


def top_products(m: RetailModel, n: int = 10) -> DataFrame:
    """RET-06: the ``n`` products with the highest revenue (a top-k report)."""
    return product_performance(m).orderBy(F.col("total_revenue").desc_nulls_last(),
                                          F.col("product_id")).limit(n)


KPI_METRICS = [("Total Orders", "order_count"), ("Revenue", "revenue"),
               ("Unique Customers", "customer_count"), ("Average Order Value", "avg_order_value")]


def monthly_kpi(m: RetailModel) -> DataFrame:
    """RET-07: template KPIs per month with the change against the previous
    month in percent (2 dp). The window runs over the monthly aggregate,
    one row per month, never over the fact."""
    ms = monthly_summary(m)
    long = ms.select("month", F.explode(F.array(*[
        F.struct(F.lit(label).alias("metric"), F.col(c).cast("double").alias("value"))
        for label, c in KPI_METRICS])).alias("kv")).select("month", "kv.metric", "kv.value")
    prev = F.lag("value").over(Window.partitionBy("metric").orderBy("month"))
    return (long.withColumn("_prev", prev)
            .select("month", "metric", "value",
                    round_half_up(F.lit(100.0) * ratio(F.col("value") - F.col("_prev"),
                                                       F.col("_prev")), 2).alias("change_pct"))
            .orderBy("month", "metric"))


def orders_by_category(m: RetailModel) -> DataFrame:
    """RET-08: category -> distinct orders, quantity, revenue."""
    p = m.products.select("product_id", "category")
    return (m.orders.join(p, "product_id", "left")
            .groupBy("category")
            .agg(F.countDistinct("order_id").alias("order_count"),
                 F.sum("quantity").alias("total_quantity"),
                 exact_sum("total_amount").alias("total_revenue"))
            .orderBy(F.col("total_revenue").desc_nulls_last()))


def order_line_export(m: RetailModel) -> DataFrame:
    """RET-09: the detail sheet, every order line with names."""
    return _order_lines(m).select("order_id", "customer_name", "product_name",
                                  "quantity", "total_amount", "order_date")
