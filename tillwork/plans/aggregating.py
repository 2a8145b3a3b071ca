"""Aggregates, subqueries and top-k queries."""

from datetime import datetime

from pyspark.sql import functions as F

from tillwork.functions.dates import month_label, month_of
from tillwork.functions.money import (
    RATIO,
    amount,
    money,
    money_mean,
    money_sum,
    percent,
    revenue,
    revenue_sum,
)
from tillwork.operators.joins import best_with_ties, having_match
from tillwork.plans import raw, sql
from tillwork.plans.catalog import fulfilled, query
from tillwork.plans.joining import on
from tillwork.sources.shared import pin

ORDER_TOTALS = f"SELECT o_custkey, SUM({sql.TOTAL}) AS total_sales FROM orders GROUP BY o_custkey"


def customer_sales(t):
    return t.orders.groupBy("o_custkey").agg(money_sum("o_totalprice").alias("total_sales"))


# --- plain aggregates --------------------------------------------------------------------

@query(f"SELECT {sql.count()} AS total_orders, {sql.count('o_custkey')} AS with_customer FROM orders")
def agg_count(t):
    return t.orders.agg(
        F.count("*").alias("total_orders"), F.count("o_custkey").alias("with_customer")
    )


@query(f"SELECT {sql.amount(f'SUM({sql.TOTAL})')} AS delivered_revenue FROM orders WHERE o_orderstatus = 'F'")
def agg_sum_filtered(t):
    finished = t.orders.filter("o_orderstatus = 'F'")
    return finished.agg(amount(money_sum("o_totalprice")).alias("delivered_revenue"))


@query(f"""
SELECT o_orderstatus, {sql.count()} AS order_count, {sql.amount(f'SUM({sql.TOTAL})')} AS total_revenue,
       {sql.mean(sql.TOTAL)} AS avg_revenue FROM orders GROUP BY o_orderstatus
""")
def agg_by_status(t):
    return t.orders.groupBy("o_orderstatus").agg(
        F.count("*").alias("order_count"),
        amount(money_sum("o_totalprice")).alias("total_revenue"),
        amount(money_mean("o_totalprice")).alias("avg_revenue"),
    )


@query(f"""
SELECT p_type, {sql.count()} AS product_count, {sql.mean(sql.PRICE, 4)} AS avg_price,
       {sql.mean(sql.PRICE)} AS avg_price_rounded FROM part GROUP BY p_type
""")
def agg_avg_price(t):
    return t.part.groupBy("p_type").agg(
        F.count("*").alias("product_count"),
        amount(money_mean("p_retailprice"), 4).alias("avg_price"),
        amount(money_mean("p_retailprice")).alias("avg_price_rounded"),
    )


@query(f"""
SELECT p_brand, MAX(p_retailprice) AS max_price, MIN(p_retailprice) AS min_price,
       {sql.amount(f'MAX({sql.PRICE}) - MIN({sql.PRICE})')} AS price_range FROM part GROUP BY p_brand
""")
def agg_price_range(t):
    price = money("p_retailprice")
    return t.part.groupBy("p_brand").agg(
        F.max("p_retailprice").alias("max_price"),
        F.min("p_retailprice").alias("min_price"),
        amount(F.max(price) - F.min(price)).alias("price_range"),
    )


@query(f"""
SELECT p_brand, {sql.count()} AS product_count, {sql.mean(sql.PRICE)} AS avg_price FROM part
GROUP BY p_brand HAVING AVG({sql.PRICE}) > 950
""")
def agg_having(t):
    grouped = t.part.groupBy("p_brand").agg(
        F.count("*").alias("product_count"), money_mean("p_retailprice").alias("avg_price")
    )
    return grouped.filter("avg_price > 950").withColumn("avg_price", amount(F.col("avg_price")))


@query(f"""
SELECT p_brand, {sql.count()} AS product_count, {sql.mean(sql.PRICE)} AS avg_price FROM part
WHERE p_size > 15 GROUP BY p_brand HAVING COUNT(*) > 2
""")
def agg_where_having(t):
    grouped = t.part.filter("p_size > 15").groupBy("p_brand").agg(
        F.count("*").alias("product_count"), amount(money_mean("p_retailprice")).alias("avg_price")
    )
    return grouped.filter("product_count > 2")


@query(f"""
SELECT l_returnflag, {sql.count('DISTINCT l_orderkey')} AS orders,
       {sql.count('DISTINCT l_partkey')} AS parts FROM lineitem GROUP BY l_returnflag
""")
def agg_count_distinct(t):
    return t.lineitem.groupBy("l_returnflag").agg(
        F.countDistinct("l_orderkey").alias("orders"), F.countDistinct("l_partkey").alias("parts")
    )


@query(f"""
SELECT o_orderpriority, {sql.total("CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END")} AS delivered,
       {sql.total("CASE WHEN o_orderstatus = 'P' THEN 1 END")} AS shipped,
       {sql.total("CASE WHEN o_orderstatus = 'X' THEN 1 END")} AS cancelled,
       {sql.count()} AS total FROM orders GROUP BY o_orderpriority
""")
def agg_conditional(t):
    """Without an otherwise branch a group that never matches sums to null, not to zero."""
    status = F.col("o_orderstatus")
    return t.orders.groupBy("o_orderpriority").agg(
        F.count_if(status == "F").alias("delivered"),
        F.sum(F.when(status == "P", 1)).alias("shipped"),
        F.sum(F.when(status == "X", 1)).alias("cancelled"),
        F.count("*").alias("total"),
    )


@query(f"""
SELECT o_orderstatus, {sql.count()} AS num_orders,
       {sql.percent('COUNT(*)', '(SELECT COUNT(*) FROM orders)', 1)} AS pct_of_total
FROM orders GROUP BY o_orderstatus
""")
def status_mix_pct(t):
    everything = t.orders.agg(F.count("*")).scalar()
    grouped = t.orders.groupBy("o_orderstatus").agg(F.count("*").alias("num_orders"))
    return grouped.withColumn("pct_of_total", percent(F.col("num_orders"), everything, 1))


@query(f"""
SELECT SUM(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END)::BIGINT AS delivered_orders,
       SUM(CASE WHEN o_orderstatus <> 'F' THEN 1 ELSE 0 END)::BIGINT AS not_delivered_orders,
       {sql.count()} AS total_orders,
       {sql.percent("SUM(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END)", "COUNT(*)")} AS delivery_rate_percent
FROM orders
""")
def delivery_rate(t):
    done = F.col("o_orderstatus") == "F"
    return t.orders.agg(
        F.count_if(done).alias("delivered_orders"),
        F.count_if(~done).alias("not_delivered_orders"),
        F.count("*").alias("total_orders"),
        percent(F.count_if(done), F.count("*")).alias("delivery_rate_percent"),
    )


@query(f"""
SELECT {sql.count()} AS total_rows, {sql.mean(sql.TOTAL)} AS avg_order_value,
       {sql.amount(f'SUM({sql.TOTAL})')} AS total_revenue, MIN(o_totalprice) AS min_order_value,
       MAX(o_totalprice) AS max_order_value FROM orders
""")
def agg_global_summary(t):
    return t.orders.agg(
        F.count("*").alias("total_rows"),
        amount(money_mean("o_totalprice")).alias("avg_order_value"),
        amount(money_sum("o_totalprice")).alias("total_revenue"),
        F.min("o_totalprice").alias("min_order_value"),
        F.max("o_totalprice").alias("max_order_value"),
    )


def _six(value: str) -> str:
    return sql.amount(f"CAST({value} AS DECIMAL(18,6))", 3)


@query(f"""
SELECT l_returnflag, {_six('STDDEV_SAMP(l_quantity)')} AS quantity_stddev,
       {_six('VAR_SAMP(l_quantity)')} AS quantity_variance,
       {sql.mean("NULLIF(l_quantity, 1)", 3)} AS avg_quantity_above_one
FROM lineitem GROUP BY l_returnflag
""")
def agg_stddev(t):
    """Spread of a measure, and a mean that passes over nulls."""
    def rounded(c):
        return amount(c.cast(RATIO), 3)

    return t.lineitem.groupBy("l_returnflag").agg(
        rounded(F.stddev_samp("l_quantity")).alias("quantity_stddev"),
        rounded(F.var_samp("l_quantity")).alias("quantity_variance"),
        rounded(F.avg(F.nullif("l_quantity", F.lit(1.0)))).alias("avg_quantity_above_one"),
    )


@query(f"""
SELECT strftime(o_orderdate, '%Y-%m') AS month, {sql.count()} AS num_orders,
       {sql.amount(f'SUM({sql.TOTAL})')} AS total_revenue, {sql.mean(sql.TOTAL)} AS avg_order_value
FROM orders WHERE {sql.FULFILLED} GROUP BY 1
""")
def monthly_revenue(t):
    grouped = fulfilled(t.orders).groupBy(month_of("o_orderdate").alias("m")).agg(
        F.count("*").alias("num_orders"),
        amount(money_sum("o_totalprice")).alias("total_revenue"),
        amount(money_mean("o_totalprice")).alias("avg_order_value"),
    )
    return grouped.select(
        month_label(F.col("m")).alias("month"), "num_orders", "total_revenue", "avg_order_value"
    ).orderBy("month")


@query(f"""
SELECT strftime(o_orderdate, '%Y-%m') AS month, {sql.count()} AS orders,
       {sql.amount(f'SUM({sql.TOTAL})')} AS revenue, {sql.mean(sql.TOTAL)} AS avg_order_value,
       MAX(o_totalprice) AS largest_order, MIN(o_totalprice) AS smallest_order
FROM orders GROUP BY 1
""")
def monthly_order_stats(t):
    grouped = t.orders.groupBy(month_of("o_orderdate").alias("m")).agg(
        F.count("*").alias("orders"),
        amount(money_sum("o_totalprice")).alias("revenue"),
        amount(money_mean("o_totalprice")).alias("avg_order_value"),
        F.max("o_totalprice").alias("largest_order"),
        F.min("o_totalprice").alias("smallest_order"),
    )
    return grouped.withColumn("month", month_label(F.col("m"))).drop("m").orderBy("month")


# --- aggregates over joins ---------------------------------------------------------------
# Facts are summed per key before they meet a dimension: the join then sees one row per key.

REGION_SPEND = """
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
"""


def by_region(t, sales):
    """Attach segment and region to rows per customer."""
    return (
        sales.join(t.customer, on("o_custkey", "c_custkey"))
        .join(t.nation, on("c_nationkey", "n_nationkey"))
        .join(t.region, on("n_regionkey", "r_regionkey"))
    )


def spend_per_customer(t):
    return t.orders.groupBy("o_custkey").agg(
        F.count("*").alias("n"), F.count("o_totalprice").alias("priced"), money_sum("o_totalprice").alias("spend")
    )


@query(f"""
SELECT r_name AS region, c_mktsegment AS category, {sql.count()} AS order_count,
       {sql.amount(f'SUM({sql.TOTAL})')} AS total_revenue {REGION_SPEND} GROUP BY 1, 2
""")
def agg_region_category(t):
    placed = by_region(t, spend_per_customer(t))
    return placed.groupBy(F.col("r_name").alias("region"), F.col("c_mktsegment").alias("category")).agg(
        F.sum("n").alias("order_count"), amount(F.sum("spend")).alias("total_revenue")
    )


@query(f"""
SELECT r_name AS region, {sql.count()} AS order_count, {sql.amount(f'SUM({sql.TOTAL})')} AS total_revenue,
       {sql.mean(sql.TOTAL)} AS avg_order_value {REGION_SPEND} GROUP BY 1
HAVING AVG(o_totalprice) > (SELECT AVG(o_totalprice) FROM orders)
""")
def regions_above_avg(t):
    """The overall mean is a scalar subquery inside the plan; nothing is collected."""
    overall = t.orders.agg(money_mean("o_totalprice").cast("double")).scalar()
    placed = by_region(t, spend_per_customer(t)).groupBy(F.col("r_name").alias("region"))
    grouped = placed.agg(
        F.sum("n").alias("order_count"), F.sum("priced").alias("priced"), F.sum("spend").alias("spend")
    )
    mean = F.col("spend").cast("double") / F.nullif("priced", F.lit(0))
    return grouped.filter(mean > overall).select(
        "region",
        "order_count",
        amount(F.col("spend")).alias("total_revenue"),
        amount(mean.cast(RATIO)).alias("avg_order_value"),
    )


@query(f"""
SELECT r_name AS region, {sql.count('DISTINCT o_orderkey')} AS orders,
       {sql.amount(f'SUM({sql.TOTAL})')} AS sales {REGION_SPEND} GROUP BY 1
""")
def sales_by_region(t):
    placed = by_region(t, spend_per_customer(t)).groupBy(F.col("r_name").alias("region"))
    return placed.agg(F.sum("n").alias("orders"), amount(F.sum("spend")).alias("sales"))


@query(f"""
SELECT c_mktsegment AS segment, {sql.amount(f'SUM({sql.TOTAL})')} AS sales
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1
""")
def sales_by_segment(t):
    joined = spend_per_customer(t).join(t.customer, on("o_custkey", "c_custkey"))
    return joined.groupBy(F.col("c_mktsegment").alias("segment")).agg(
        amount(F.sum("spend")).alias("sales")
    )


def sales_per_part(lines):
    return lines.groupBy("l_partkey").agg(
        F.count("*").alias("lines"),
        F.sum("l_quantity").cast("bigint").alias("units"),
        revenue_sum().alias("revenue"),
    )


@query(f"""
SELECT p_type AS category, {sql.amount(f'SUM({sql.REV})')} AS total_revenue
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1
""")
def revenue_by_category(t):
    joined = sales_per_part(t.lineitem).join(t.part, on("l_partkey", "p_partkey"))
    return joined.groupBy(F.col("p_type").alias("category")).agg(
        amount(F.sum("revenue")).alias("total_revenue")
    )


@query(f"""
SELECT p_type AS category, {sql.count('DISTINCT l_orderkey')} AS num_orders, {sql.count()} AS total_items_sold,
       {sql.total('l_quantity')} AS total_quantity, {sql.amount(f'SUM({sql.REV})')} AS revenue_after_discount
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1
""")
def category_revenue_discounted(t):
    """Lines collapse to one row per (category, order) before orders are counted."""
    joined = t.lineitem.join(t.part, on("l_partkey", "p_partkey"))
    per_order = joined.groupBy(F.col("p_type").alias("category"), "l_orderkey").agg(
        F.count("*").alias("lines"),
        F.sum("l_quantity").cast("bigint").alias("units"),
        revenue_sum().alias("revenue"),
    )
    return per_order.groupBy("category").agg(
        F.count("l_orderkey").alias("num_orders"),
        F.sum("lines").alias("total_items_sold"),
        F.sum("units").alias("total_quantity"),
        amount(F.sum("revenue")).alias("revenue_after_discount"),
    )


@query(f"""
SELECT c_custkey, c_name, {sql.count('o_orderkey')} AS order_count,
       {sql.amount(f'SUM({sql.TOTAL})')} AS total_spent, {sql.mean(sql.TOTAL)} AS avg_order_value
FROM customer LEFT JOIN orders ON c_custkey = o_custkey
GROUP BY c_custkey, c_name HAVING COUNT(o_orderkey) > 1
""")
def repeat_customers(t):
    spend = t.orders.groupBy("o_custkey").agg(
        F.count("*").alias("order_count"),
        amount(money_sum("o_totalprice")).alias("total_spent"),
        amount(money_mean("o_totalprice")).alias("avg_order_value"),
    )
    again = spend.filter("order_count > 1").join(t.customer, on("o_custkey", "c_custkey"))
    return again.select("c_custkey", "c_name", "order_count", "total_spent", "avg_order_value")


@query(f"SELECT n_name AS city, {sql.count()} AS num_customers FROM customer JOIN nation"
       " ON c_nationkey = n_nationkey GROUP BY 1 HAVING COUNT(*) > 60")
def big_cities(t):
    sizes = t.customer.groupBy("c_nationkey").agg(F.count("*").alias("num_customers"))
    named = sizes.filter("num_customers > 60").join(t.nation, on("c_nationkey", "n_nationkey"))
    return named.select(F.col("n_name").alias("city"), "num_customers")


# --- top and bottom k --------------------------------------------------------------------

@query(f"""
SELECT p_partkey, p_name, p_type, {sql.total('l_quantity')} AS total_quantity,
       {sql.count('DISTINCT l_orderkey')} AS num_orders, {sql.amount(f'SUM({sql.REV})')} AS total_revenue
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_partkey, p_name, p_type
ORDER BY total_quantity DESC, p_partkey LIMIT 3
""")
def top_products_qty(t):
    """Names are looked up for the three winners only, chosen among the known parts, and only their
    orders are told apart: no task holds a row per part and order."""
    sold = t.lineitem.groupBy("l_partkey").agg(
        F.sum("l_quantity").cast("bigint").alias("total_quantity"),
        amount(revenue_sum()).alias("total_revenue"),
    )
    known = having_match(sold, t.part, "l_partkey", "p_partkey")
    top = pin(known.orderBy(F.desc("total_quantity"), "l_partkey").limit(3), "top")
    won = F.broadcast(top.select(F.col("l_partkey").alias("won")))  # three rows
    lines = t.lineitem.select("l_partkey", "l_orderkey").join(won, on("l_partkey", "won"), "left_semi")
    orders = lines.groupBy(F.col("l_partkey").alias("of_part")).agg(F.countDistinct("l_orderkey").alias("num_orders"))
    named = top.join(t.part, on("l_partkey", "p_partkey")).join(F.broadcast(orders), on("l_partkey", "of_part"))
    return named.select(
        "p_partkey", "p_name", "p_type", "total_quantity", "num_orders", "total_revenue"
    )


@query(f"""
SELECT l_partkey, {sql.count()} AS num_orders, {sql.total('l_quantity')} AS units_sold,
       {sql.amount(f'SUM({sql.REV})')} AS total_revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE {sql.FULFILLED}
GROUP BY l_partkey ORDER BY SUM({sql.REV}) DESC, l_partkey LIMIT 10
""")
def top10_products(t):
    lines = t.lineitem.join(fulfilled(t.orders), on("l_orderkey", "o_orderkey"))
    top = sales_per_part(lines).orderBy(F.desc("revenue"), "l_partkey").limit(10)
    return top.select(
        "l_partkey",
        F.col("lines").alias("num_orders"),
        F.col("units").alias("units_sold"),
        amount(F.col("revenue")).alias("total_revenue"),
    )


@query("""
SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM orders
WHERE o_orderstatus = 'F' AND o_totalprice > 400000 AND o_orderdate >= TIMESTAMP '1998-05-01'
ORDER BY o_totalprice DESC, o_orderkey LIMIT 10
""")
def high_value_orders(t):
    chosen = t.orders.filter(
        (F.col("o_orderstatus") == "F")
        & (F.col("o_totalprice") > 400000)
        & (F.col("o_orderdate") >= datetime(1998, 5, 1))
    )
    top = chosen.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)
    return top.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")


# --- subqueries --------------------------------------------------------------------------

@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
WHERE CAST(l_extendedprice AS DECIMAL(18,2)) >
      (SELECT CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(l_extendedprice) FROM lineitem)
""")
def lines_above_avg(t):
    mean = t.lineitem.agg(money_mean("l_extendedprice").cast("double")).scalar()
    above = t.lineitem.filter(F.col("l_extendedprice") > mean)
    return above.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


@query(f"""
SELECT (SELECT {sql.count()} FROM customer) AS n_customers, (SELECT {sql.count()} FROM part) AS n_products,
       (SELECT {sql.count()} FROM orders) AS n_orders
""")
def table_counts_row(t):
    """Three scalar subqueries in one row."""
    def size(df):
        return df.agg(F.count("*")).scalar()

    row = t.spark.range(1).select(
        size(t.customer).alias("n_customers"), size(t.part).alias("n_products"), size(t.orders).alias("n_orders")
    )
    return row


@query("""
SELECT o_custkey, o_orderkey, o_totalprice FROM orders o WHERE o_totalprice =
    (SELECT MAX(o_totalprice) FROM orders i WHERE i.o_custkey = o.o_custkey)
""")
def highest_order_per_customer(t):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_totalprice")
    best = best_with_ties(rows, "o_custkey", "o_totalprice")
    return best.select("o_custkey", "o_orderkey", "o_totalprice")


@query(f"""
WITH s AS ({ORDER_TOTALS})
SELECT o_custkey, {sql.amount('total_sales')} AS total_sales FROM s
WHERE total_sales > (SELECT CAST(SUM(total_sales) AS DOUBLE) / COUNT(total_sales) FROM s)
""")
def above_avg_customers(t):
    sales = customer_sales(t)
    mean = sales.agg(F.sum("total_sales").cast("double") / F.count("total_sales")).scalar()
    above = sales.filter(F.col("total_sales").cast("double") > mean)
    return above.select("o_custkey", amount(F.col("total_sales")).alias("total_sales"))


@query(f"""
SELECT c_custkey, c_name, {sql.amount(f'SUM({sql.TOTAL})')} AS lifetime_spend
FROM customer JOIN orders ON c_custkey = o_custkey WHERE {sql.FULFILLED}
GROUP BY c_custkey, c_name HAVING SUM({sql.TOTAL}) > (SELECT CAST(SUM(s) AS DOUBLE) / COUNT(s) FROM
    (SELECT SUM({sql.TOTAL}) AS s FROM orders WHERE {sql.FULFILLED} GROUP BY o_custkey))
ORDER BY SUM({sql.TOTAL}) DESC, c_custkey LIMIT 15
""")
def having_above_avg(t):
    spend = fulfilled(t.orders).groupBy("o_custkey").agg(money_sum("o_totalprice").alias("spend"))
    mean = spend.agg(F.sum("spend").cast("double") / F.count("spend")).scalar()
    above = spend.filter(F.col("spend").cast("double") > mean)
    known = having_match(above, t.customer, "o_custkey", "c_custkey")
    top = known.orderBy(F.desc("spend"), "o_custkey")
    named = top.limit(15).join(t.customer, on("o_custkey", "c_custkey"))
    return named.select("c_custkey", "c_name", amount(F.col("spend")).alias("lifetime_spend"))


PART_REVENUE = f"SELECT l_partkey, SUM({sql.REV}) AS revenue FROM lineitem GROUP BY l_partkey"


@query(f"""
SELECT p_partkey, p_name, p_type, (SELECT {sql.amount(f'SUM({sql.REV})')}
       FROM {raw.renumbered_sql("lineitem", "l_partkey")} WHERE l_partkey = p_partkey) AS product_revenue
FROM part
""")
def product_revenue(t):
    """A correlated total per product; a product that never sold has none."""
    lines = raw.renumbered(t.lineitem, "l_partkey")
    totals = lines.groupBy("l_partkey").agg(amount(revenue_sum()).alias("product_revenue"))
    joined = t.part.join(totals, on("p_partkey", "l_partkey"), "left")
    return joined.select("p_partkey", "p_name", "p_type", "product_revenue")


@query(f"""
WITH r AS ({PART_REVENUE}), j AS (SELECT * FROM r JOIN part ON l_partkey = p_partkey)
SELECT p_partkey, p_name, p_type, {sql.amount('revenue')} AS product_revenue FROM j
WHERE revenue > (SELECT CAST(SUM(i.revenue) AS DOUBLE) / COUNT(i.revenue) FROM j i WHERE i.p_type = j.p_type)
""")
def product_vs_category(t):
    """Products that earn more than the mean product of their category."""
    revenue = sales_per_part(t.lineitem).select("l_partkey", "revenue")
    named = revenue.join(t.part, on("l_partkey", "p_partkey"))
    means = named.groupBy(F.col("p_type").alias("category")).agg(
        F.try_divide(F.sum("revenue").cast("double"), F.count("revenue")).alias("mean_revenue")
    )
    above = named.join(means, on("p_type", "category")).filter(
        F.col("revenue").cast("double") > F.col("mean_revenue")
    )
    return above.select("p_partkey", "p_name", "p_type", amount(F.col("revenue")).alias("product_revenue"))


@query(f"""
SELECT o_custkey, {sql.count('DISTINCT o_orderkey')} AS num_orders,
       {sql.amount(f'SUM({sql.REV})')} AS total_sales,
       {sql.mean('CAST(l_extendedprice AS DECIMAL(18,2))')} AS avg_line_sales
FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_custkey
ORDER BY SUM({sql.REV}) DESC, o_custkey LIMIT 20
""")
def customer_sales_cte(t):
    """Lines are summed per order, so the join with orders moves one row per order."""
    per_order = t.lineitem.groupBy("l_orderkey").agg(
        revenue_sum().alias("sales"),
        money_sum("l_extendedprice").alias("listed"),
        F.count("l_extendedprice").alias("lines"),
    )
    joined = per_order.join(t.orders, on("l_orderkey", "o_orderkey"))
    mean = F.try_divide(F.sum("listed").cast("double"), F.sum("lines"))
    sales = joined.groupBy("o_custkey").agg(
        F.count("*").alias("num_orders"),
        F.sum("sales").alias("total"),
        amount(mean.cast(RATIO)).alias("avg_line_sales"),
    )
    top = sales.orderBy(F.desc("total"), "o_custkey").limit(20)
    return top.select("o_custkey", "num_orders", amount(F.col("total")).alias("total_sales"), "avg_line_sales")
