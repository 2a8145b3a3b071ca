"""Rankings, running totals and period comparisons."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tillwork.functions.dates import day, month_label, month_of
from tillwork.functions.money import amount, money_sum, percent, percent_change, ratio
from tillwork.operators.joins import having_match
from tillwork.operators.ordered import over_ordered
from tillwork.plans import sql
from tillwork.plans.aggregating import (
    ORDER_TOTALS,
    by_region,
    customer_sales,
    sales_per_part,
)
from tillwork.plans.catalog import RISK_GAP_DAYS, fulfilled, query
from tillwork.plans.joining import on

BIGGEST_FIRST = [("total_sales", "desc"), ("o_custkey", "asc")]
SALES = sql.amount("total_sales")


def published(df, *columns):
    """Turn exact totals into doubles for output."""
    return df.withColumns({c: amount(F.col(c)) for c in columns})


# --- whole-population rankings -----------------------------------------------------------

@query(f"""
WITH s AS ({ORDER_TOTALS})
SELECT o_custkey, {SALES} AS total_sales,
       ROW_NUMBER() OVER (ORDER BY total_sales DESC, o_custkey) AS row_num,
       RANK() OVER (ORDER BY total_sales DESC) AS sales_rank,
       DENSE_RANK() OVER (ORDER BY total_sales DESC) AS sales_dense_rank FROM s
""")
def rank_customers(t):
    ranked = over_ordered(
        customer_sales(t), BIGGEST_FIRST, ties=1,
        row_number="row_num", rank="sales_rank", dense_rank="sales_dense_rank",
    )
    return published(ranked, "total_sales")


@query(f"""
SELECT o_custkey, o_orderkey, o_totalprice,
       RANK() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC) AS rank_within_customer
FROM orders
""")
def rank_orders_in_customer(t):
    return over_ordered(
        t.orders.select("o_custkey", "o_orderkey", "o_totalprice"),
        [("o_totalprice", "desc"), ("o_orderkey", "asc")],
        group=["o_custkey"], ties=1, rank="rank_within_customer",
    )


@query(f"""
WITH s AS ({ORDER_TOTALS})
SELECT o_custkey, {SALES} AS total_sales,
       NTILE(4) OVER (ORDER BY total_sales DESC, o_custkey) AS sales_quartile FROM s
""")
def customer_quartiles(t):
    ranked = over_ordered(customer_sales(t), BIGGEST_FIRST, ntile=("sales_quartile", 4))
    return published(ranked, "total_sales")


@query(f"""
WITH s AS ({ORDER_TOTALS}), q AS (SELECT *, NTILE(4) OVER (ORDER BY total_sales DESC, o_custkey) AS quartile FROM s)
SELECT o_custkey, {SALES} AS total_sales, quartile, CASE quartile WHEN 1 THEN 'Platinum'
       WHEN 2 THEN 'Gold' WHEN 3 THEN 'Silver' WHEN 4 THEN 'Bronze' END AS quartile_label FROM q
""")
def ltv_quartile_labels(t):
    ranked = over_ordered(customer_sales(t), BIGGEST_FIRST, ntile=("quartile", 4))
    quartile = F.col("quartile")
    label = (
        F.when(quartile == 1, "Platinum").when(quartile == 2, "Gold")
        .when(quartile == 3, "Silver").when(quartile == 4, "Bronze")
    )
    return published(ranked.withColumn("quartile_label", label), "total_sales")


@query(f"""
WITH s AS (SELECT o_custkey, SUM({sql.TOTAL}) AS total_sales, {sql.count()} AS num_orders
           FROM orders GROUP BY o_custkey)
SELECT o_custkey, c_name, c_mktsegment, {SALES} AS total_sales, num_orders,
       ROW_NUMBER() OVER (ORDER BY total_sales DESC, o_custkey) AS sales_rank
FROM s JOIN customer ON o_custkey = c_custkey
""")
def ranked_customer_report(t):
    sales = t.orders.groupBy("o_custkey").agg(
        money_sum("o_totalprice").alias("total_sales"), F.count("*").alias("num_orders")
    )
    named = sales.join(t.customer, on("o_custkey", "c_custkey")).select(
        "o_custkey", "c_name", "c_mktsegment", "total_sales", "num_orders"
    )
    return published(over_ordered(named, BIGGEST_FIRST, row_number="sales_rank"), "total_sales")


@query(f"""
WITH s AS ({ORDER_TOTALS})
SELECT c_mktsegment AS segment, o_custkey, c_name, {SALES} AS total_sales,
       RANK() OVER (PARTITION BY c_mktsegment ORDER BY total_sales DESC) AS rank_in_segment
FROM s JOIN customer ON o_custkey = c_custkey
""")
def rank_in_segment(t):
    named = customer_sales(t).join(t.customer, on("o_custkey", "c_custkey")).select(
        F.col("c_mktsegment").alias("segment"), "o_custkey", "c_name", "total_sales"
    )
    ranked = over_ordered(named, BIGGEST_FIRST, group=["segment"], ties=1, rank="rank_in_segment")
    return published(ranked, "total_sales")


PART_SALES = f"""
SELECT p_type AS category, p_partkey, p_name, SUM({sql.REV}) AS total_sales,
       {sql.total('l_quantity')} AS units_sold
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3
"""


def part_sales(t):
    joined = sales_per_part(t.lineitem).join(t.part, on("l_partkey", "p_partkey"))
    return joined.select(
        F.col("p_type").alias("category"), "p_partkey", "p_name",
        F.col("revenue").alias("total_sales"), F.col("units").alias("units_sold"),
    )


@query(f"""
WITH s AS ({PART_SALES})
SELECT category, p_partkey, p_name, {SALES} AS total_sales, units_sold,
       DENSE_RANK() OVER (PARTITION BY category ORDER BY total_sales DESC) AS rank_in_category FROM s
""")
def rank_products_in_category(t):
    ranked = over_ordered(
        part_sales(t), [("total_sales", "desc"), ("p_partkey", "asc")],
        group=["category"], ties=1, dense_rank="rank_in_category",
    )
    return published(ranked, "total_sales")


@query(f"""
WITH s AS ({PART_SALES}), r AS (SELECT *, RANK() OVER (PARTITION BY category ORDER BY total_sales DESC) AS place,
       SUM(total_sales) OVER (PARTITION BY category) AS whole FROM s)
SELECT category, p_partkey, p_name, {SALES} AS total_sales, units_sold, place AS rank_in_category,
       {sql.percent('total_sales', 'whole', 1)} AS pct_of_category_revenue FROM r WHERE place <= 3
""")
def top3_per_category(t):
    """Catalyst cuts each task to the best three per category before the shuffle.

    The category total is a separate small aggregate, so no category is gathered.
    """
    sales = part_sales(t)
    window = Window.partitionBy("category").orderBy(F.desc("total_sales"))
    top = sales.withColumn("rank_in_category", F.rank().over(window).cast("bigint")).filter(
        "rank_in_category <= 3"
    )
    whole = sales.groupBy(F.col("category").alias("of")).agg(F.sum("total_sales").alias("whole"))
    share = percent(F.col("total_sales"), F.col("whole"), 1).alias("pct_of_category_revenue")
    joined = top.join(whole, F.col("category").eqNullSafe(F.col("of")))
    return published(joined.select(*top.columns, share), "total_sales")


@query(f"""
WITH s AS ({ORDER_TOTALS})
SELECT o_custkey, c_name, c_mktsegment, {SALES} AS total_sales, RANK() OVER (ORDER BY total_sales DESC) AS sales_rank
FROM s JOIN customer ON o_custkey = c_custkey ORDER BY s.total_sales DESC, o_custkey LIMIT 10
""")
def top10_customers(t):
    return _ends(t, F.desc("total_sales"), "sales_rank")


@query(f"""
WITH s AS ({ORDER_TOTALS})
SELECT o_custkey, c_name, c_mktsegment, {SALES} AS total_sales, RANK() OVER (ORDER BY total_sales) AS rank_from_bottom
FROM s JOIN customer ON o_custkey = c_custkey ORDER BY s.total_sales, o_custkey LIMIT 10
""")
def bottom10_customers(t):
    return _ends(t, F.asc("total_sales"), "rank_from_bottom")


def _ends(t, order, rank_name):
    """Ten known customers from one end.

    Ranks depend only on better rows, so ten rows suffice to rank and to look names up.
    """
    known = having_match(customer_sales(t), t.customer, "o_custkey", "c_custkey")
    ten = known.orderBy(order, "o_custkey").limit(10)
    ranked = ten.withColumn(rank_name, F.rank().over(Window.orderBy(order)).cast("bigint"))
    named = ranked.join(t.customer, on("o_custkey", "c_custkey"))
    return published(named.select("o_custkey", "c_name", "c_mktsegment", "total_sales", rank_name), "total_sales")


@query(f"""
WITH s AS ({ORDER_TOTALS}), r AS (SELECT *, SUM(total_sales) OVER (ORDER BY total_sales DESC, o_custkey
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumulative, SUM(total_sales) OVER () AS whole FROM s)
SELECT o_custkey, {SALES} AS total_sales, {sql.amount('cumulative')} AS cumulative_revenue,
       {sql.percent('cumulative', 'whole')} AS cumulative_percent FROM r
""")
def revenue_pareto(t):
    ranked = over_ordered(
        customer_sales(t), BIGGEST_FIRST,
        running={"cumulative_revenue": "total_sales"}, totals={"whole": "total_sales"},
    )
    share = percent(F.col("cumulative_revenue"), F.col("whole")).alias("cumulative_percent")
    return published(
        ranked.select("o_custkey", "total_sales", "cumulative_revenue", share),
        "total_sales", "cumulative_revenue",
    )


# --- sequences per customer --------------------------------------------------------------

ORDER_DATES = "SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS order_date FROM orders"


def order_dates(t):
    return t.orders.select("o_custkey", "o_orderkey", day("o_orderdate").alias("order_date"))


IN_TIME = [("order_date", "asc"), ("o_orderkey", "asc")]


@query(f"""
WITH d AS ({ORDER_DATES})
SELECT *, ROW_NUMBER() OVER w AS order_sequence, LAG(order_date) OVER w AS previous_order_date
FROM d WINDOW w AS (PARTITION BY o_custkey ORDER BY order_date, o_orderkey)
""")
def order_sequence(t):
    return over_ordered(
        order_dates(t), IN_TIME, group=["o_custkey"],
        row_number="order_sequence", lag={"previous_order_date": "order_date"},
    )


@query(f"""
WITH d AS ({ORDER_DATES}), g AS (SELECT *, LAG(order_date) OVER (PARTITION BY o_custkey
       ORDER BY order_date, o_orderkey) AS previous_order_date FROM d),
a AS (SELECT o_custkey, AVG(order_date - previous_order_date) AS gap FROM g
      WHERE previous_order_date IS NOT NULL GROUP BY o_custkey)
SELECT o_custkey, o_orderkey, order_date, previous_order_date,
       CAST(order_date - previous_order_date AS BIGINT) AS days_gap,
       CASE WHEN gap > {RISK_GAP_DAYS} THEN 'At Risk' ELSE 'Normal' END AS risk_flag
FROM g JOIN a USING (o_custkey)
""")
def order_gap_risk(t):
    """Days between orders, and whether a customer's mean gap marks a risk.

    Gaps add up to the span from first to last order, so their mean needs no window.
    """
    dates = order_dates(t)
    steps = over_ordered(
        dates, IN_TIME, group=["o_custkey"], lag={"previous_order_date": "order_date"}
    )
    span = F.datediff(F.max("order_date"), F.min("order_date"))
    habits = dates.groupBy(F.col("o_custkey").alias("of")).agg(
        F.count("*").alias("n"), span.alias("span")
    )
    risky = F.col("span") > F.lit(RISK_GAP_DAYS) * (F.col("n") - 1)
    joined = steps.join(habits.filter("n > 1"), on("o_custkey", "of"))
    gap = F.datediff("order_date", "previous_order_date").cast("bigint")
    return joined.select(
        "o_custkey", "o_orderkey", "order_date", "previous_order_date",
        gap.alias("days_gap"),
        F.when(risky, "At Risk").otherwise("Normal").alias("risk_flag"),
    )


# --- calendars ---------------------------------------------------------------------------
# Windows below run over one row per month or day, which the calendar bounds.

MONTHLY = f"""
SELECT date_trunc('month', o_orderdate) AS m, SUM({sql.TOTAL}) AS revenue, {sql.count()} AS n
FROM orders WHERE {sql.FULFILLED} GROUP BY 1
"""


def monthly(orders):
    return orders.groupBy(month_of("o_orderdate").alias("m")).agg(money_sum("o_totalprice").alias("revenue"))


@query(f"""
WITH m AS ({MONTHLY})
SELECT strftime(m, '%Y-%m') AS month, {sql.amount('revenue')} AS revenue,
       {sql.amount('SUM(revenue) OVER (ORDER BY m)')} AS cumulative_revenue FROM m
""")
def cumulative_revenue(t):
    so_far = Window.orderBy("m").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    months = monthly(fulfilled(t.orders))
    return months.select(
        month_label(F.col("m")).alias("month"),
        amount(F.col("revenue")).alias("revenue"),
        amount(F.sum("revenue").over(so_far)).alias("cumulative_revenue"),
    )


@query(f"""
WITH m AS ({MONTHLY}), w AS (SELECT *, SUM(revenue) OVER r AS s, COUNT(*) OVER r AS k FROM m
       WINDOW r AS (ORDER BY m ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))
SELECT strftime(m, '%Y-%m') AS month, {sql.amount('revenue')} AS revenue,
       {sql.ratio('s', 'k')} AS rolling_3mo_avg FROM w
""")
def rolling_avg_3m(t):
    recent = Window.orderBy("m").rowsBetween(-2, Window.currentRow)
    months = monthly(fulfilled(t.orders))
    mean = ratio(F.sum("revenue").over(recent), F.count("*").over(recent))
    return months.select(
        month_label(F.col("m")).alias("month"),
        amount(F.col("revenue")).alias("revenue"),
        mean.alias("rolling_3mo_avg"),
    )


@query(f"""
WITH m AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       SUM({sql.TOTAL}) AS revenue FROM orders GROUP BY 1, 2)
SELECT m.year, m.month, {sql.amount('m.revenue')} AS revenue, {sql.amount('p.revenue')} AS prev_year_revenue,
       {sql.percent('CAST(m.revenue AS DOUBLE) - CAST(p.revenue AS DOUBLE)', 'p.revenue')} AS yoy_growth_percent
FROM m LEFT JOIN m p ON p.year = m.year - 1 AND p.month = m.month
""")
def yoy_revenue(t):
    """Each month beside the same month a year before, a self-join on a shifted key."""
    months = monthly(t.orders).select(
        F.year("m").alias("year"), F.month("m").alias("month"), "revenue"
    )
    before = months.select(
        (F.col("year") + 1).alias("y"), F.col("month").alias("mo"), F.col("revenue").alias("earlier")
    )
    joined = months.join(before, on("year", "y") & on("month", "mo"), "left")
    return joined.select(
        "year", "month",
        amount(F.col("revenue")).alias("revenue"),
        amount(F.col("earlier")).alias("prev_year_revenue"),
        percent_change(F.col("earlier"), F.col("revenue")).alias("yoy_growth_percent"),
    )


@query(f"""
WITH d AS (SELECT r_name AS region, CAST(o_orderdate AS DATE) AS order_date, SUM({sql.TOTAL}) AS revenue
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2)
SELECT region, order_date, {sql.amount('revenue')} AS daily_revenue,
       {sql.amount('SUM(revenue) OVER (PARTITION BY region ORDER BY order_date ROWS UNBOUNDED PRECEDING)')} AS running_total
FROM d
""")
def running_revenue_region(t):
    """Orders collapse to one row per (customer, day) before they meet the dimensions."""
    daily = t.orders.groupBy("o_custkey", day("o_orderdate").alias("order_date")).agg(
        money_sum("o_totalprice").alias("spend")
    )
    placed = by_region(t, daily).groupBy(F.col("r_name").alias("region"), "order_date")
    days = placed.agg(F.sum("spend").alias("revenue"))
    so_far = Window.partitionBy("region").orderBy("order_date").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return days.select(
        "region", "order_date",
        amount(F.col("revenue")).alias("daily_revenue"),
        amount(F.sum("revenue").over(so_far)).alias("running_total"),
    )
