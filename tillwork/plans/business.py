"""Customer, product and order reports."""

from datetime import date

from pyspark.sql import Window
from pyspark.sql import functions as F

from tillwork.functions.dates import day, month_label, month_of, months_between, preceding, period, within
from tillwork.functions.money import amount, money_sum, percent, percent_change, ratio, revenue_sum
from tillwork.operators.joins import having_match, lacking_match
from tillwork.plans import sql
from tillwork.plans.aggregating import ORDER_TOTALS, customer_sales, sales_per_part
from tillwork.plans.catalog import (
    AS_OF,
    MONTHLY_CUTS,
    SEGMENT_CUTS,
    fulfilled,
    query,
    tier,
)
from tillwork.plans.joining import on
from tillwork.sources.shared import pin


# --- customers ---------------------------------------------------------------------------

SPEND = f"""
SELECT c_custkey, c_name, n_name AS city, {sql.count()} AS total_orders, SUM({sql.TOTAL}) AS spend,
       MAX(CAST(o_orderdate AS DATE)) AS last_order_date
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE {sql.FULFILLED} GROUP BY 1, 2, 3
"""
SEGMENT = sql.tier("spend", SEGMENT_CUTS, "Low Value")


def spend_rows(t):
    """Fulfilled orders are summed per customer before names and cities are attached."""
    spend = fulfilled(t.orders).groupBy("o_custkey").agg(
        F.count("*").alias("total_orders"),
        money_sum("o_totalprice").alias("spend"),
        F.max(day("o_orderdate")).alias("last_order_date"),
    )
    named = spend.join(t.customer, on("o_custkey", "c_custkey")).join(
        t.nation, on("c_nationkey", "n_nationkey")
    )
    return named.select(
        "c_custkey", "c_name", F.col("n_name").alias("city"), "total_orders", "spend", "last_order_date"
    )


def segment():
    return tier(F.col("spend"), SEGMENT_CUTS, "Low Value").alias("customer_segment")


@query(f"""
WITH s AS ({SPEND})
SELECT c_custkey, c_name, city, total_orders, {sql.amount('spend')} AS lifetime_spend, last_order_date,
       {SEGMENT} AS customer_segment FROM s
""")
def customer_360(t):
    return spend_rows(t).select(
        "c_custkey", "c_name", "city", "total_orders",
        amount(F.col("spend")).alias("lifetime_spend"), "last_order_date", segment(),
    )


@query(f"""
WITH s AS ({SPEND})
SELECT c_custkey, c_name, {sql.amount('spend')} AS lifetime_spend, total_orders, {SEGMENT} AS customer_segment
FROM s ORDER BY spend DESC, c_custkey LIMIT 20
""")
def customer_segments(t):
    top = spend_rows(t).orderBy(F.desc("spend"), "c_custkey").limit(20)
    return top.select(
        "c_custkey", "c_name", amount(F.col("spend")).alias("lifetime_spend"), "total_orders", segment()
    )


@query(f"WITH s AS ({SPEND}) SELECT {SEGMENT} AS customer_segment, {sql.count()} AS num_customers FROM s GROUP BY 1")
def segment_counts(t):
    return spend_rows(t).groupBy(segment()).agg(F.count("*").alias("num_customers"))


@query(f"""
WITH s AS ({SPEND})
SELECT c_custkey, c_name, city, total_orders, {sql.amount('spend')} AS lifetime_spend,
       {sql.ratio('spend', 'total_orders')} AS avg_order_value FROM s ORDER BY spend DESC, c_custkey LIMIT 10
""")
def customer_lifetime(t):
    top = spend_rows(t).orderBy(F.desc("spend"), "c_custkey").limit(10)
    return top.select(
        "c_custkey", "c_name", "city", "total_orders",
        amount(F.col("spend")).alias("lifetime_spend"),
        ratio(F.col("spend"), F.col("total_orders")).alias("avg_order_value"),
    )


@query(f"""
WITH s AS ({SPEND})
SELECT c_custkey, c_name, {sql.amount('spend')} AS lifetime_spend, last_order_date,
       CAST(DATE '{AS_OF}' - last_order_date AS BIGINT) AS days_since FROM s
WHERE spend >= 2500000 AND DATE '{AS_OF}' - last_order_date > 365
""")
def churn_candidates(t):
    """Customers worth keeping who have not ordered for a year."""
    since = F.datediff(F.lit(AS_OF), "last_order_date").cast("bigint").alias("days_since")
    rows = spend_rows(t).select(
        "c_custkey", "c_name", "spend", "last_order_date", since
    ).filter("spend >= 2500000 and days_since > 365")
    return rows.withColumn("lifetime_spend", amount(F.col("spend"))).drop("spend")


@query("""
WITH n AS (SELECT o_custkey, CAST(COUNT(DISTINCT o_orderkey) AS BIGINT) AS num_orders FROM orders GROUP BY o_custkey)
SELECT c_custkey, c_name, c_mktsegment, num_orders FROM n JOIN customer ON o_custkey = c_custkey
WHERE num_orders = 1
""")
def single_order_customers(t):
    counts = t.orders.groupBy("o_custkey").agg(F.countDistinct("o_orderkey").alias("num_orders"))
    one = counts.filter("num_orders = 1").join(t.customer, on("o_custkey", "c_custkey"))
    return one.select("c_custkey", "c_name", "c_mktsegment", "num_orders")


@query(f"""
WITH s AS ({ORDER_TOTALS}), a AS (SELECT CAST(SUM(total_sales) AS DOUBLE) / COUNT(total_sales) AS mean FROM s)
SELECT c_custkey, c_name, c_mktsegment, {sql.amount('total_sales')} AS total_sales,
       {sql.amount('CAST(total_sales - CAST(mean AS DECIMAL(18,6)) AS DECIMAL(18,6))')} AS diff_from_avg
FROM s JOIN customer ON o_custkey = c_custkey, a WHERE total_sales > mean
""")
def above_avg_diff(t):
    sales = customer_sales(t)
    mean = sales.agg(F.sum("total_sales").cast("double") / F.count("total_sales")).scalar()
    above = sales.filter(F.col("total_sales").cast("double") > mean)
    difference = (F.col("total_sales") - mean.cast("decimal(18,6)")).cast("decimal(18,6)")
    named = above.withColumn("diff_from_avg", amount(difference)).join(
        t.customer, on("o_custkey", "c_custkey")
    )
    return named.select(
        "c_custkey", "c_name", "c_mktsegment", amount(F.col("total_sales")).alias("total_sales"), "diff_from_avg"
    )


@query("""
SELECT DISTINCT o_custkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey
WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_custkey IS NOT NULL)
""")
def never_delivered_customers(t):
    """One look at each customer's orders decides, instead of a join of orders with orders."""
    done = F.bool_or(F.col("o_orderstatus") == "F")
    habits = t.orders.filter(F.col("o_custkey").isNotNull()).groupBy("o_custkey").agg(
        F.coalesce(done, F.lit(False)).alias("delivered")
    )
    named = habits.filter("not delivered").join(t.customer, on("o_custkey", "c_custkey"))
    return named.select("o_custkey", "c_name")


@query(f"""
SELECT o_custkey, c_name, {sql.amount(f'SUM({sql.REV})')} AS total_order_value
FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
GROUP BY o_custkey, c_name ORDER BY SUM({sql.REV}) DESC, o_custkey LIMIT 10
""")
def top10_customers_value(t):
    known = having_match(value_per_customer(t), t.customer, "o_custkey", "c_custkey")
    top = known.orderBy(F.desc("value"), "o_custkey").limit(10)
    named = top.join(t.customer, on("o_custkey", "c_custkey"))
    return named.select("o_custkey", "c_name", amount(F.col("value")).alias("total_order_value"))


def order_values(t):
    """Line revenue per order, with the order's customer and date."""
    per_order = t.lineitem.groupBy("l_orderkey").agg(revenue_sum().alias("value"))
    return per_order.join(t.orders, on("l_orderkey", "o_orderkey")).select(
        "o_orderkey", "o_custkey", day("o_orderdate").alias("order_date"), "value"
    )


def value_per_customer(t):
    return order_values(t).groupBy("o_custkey").agg(F.sum("value").alias("value"))


@query(f"""
SELECT o_custkey, {sql.amount(f'SUM({sql.REV})')} AS total_value
FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_custkey
""")
def customer_ltv(t):
    return value_per_customer(t).select("o_custkey", amount(F.col("value")).alias("total_value"))


@query(f"""
WITH m AS (SELECT o_custkey, date_trunc('month', o_orderdate) AS month, SUM({sql.TOTAL}) AS revenue
           FROM orders GROUP BY 1, 2)
SELECT strftime(month, '%Y-%m') AS year_month, {sql.tier('revenue', MONTHLY_CUTS, 'Low')} AS tier,
       {sql.count('DISTINCT o_custkey')} AS customer_count FROM m GROUP BY 1, 2
""")
def monthly_tier_counts(t):
    """One row per (customer, month) already, so a plain count is a distinct count."""
    months = t.orders.groupBy("o_custkey", month_of("o_orderdate").alias("m")).agg(
        money_sum("o_totalprice").alias("revenue")
    )
    label = tier(F.col("revenue"), MONTHLY_CUTS, "Low").alias("tier")
    return months.groupBy("m", label).agg(F.count("o_custkey").alias("customer_count")).select(
        month_label(F.col("m")).alias("year_month"), "tier", "customer_count"
    )


@query(f"""
WITH b AS (SELECT o_custkey, p_type, (o_orderdate, o_orderkey, l_linenumber, l_partkey) AS place FROM orders
    JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey WHERE o_custkey IS NOT NULL),
c AS (SELECT o_custkey, arg_min_null(p_type, place) AS first_category, arg_max_null(p_type, place) AS last_category
      FROM b GROUP BY o_custkey)
SELECT *, CASE WHEN first_category <> last_category THEN 'Yes' ELSE 'No' END AS category_shift FROM c
""")
def category_shift(t):
    """First and last category bought.

    min_by and max_by combine before each shuffle: lines shrink to the two ends of their
    order, and orders to the two ends of their customer.
    """
    lines = t.lineitem.join(t.part, on("l_partkey", "p_partkey"))
    place = F.struct("l_linenumber", "l_partkey")
    per_order = lines.groupBy("l_orderkey").agg(
        F.min_by("p_type", place).alias("first"), F.max_by("p_type", place).alias("last")
    )
    buyers = t.orders.filter(F.col("o_custkey").isNotNull())
    dated = per_order.join(buyers, on("l_orderkey", "o_orderkey"))
    when = F.struct("o_orderdate", "o_orderkey")
    ends = dated.groupBy("o_custkey").agg(
        F.min_by("first", when).alias("first_category"),
        F.max_by("last", when).alias("last_category"),
    )
    moved = F.when(F.col("first_category") != F.col("last_category"), "Yes").otherwise("No")
    return ends.withColumn("category_shift", moved)


def _offset_columns():
    active = "COUNT(*) FILTER (WHERE month_offset = {0})"
    plain = ", ".join(f"CAST({active.format(i)} AS BIGINT) AS month_{i}_active" for i in range(4))
    shares = ", ".join(
        f"{sql.percent(active.format(i), 'MAX(cohort_size)')} AS retention_month_{i}_pct" for i in range(1, 4)
    )
    return f"{plain}, {shares}"


@query(f"""
WITH f AS (SELECT o_custkey, date_trunc('month', MIN(o_orderdate)) AS cohort FROM orders
    WHERE o_custkey IS NOT NULL GROUP BY 1),
s AS (SELECT cohort, COUNT(*) AS cohort_size FROM f GROUP BY 1),
m AS (SELECT DISTINCT o_custkey, date_trunc('month', o_orderdate) AS active_month FROM orders),
a AS (SELECT cohort, (year(active_month) - year(cohort)) * 12 + month(active_month) - month(cohort)
      AS month_offset FROM f JOIN m USING (o_custkey))
SELECT strftime(cohort, '%Y-%m') AS cohort_month, CAST(MAX(cohort_size) AS BIGINT) AS cohort_size,
       {_offset_columns()} FROM a JOIN s USING (cohort) WHERE month_offset >= 0 GROUP BY cohort
""")
def cohort_retention(t):
    """Share of a first-order cohort that orders again one to three months later.

    Rows collapse to one per (customer, month) first; the cohort is the earliest of a
    customer's months, and joins back one row per customer.
    """
    months = t.orders.filter(F.col("o_custkey").isNotNull()).select(
        "o_custkey", month_of("o_orderdate").alias("month")
    ).distinct()
    cohorts = months.groupBy(F.col("o_custkey").alias("who")).agg(F.min("month").alias("cohort"))
    active = months.join(cohorts, on("o_custkey", "who"))
    offset = months_between(F.col("cohort"), F.col("month"))
    counts = [F.count_if(offset == i).alias(f"month_{i}_active") for i in range(4)]
    grouped = active.groupBy("cohort").agg(*counts)
    # Everyone is active in the month that defines the cohort.
    size = F.col("month_0_active")
    shares = [
        percent(F.col(f"month_{i}_active"), size).alias(f"retention_month_{i}_pct") for i in range(1, 4)
    ]
    return grouped.select(
        month_label(F.col("cohort")).alias("cohort_month"),
        size.alias("cohort_size"),
        *[f"month_{i}_active" for i in range(4)],
        *shares,
    )


# --- products ----------------------------------------------------------------------------

SIGNED = "CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END"


def flow_per_part(t):
    """Units bought and returned per part."""
    back = F.col("l_returnflag") == "R"
    units = F.col("l_quantity").cast("bigint")
    return t.lineitem.groupBy("l_partkey").agg(
        F.coalesce(F.sum(F.when(~back, units)), F.lit(0)).alias("total_purchased"),
        F.coalesce(F.sum(F.when(back, units)), F.lit(0)).alias("total_returned"),
    )


@query(f"""
WITH s AS (SELECT l_partkey, {SIGNED} AS q FROM lineitem)
SELECT p_partkey, p_name, {sql.total('CASE WHEN q > 0 THEN q ELSE 0 END')} AS total_purchased,
       {sql.total('CASE WHEN q < 0 THEN -q ELSE 0 END')} AS total_returned
FROM s JOIN part ON l_partkey = p_partkey GROUP BY 1, 2 HAVING total_returned > total_purchased
""")
def over_returned_products(t):
    worse = flow_per_part(t).filter("total_returned > total_purchased")
    named = worse.join(t.part, on("l_partkey", "p_partkey"))
    return named.select("p_partkey", "p_name", "total_purchased", "total_returned")


@query(f"""
WITH s AS (SELECT p_type AS category, {SIGNED} AS q FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT category, {sql.total('CASE WHEN q < 0 THEN -q ELSE 0 END')} AS returned_items,
       {sql.total('ABS(q)')} AS total_items,
       {sql.ratio('SUM(CASE WHEN q < 0 THEN -q ELSE 0 END)', 'SUM(ABS(q))', 4)} AS return_rate
FROM s GROUP BY category
""")
def return_rate(t):
    named = flow_per_part(t).join(t.part, on("l_partkey", "p_partkey"))
    grouped = named.groupBy(F.col("p_type").alias("category")).agg(
        F.sum("total_returned").alias("returned_items"),
        F.sum(F.col("total_returned") + F.col("total_purchased")).alias("total_items"),
    )
    rate = ratio(F.col("returned_items"), F.col("total_items"), 4)
    return grouped.withColumn("return_rate", rate)


@query(f"""
SELECT p_type AS category, {sql.count()} AS num_orders, {sql.amount(f'SUM({sql.REV})')} AS total_revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
WHERE {sql.FULFILLED} GROUP BY 1
""")
def fulfilled_category_revenue(t):
    named = fulfilled_parts(t).join(t.part, on("l_partkey", "p_partkey"))
    return named.groupBy(F.col("p_type").alias("category")).agg(
        F.sum("lines").alias("num_orders"), amount(F.sum("revenue")).alias("total_revenue")
    )


def fulfilled_parts(t):
    done = fulfilled(t.orders).select("o_orderkey")
    return sales_per_part(t.lineitem.join(done, on("l_orderkey", "o_orderkey"), "left_semi"))


@query(f"""
WITH l AS (SELECT l_orderkey, l_partkey, p_name FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT least(x.p_name, y.p_name) AS product_a, greatest(x.p_name, y.p_name) AS product_b,
       {sql.count()} AS times_bought_together
FROM l x JOIN l y ON x.l_orderkey = y.l_orderkey AND x.l_partkey < y.l_partkey
GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 50
""")
def bought_together(t):
    """Product names sold in one order: how many pairs of lines with two products.

    Pairs of lines are counted, not built: an order shrinks to one row per name, n lines of
    which ``same`` pairs (ordered, with itself) share a product. Two names then meet n_a * n_b
    times, and a name meets itself (n * n - same) / 2 times. Only names that can be in the
    result are paired, by a join on the order that AQE can split; no basket is gathered.
    """
    lines = t.lineitem.filter(F.col("l_orderkey").isNotNull())
    parts = lines.groupBy("l_orderkey", "l_partkey").agg(F.count("*").alias("n"))
    named = parts.join(t.part, on("l_partkey", "p_partkey")).groupBy("l_orderkey", "p_name").agg(
        F.sum(F.col("n") * F.col("n")).alias("same"), F.sum("n").alias("n")
    )
    counted = pairs_of(named.filter(F.col("p_name").isNotNull()), BASKET_PAIRS)
    return counted.orderBy(F.desc("times_bought_together"), "product_a", "product_b").limit(BASKET_PAIRS)


BASKET_PAIRS = 50


def _meetings(named):
    """How often each two names of ``named`` (l_orderkey, p_name, n, same) meet."""
    a, b = named.alias("a"), named.alias("b")
    met = a.join(b, on("a.l_orderkey", "b.l_orderkey") & (F.col("a.p_name") <= F.col("b.p_name")))
    itself = F.expr("(a.n * a.n - a.same) div 2")
    times = F.when(F.col("a.p_name") == F.col("b.p_name"), itself).otherwise(F.col("a.n") * F.col("b.n"))
    counted = met.groupBy(
        F.col("a.p_name").alias("product_a"), F.col("b.p_name").alias("product_b")
    ).agg(F.sum(times).alias("times_bought_together"))
    return counted.filter("times_bought_together > 0")


def pairs_of(named, wanted: int):
    """The meetings of all names that can be among the ``wanted`` most frequent pairs.

    In an order a name meets another no oftener than its lines times the most lines of any name
    there, which bounds every pair from above by each of its names. The names with the highest
    bounds give exact counts, the last of which bounds the result from below; names that stay
    under that go before any pairing.
    """
    named = pin(named, "baskets")
    whole = named.groupBy(F.col("l_orderkey").alias("order")).agg(F.max("n").alias("top"))
    meets = F.col("n") * F.col("top")
    most = named.join(whole, on("l_orderkey", "order")).groupBy(F.col("p_name").alias("name")).agg(
        F.sum(meets).alias("most")
    )
    most = pin(most, "meetings")
    few = most.orderBy(F.desc("most"), "name").limit(2 * wanted).select("name")
    first = _meetings(named.join(few, on("p_name", "name"), "left_semi"))
    ranked = first.orderBy(F.desc("times_bought_together")).limit(wanted)
    bound = ranked.agg(
        F.when(F.count("*") == wanted, F.min("times_bought_together")).otherwise(0)
    ).scalar()
    hopeful = most.filter(F.col("most") >= bound).select("name")
    return _meetings(named.join(hopeful, on("p_name", "name"), "left_semi"))


# --- orders ------------------------------------------------------------------------------

@query(f"""
SELECT strftime(o_orderdate, '%Y-%m') AS year_month, {sql.count()} AS order_count FROM orders
WHERE o_orderdate >= (SELECT MAX(o_orderdate) FROM orders) - INTERVAL 12 MONTH GROUP BY 1
""")
def orders_last_12_months(t):
    """The whole bound is one scalar subquery, so the filter on the column reaches the scan."""
    year_before = F.max("o_orderdate") - F.expr("interval 12 months")
    since = t.orders.agg(year_before.alias("since")).scalar()
    recent = t.orders.filter(F.col("o_orderdate") >= since)
    grouped = recent.groupBy(month_of("o_orderdate").alias("m")).agg(F.count("*").alias("order_count"))
    return grouped.select(month_label(F.col("m")).alias("year_month"), "order_count").orderBy("year_month")


@query(f"""
WITH p AS (SELECT DISTINCT l_orderkey FROM lineitem), f AS (SELECT COUNT(*) AS total_orders,
  COUNT(*) FILTER (WHERE o_orderstatus IN ('O', 'P', 'F')) AS processing,
  COUNT(*) FILTER (WHERE o_orderstatus IN ('P', 'F')) AS shipped,
  COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS delivered,
  COUNT(*) FILTER (WHERE o_orderstatus = 'F' AND l_orderkey IS NOT NULL) AS paid_delivery
  FROM orders LEFT JOIN p ON o_orderkey = l_orderkey)
SELECT CAST(total_orders AS BIGINT) AS total_orders, CAST(processing AS BIGINT) AS processing,
  {sql.percent('processing', 'total_orders', 1)} AS pct_processing, CAST(shipped AS BIGINT) AS shipped,
  {sql.percent('shipped', 'total_orders', 1)} AS pct_shipped, CAST(delivered AS BIGINT) AS delivered,
  {sql.percent('delivered', 'total_orders', 1)} AS pct_delivered, CAST(paid_delivery AS BIGINT) AS paid_delivery,
  {sql.percent('paid_delivery', 'total_orders', 1)} AS pct_paid_delivery FROM f
""")
def order_funnel(t):
    """How many orders reach each stage. An order counts as paid once it has lines."""
    unpaid = lacking_match(
        t.orders.filter("o_orderstatus = 'F'"), t.lineitem, "o_orderkey", "l_orderkey"
    ).agg(F.count("*")).scalar()
    status = F.col("o_orderstatus")
    totals = t.orders.agg(
        F.count("*").alias("total_orders"),
        F.count_if(status.isin("O", "P", "F")).alias("processing"),
        F.count_if(status.isin("P", "F")).alias("shipped"),
        F.count_if(status == "F").alias("delivered"),
    ).withColumn("paid_delivery", F.col("delivered") - unpaid)
    stages = ["processing", "shipped", "delivered", "paid_delivery"]
    shares = [percent(F.col(s), F.col("total_orders"), 1).alias(f"pct_{s}") for s in stages]
    return totals.select("total_orders", *stages, *shares)


@query(f"""
WITH m AS (SELECT date_trunc('month', o_orderdate) AS month, o_orderstatus, COUNT(*) AS n FROM orders GROUP BY 1, 2),
w AS (SELECT month, SUM(n) AS whole FROM m GROUP BY month)
SELECT strftime(m.month, '%Y-%m') AS month, o_orderstatus, CAST(n AS BIGINT) AS num_orders,
       CAST(whole AS BIGINT) AS month_total, {sql.percent('n', 'whole', 1)} AS pct_of_month
FROM m JOIN w ON m.month = w.month WHERE o_orderstatus = 'F'
""")
def monthly_delivered_share(t):
    months = t.orders.groupBy(month_of("o_orderdate").alias("m"), "o_orderstatus").agg(
        F.count("*").alias("num_orders")
    )
    whole = months.groupBy(F.col("m").alias("of")).agg(F.sum("num_orders").alias("month_total"))
    joined = months.filter("o_orderstatus = 'F'").join(whole, on("m", "of"))
    return joined.select(
        month_label(F.col("m")).alias("month"), "o_orderstatus", "num_orders", "month_total",
        percent(F.col("num_orders"), F.col("month_total"), 1).alias("pct_of_month"),
    )


@query(f"""
WITH s AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day, event_type FROM events)
SELECT day, {sql.count('DISTINCT user_id')} AS users,
       CAST(COUNT(*) FILTER (WHERE event_type = 'view') AS BIGINT) AS viewed,
       CAST(COUNT(*) FILTER (WHERE event_type = 'click') AS BIGINT) AS clicked,
       CAST(COUNT(*) FILTER (WHERE event_type = 'signup') AS BIGINT) AS signed_up,
       CAST(COUNT(*) FILTER (WHERE event_type = 'purchase') AS BIGINT) AS purchased
FROM s GROUP BY day
""")
def event_funnel(t):
    """Users per day who reach each stage of a visit."""
    kind = F.col("event_type")
    visits = t.events.groupBy("user_id", F.col("ts").cast("date").alias("day")).agg(
        *[F.bool_or(kind == k).alias(k) for k in ("view", "click", "signup", "purchase")]
    )
    return visits.groupBy("day").agg(
        F.count("*").alias("users"),
        F.count_if("view").alias("viewed"),
        F.count_if("click").alias("clicked"),
        F.count_if("signup").alias("signed_up"),
        F.count_if("purchase").alias("purchased"),
    )


# --- period report -----------------------------------------------------------------------

REPORT_DAY = date(1998, 6, 17)
KINDS = ["daily", "weekly", "monthly"]
TOP = 3


def _bounds(kind: str):
    start, end = period(kind, F.lit(REPORT_DAY))
    return start, end, *preceding(start, end)


def marked_orders(t):
    """The orders of the widest range, marked for each report as of now or of the time before."""
    bounds = {kind: _bounds(kind) for kind in KINDS}
    first = F.least(*[before for _, _, before, _ in bounds.values()])
    last = F.greatest(*[end for _, end, _, _ in bounds.values()])
    placed = day("o_orderdate")
    marks = {}
    for kind, (start, end, before, before_end) in bounds.items():
        marks[f"{kind}_now"] = placed.between(start, end)
        marks[f"{kind}_before"] = placed.between(before, before_end)
    chosen = t.orders.filter(within("o_orderdate", first, last))
    return chosen.select("o_orderkey", "o_custkey", *[m.alias(name) for name, m in marks.items()])


SIDES = [f"{kind}_{side}" for kind in KINDS for side in ("now", "before")]


def product_sales(t, chosen):
    """Revenue per product name and mark, from one scan of the order lines."""
    lines = t.lineitem.join(chosen, on("l_orderkey", "o_orderkey"))
    sums = [revenue_sum(where=F.col(side)).alias(side) for side in SIDES]
    named = lines.groupBy("l_partkey").agg(*sums).join(t.part, on("l_partkey", "p_partkey"), "left")
    return named.groupBy(F.col("p_name").alias("product")).agg(*[F.sum(s).alias(s) for s in SIDES])


def top_products(sales):
    """The products of each report that earn most: report, rank, product, total."""
    totals = [F.struct(F.lit(k).alias("report"), F.col(f"{k}_now").alias("total")) for k in KINDS]
    long = sales.filter("product is not null").select("product", F.inline(F.array(*totals)))
    order = Window.partitionBy("report").orderBy(F.desc("total"), "product")
    ranked = long.filter("total is not null").withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= TOP)


def _top_sql(kind: str) -> str:
    start, end = f"({_range_sql(kind)[0]})", f"({_range_sql(kind)[1]})"
    return f"""
SELECT '{kind}' AS report, ROW_NUMBER() OVER (ORDER BY SUM({sql.REV}) DESC, p_name) AS rank,
       p_name AS product, SUM({sql.REV}) AS total
FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey
WHERE CAST(o_orderdate AS DATE) BETWEEN {start} AND {end} GROUP BY p_name QUALIFY rank <= {TOP}"""


def _range_sql(kind: str) -> tuple[str, str, str, str]:
    at = f"DATE '{REPORT_DAY}'"
    start = {"daily": at, "weekly": f"CAST(date_trunc('week', {at}) AS DATE)",
             "monthly": f"CAST(date_trunc('month', {at}) AS DATE)"}[kind]
    end = {"daily": at, "weekly": f"{start} + 6", "monthly": f"last_day({at})"}[kind]
    return start, end, f"{start} - 1 - CAST({end} - {start} AS INTEGER)", f"{start} - 1"


def _report_sql(kind: str) -> str:
    start, end, before, before_end = _range_sql(kind)

    def part(name, first, last):
        days = f"CAST(o_orderdate AS DATE) BETWEEN {first} AND {last}"
        return (
            f"{name} AS (SELECT COUNT(DISTINCT o_orderkey) AS orders, COUNT(DISTINCT o_custkey) AS customers,"
            f" (SELECT COALESCE(SUM({sql.REV}), 0) FROM orders JOIN lineitem ON o_orderkey = l_orderkey"
            f" WHERE {days}) AS revenue FROM orders WHERE {days})"
        )

    changes = ", ".join(
        f"{sql.percent(f'CAST(n.{c} AS DOUBLE) - CAST(p.{c} AS DOUBLE)', f'p.{c}')} AS {c}_change_pct"
        for c in ("orders", "revenue", "customers")
    )
    return (
        f"WITH {part('n', start, end)}, {part('p', before, before_end)}, b AS ({_top_sql(kind)}) SELECT '{kind}' AS report,"
        f" CAST({start} AS DATE) AS start_date, CAST({end} AS DATE) AS end_date, CAST(n.orders AS BIGINT) AS total_orders,"
        f" {sql.amount('n.revenue')} AS total_revenue, CAST(n.customers AS BIGINT) AS unique_customers,"
        f" {changes}, COALESCE((SELECT STRING_AGG(product, ', ' ORDER BY rank) FROM b), '') AS top_products FROM n, p"
    )


@query(" UNION ALL ".join(f"SELECT * FROM ({_report_sql(kind)})" for kind in KINDS))
def period_report(t):
    """Totals of a day, a week and a month, their change against the time before, best products.

    Orders shrink to one row per customer before they are counted; order keys are unique.
    """
    chosen = marked_orders(t)
    per_customer = chosen.groupBy("o_custkey").agg(*[F.count_if(s).alias(s) for s in SIDES])
    known = F.col("o_custkey").isNotNull()
    counts = per_customer.agg(
        *[F.coalesce(F.sum(s), F.lit(0)).alias(f"orders_{s}") for s in SIDES],
        *[F.count_if(known & (F.col(s) > 0)).alias(f"customers_{s}") for s in SIDES],
    )
    sales = product_sales(t, chosen)
    zero = F.lit(0).cast("decimal(38,6)")
    money = sales.agg(*[F.coalesce(F.sum(s), zero).alias(f"revenue_{s}") for s in SIDES])
    best = top_products(sales).groupBy("report").agg(
        F.sort_array(F.collect_list(F.struct("rank", "product"))).alias("best")  # TOP of them
    )

    def line(kind: str):
        start, end = period(kind, F.lit(REPORT_DAY))
        now = lambda what: F.col(f"{what}_{kind}_now")
        changes = [
            percent_change(F.col(f"{what}_{kind}_before"), now(what)).alias(f"{what}_change_pct")
            for what in ("orders", "revenue", "customers")
        ]
        return F.struct(
            F.lit(kind).alias("report"),
            start.alias("start_date"),
            end.alias("end_date"),
            now("orders").alias("total_orders"),
            amount(now("revenue")).alias("total_revenue"),
            now("customers").alias("unique_customers"),
            *changes,
        )

    earned = money.select(F.struct(*money.columns)).scalar()
    totals = counts.withColumn("earned", earned).select("*", "earned.*")
    reports = totals.select(F.inline(F.array(*map(line, KINDS))))
    names = F.array_join(F.transform("best", lambda b: b["product"]), ", ")
    joined = reports.join(best.withColumnRenamed("report", "of"), on("report", "of"), "left")
    return joined.select(*reports.columns, F.coalesce(names, F.lit("")).alias("top_products"))


@query(
    f"SELECT report, CAST(rank AS INTEGER) AS rank, product, {sql.amount('total')} AS revenue FROM ("
    + " UNION ALL ".join(f"({_top_sql(kind)})" for kind in KINDS)
    + ")"
)
def period_top_products(t):
    best = top_products(product_sales(t, marked_orders(t)))
    return best.select("report", "rank", "product", amount(F.col("total")).alias("revenue"))
