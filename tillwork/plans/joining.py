"""Join and set-operation queries."""

from pyspark.sql import functions as F

from tillwork.functions.money import amount, money_sum, revenue, revenue_sum
from tillwork.operators import joins
from tillwork.plans import raw, sql
from tillwork.plans.catalog import fulfilled, query


def on(left: str, right: str):
    return F.col(left) == F.col(right)


CUSTOMER_ORDERS = ["c_custkey", "c_name", "o_orderkey", "o_orderdate"]
CUSTOMER_ORDERS_SQL = ", ".join(CUSTOMER_ORDERS)


def finished(t):
    return t.orders.filter("o_orderstatus = 'F'")


# --- inner joins -------------------------------------------------------------------------

@query(
    "SELECT o_orderkey, o_orderdate, c_name, o_totalprice FROM orders JOIN customer"
    " ON o_custkey = c_custkey"
)
def join_inner(t):
    joined = t.orders.join(t.customer, on("o_custkey", "c_custkey"))
    return joined.select("o_orderkey", "o_orderdate", "c_name", "o_totalprice")


@query(f"""
SELECT l_linenumber, o_orderkey, o_orderdate, p_name, p_type, l_quantity, l_discount,
       l_extendedprice AS subtotal_before_discount, {sql.amount(sql.REV)} AS subtotal_after_discount
FROM orders, lineitem, part WHERE o_orderkey = l_orderkey AND l_partkey = p_partkey
""")
def join_three_way(t):
    joined = t.lineitem.join(t.orders, on("l_orderkey", "o_orderkey")).join(
        t.part, on("l_partkey", "p_partkey")
    )
    return joined.select(
        "l_linenumber", "o_orderkey", "o_orderdate", "p_name", "p_type", "l_quantity", "l_discount",
        F.col("l_extendedprice").alias("subtotal_before_discount"),
        revenue().alias("subtotal_after_discount"),
    )


@query(f"""
SELECT c_name, o_orderkey, o_orderdate, p_name, p_type, l_quantity, {sql.amount(sql.REV)} AS line_total,
       o_orderstatus
FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON o_orderkey = l_orderkey
JOIN part ON l_partkey = p_partkey WHERE o_orderstatus = 'F'
""")
def join_four_way(t):
    joined = (
        t.lineitem.join(finished(t), on("l_orderkey", "o_orderkey"))
        .join(t.customer, on("o_custkey", "c_custkey"))
        .join(t.part, on("l_partkey", "p_partkey"))
    )
    return joined.select(
        "c_name", "o_orderkey", "o_orderdate", "p_name", "p_type", "l_quantity",
        revenue().alias("line_total"), "o_orderstatus",
    )


@query(f"""
WITH paid AS (SELECT l_orderkey, SUM({sql.REV}) AS paid, {sql.count()} AS lines
              FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey, o_orderdate, o_orderstatus, c_custkey, c_name, n_name AS city, lines,
       {sql.amount('paid')} AS paid
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN paid ON o_orderkey = l_orderkey
""")
def customer_360_rows(t):
    """Orders with their customer, and what was paid if anything was."""
    paid = t.lineitem.groupBy("l_orderkey").agg(
        F.count("*").alias("lines"), amount(revenue_sum()).alias("paid")
    )
    joined = (
        t.orders.join(t.customer, on("o_custkey", "c_custkey"))
        .join(t.nation, on("c_nationkey", "n_nationkey"))
        .join(paid, on("o_orderkey", "l_orderkey"), "left")
    )
    return joined.select(
        "o_orderkey", "o_orderdate", "o_orderstatus", "c_custkey", "c_name",
        F.col("n_name").alias("city"), "lines", "paid",
    )


@query(f"""
SELECT c_custkey, c_name, n_name AS city, {sql.count('o_orderkey')} AS total_orders,
       {sql.amount(f'SUM({sql.TOTAL})')} AS lifetime_spend
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE {sql.FULFILLED} GROUP BY c_custkey, c_name, n_name
""")
def join_broadcast(t):
    """Customer and nation attributes go onto spend per customer; Spark broadcasts what its
    statistics or the running query show to be small."""
    spend = fulfilled(t.orders).groupBy("o_custkey").agg(
        F.count("o_orderkey").alias("total_orders"),
        amount(money_sum("o_totalprice")).alias("lifetime_spend"),
    )
    named = spend.join(t.customer, on("o_custkey", "c_custkey"))
    placed = named.join(t.nation, on("c_nationkey", "n_nationkey"))
    return placed.select(
        "c_custkey", "c_name", F.col("n_name").alias("city"), "total_orders", "lifetime_spend"
    )


# --- outer joins -------------------------------------------------------------------------

RENUMBERED_ORDERS = raw.renumbered_sql("orders", "o_custkey")


def renumbered_orders(t):
    return raw.renumbered(t.orders, "o_custkey")


def with_orders(t, how: str):
    return joins.outer_join(t.customer, renumbered_orders(t), "c_custkey", "o_custkey", how)


@query(f"""
SELECT {CUSTOMER_ORDERS_SQL}, o_totalprice FROM customer LEFT JOIN {RENUMBERED_ORDERS} ON c_custkey = o_custkey
""")
def join_left(t):
    return with_orders(t, "left").select(*CUSTOMER_ORDERS, "o_totalprice")


@query(f"SELECT {CUSTOMER_ORDERS_SQL} FROM customer RIGHT JOIN {RENUMBERED_ORDERS} ON c_custkey = o_custkey")
def join_right(t):
    return with_orders(t, "right").select(*CUSTOMER_ORDERS)


@query(f"SELECT {CUSTOMER_ORDERS_SQL} FROM customer FULL JOIN {RENUMBERED_ORDERS} ON c_custkey = o_custkey")
def join_full(t):
    return with_orders(t, "full").select(*CUSTOMER_ORDERS)


@query(f"""
SELECT {CUSTOMER_ORDERS_SQL} FROM customer LEFT JOIN {RENUMBERED_ORDERS} ON c_custkey = o_custkey
UNION
SELECT {CUSTOMER_ORDERS_SQL} FROM customer RIGHT JOIN {RENUMBERED_ORDERS} ON c_custkey = o_custkey
""")
def join_full_union(t):
    """A left and a right join made into a set are the full join without copies."""
    return join_full(t).distinct()


@query(f"""
SELECT p_partkey, p_name, {sql.count('l_orderkey')} AS times_purchased,
       CAST(SUM(l_quantity) AS BIGINT) AS total_quantity
FROM part LEFT JOIN {raw.renumbered_sql("lineitem", "l_partkey")} ON p_partkey = l_partkey
GROUP BY p_partkey, p_name
""")
def join_left_agg(t):
    """Sums per part first, so the join is one to one whatever the popularity of a part."""
    sold = raw.renumbered(t.lineitem, "l_partkey").groupBy("l_partkey").agg(
        F.count("l_orderkey").alias("n"), F.sum("l_quantity").cast("bigint").alias("total_quantity")
    )
    joined = t.part.join(sold, on("p_partkey", "l_partkey"), "left")
    return joined.select(
        "p_partkey", "p_name", F.coalesce("n", F.lit(0)).alias("times_purchased"), "total_quantity"
    )


# --- semi and anti joins -----------------------------------------------------------------

@query(f"""
SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN
    (SELECT o_custkey FROM {RENUMBERED_ORDERS} WHERE o_custkey IS NOT NULL)
""")
def customers_without_orders(t):
    lacking = joins.lacking_match(t.customer, renumbered_orders(t), "c_custkey", "o_custkey")
    return lacking.select("c_custkey", "c_name")


@query("""
SELECT o_orderkey, o_custkey, o_orderdate, o_orderstatus FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
""")
def orders_without_payment(t):
    lacking = joins.lacking_match(t.orders, t.lineitem, "o_orderkey", "l_orderkey")
    return lacking.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")


@query("""
SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_custkey IN
    (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O' AND o_totalprice > 450000)
""")
def join_semi(t):
    large = t.orders.filter("o_orderstatus = 'O' and o_totalprice > 450000")
    found = joins.having_match(t.customer, large, "c_custkey", "o_custkey")
    return found.select("c_custkey", "c_name", "c_nationkey")


# --- self joins and products -------------------------------------------------------------

@query(f"""
SELECT a.c_nationkey AS city, {sql.count()} AS customer_pairs
FROM customer a JOIN customer b ON a.c_nationkey = b.c_nationkey AND a.c_custkey < b.c_custkey
GROUP BY a.c_nationkey
""")
def join_self_theta(t):
    """How many pairs of customers share a city.

    The pairs themselves grow with the square of the city, so they are counted, not built:
    a city of n customers has n * (n - 1) / 2.
    """
    placed = t.customer.filter(F.col("c_nationkey").isNotNull())
    sizes = placed.groupBy(F.col("c_nationkey").alias("city")).agg(
        F.countDistinct("c_custkey").alias("n")
    )
    n = F.col("n").cast("decimal(20,0)")
    pairs = (n * (n - 1) / 2).cast("bigint").alias("customer_pairs")
    return sizes.filter("n > 1").select("city", pairs)


@query("""
SELECT c_custkey, c_name, p_partkey, p_name FROM customer CROSS JOIN part
ORDER BY c_custkey, p_partkey LIMIT 5
""")
def join_cross(t):
    """The first combinations, without the product of the two tables."""
    customers = t.customer.select("c_custkey", "c_name")
    parts = t.part.select("p_partkey", "p_name")
    return joins.first_pairs(customers, parts, ["c_custkey"], ["p_partkey"], 5)


@query("""
SELECT p_type, arg_min(p_name, (p_retailprice, p_partkey)) AS cheapest_product,
       MIN(p_retailprice) AS min_price,
       arg_min(p_name, (-p_retailprice, p_partkey)) AS most_expensive_product,
       MAX(p_retailprice) AS max_price
FROM part GROUP BY p_type
""")
def min_max_named(t):
    price, key = F.col("p_retailprice"), F.col("p_partkey")
    return t.part.groupBy("p_type").agg(
        F.min_by("p_name", F.struct(price, key)).alias("cheapest_product"),
        F.min("p_retailprice").alias("min_price"),
        F.min_by("p_name", F.struct(-price, key)).alias("most_expensive_product"),
        F.max("p_retailprice").alias("max_price"),
    )


# --- set operations ----------------------------------------------------------------------

@query("SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier")
def union_distinct(t):
    buyers = t.customer.select(F.col("c_nationkey").alias("nationkey"))
    return buyers.union(t.supplier.select("s_nationkey")).distinct()


@query("""
SELECT c_name AS name, c_acctbal AS balance, 'customer' AS party FROM customer
UNION ALL SELECT s_name, s_acctbal, 'supplier' FROM supplier
""")
def union_all(t):
    customers = t.customer.select(
        F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.lit("customer").alias("party")
    )
    suppliers = t.supplier.select(
        F.lit("supplier").alias("party"), F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name")
    )
    return customers.unionByName(suppliers)
