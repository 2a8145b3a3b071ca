"""Layers, slowly changing products, table maintenance and cleaning flows."""

from decimal import Decimal

from pyspark.sql import functions as F

from tillwork.functions.dates import day
from tillwork.functions.money import amount, money
from tillwork.operators import flows, joins, medallion, scd2, validate
from tillwork.plans import raw, sql
from tillwork.plans.business import fulfilled_parts
from tillwork.plans.catalog import (
    CHECKED_ON,
    OPENED_ON,
    ORDER_CUTS,
    REPRICED_AGAIN_ON,
    REPRICED_ON,
    SEGMENT_CUTS,
    query,
    tier,
)
from tillwork.plans.joining import on
from tillwork.sources import files
from tillwork.sources.published import append, publish
from tillwork.sources.shared import new_folder
from tillwork.sources.tables import SCHEMAS
from tillwork.streaming.bronze import land_new_files


# --- slowly changing products ------------------------------------------------------------

def scaled(column: str, factor: str):
    return amount(money(column) * F.lit(Decimal(factor)))


def repriced(t):
    """Product versions after two batches: promotions go up, then large items go down."""
    opened = scd2.init(raw.catalogue(t), OPENED_ON)
    promotions = raw.catalogue(t).filter("category = 'PROMO'").select(
        "product_id", scaled("price", "1.10").alias("price")
    )
    once = scd2.apply_changes(opened, promotions, "product_id", REPRICED_ON, ["price"])
    large = scd2.current(once).filter("size > 25").select(
        "product_id", scaled("price", "0.95").alias("price")
    )
    return scd2.apply_changes(once, large, "product_id", REPRICED_AGAIN_ON, ["price"])


UP = sql.amount(f"{sql.PRICE} * 1.10")
BEFORE_LARGE = f"(CASE WHEN p_type = 'PROMO' THEN {UP} ELSE p_retailprice END)"
DOWN = sql.amount(f"CAST({BEFORE_LARGE} AS DECIMAL(18,2)) * 0.95")
VERSIONS = f"""
WITH c AS (SELECT p_partkey, p_retailprice AS price, DATE '{OPENED_ON}' AS effective_date FROM part
    UNION ALL SELECT p_partkey, {UP}, DATE '{REPRICED_ON}' FROM part WHERE p_type = 'PROMO'
    UNION ALL SELECT p_partkey, {DOWN}, DATE '{REPRICED_AGAIN_ON}' FROM part WHERE p_size > 25),
v AS (SELECT *, LEAD(effective_date) OVER (PARTITION BY p_partkey ORDER BY effective_date) AS end_date FROM c)
SELECT p.p_partkey AS product_id, p_name AS product_name, p_type AS category, price, p_size AS size,
       effective_date, end_date, end_date IS NULL AS is_current
FROM v JOIN part p ON v.p_partkey = p.p_partkey
"""


@query(f"""
SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_retailprice AS price,
       p_size AS size, DATE '{OPENED_ON}' AS effective_date, CAST(NULL AS DATE) AS end_date, TRUE AS is_current FROM part
""")
def scd2_init(t):
    return scd2.init(raw.catalogue(t), OPENED_ON)


@query(VERSIONS)
def scd2_apply(t):
    return repriced(t)


@query(f"SELECT * FROM ({VERSIONS}) WHERE product_id IN (SELECT product_id FROM ({VERSIONS}) WHERE NOT is_current)")
def scd2_history(t):
    """All versions of every product whose price ever changed."""
    versions = repriced(t)
    return joins.having_match(
        versions, versions.filter("not is_current").select(F.col("product_id").alias("changed")),
        "product_id", "changed",
    )


@query(f"SELECT * FROM ({VERSIONS}) WHERE is_current")
def scd2_current(t):
    return scd2.current(repriced(t))


@query(f"""
SELECT * FROM ({VERSIONS}) WHERE effective_date <= DATE '{REPRICED_ON}'
AND (end_date IS NULL OR end_date > DATE '{REPRICED_ON}')
""")
def scd2_as_of(t):
    return scd2.as_of(repriced(t), REPRICED_ON)


@query(f"""
SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_shipdate AS DATE) AS ship_date, price, effective_date
FROM lineitem JOIN ({VERSIONS}) ON l_partkey = product_id
AND effective_date <= CAST(l_shipdate AS DATE) AND (end_date IS NULL OR CAST(l_shipdate AS DATE) < end_date)
""")
def scd2_price_as_of(t):
    """The price in force on the day each line was shipped."""
    lines = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", day("l_shipdate").alias("ship_date")
    )
    priced = joins.as_of(lines, repriced(t), "l_partkey", "product_id", "ship_date")
    return priced.select(*lines.columns, "price", "effective_date")


@query(f"""
WITH s AS (SELECT l_partkey, {sql.total('l_quantity')} AS units_sold, {sql.amount(f'SUM({sql.REV})')} AS total_revenue
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE {sql.FULFILLED} GROUP BY l_partkey)
SELECT product_id, product_name, category, price, units_sold, total_revenue
FROM s JOIN ({VERSIONS}) ON l_partkey = product_id WHERE is_current
""")
def product_performance(t):
    """Fulfilled sales per product beside its current price."""
    sold = fulfilled_parts(t).select(
        "l_partkey", F.col("units").alias("units_sold"), amount(F.col("revenue")).alias("total_revenue")
    )
    named = sold.join(scd2.current(repriced(t)), on("l_partkey", "product_id"))
    return named.select("product_id", "product_name", "category", "price", "units_sold", "total_revenue")


# --- versioned tables and row maintenance ------------------------------------------------

def part_versions(t):
    """Created, rewritten from itself, then appended to: (operation, path) of each folder."""
    read = t.spark.read.parquet
    created = publish(t.part, "part")
    dearer = publish(read(created).withColumn("p_retailprice", scaled("p_retailprice", "1.10")), "part")
    kept = publish(read(dearer), "part")
    append(t.part.filter("p_type = 'PROMO'"), kept)
    return [("create", created), ("overwrite", dearer), ("append", kept)]


@query(f"""
SELECT 'latest' AS version, * REPLACE ({UP} AS p_retailprice) FROM part
UNION ALL SELECT 'latest', * FROM part WHERE p_type = 'PROMO' UNION ALL SELECT 'first', * FROM part
""")
def versioned_table(t):
    versions = part_versions(t)
    read = lambda k, name: t.spark.read.parquet(versions[k][1]).withColumn("version", F.lit(name))
    return read(-1, "latest").unionByName(read(0, "first"))


@query(f"""
SELECT CAST(0 AS BIGINT) AS version, 'create' AS operation, {sql.count()} AS row_count FROM part
UNION ALL SELECT 1, 'overwrite', {sql.count()} FROM part
UNION ALL SELECT 2, 'append', CAST(COUNT(*) + COUNT(*) FILTER (WHERE p_type = 'PROMO') AS BIGINT) FROM part
""")
def table_history(t):
    result = None
    for version, (operation, path) in enumerate(part_versions(t)):
        rows = t.spark.read.parquet(path).agg(F.count("*").alias("row_count")).select(
            F.lit(version).cast("bigint").alias("version"), F.lit(operation).alias("operation"), "row_count"
        )
        result = rows if result is None else result.unionByName(rows)
    return result


@query(f"SELECT * REPLACE (CASE WHEN p_type = 'PROMO' THEN {UP} ELSE p_retailprice END AS p_retailprice) FROM part")
def merge_update(t):
    updates = t.part.filter("p_type = 'PROMO'").select(
        "p_partkey", scaled("p_retailprice", "1.10").alias("p_retailprice")
    )
    return scd2.merge_update(t.part, updates, "p_partkey", ["p_retailprice"])


@query("SELECT * FROM orders UNION ALL SELECT * REPLACE (-o_orderkey - 1 AS o_orderkey, 'O' AS o_orderstatus)"
       " FROM orders WHERE o_orderstatus = 'P'")
def insert_rows(t):
    reorders = t.orders.filter("o_orderstatus = 'P'").withColumns(
        {"o_orderkey": -F.col("o_orderkey") - 1, "o_orderstatus": F.lit("O")}
    )
    return scd2.insert_rows(t.orders, reorders)


@query("SELECT * FROM orders WHERE (o_orderstatus = 'O' AND o_totalprice < 50000) IS NOT TRUE")
def delete_rows(t):
    small_open = (F.col("o_orderstatus") == "O") & (F.col("o_totalprice") < 50000)
    return scd2.delete_rows(t.orders, small_open)


STOCK = "SELECT p_partkey, CAST(300 + p_size * 10 AS BIGINT) AS stock FROM part"


def stock(t):
    return t.part.select("p_partkey", (F.lit(300) + F.col("p_size") * 10).cast("bigint").alias("stock"))


@query(f"""
WITH s AS ({STOCK}), d AS (SELECT l_partkey, {sql.total('l_quantity')} AS taken FROM lineitem GROUP BY l_partkey)
SELECT p_partkey, stock - COALESCE(taken, 0) AS stock FROM s LEFT JOIN d ON p_partkey = l_partkey
""")
def update_stock(t):
    demand = t.lineitem.select(
        F.col("l_partkey").alias("p_partkey"), F.col("l_quantity").cast("bigint").alias("quantity")
    )
    return scd2.take_stock(stock(t), demand, "p_partkey", "stock", "quantity")


# SQL has no loop until nothing changes, so its rounds are written out, with some to spare.
GUARD_ROUNDS = 30
GUARDED = f"""
WITH s AS ({STOCK}), d AS (SELECT l_orderkey, l_partkey, SUM(l_quantity) AS quantity FROM lineitem GROUP BY 1, 2),
r0 AS MATERIALIZED (SELECT l_orderkey, l_partkey, quantity, COALESCE(stock, -1) AS stock, 0 AS state
    FROM d LEFT JOIN s ON l_partkey = p_partkey),
""" + ",".join(f"""
r{k + 1} AS MATERIALIZED (
    SELECT l_orderkey, l_partkey, quantity, stock,
           CASE WHEN state <> 0 THEN state WHEN BOOL_AND(most <= stock) OVER o THEN 1
                WHEN BOOL_AND(least + quantity <= stock) OVER o THEN 0 ELSE 2 END AS state
    FROM (SELECT *, SUM(CASE WHEN state < 2 THEN quantity ELSE 0 END) OVER w AS most,
                 SUM(CASE WHEN state = 1 THEN quantity ELSE 0 END) OVER w AS least
          FROM r{k} WINDOW w AS (PARTITION BY l_partkey ORDER BY l_orderkey NULLS FIRST ROWS UNBOUNDED PRECEDING))
    WINDOW o AS (PARTITION BY l_orderkey))""" for k in range(GUARD_ROUNDS)) + f"""
SELECT l_orderkey, {sql.count()} AS items, CAST(COUNT(*) FILTER (WHERE before + quantity <= stock) AS BIGINT) AS items_in_stock,
       BOOL_AND(before + quantity <= stock) AS accepted
FROM (SELECT *, SUM(CASE WHEN state = 1 THEN quantity ELSE 0 END) OVER (PARTITION BY l_partkey
             ORDER BY l_orderkey NULLS FIRST ROWS UNBOUNDED PRECEDING) - CASE WHEN state = 1 THEN quantity ELSE 0 END AS before
      FROM r{GUARD_ROUNDS}) GROUP BY l_orderkey
"""


@query(GUARDED)
def stock_guarded_orders(t):
    demand = t.lineitem.groupBy("l_orderkey", F.col("l_partkey").alias("p_partkey")).agg(
        F.sum("l_quantity").cast("bigint").alias("quantity")
    )
    return scd2.guard_stock(demand, stock(t), "l_orderkey", "p_partkey", "quantity", "stock")


# --- layers ------------------------------------------------------------------------------

@query("SELECT *, TRUE AS from_incoming_file FROM orders")
def bronze_new_files(t):
    """The same landing as bronze_ingest, but only of files not landed before; run twice. Each
    row names a file that did come in."""
    places = [new_folder(t.spark, label) for label in ("bronze-orders", "progress")]
    source = new_folder(t.spark, "incoming")
    t.orders.write.parquet(source)
    land_new_files(t.spark, source, SCHEMAS["orders"], *places)
    landed = land_new_files(t.spark, source, SCHEMAS["orders"], *places)
    came = files.file_facts(t.spark, source).select("item_name")
    known = landed.join(came, on("_source_file", "item_name"), "left")
    flag = F.col("item_name").isNotNull().alias("from_incoming_file")
    return known.select(*[c for c in landed.columns if not c.startswith("_")], flag)


CITY = """array_to_string(list_transform(string_split(lower(n_name), ' '), lambda s: upper(s[1]) || s[2:]), ' ')"""


@query(f"""
SELECT c_custkey AS customer_id, c_name AS customer_name, lower(c_name) || '@example.com' AS email,
       {CITY} AS city, CAST(DATE '1990-01-01' + c_nationkey AS DATE) AS signup_date FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
""")
def silver_customers(t):
    return medallion.silver_customers(raw.city_customers(t))


FIRST = ", ".join(f"{c} NULLS FIRST" for c in raw.FIRST_COPY)
CLEAN_ORDERS = f"""
SELECT order_id, customer_id, product_id, quantity, unit_price, CAST(order_date AS DATE) AS order_date,
       CAST(delivery_date AS DATE) AS delivery_date,
       CASE WHEN CAST(delivery_date AS DATE) >= CAST(order_date AS DATE)
            THEN CAST(CAST(delivery_date AS DATE) - CAST(order_date AS DATE) AS BIGINT) END AS delivery_days,
       {sql.amount('quantity * CAST(unit_price AS DECIMAL(18,2))')} AS line_revenue,
       {raw.title_sql('order_status')} AS order_status, quantity > 0 AS is_valid_quantity
FROM ({raw.SHIPMENTS}) QUALIFY ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY {FIRST}) = 1
"""


def first_copy():
    return [F.col(c) for c in raw.FIRST_COPY]


@query(CLEAN_ORDERS)
def silver_orders(t):
    return medallion.silver_orders(raw.shipments(t), first_copy())


@query(f"""
SELECT * FROM ({raw.PAYMENTS}) QUALIFY ROW_NUMBER() OVER (PARTITION BY payment_id
       ORDER BY order_id, payment_method, amount NULLS FIRST, payment_status) = 1
""")
def silver_payments(t):
    return medallion.silver_payments(raw.payments(t))


def segment(spend):
    return tier(spend, SEGMENT_CUTS, "Low Value")


GOLD_STATUSES = ["Delivered", "Shipped"]
SALES = f"SELECT * FROM ({CLEAN_ORDERS}) WHERE order_status IN ('Delivered', 'Shipped')"
SPENT = "SUM(CAST(line_revenue AS DECIMAL(18,2)))"


@query(f"""
WITH s AS ({SALES}), c AS (SELECT customer_id, {sql.count('order_id')} AS total_orders,
    {sql.amount(SPENT)} AS lifetime_spend, MAX(order_date) AS last_order_date FROM s
    WHERE customer_id IN (SELECT c_custkey FROM customer) GROUP BY 1),
g AS (SELECT 'customer_360' AS gold_table, CAST(customer_id AS VARCHAR) AS row_key, total_orders AS n,
    lifetime_spend AS value, {sql.tier('lifetime_spend', SEGMENT_CUTS, 'Low Value')} AS label FROM c
  UNION ALL SELECT 'monthly_revenue', strftime(order_date, '%Y-%m'), {sql.count()}, {sql.amount(SPENT)},
    CAST(NULL AS VARCHAR) FROM s GROUP BY 2
  UNION ALL SELECT 'product_performance', CAST(product_id AS VARCHAR), {sql.total('quantity')},
    {sql.amount(SPENT)}, p_type FROM s JOIN part ON product_id = p_partkey GROUP BY 2, p_type)
SELECT * FROM g
""")
def medallion_gold(t):
    """Bronze to gold through storage, with one repricing; the three gold tables in one list."""
    root = new_folder(t.spark, "lake")
    lake = medallion.Lake(t.spark, root)
    incoming = {
        "customers": raw.city_customers(t),
        "orders": raw.shipments(t),
        "payments": raw.payments(t),
        "products": raw.catalogue(t),
    }
    lake.build_bronze({n: t.spark.read.parquet(publish(df, f"incoming-{n}")) for n, df in incoming.items()})
    lake.build_silver(first_copy(), OPENED_ON)
    changes = raw.catalogue(t).filter("category = 'PROMO'").select(
        "product_id", scaled("price", "1.10").alias("price")
    )
    lake.reprice(changes, REPRICED_ON)
    lake.build_gold(GOLD_STATUSES, segment)
    lake.commit()
    lake = medallion.Lake.opened(t.spark, root)

    def listed(name, key, n, value, label):
        return lake.read("gold", name).select(
            F.lit(name).alias("gold_table"), F.col(key).cast("string").alias("row_key"),
            F.col(n).alias("n"), F.col(value).alias("value"), label.alias("label"),
        )

    people = listed("customer_360", "customer_id", "total_orders", "lifetime_spend", F.col("customer_segment"))
    months = listed("monthly_revenue", "month", "num_orders", "total_revenue", F.lit(None).cast("string"))
    goods = listed("product_performance", "product_id", "units_sold", "total_revenue", F.col("category"))
    return people.unionByName(months).unionByName(goods)


# --- cleaning flows ----------------------------------------------------------------------

@query(CLEAN_ORDERS)
def clean_orders(t):
    return flows.clean_orders(raw.shipments(t), first_copy())


@query(f"""
WITH b AS (SELECT COUNT(*) AS n FROM ({raw.SHIPMENTS})), a AS ({CLEAN_ORDERS}), k AS (SELECT COUNT(*) AS n,
  COUNT(*) FILTER (WHERE NOT is_valid_quantity) AS q, COUNT(*) FILTER (WHERE delivery_days IS NULL) AS d FROM a)
SELECT 'rows_before' AS metric, CAST(n AS BIGINT) AS value FROM b
UNION ALL SELECT 'rows_after', CAST(n AS BIGINT) FROM k
UNION ALL SELECT 'duplicate_rows_removed', CAST((SELECT n FROM b) - n AS BIGINT) FROM k
UNION ALL SELECT 'orders_with_invalid_quantity', CAST(q AS BIGINT) FROM k
UNION ALL SELECT 'orders_missing_delivery_days', CAST(d AS BIGINT) FROM k
""")
def cleaning_summary(t):
    before = raw.shipments(t)
    return flows.clean_summary(before, flows.clean_orders(before, first_copy()))


LIMIT_DAY = f"TIMESTAMP '{CHECKED_ON}'"
FLAGS = f"""
SELECT *, COALESCE(trim(customer_id) = '', TRUE) AS no_customer, NOT {raw.WELL_FORMED} AS reformatted,
       {raw.PARSED_DATE} IS NULL AS lost, COALESCE({raw.PARSED_DATE} > {LIMIT_DAY}, FALSE) AS later
FROM ({raw.ORDERS})
"""
ISSUE_FLAGS = {
    "missing_customer_id": "no_customer", "reformatted_date": "reformatted",
    "unparseable_date": "lost", "future_dated_order": "later",
}


def limit_day():
    return F.lit(CHECKED_ON).cast("timestamp_ntz")


@query(f"WITH f AS ({FLAGS}) " + " UNION ALL ".join(
    f"SELECT '{issue}' AS issue, order_id FROM f WHERE {flag}" for issue, flag in ISSUE_FLAGS.items()
))
def clean_orders_issues(t):
    return flows.order_issues(flows.clean_raw_orders(raw.orders(t), limit_day()))


@query(f"""
WITH f AS ({FLAGS}) SELECT order_id, TRY_CAST(CASE WHEN no_customer THEN NULL ELSE customer_id END AS BIGINT) AS customer_id,
       {raw.PARSED_DATE} AS order_date, status, no_customer AS customer_id_missing_flag,
       reformatted AS date_reformatted, lost AS date_unparseable, later AS date_in_future FROM f
""")
def clean_raw_orders(t):
    return flows.clean_raw_orders(raw.orders(t), limit_day())


def _metric(table: str, name: str, condition: str, source: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{name}' AS metric,"
        f" CAST(COUNT(*) FILTER (WHERE {condition}) AS BIGINT) AS value FROM {source}"
    )


TITLE = raw.title_sql("product_name")


@query(
    f"WITH f AS ({FLAGS}), p AS (SELECT product_name, {TITLE} AS tidy FROM ({raw.PRODUCTS})),"
    f" i AS (SELECT * REPLACE (order_id * 2 AS order_id) FROM ({raw.ITEMS})), o AS (SELECT o_orderkey FROM orders) "
    + " UNION ALL ".join(
        [_metric("orders", issue, flag, "f") for issue, flag in ISSUE_FLAGS.items()]
        + [
            _metric("products", "names_normalized", "product_name <> tidy", "p"),
            _metric("products", "duplicate_names",
                    "tidy IN (SELECT tidy FROM p GROUP BY tidy HAVING COUNT(*) > 1)", "p"),
            _metric("customers", "invalid_emails", f"NOT {raw.EMAIL_SQL}", f"({raw.CUSTOMERS})"),
            _metric("order_items", "negative_quantity", "quantity < 0", "i"),
            _metric("order_items", "zero_quantity", "quantity = 0", "i"),
            _metric("order_items", "discount_out_of_range",
                    "discount_percent < 0 OR discount_percent > 100", "i"),
            _metric("order_items", "orphaned_items", "order_id IS NULL OR order_id NOT IN (SELECT o_orderkey FROM o)", "i"),
        ]
    )
)
def dq_report(t):
    items = raw.renumbered(raw.items(t), "order_id")
    return flows.quality_report(
        raw_orders=raw.orders(t),
        as_of=limit_day(),
        products=raw.products(t),
        customers=raw.customers(t),
        orphans=validate.orphan_rows(items, t.orders, "order_id", "o_orderkey"),
        items=items,
    )


KEPT = "quantity IS NOT NULL AND total_amount IS NOT NULL AND unit_price IS NOT NULL"


@query(f"""
WITH t AS (SELECT DISTINCT * FROM ({raw.TRANSACTIONS})),
k AS (SELECT *, COALESCE(age, (SELECT QUANTILE_DISC(age, 0.5) FROM t WHERE {KEPT})) AS years
      FROM t WHERE {KEPT})
SELECT region, {raw.CATEGORY_SQL.replace('category', 'product_category')} AS category, {sql.count()} AS order_count,
       {sql.amount('SUM(CAST(total_amount AS DECIMAL(18,2)))')} AS total_revenue,
       {sql.mean('CAST(total_amount AS DECIMAL(18,2))')} AS avg_order_value
FROM k WHERE order_status = 'Completed' AND years >= 18 GROUP BY 1, 2
""")
def retail_summary(t):
    return flows.retail_summary(raw.transactions(t))


@query(f"""
WITH j AS (SELECT * FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
SELECT o_orderkey AS transaction_id, o_custkey AS customer_id, c_nationkey AS age, c_nationkey AS total_purchases,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 0 ELSE 4 END AS ratings, trim(n_name) AS country,
       trim(n_name) AS state, c_mktsegment AS gender, c_mktsegment AS customer_segment,
       COALESCE(NULLIF(o_orderstatus, 'O'), 'Unknown') AS product_brand,
       o_orderpriority AS payment_method,
       COALESCE(NULLIF(o_orderstatus, 'P'), 'Unknown') AS order_status,
       c_acctbal AS unit_amount, o_totalprice AS total_amount, upper(c_mktsegment) AS product_category,
       CAST(o_orderdate AS DATE) AS txn_date, {sql.tier('o_totalprice', ORDER_CUTS, 'Low')} AS order_value_tier,
       CAST(year(o_orderdate) AS INTEGER) AS txn_year, CAST(month(o_orderdate) AS INTEGER) AS txn_month
FROM j WHERE o_orderpriority <> '5-LOW' AND o_orderkey IS NOT NULL AND o_custkey IS NOT NULL AND o_totalprice IS NOT NULL
""")
def retail_txn_clean(t):
    return flows.clean_transactions(raw.wide_orders(t), tiers=ORDER_CUTS)


SHOPPING = """
SELECT CAST(l_orderkey AS VARCHAR) AS order_id, p_name AS product, p_type AS category,
       CASE WHEN l_tax < 0.02 THEN 'N/A' WHEN l_tax < 0.04 THEN '' ELSE p_brand END AS size,
       CASE WHEN l_returnflag = 'A' THEN NULL ELSE l_extendedprice END AS price,
       CASE WHEN l_discount < 0.01 THEN NULL ELSE CAST(l_quantity AS INTEGER) END AS quantity,
       CAST(l_shipdate AS DATE) AS purchase_date
FROM lineitem JOIN part ON l_partkey = p_partkey
"""


def shopping(t):
    joined = t.lineitem.join(t.part, on("l_partkey", "p_partkey"))
    tax = F.col("l_tax")
    return joined.select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("p_name").alias("product"),
        F.col("p_type").alias("category"),
        F.when(tax < 0.02, "N/A").when(tax < 0.04, "").otherwise(F.col("p_brand")).alias("size"),
        F.when(F.col("l_returnflag") != "A", F.col("l_extendedprice")).alias("price"),
        F.when(F.col("l_discount") >= 0.01, F.col("l_quantity").cast("int")).alias("quantity"),
        day("l_shipdate").alias("purchase_date"),
    )


@query(f"""
WITH s AS ({SHOPPING}), m AS (SELECT CAST(QUANTILE_CONT(price, 0.5) AS DECIMAL(18,2)) AS p FROM s),
q AS (SELECT quantity AS q FROM s WHERE quantity IS NOT NULL GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1),
f AS (SELECT DISTINCT order_id, product, category, CASE WHEN size IN ('N/A', '') THEN 'Unknown' ELSE size END AS size,
      CAST(COALESCE(CAST(price AS DECIMAL(18,2)), p) AS DOUBLE) AS price, COALESCE(quantity, q) AS quantity,
      purchase_date FROM s, m, q)
SELECT *, {sql.amount('CAST(price AS DECIMAL(18,2)) * quantity')} AS total_amount FROM f
""")
def shopping_clean(t):
    cleaned = flows.clean_shopping(shopping(t))
    return cleaned.withColumn("price", F.col("price").cast("decimal(18,2)").cast("double"))
