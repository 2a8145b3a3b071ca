"""The driver tables as they look before cleaning.

The tables are clean, so each raw layout spoils some columns with fixed expressions over
real columns. Spark and SQL use the same expressions, and no row is left out.
"""

from pyspark.sql import functions as F

from tillwork.functions.dates import day


def orders(t):
    """Text orders: blank customers, two date layouts and some words instead of dates."""
    low_open = (F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "5-LOW")
    return t.orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "  ")
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("customer_id"),
        F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "dd-MM-yyyy"))
        .when(low_open, "unknown")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
        .alias("order_date"),
        F.concat(F.lit("  "), F.col("o_orderstatus"), F.lit(" ")).alias("status"),
    )


ORDERS = """
SELECT o_orderkey AS order_id,
       CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '  '
            ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
       CASE WHEN o_orderstatus = 'P' THEN strftime(o_orderdate, '%d-%m-%Y')
            WHEN o_orderstatus = 'O' AND o_orderpriority = '5-LOW' THEN 'unknown'
            ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS order_date,
       '  ' || o_orderstatus || ' ' AS status
FROM orders
"""

PARSED_DATE = """COALESCE(TRY_STRPTIME(order_date, '%Y-%m-%d %H:%M:%S'),
    TRY_STRPTIME(order_date, '%d-%m-%Y'), TRY_CAST(order_date AS TIMESTAMP))"""
WELL_FORMED = r"regexp_full_match(order_date, '\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}')"


def products(t):
    """Names padded, in capitals or hyphenated; categories in several spellings."""
    size, name, kind = F.col("p_size"), F.col("p_name"), F.col("p_type")
    return t.part.select(
        F.col("p_partkey").alias("product_id"),
        F.when(size > 40, F.concat(F.lit("  "), F.upper(name), F.lit(" ")))
        .when(size > 30, F.replace(name, F.lit(" "), F.lit("-")))
        .otherwise(name)
        .alias("product_name"),
        F.when(kind == "PROMO", "electronic")
        .when(kind == "ECONOMY", " CLOTHS ")
        .when(kind == "SMALL", "groceries")
        .when(kind == "MEDIUM", "Book")
        .when(kind == "LARGE", "sport")
        .otherwise(kind)
        .alias("category"),
        F.col("p_retailprice").alias("price"),
    )


PRODUCTS = """
SELECT p_partkey AS product_id,
       CASE WHEN p_size > 40 THEN '  ' || upper(p_name) || ' '
            WHEN p_size > 30 THEN replace(p_name, ' ', '-') ELSE p_name END AS product_name,
       CASE p_type WHEN 'PROMO' THEN 'electronic' WHEN 'ECONOMY' THEN ' CLOTHS '
            WHEN 'SMALL' THEN 'groceries' WHEN 'MEDIUM' THEN 'Book' WHEN 'LARGE' THEN 'sport'
            ELSE p_type END AS category,
       p_retailprice AS price
FROM part
"""


def title_sql(text: str) -> str:
    runs = f"regexp_extract_all(lower(trim({text})), '[a-z]+|[^a-z]+')"
    return f"array_to_string(list_transform({runs}, lambda s: upper(s[1]) || s[2:]), '')"


CATEGORY_SQL = """CASE lower(trim(category)) WHEN 'electronic' THEN 'Electronics'
    WHEN 'cloths' THEN 'Clothing' WHEN 'groceries' THEN 'Grocery' WHEN 'book' THEN 'Books'
    WHEN 'sport' THEN 'Sports' ELSE category END"""


def customers(t):
    """E-mail addresses, some missing, without an at sign or without a domain."""
    name, segment = F.col("c_name"), F.col("c_mktsegment")
    return t.customer.select(
        F.col("c_custkey").alias("customer_id"),
        F.when(segment == "MACHINERY", F.lit(None))
        .when(segment == "BUILDING", F.concat(name, F.lit("example.com")))
        .when(segment == "HOUSEHOLD", F.concat(name, F.lit("@example")))
        .otherwise(F.concat(F.lower(name), F.lit("@example.com")))
        .alias("email"),
        F.when(segment == "MACHINERY", "N/A")
        .when(segment == "BUILDING", " ")
        .when(segment == "FURNITURE", "NULL")
        .otherwise(segment)
        .alias("segment"),
    )


CUSTOMERS = """
SELECT c_custkey AS customer_id,
       CASE c_mktsegment WHEN 'MACHINERY' THEN NULL WHEN 'BUILDING' THEN c_name || 'example.com'
            WHEN 'HOUSEHOLD' THEN c_name || '@example'
            ELSE lower(c_name) || '@example.com' END AS email,
       CASE c_mktsegment WHEN 'MACHINERY' THEN 'N/A' WHEN 'BUILDING' THEN ' '
            WHEN 'FURNITURE' THEN 'NULL' ELSE c_mktsegment END AS segment
FROM customer
"""
EMAIL_SQL = r"COALESCE(regexp_matches(email, '^[^@\s]+@[^@\s]+\.[^@\s]+$'), FALSE)"


def items(t):
    """Order items: returns as negative quantities, some zeros, discounts out of range."""
    tax = F.col("l_tax")
    return t.lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_linenumber").alias("item_no"),
        F.when(F.col("l_returnflag") == "R", -F.col("l_quantity"))
        .when(tax == 0.08, 0.0)
        .otherwise(F.col("l_quantity"))
        .cast("int")
        .alias("quantity"),
        F.col("l_extendedprice").alias("unit_price"),
        F.when(tax == 0.0, 150)
        .when(tax == 0.01, -10)
        .otherwise(F.round(F.col("l_discount") * 100).cast("int"))
        .alias("discount_percent"),
    )


ITEMS = """
SELECT l_orderkey AS order_id, l_partkey AS product_id, l_linenumber AS item_no,
       CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity WHEN l_tax = 0.08 THEN 0
            ELSE l_quantity END AS INTEGER) AS quantity,
       l_extendedprice AS unit_price,
       CASE WHEN l_tax = 0.0 THEN 150 WHEN l_tax = 0.01 THEN -10
            ELSE CAST(round(l_discount * 100) AS INTEGER) END AS discount_percent
FROM lineitem
"""


def shipments(t):
    """One record per order line with text dates, as an order export would hold it."""
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.when(F.col("l_tax") == 0.08, 0)
        .otherwise(F.col("l_quantity").cast("int"))
        .alias("quantity"),
        F.col("l_extendedprice").alias("unit_price"),
        day("o_orderdate").cast("string").alias("order_date"),
        F.when(F.col("l_linestatus") == "F", day("l_shipdate").cast("string")).alias("delivery_date"),
        F.concat(
            F.lit("  "),
            F.when(F.col("o_orderstatus") == "F", "DELIVERED")
            .when(F.col("o_orderstatus") == "P", "shipped")
            .otherwise("processing"),
        ).alias("order_status"),
    )


SHIPMENTS = """
SELECT concat_ws('-', l_orderkey, l_linenumber) AS order_id, o_custkey AS customer_id,
       l_partkey AS product_id,
       CASE WHEN l_tax = 0.08 THEN 0 ELSE CAST(l_quantity AS INTEGER) END AS quantity,
       l_extendedprice AS unit_price,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date,
       CASE WHEN l_linestatus = 'F' THEN CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END
           AS delivery_date,
       '  ' || CASE o_orderstatus WHEN 'F' THEN 'DELIVERED' WHEN 'P' THEN 'shipped'
            ELSE 'processing' END AS order_status
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""
# A total order of the copies of one order line.
FIRST_COPY = ["product_id", "unit_price", "quantity", "order_date", "delivery_date"]


# --- keys that do not all match ------------------------------------------------------------

# Doubled keys, as after a renumbering of one system only: every second parent keeps its rows,
# the others have none, and about half of the rows point to no parent.

def renumbered(df, *keys):
    return df.withColumns({k: F.col(k) * 2 for k in keys})


def renumbered_sql(table, *keys):
    doubled = ", ".join(f"{k} * 2 AS {k}" for k in keys)
    return f"(SELECT * REPLACE ({doubled}) FROM {table})"


def loose_lines(t):
    """Order lines whose keys have gaps: some without order or line number, some renumbered."""
    order, discount, tax = F.col("l_orderkey"), F.col("l_discount"), F.col("l_tax")
    return t.lineitem.withColumns(
        {
            "l_orderkey": F.when(tax < 0.075, F.when(discount >= 0.095, -order - 1).otherwise(order)),
            "l_linenumber": F.when(tax > 0.005, F.col("l_linenumber")),
        }
    )


LOOSE_LINES = """
SELECT * REPLACE (
    CASE WHEN l_tax < 0.075 THEN CASE WHEN l_discount >= 0.095 THEN -l_orderkey - 1 ELSE l_orderkey END END AS l_orderkey,
    CASE WHEN l_tax > 0.005 THEN l_linenumber END AS l_linenumber)
FROM lineitem
"""


# --- the sources of the lake -------------------------------------------------------------

def city_customers(t):
    """Customers with their city; those in debt come twice, spelled differently."""
    named = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    rows = named.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
        F.concat(F.lit("  "), F.col("n_name")).alias("city"),
        F.date_add(F.lit("1990-01-01").cast("date"), F.col("c_nationkey")).alias("signup_date"),
        "c_acctbal",
    )
    again = rows.filter("c_acctbal < 0").withColumn("city", F.concat(F.lower("city"), F.lit(" ")))
    return rows.unionByName(again).drop("c_acctbal")


def payments(t):
    """One payment per order line; lines that share a number share a payment id."""
    return t.lineitem.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("payment_id"),
        F.col("l_orderkey").alias("order_id"),
        F.when(F.col("l_tax") < 0.03, "Card").when(F.col("l_tax") < 0.06, "Cash").otherwise("Wallet").alias("payment_method"),
        F.col("l_extendedprice").alias("amount"),
        F.when(F.col("l_linestatus") == "F", "Success").otherwise("Pending").alias("payment_status"),
        day("l_shipdate").alias("payment_date"),
    )


PAYMENTS = """
SELECT concat_ws('-', l_orderkey, l_linenumber) AS payment_id, l_orderkey AS order_id,
       CASE WHEN l_tax < 0.03 THEN 'Card' WHEN l_tax < 0.06 THEN 'Cash' ELSE 'Wallet' END AS payment_method,
       l_extendedprice AS amount, CASE l_linestatus WHEN 'F' THEN 'Success' ELSE 'Pending' END AS payment_status,
       CAST(l_shipdate AS DATE) AS payment_date
FROM lineitem
"""


def catalogue(t):
    return t.part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"),
        F.col("p_size").alias("size"),
    )


# --- wide transactions -------------------------------------------------------------------

def transactions(t):
    """Order lines in the layout of a retail export, with gaps and mixed spellings."""
    joined = (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(products(t), F.col("l_partkey") == F.col("product_id"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return joined.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("transaction_id"),
        F.col("r_name").alias("region"),
        F.when(F.col("c_nationkey") < 3, "  ").otherwise(F.col("n_name")).alias("city"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "NA")
        .otherwise(F.concat((F.col("l_quantity").cast("int") + 8).cast("string"), F.lit(".0")))
        .alias("age"),
        F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("payment_method"),
        F.col("category").alias("product_category"),
        F.when(F.col("l_tax") < 0.08, F.col("l_quantity")).alias("quantity"),
        F.col("price").alias("unit_price"),
        F.col("l_extendedprice").alias("total_amount"),
        F.when(F.col("o_orderstatus") == "F", "Completed").otherwise("Pending").alias("order_status"),
    )


TRANSACTIONS = f"""
SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey) AS transaction_id, r_name AS region,
       CASE WHEN c_nationkey < 3 THEN '  ' ELSE n_name END AS city,
       CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE CAST(l_quantity + 8 AS INTEGER) END AS age,
       NULLIF(o_orderpriority, '4-NOT SPECIFIED') AS payment_method, category AS product_category,
       CASE WHEN l_tax < 0.08 THEN l_quantity END AS quantity, price AS unit_price,
       l_extendedprice AS total_amount,
       CASE WHEN o_orderstatus = 'F' THEN 'Completed' ELSE 'Pending' END AS order_status
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN ({PRODUCTS}) ON l_partkey = product_id
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
"""


def wide_orders(t):
    """Orders as a wide export: keys as doubles, padded text, month/day/year dates, gaps."""
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey")
    )

    def padded(c):
        return F.concat(F.lit(" "), F.col(c), F.lit("  "))

    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    return joined.select(
        F.col("o_orderkey").cast("double").alias("transaction_id"),
        F.col("o_custkey").cast("double").alias("customer_id"),
        padded("n_name").alias("country"),
        padded("n_name").alias("state"),
        F.col("c_nationkey").cast("double").alias("age"),
        padded("c_mktsegment").alias("gender"),
        padded("c_mktsegment").alias("customer_segment"),
        F.date_format("o_orderdate", "M/d/yyyy").alias("date"),
        F.col("c_nationkey").cast("double").alias("total_purchases"),
        F.col("c_acctbal").alias("unit_amount"),
        F.when(priority != "5-LOW", F.col("o_totalprice")).alias("total_amount"),
        padded("c_mktsegment").alias("product_category"),
        F.when(status != "O", padded("o_orderstatus")).alias("product_brand"),
        padded("o_orderpriority").alias("payment_method"),
        F.when(status != "P", padded("o_orderstatus")).alias("order_status"),
        F.when(priority != "1-URGENT", F.lit(4.0)).alias("ratings"),
    )
