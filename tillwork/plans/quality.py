"""Profiling, cleaning and validation queries."""

from pyspark.sql import functions as F

from tillwork.functions import text
from tillwork.functions.dates import after_day, day, elapsed_days, parse_timestamp
from tillwork.functions.money import MONEY, amount
from tillwork.operators import clean, flows, profile, validate
from tillwork.plans import raw, sql
from tillwork.plans.catalog import CHECKED_ON, query
from tillwork.sources.shared import pin

LINE_ID = ["l_orderkey", "l_linenumber", "l_partkey"]
LINES = ", ".join(LINE_ID)


# --- profiles ----------------------------------------------------------------------------

SPOILED = """
SELECT c_custkey, NULLIF(c_mktsegment, 'BUILDING') AS segment,
       CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS balance,
       CASE WHEN c_nationkey < 3 THEN '  ' ELSE c_name END AS name
FROM customer
"""


def spoiled(t):
    return t.customer.select(
        "c_custkey",
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance"),
        F.when(F.col("c_nationkey") < 3, "  ").otherwise(F.col("c_name")).alias("name"),
    )


@query(f"""
WITH r AS ({SPOILED})
SELECT 'segment' AS column_name, {sql.count()} - {sql.count('segment')} AS null_count,
       {sql.percent('COUNT(*) - COUNT(segment)', 'COUNT(*)')} AS null_percent FROM r
UNION ALL
SELECT 'balance', {sql.count()} - {sql.count('balance')},
       {sql.percent('COUNT(*) - COUNT(balance)', 'COUNT(*)')} FROM r
""")
def profile_nulls(t):
    return profile.null_profile(spoiled(t))


@query(f"WITH r AS ({SPOILED})" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(COUNT(*) FILTER (WHERE {c} IS NULL OR"
    f" trim(CAST({c} AS VARCHAR)) = '') AS BIGINT) AS missing_count FROM r"
    for c in ("c_custkey", "segment", "balance", "name")
))
def profile_blanks(t):
    return profile.blank_profile(spoiled(t))


PART_TYPES = {"p_partkey": "bigint", "p_name": "string", "p_brand": "string",
              "p_type": "string", "p_size": "int", "p_retailprice": "double"}


@query(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST({i} AS BIGINT) AS position, '{kind}' AS data_type,"
    f" {sql.count(c)} AS non_null_count, {sql.count()} AS total_rows FROM part"
    for i, (c, kind) in enumerate(PART_TYPES.items(), start=1)
))
def schema_profile(t):
    return profile.schema_profile(t.part)


MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _four(value: str) -> str:
    return sql.amount(f"CAST({value} AS DECIMAL(18,6))", 4)


@query(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {sql.count(c)} AS count, {_four(f'AVG({c})')} AS mean,"
    f" {_four(f'STDDEV_SAMP({c})')} AS std, MIN({c}) AS min, MAX({c}) AS max,"
    f" {_four(f'QUANTILE_CONT({c}, 0.25)')} AS q1, {_four(f'QUANTILE_CONT({c}, 0.5)')} AS median,"
    f" {_four(f'QUANTILE_CONT({c}, 0.75)')} AS q3 FROM lineitem"
    for c in MEASURES
))
def describe_numeric(t):
    return profile.describe_numeric(t.lineitem, *MEASURES)


@query(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {sql.count(c)} AS count,"
    f" {sql.count(f'DISTINCT {c}')} AS unique_values,"
    f" (SELECT {c} FROM part GROUP BY {c} ORDER BY COUNT(*) DESC, {c} LIMIT 1) AS top,"
    f" (SELECT {sql.count()} FROM part GROUP BY {c} ORDER BY COUNT(*) DESC LIMIT 1) AS freq"
    f" FROM part" for c in ("p_name", "p_brand", "p_type")
))
def describe_categorical(t):
    return profile.describe_categorical(t.part, "p_name", "p_brand", "p_type")


@query(f"SELECT o_orderpriority, {sql.count()} AS n FROM orders GROUP BY o_orderpriority")
def value_counts(t):
    return profile.value_counts(t.orders, "o_orderpriority")


@query(f"""
SELECT l_orderkey, l_linenumber, {sql.count()} AS copies
FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1
""")
def find_duplicates(t):
    return profile.copies(t.lineitem, "l_orderkey", "l_linenumber")


@query(f"""
SELECT {sql.count()} AS total_rows, {sql.count('DISTINCT (l_orderkey, l_linenumber)')} AS distinct_keys,
       {sql.count()} - {sql.count('DISTINCT (l_orderkey, l_linenumber)')} AS duplicate_rows
FROM lineitem
""")
def duplicate_key_count(t):
    return profile.surplus(t.lineitem, "l_orderkey", "l_linenumber")


@query(f"""
SELECT p_name, {sql.count('DISTINCT p_brand')} AS distinct_values
FROM part GROUP BY p_name HAVING COUNT(DISTINCT p_brand) > 1
""")
def attribute_drift(t):
    return profile.attribute_drift(t.part, "p_name", "p_brand")


@query(f"""
SELECT 'fulfilled_without_priority' AS rule, CAST(COUNT(*) FILTER (WHERE o_orderstatus IN ('F', 'P')
       AND o_orderpriority = '4-NOT SPECIFIED') AS BIGINT) AS n FROM orders
UNION ALL SELECT 'tiny_total', CAST(COUNT(*) FILTER (WHERE o_totalprice < 5000) AS BIGINT) FROM orders
UNION ALL SELECT 'missing_customer', CAST(COUNT(*) FILTER (WHERE o_custkey IS NULL) AS BIGINT) FROM orders
""")
def rule_scan(t):
    done = F.col("o_orderstatus").isin("F", "P")
    return profile.count_rules(
        t.orders,
        {
            "fulfilled_without_priority": done & (F.col("o_orderpriority") == "4-NOT SPECIFIED"),
            "tiny_total": F.col("o_totalprice") < 5000,
            "missing_customer": F.col("o_custkey").isNull(),
        },
    )


# --- filling and dropping ----------------------------------------------------------------

@query("SELECT o_orderkey, COALESCE(NULLIF(o_orderpriority, '4-NOT SPECIFIED'), 'Unknown') AS priority FROM orders")
def fill_constant(t):
    priority = F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("priority")
    return t.orders.select("o_orderkey", priority).fillna({"priority": "Unknown"})


GAPS = f"""
SELECT {LINES}, CASE WHEN l_returnflag = 'A' THEN NULL ELSE l_extendedprice END AS price,
       CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_quantity END AS quantity
FROM lineitem
"""


def with_gaps(t):
    flag = F.col("l_returnflag")
    return t.lineitem.select(
        *LINE_ID,
        F.when(flag != "A", F.col("l_extendedprice")).alias("price"),
        F.when(flag != "R", F.col("l_quantity")).alias("quantity"),
    )


@query(f"""
WITH r AS ({GAPS}), m AS (SELECT QUANTILE_CONT(price, 0.5) AS p, QUANTILE_CONT(quantity, 0.5) AS q FROM r)
SELECT {LINES}, {sql.amount('CAST(COALESCE(price, p) AS DECIMAL(18,6))', 4)} AS price,
       COALESCE(quantity, q) AS quantity FROM r, m
""")
def fill_median(t):
    filled = clean.fill_median(with_gaps(t), "price", "quantity")
    return filled.withColumn("price", amount(F.col("price").cast("decimal(18,6)"), 4))


@query(f"""
WITH r AS ({GAPS})
SELECT {LINES}, COALESCE(quantity, (SELECT quantity FROM r WHERE quantity IS NOT NULL
       GROUP BY quantity ORDER BY COUNT(*) DESC, quantity LIMIT 1)) AS quantity FROM r
""")
def fill_mode(t):
    return clean.fill_mode(with_gaps(t).drop("price"), "quantity")


@query(f"""
WITH r AS ({GAPS})
SELECT {LINES}, COALESCE(quantity, (SELECT QUANTILE_DISC(quantity, 0.5) FROM r)) AS quantity FROM r
""")
def fill_approx_median(t):
    return clean.fill_approx_median(with_gaps(t).drop("price"), "quantity", relative_error=0.0001)


@query(f"WITH r AS ({GAPS}) SELECT * FROM r WHERE price IS NOT NULL AND quantity IS NOT NULL")
def drop_missing(t):
    return with_gaps(t).dropna(subset=["price", "quantity"])


@query(f"WITH r AS ({GAPS}) SELECT {LINES}, COALESCE(price, 0) AS price FROM r")
def assert_complete(t):
    """The job would fail here if the fill had left a null behind."""
    filled = with_gaps(t).drop("quantity").fillna({"price": 0.0})
    return clean.require_complete(filled, "price")


# --- text, numbers, dates ----------------------------------------------------------------

@query(f"WITH r AS ({SPOILED}) SELECT c_custkey, CASE WHEN trim(name) = '' THEN NULL ELSE name END AS name FROM r")
def blank_to_null(t):
    return spoiled(t).select("c_custkey", text.blank_to_null(F.col("name")).alias("name"))


@query(f"""
WITH r AS ({raw.CUSTOMERS})
SELECT customer_id, CASE WHEN trim(segment) IN ('', 'N/A', 'NULL') THEN NULL ELSE segment END AS segment FROM r
""")
def null_tokens(t):
    segment = text.tokens_to_null(F.col("segment")).alias("segment")
    return raw.customers(t).select("customer_id", segment)


@query("""
SELECT o_orderkey, CAST(CASE WHEN o_orderstatus = 'O' THEN NULL ELSE trunc(o_totalprice) END AS INTEGER) AS total
FROM orders
""")
def coerce_numeric(t):
    words = F.when(F.col("o_orderstatus") == "O", "NA").otherwise(F.col("o_totalprice").cast("string"))
    return t.orders.select("o_orderkey", text.to_integer(words).alias("total"))


@query(f"WITH r AS ({raw.PRODUCTS}) SELECT product_id, {raw.CATEGORY_SQL} AS category FROM r")
def canonicalize_category(t):
    category = text.canonical(F.col("category"), text.CATEGORY_NAMES)
    return raw.products(t).select("product_id", category.alias("category"))


@query(f"""
WITH r AS ({raw.PRODUCTS})
SELECT product_id, category, price, {raw.title_sql('product_name')} AS product_name,
       product_name <> {raw.title_sql('product_name')} AS name_changed FROM r
""")
def normalize_names(t):
    return flows.clean_products(raw.products(t))


@query("""
SELECT n_nationkey, array_to_string(list_transform(string_split(lower(trim('  ' || n_name || ' ')), ' '),
       lambda s: upper(s[1]) || s[2:]), ' ') AS city FROM nation
""")
def standardize_case(t):
    padded = F.concat(F.lit("  "), F.col("n_name"), F.lit(" "))
    return t.nation.select("n_nationkey", F.initcap(F.trim(padded)).alias("city"))


@query(f"""
WITH r AS ({raw.ORDERS})
SELECT order_id, {raw.PARSED_DATE} AS order_date, NOT {raw.WELL_FORMED} AS reformatted FROM r
""")
def parse_dates(t):
    written = F.col("order_date")
    return raw.orders(t).select(
        "order_id",
        parse_timestamp(written, flows.ORDER_DATE_FORMATS).alias("order_date"),
        (~written.rlike(flows.WELL_FORMED_DATE)).alias("reformatted"),
    )


@query(f"SELECT o_orderkey, o_orderdate FROM orders WHERE CAST(o_orderdate AS DATE) > DATE '{CHECKED_ON}'")
def flag_future_dates(t):
    """Orders dated after the day of the check, given as a parameter."""
    later = after_day("o_orderdate", CHECKED_ON)
    return t.orders.filter(later).select("o_orderkey", "o_orderdate")


@query(f"WITH r AS ({raw.CUSTOMERS}) SELECT customer_id, email FROM r WHERE NOT {raw.EMAIL_SQL}")
def validate_emails(t):
    customers = raw.customers(t).select("customer_id", "email")
    return customers.filter(~text.is_email(F.col("email")))


# --- duplicates --------------------------------------------------------------------------

@query("SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def drop_duplicates(t):
    return t.lineitem.select("l_orderkey", "l_linenumber").dropDuplicates()


FIRST_LINE = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_tax"]


@query(f"""
SELECT * FROM lineitem QUALIFY ROW_NUMBER() OVER (
    PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(FIRST_LINE)}) = 1
""")
def dedup_keep_first(t):
    return clean.first_by(t.lineitem, ["l_orderkey", "l_linenumber"], [F.col(c) for c in FIRST_LINE])


# --- ranges and intervals ----------------------------------------------------------------

@query(f"""
WITH r AS ({raw.ITEMS})
SELECT 'negative_quantity' AS rule, CAST(COUNT(*) FILTER (WHERE quantity < 0) AS BIGINT) AS n FROM r
UNION ALL SELECT 'zero_quantity', CAST(COUNT(*) FILTER (WHERE quantity = 0) AS BIGINT) FROM r
UNION ALL SELECT 'discount_out_of_range',
       CAST(COUNT(*) FILTER (WHERE discount_percent < 0 OR discount_percent > 100) AS BIGINT) FROM r
""")
def range_checks(t):
    discount = F.col("discount_percent")
    return profile.count_rules(
        raw.items(t),
        {
            "negative_quantity": F.col("quantity") < 0,
            "zero_quantity": F.col("quantity") == 0,
            "discount_out_of_range": (discount < 0) | (discount > 100),
        },
    )


@query(f"""
WITH r AS ({raw.ITEMS})
SELECT order_id, item_no, product_id,
       {sql.amount('quantity * CAST(unit_price AS DECIMAL(18,2)) * CAST(1 - LEAST(GREATEST(discount_percent, 0), 100) / 100.0 AS DECIMAL(5,4))')} AS revenue
FROM r
""")
def clamped_revenue(t):
    kept = F.lit(1) - clean.clamp(F.col("discount_percent"), 0, 100) / 100
    value = F.col("quantity") * F.col("unit_price").cast(MONEY) * kept.cast("decimal(5,4)")
    return raw.items(t).select("order_id", "item_no", "product_id", amount(value).alias("revenue"))


@query(f"""
SELECT {LINES}, CASE WHEN l_shipdate >= o_orderdate
       THEN CAST(date_diff('day', o_orderdate, l_shipdate) AS BIGINT) END AS delivery_days
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""")
def delivery_days(t):
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    days = elapsed_days(day("o_orderdate"), day("l_shipdate")).cast("bigint")
    return joined.select(*LINE_ID, days.alias("delivery_days"))


@query(f"""
WITH d AS (SELECT {LINES}, CASE WHEN l_shipdate >= o_orderdate
       THEN date_diff('day', o_orderdate, l_shipdate) END AS days
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT {LINES}, CASE WHEN days IS NULL THEN 'Unknown' WHEN days <= 300 THEN 'Fast'
       WHEN days <= 1000 THEN 'Normal' ELSE 'Slow' END AS delivery_speed FROM d
""")
def case_delivery_speed(t):
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    days = elapsed_days(day("o_orderdate"), day("l_shipdate"))
    speed = (
        F.when(days.isNull(), "Unknown").when(days <= 300, "Fast").when(days <= 1000, "Normal")
    )
    return joined.select(*LINE_ID, speed.otherwise("Slow").alias("delivery_speed"))


# --- constraints -------------------------------------------------------------------------

@query(f"""
SELECT * FROM {raw.renumbered_sql("lineitem", "l_orderkey")} AS lines
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = lines.l_orderkey)
""")
def orphan_rows(t):
    """Lines without a parent among the orders."""
    lines = raw.renumbered(t.lineitem, "l_orderkey")
    return validate.orphan_rows(lines, t.orders, "l_orderkey", "o_orderkey")


KEY_TEXT = (
    "COALESCE(CAST(l_orderkey AS VARCHAR), '<null>') || '|' || COALESCE(CAST(l_linenumber AS VARCHAR), '<null>')"
)


@query(f"""
WITH k AS ({raw.LOOSE_LINES}), v AS (
  SELECT 'check:quantity_below_50' AS rule, l_orderkey, l_linenumber FROM k WHERE NOT l_quantity < 50
  UNION ALL SELECT 'check:known_flag', l_orderkey, l_linenumber FROM k WHERE l_returnflag NOT IN ('N', 'R')
  UNION ALL SELECT 'not_null:l_linenumber', l_orderkey, l_linenumber FROM k WHERE l_linenumber IS NULL
  UNION ALL SELECT 'references:l_orderkey', l_orderkey, l_linenumber FROM k
      WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
)
SELECT rule, {KEY_TEXT} AS row_key, {sql.count()} AS occurrences FROM v GROUP BY rule, l_orderkey, l_linenumber
UNION ALL SELECT 'unique:l_orderkey+l_linenumber', {KEY_TEXT}, {sql.count()} FROM k
GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1
""")
def constraint_violations(t):
    rules = validate.Constraints(
        not_null=["l_linenumber"],
        checks={
            "quantity_below_50": F.col("l_quantity") < 50,
            "known_flag": F.col("l_returnflag").isin("N", "R"),
        },
        unique=[["l_orderkey", "l_linenumber"]],
        references={"l_orderkey": (t.orders, "o_orderkey")},
    )
    return validate.violations(raw.loose_lines(t), ["l_orderkey", "l_linenumber"], rules)


@query("SELECT p_type, p_brand, MIN(p_name) AS product_name FROM part GROUP BY p_type, p_brand")
def canonical_names(t):
    return t.part.groupBy("p_type", "p_brand").agg(F.min("p_name").alias("product_name"))


STAGING = """
SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey
"""


@query(f"""
WITH s AS ({STAGING})
SELECT DISTINCT 'customers' AS table_name, CAST(c_custkey AS VARCHAR) AS row_key,
       concat_ws('|', c_name, c_mktsegment) AS label FROM s
UNION ALL SELECT 'products', CAST(l_partkey AS VARCHAR), MIN(p_name) FROM s GROUP BY l_partkey, p_type
UNION ALL (SELECT DISTINCT 'orders', CAST(l_orderkey AS VARCHAR),
       concat_ws('|', o_orderstatus, strftime(o_orderdate, '%Y-%m-%d')) FROM s)
""")
def normalize_staging(t):
    flat = (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            "c_custkey", "c_name", "c_mktsegment", "l_partkey", "p_type", "p_name", "l_orderkey",
            "o_orderstatus", day("o_orderdate").alias("order_date"),
        )
    )
    tables = flows.split_staging(
        pin(flat, "staging"),
        customers=["c_custkey", "c_name", "c_mktsegment"],
        products=["l_partkey", "p_type"],
        product_name="p_name",
        orders=["l_orderkey", "o_orderstatus", "order_date"],
    )
    labels = {
        "customers": ["c_name", "c_mktsegment"],
        "products": ["p_name"],
        "orders": ["o_orderstatus", "order_date"],
    }
    result = None
    for name, table in tables.items():
        rows = table.select(
            F.lit(name).alias("table_name"),
            F.col(table.columns[0]).cast("string").alias("row_key"),
            F.concat_ws("|", *[F.col(c).cast("string") for c in labels[name]]).alias("label"),
        )
        result = rows if result is None else result.unionByName(rows)
    return result
