"""Sources, sinks, projections, filters and conditional columns."""

from datetime import datetime

from pyspark.sql import functions as F

from tillwork.functions.dates import day
from tillwork.functions.money import amount, money, money_sum, revenue
from tillwork.plans import sql
from tillwork.plans.catalog import ORDER_CUTS, query, tier
from tillwork.sources import files
from tillwork.sources.shared import new_folder, pin
from tillwork.sources.tables import SCHEMAS

LINEITEM = "SELECT * FROM lineitem"


# --- sources and sinks -------------------------------------------------------------------

@query("SELECT *, 'int int string double timestamp string' AS inferred FROM orders")
def scan_csv(t):
    path = new_folder(t.spark, "orders-csv")
    files.write_csv(t.orders, path)
    read = files.read_csv(t.spark, path)
    # Inference finds ints and zoned timestamps: say so, and restore the declared types.
    return read.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in t.orders.schema.fields],
        F.lit(" ".join(kind for _, kind in read.dtypes)).alias("inferred"),
    )


@query(LINEITEM)
def scan_csv_schema(t):
    path = new_folder(t.spark, "lineitem-csv")
    files.write_csv(t.lineitem, path)
    return files.read_csv(t.spark, path, SCHEMAS["lineitem"])


@query("SELECT * FROM customer")
def sink_csv_roundtrip(t):
    """Rows leave as CSV and come back as text; types are restored by casting."""
    path = new_folder(t.spark, "customer-csv")
    files.write_csv(t.customer, path)
    text = files.read_csv_text(t.spark, path)
    return text.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in t.customer.schema.fields]
    )


@query(LINEITEM)
def scan_parquet(t):
    return t.lineitem


@query(
    f"SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, {sql.count()} AS orders,"
    f" {sql.amount(f'SUM({sql.TOTAL})')} AS revenue FROM orders GROUP BY 1"
)
def sink_partitioned_parquet(t):
    path = new_folder(t.spark, "orders-by-year")
    files.write_partitioned(t.orders.withColumn("order_year", F.year("o_orderdate")), path, "order_year")
    orders = t.spark.read.parquet(path)
    return orders.groupBy("order_year").agg(
        F.count("*").alias("orders"), amount(money_sum("o_totalprice")).alias("revenue")
    )


@query("SELECT * FROM part UNION ALL SELECT * FROM part WHERE p_type = 'PROMO'")
def land_table(t):
    """A landed table is replaced, then appended to."""
    path = new_folder(t.spark, "part")
    t.part.write.mode("overwrite").parquet(path)
    t.part.filter("p_type = 'PROMO'").write.mode("append").parquet(path)
    return t.spark.read.schema(SCHEMAS["part"]).parquet(path)


@query("SELECT *, 'orders.parquet' AS _source_file, TRUE AS ingested FROM orders")
def bronze_ingest(t):
    rows = files.with_lineage(t.orders)
    return rows.withColumn("ingested", F.col("_ingested_at").isNotNull()).drop("_ingested_at")


@query("SELECT * FROM supplier")
def validated_copy(t):
    source, target = new_folder(t.spark, "raw"), new_folder(t.spark, "processed")
    files.write_csv(t.supplier, source)
    copy = files.validated_copy(t.spark, source, target)
    return copy.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in t.supplier.schema.fields]
    )


@query("""
SELECT 'parquet' AS format, TRUE AS has_files, FALSE AS is_larger UNION ALL SELECT 'csv', TRUE, TRUE
""")
def dataset_size(t):
    """One table on disk as Parquet and as CSV: which takes more bytes."""
    as_csv = new_folder(t.spark, "size-csv")
    files.write_csv(t.lineitem, as_csv)
    parquet, csv = files.dataset_size(t.spark, t.path("lineitem")), files.dataset_size(t.spark, as_csv)
    listed = lambda own, other, name: own.select(
        F.lit(name).alias("format"),
        (F.col("files") > 0).alias("has_files"),
        (F.col("bytes") > other.select("bytes").scalar()).alias("is_larger"),
    )
    return listed(parquet, csv, "parquet").unionByName(listed(csv, parquet, "csv"))


@query(f"SELECT o_orderstatus, o_orderpriority, {sql.count()} AS orders FROM orders GROUP BY 1, 2")
def sink_report(t):
    """A report as a sorted CSV, read back."""
    path = new_folder(t.spark, "report")
    counts = t.orders.groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("orders"))
    files.write_report(counts, path, "o_orderstatus", "o_orderpriority")
    return files.read_csv(t.spark, path, "o_orderstatus string, o_orderpriority string, orders bigint")


@query(f"""
WITH v AS (SELECT o_custkey, SUM({sql.TOTAL}) AS spend FROM orders GROUP BY o_custkey)
SELECT o_custkey, {sql.amount('spend')} AS spend,
       {sql.amount('spend - (SELECT MIN(spend) FROM v)')} AS above_least FROM v
""")
def reuse_intermediate(t):
    """An intermediate that two readers share is written once and not computed again."""
    spend = pin(t.orders.groupBy("o_custkey").agg(money_sum("o_totalprice").alias("spend")), "spend")
    least = spend.agg(F.min("spend")).scalar()
    return spend.select(
        "o_custkey", amount(F.col("spend")).alias("spend"), amount(F.col("spend") - least).alias("above_least")
    )


TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@query(
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, {sql.count()} AS row_count FROM {name}" for name in TABLES
    )
)
def table_row_counts(t):
    counts = [
        t.read(name).agg(F.count("*").alias("row_count")).withColumn("table_name", F.lit(name))
        for name in TABLES
    ]
    result = counts[0]
    for one in counts[1:]:
        result = result.unionByName(one)
    return result


@query("SELECT * FROM orders ORDER BY o_orderkey LIMIT 10")
def preview_head(t):
    return t.orders.orderBy("o_orderkey").limit(10)


@query("""
SELECT CAST(25 AS BIGINT) AS rows_taken, CAST(25 AS BIGINT) AS rows_known, CAST(25 AS BIGINT) AS rows_unlike
FROM (SELECT COUNT(*) AS n FROM orders) WHERE n >= 25
""")
def limit_unordered(t):
    """Any 25 rows, whichever come first: which ones is free, so they are counted and looked up."""
    some = t.orders.select("o_orderkey").limit(25)
    known = some.join(t.orders.select(F.col("o_orderkey").alias("key")), F.col("o_orderkey") == F.col("key"), "left")
    return known.agg(
        F.count_distinct("o_orderkey").alias("rows_taken"),
        F.count("key").alias("rows_known"),
        F.count_distinct("key").alias("rows_unlike"),
    )


@query("SELECT * FROM orders ORDER BY o_orderkey DESC LIMIT 10")
def preview_tail(t):
    return t.orders.orderBy(F.desc("o_orderkey")).limit(10)


@query(
    f"SELECT o_orderstatus, {sql.count()} AS orders FROM orders"
    " WHERE o_totalprice > 100000 GROUP BY o_orderstatus"
)
def query_view(t):
    t.register_views(["orders"])
    return t.spark.sql(
        "SELECT o_orderstatus, count(*) AS orders FROM orders"
        " WHERE o_totalprice > 100000 GROUP BY o_orderstatus"
    )


# --- projections -------------------------------------------------------------------------

@query("SELECT c_name, c_mktsegment, c_nationkey FROM customer")
def project_columns(t):
    return t.customer.select("c_name", "c_mktsegment", "c_nationkey")


@query("SELECT * FROM region")
def select_all(t):
    return t.region.select("*")


@query("SELECT DISTINCT p_type, p_brand FROM part")
def distinct_values(t):
    return t.part.select("p_type", "p_brand").distinct()


@query(
    "SELECT l_orderkey AS order_id, CAST(l_quantity AS INTEGER) AS quantity,"
    " CAST(l_extendedprice AS DECIMAL(12,2)) AS amount, CAST(l_shipdate AS DATE) AS ship_date,"
    " CAST(l_linenumber AS BIGINT) AS line_number FROM lineitem"
)
def cast_columns(t):
    return t.lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("amount"),
        day("l_shipdate").alias("ship_date"),
        F.col("l_linenumber").cast("bigint").alias("line_number"),
    )


@query(
    "SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS order_total FROM orders"
)
def rename_columns(t):
    return t.orders.select("o_orderkey", "o_custkey", "o_totalprice").withColumnsRenamed(
        {"o_orderkey": "order_id", "o_custkey": "customer_id", "o_totalprice": "order_total"}
    )


QTY_PRICE = "CAST(l_quantity AS DECIMAL(10,2)) * CAST(p_retailprice AS DECIMAL(18,2))"


@query(
    f"SELECT l_orderkey, l_linenumber, l_partkey, {sql.amount(QTY_PRICE)} AS total_amount"
    " FROM lineitem JOIN part ON l_partkey = p_partkey"
)
def derive_total_amount(t):
    priced = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    total = F.col("l_quantity").cast("decimal(10,2)") * money("p_retailprice")
    return priced.select("l_orderkey", "l_linenumber", "l_partkey", amount(total).alias("total_amount"))


@query(
    "SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice AS before_discount,"
    f" {sql.amount(sql.REV)} AS line_total FROM lineitem"
)
def line_totals(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.col("l_extendedprice").alias("before_discount"),
        revenue().alias("line_total"),
    )


# --- filters -----------------------------------------------------------------------------

@query("SELECT * FROM orders WHERE o_orderstatus = 'F'")
def filter_eq(t):
    return t.orders.filter(F.col("o_orderstatus") == "F")


@query("SELECT * FROM part WHERE p_type = 'PROMO' AND p_retailprice > 950")
def filter_and(t):
    return t.part.filter((F.col("p_type") == "PROMO") & (F.col("p_retailprice") > 950))


@query("SELECT * FROM customer WHERE c_mktsegment = 'BUILDING' OR c_acctbal < 0")
def filter_or(t):
    return t.customer.filter((F.col("c_mktsegment") == "BUILDING") | (F.col("c_acctbal") < 0))


@query("SELECT * FROM part WHERE p_type IN ('PROMO', 'ECONOMY')")
def filter_in(t):
    return t.part.filter(F.col("p_type").isin("PROMO", "ECONOMY"))


@query(
    "SELECT * FROM orders WHERE o_totalprice BETWEEN 100000 AND 200000"
    " AND o_orderdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-12-31'"
)
def filter_between(t):
    return t.orders.filter(
        F.col("o_totalprice").between(100000, 200000)
        & F.col("o_orderdate").between(datetime(1997, 1, 1), datetime(1997, 12, 31))
    )


@query(
    "SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01'"
    " AND l_shipdate < TIMESTAMP '1998-01-01'"
)
def filter_date_range(t):
    """Half-open and free of functions on the column, so it reaches the scan."""
    shipped = F.col("l_shipdate")
    return t.lineitem.filter((shipped >= datetime(1997, 1, 1)) & (shipped < datetime(1998, 1, 1)))


@query(
    "SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1996-03-01'"
    " AND o_orderdate <= TIMESTAMP '1996-09-30' AND o_orderstatus <> 'P'"
)
def filter_not_equal(t):
    ordered = F.col("o_orderdate")
    return t.orders.filter(
        (ordered >= datetime(1996, 3, 1))
        & (ordered <= datetime(1996, 9, 30))
        & (F.col("o_orderstatus") != "P")
    )


@query("SELECT * FROM part WHERE p_name LIKE 'b%'")
def filter_like(t):
    return t.part.filter(F.col("p_name").like("b%"))


NULL_PRIORITY = "NULLIF(o_orderpriority, '4-NOT SPECIFIED')"


@query(
    f"SELECT o_orderkey, {NULL_PRIORITY} AS priority,"
    f" {NULL_PRIORITY} IS NOT NULL AS has_priority FROM orders"
    f" WHERE {NULL_PRIORITY} IS NULL OR o_orderstatus IS NOT NULL"
)
def filter_null(t):
    priority = F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED"))
    rows = t.orders.withColumn("priority", priority)
    kept = rows.filter(F.col("priority").isNull() | F.col("o_orderstatus").isNotNull())
    return kept.select("o_orderkey", "priority", F.col("priority").isNotNull().alias("has_priority"))


@query("SELECT * FROM customer WHERE c_custkey IN (1, 3, 7, 100)")
def lookup_by_key(t):
    return t.customer.filter(F.col("c_custkey").isin(1, 3, 7, 100))


@query(
    "SELECT c_custkey, c_mktsegment, c_acctbal, c_nationkey FROM customer"
    " WHERE c_acctbal BETWEEN 2500 AND 4000 AND c_mktsegment = 'MACHINERY' AND c_nationkey >= 5"
)
def filter_combined(t):
    return (
        t.customer.select("c_custkey", "c_mktsegment", "c_acctbal", "c_nationkey")
        .filter(F.col("c_acctbal").between(2500, 4000))
        .filter(F.col("c_mktsegment") == "MACHINERY")
        .filter(F.col("c_nationkey") >= 5)
    )


@query(
    "SELECT l_orderkey, l_partkey, l_extendedprice, l_returnflag FROM lineitem"
    " WHERE l_extendedprice IS NOT NULL AND l_returnflag = 'R'"
)
def select_filter_chain(t):
    chosen = t.lineitem.select("l_orderkey", "l_partkey", "l_extendedprice", "l_returnflag")
    return chosen.filter(F.col("l_extendedprice").isNotNull()).filter(F.col("l_returnflag") == "R")


# --- conditional columns -----------------------------------------------------------------

@query("""
SELECT p_partkey, p_retailprice,
       CASE WHEN p_retailprice < 930 THEN 'Budget'
            WHEN p_retailprice BETWEEN 930 AND 970 THEN 'Mid-Range'
            WHEN p_retailprice > 970 THEN 'Premium' END AS price_tier,
       CASE WHEN p_retailprice < 930 THEN 'Budget'
            WHEN p_retailprice > 970 THEN 'Premium' ELSE 'Uncategorized' END AS price_label
FROM part
""")
def case_price_tier(t):
    price = F.col("p_retailprice")
    return t.part.select(
        "p_partkey",
        "p_retailprice",
        F.when(price < 930, "Budget")
        .when(price.between(930, 970), "Mid-Range")
        .when(price > 970, "Premium")
        .alias("price_tier"),
        F.when(price < 930, "Budget")
        .when(price > 970, "Premium")
        .otherwise("Uncategorized")
        .alias("price_label"),
    )


@query(
    f"SELECT o_orderkey, o_totalprice, {sql.tier('o_totalprice', ORDER_CUTS, 'Low')}"
    " AS order_value_tier FROM orders"
)
def order_value_tier(t):
    label = tier(F.col("o_totalprice"), ORDER_CUTS, "Low")
    return t.orders.select("o_orderkey", "o_totalprice", label.alias("order_value_tier"))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity > 25 AS is_bulk,
       l_returnflag = 'R' AS is_return, l_discount > 0 AS is_discounted,
       'lineitem' AS source_table
FROM lineitem
""")
def flag_columns(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        (F.col("l_quantity") > 25).alias("is_bulk"),
        (F.col("l_returnflag") == "R").alias("is_return"),
        (F.col("l_discount") > 0).alias("is_discounted"),
        F.lit("lineitem").alias("source_table"),
    )
