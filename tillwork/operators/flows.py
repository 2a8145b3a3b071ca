"""Cleaning flows over the retail record layouts, built from the smaller operators."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.functions import text
from tillwork.functions.dates import elapsed_days, parse_timestamp
from tillwork.functions.money import MONEY, amount, money_mean, money_sum
from tillwork.operators.clean import fill_approx_median, fill_median, fill_mode, first_by
from tillwork.operators.profile import count_rules
from tillwork.sources.shared import pin

# The date layouts found in raw order files, in the order they are tried.
ORDER_DATE_FORMATS = ["yyyy-MM-dd HH:mm:ss", "dd-MM-yyyy"]
WELL_FORMED_DATE = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"


def clean_shopping(df: DataFrame) -> DataFrame:
    """Shopping list: text nulls, then fills, then duplicates, then totals.

    Fills come before the duplicates go, so the median and mode count every copy. The input
    is pinned because both fills read it before the result does.
    """
    known = pin(df.withColumns({c: text.tokens_to_null(F.col(c)) for c in ("category", "size")}))
    filled = fill_mode(fill_median(known, "price"), "quantity").fillna("Unknown", ["size"])
    total = F.col("price").cast(MONEY) * F.col("quantity")
    return filled.dropDuplicates().withColumn("total_amount", amount(total))


def clean_orders(df: DataFrame, order: list[Column]) -> DataFrame:
    """One row per order id: real dates, delivery days, line revenue, tidy status."""
    unique = first_by(df, ["order_id"], order)
    dated = unique.withColumns(
        {
            "order_date": F.col("order_date").try_cast("date"),
            "delivery_date": F.col("delivery_date").try_cast("date"),
            "is_valid_quantity": F.col("quantity") > 0,
            "order_status": text.title_case(text.squeeze(F.col("order_status"))),
            "line_revenue": amount(F.col("quantity") * F.col("unit_price").cast(MONEY)),
        }
    )
    return dated.withColumn(
        "delivery_days", elapsed_days(F.col("order_date"), F.col("delivery_date")).cast("bigint")
    )


def clean_summary(before: DataFrame, after: DataFrame) -> DataFrame:
    """What ``clean_orders`` did: (metric, value)."""
    raw = before.agg(F.count("*").alias("rows_before"))
    done = after.agg(
        F.count("*").alias("rows_after"),
        F.count_if(~F.col("is_valid_quantity")).alias("orders_with_invalid_quantity"),
        F.count_if(F.col("delivery_days").isNull()).alias("orders_missing_delivery_days"),
        (raw.scalar() - F.count("*")).alias("duplicate_rows_removed"),
        raw.scalar().alias("rows_before"),
    )
    return done.unpivot([], done.columns, "metric", "value")


def clean_raw_orders(df: DataFrame, as_of: Column) -> DataFrame:
    """Text orders to typed ones, each problem kept as a flag instead of a dropped row.

    A missing customer stays null; a date that needs another format is counted as such; a
    date after ``as_of`` is flagged.
    """
    raw_date = F.col("order_date")
    customer = text.blank_to_null(F.col("customer_id"))
    parsed = parse_timestamp(raw_date, ORDER_DATE_FORMATS)
    return df.select(
        "*",
        customer.isNull().alias("customer_id_missing_flag"),
        (~F.coalesce(raw_date.rlike(WELL_FORMED_DATE), F.lit(False))).alias("date_reformatted"),
        parsed.alias("_parsed"),
    ).withColumns(
        {
            "customer_id": customer.try_cast("bigint"),
            "order_date": F.col("_parsed"),
            "date_unparseable": F.col("_parsed").isNull(),
            "date_in_future": F.coalesce(F.col("_parsed") > as_of, F.lit(False)),
        }
    ).drop("_parsed")


# Issue name -> flag column that clean_raw_orders sets.
ORDER_ISSUES = {
    "missing_customer_id": "customer_id_missing_flag",
    "reformatted_date": "date_reformatted",
    "unparseable_date": "date_unparseable",
    "future_dated_order": "date_in_future",
}


def order_issues(cleaned: DataFrame) -> DataFrame:
    """One row (issue, order_id) per problem found."""
    names = [F.when(F.col(flag), F.lit(issue)) for issue, flag in ORDER_ISSUES.items()]
    found = F.explode(F.array_compact(F.array(*names)))
    return cleaned.select(found.alias("issue"), "order_id")


def clean_products(df: DataFrame) -> DataFrame:
    """Trim and title-case the product name and tell whether that changed it."""
    tidy = text.title_case(text.squeeze(F.col("product_name")))
    return df.select(
        *[c for c in df.columns if c != "product_name"],
        tidy.alias("product_name"),
        (~F.col("product_name").eqNullSafe(tidy)).alias("name_changed"),
    )


def quality_report(
    raw_orders: DataFrame,
    as_of: Column,
    products: DataFrame,
    customers: DataFrame,
    orphans: DataFrame,
    items: DataFrame,
) -> DataFrame:
    """The data-quality report as rows (table_name, metric, value), one scan per table."""
    orders = clean_raw_orders(raw_orders, as_of)
    order_part = count_rules(orders, {i: F.col(f) for i, f in ORDER_ISSUES.items()}, "metric")
    named = clean_products(products)
    names = named.groupBy("product_name").agg(
        F.count("*").alias("n"), F.count_if("name_changed").alias("changed")
    )
    product_part = names.agg(
        F.sum("changed").alias("names_normalized"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("duplicate_names"),
    )
    product_part = product_part.unpivot([], product_part.columns, "metric", "n")
    customer_part = count_rules(
        customers, {"invalid_emails": ~text.is_email(F.col("email"))}, "metric"
    )
    outside = (F.col("discount_percent") < 0) | (F.col("discount_percent") > 100)
    item_part = count_rules(
        items,
        {
            "negative_quantity": F.col("quantity") < 0,
            "zero_quantity": F.col("quantity") == 0,
            "discount_out_of_range": outside,
        },
        "metric",
    )
    orphan_part = orphans.agg(F.count("*").alias("n")).withColumn("metric", F.lit("orphaned_items"))
    parts = {
        "orders": order_part,
        "products": product_part,
        "customers": customer_part,
        "order_items": item_part.unionByName(orphan_part),
    }
    result = None
    for name, part in parts.items():
        rows = part.select(F.lit(name).alias("table_name"), "metric", F.col("n").alias("value"))
        result = rows if result is None else result.unionByName(rows)
    return result


def retail_summary(df: DataFrame) -> DataFrame:
    """Raw retail transactions to revenue per region and category of adults' completed sales."""
    unique = df.dropDuplicates()
    kept = unique.dropna(subset=["quantity", "total_amount", "unit_price"]).select(
        "region", "product_category", "order_status", "total_amount",
        text.to_integer(F.col("age")).alias("age"),
    )
    # The median and the report both read the rows: join and de-duplicate them once.
    kept = pin(kept)
    aged = fill_approx_median(kept, "age", relative_error=0.0001)
    category = text.canonical(F.col("product_category"), text.CATEGORY_NAMES)
    sales = aged.withColumn("category", category).filter(
        (F.col("order_status") == "Completed") & (F.col("age") >= 18)
    )
    return sales.groupBy("region", "category").agg(
        F.count("*").alias("order_count"),
        amount(money_sum("total_amount")).alias("total_revenue"),
        amount(money_mean("total_amount")).alias("avg_order_value"),
    )


def split_staging(
    flat: DataFrame, customers: list[str], products: list[str], product_name: str, orders: list[str]
) -> dict[str, DataFrame]:
    """Take a flat staging table apart into customers, products and orders.

    A product may be spelled in several ways; the smallest name stands for all.
    """
    return {
        "customers": flat.select(*customers).distinct(),
        "products": flat.groupBy(*products).agg(F.min(product_name).alias(product_name)),
        "orders": flat.select(*orders).distinct(),
    }


# Amounts from which an order counts as high or medium.
VALUE_TIERS = [("High", 500), ("Medium", 150)]


def clean_transactions(df: DataFrame, tiers=tuple(VALUE_TIERS)) -> DataFrame:
    """Wide retail transactions: typed, trimmed, tiered, with year and month of sale."""
    whole = {"transaction_id": "bigint", "customer_id": "bigint", "age": "int",
             "total_purchases": "int", "ratings": "int"}
    plain = ["country", "state", "gender", "customer_segment", "product_brand",
             "payment_method", "order_status"]
    columns = [F.col(c).try_cast(kind).alias(c) for c, kind in whole.items()]
    columns += [F.trim(c).alias(c) for c in plain]
    columns += [amount(F.col(c).cast(MONEY)).alias(c) for c in ("unit_amount", "total_amount")]
    columns += [
        F.upper(F.trim("product_category")).alias("product_category"),
        F.try_to_timestamp("date", F.lit("M/d/yyyy")).cast("date").alias("txn_date"),
    ]
    rows = df.select(*columns).dropna(subset=["transaction_id", "customer_id", "total_amount"])
    rows = rows.fillna({"ratings": 0, "order_status": "Unknown", "product_brand": "Unknown"})
    (high, high_cut), (medium, medium_cut) = tiers
    value = F.col("total_amount")
    return rows.withColumns(
        {
            "order_value_tier": F.when(value >= high_cut, high)
            .when(value >= medium_cut, medium)
            .otherwise("Low"),
            "txn_year": F.year("txn_date"),
            "txn_month": F.month("txn_date"),
        }
    )
