"""Bronze, silver and gold layers of the retail lake, each table a published folder.

Layers meet only through storage: a layer is written once and read back by the next. Columns
that a layer does not clean pass through it.
"""

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillwork.functions.money import amount, money_sum
from tillwork.operators import scd2
from tillwork.operators.clean import first_by
from tillwork.operators.flows import clean_orders
from tillwork.sources.files import with_lineage
from tillwork.sources.published import publish, read_manifest, write_manifest

LINEAGE = ["_ingested_at", "_source_file"]
BY_STATE = ("is_current",)


def silver_customers(bronze: DataFrame) -> DataFrame:
    """One row per customer, city in one spelling. Of several copies the first city wins."""
    tidy = bronze.withColumn("city", F.initcap(F.trim("city")))
    order = [F.col(c) for c in ("city", "customer_name", "email")]
    return first_by(tidy, ["customer_id"], order)


def silver_orders(bronze: DataFrame, order: list[Column]) -> DataFrame:
    return clean_orders(bronze, order)


def silver_payments(bronze: DataFrame) -> DataFrame:
    order = [F.col(c) for c in ("order_id", "payment_method", "amount", "payment_status")]
    return first_by(bronze, ["payment_id"], order)


def gold_monthly_revenue(fulfilled: DataFrame) -> DataFrame:
    months = fulfilled.groupBy(F.trunc("order_date", "MM").alias("m")).agg(
        F.count("*").alias("num_orders"),
        amount(money_sum("line_revenue")).alias("total_revenue"),
    )
    return months.select(
        F.date_format("m", "yyyy-MM").alias("month"), "num_orders", "total_revenue"
    )


def gold_customer_360(fulfilled: DataFrame, customers: DataFrame, segment) -> DataFrame:
    """``segment`` turns the spend column into a label."""
    spend = fulfilled.groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"),
        amount(money_sum("line_revenue")).alias("lifetime_spend"),
        F.max("order_date").alias("last_order_date"),
    )
    named = spend.join(customers, "customer_id").select(
        "customer_id", "customer_name", "city", "total_orders", "lifetime_spend", "last_order_date"
    )
    return named.withColumn("customer_segment", segment(F.col("lifetime_spend")))


def gold_product_performance(fulfilled: DataFrame, products: DataFrame) -> DataFrame:
    sold = fulfilled.groupBy("product_id").agg(
        F.sum("quantity").alias("units_sold"),
        amount(money_sum("line_revenue")).alias("total_revenue"),
    )
    named = sold.join(scd2.current(products), "product_id")
    return named.select("product_id", "product_name", "category", "units_sold", "total_revenue")


class Lake:
    """The whole flow, in fresh folders under ``root``, which should outlive the session.

    ``commit`` writes the manifest, one file that names the folders of all tables; any session
    reads what it names with ``opened``. A build that fails before its commit changes nothing for
    readers. A table has one folder, but product versions may have several: the newest one holds
    all current versions, and each holds the versions that its batch ended.
    """

    def __init__(self, spark: SparkSession, root: str, tables: dict | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.tables: dict[str, dict] = tables or {}

    @classmethod
    def opened(cls, spark: SparkSession, root: str) -> "Lake":
        return cls(spark, root, read_manifest(spark, root.rstrip("/")))

    def commit(self) -> None:
        write_manifest(self.spark, self.root, self.tables)

    def read(self, layer: str, name: str) -> DataFrame:
        *older, newest = self.tables[f"{layer}/{name}"]["folders"]
        rows = self._folders(layer, name, newest)
        if older:
            rows = rows.unionByName(self._folders(layer, name, *older).filter("not is_current"))
        return rows

    def _folders(self, layer: str, name: str, *folders: str) -> DataFrame:
        own = self.tables[f"{layer}/{name}"]
        schema = StructType.fromJson(own["schema"])
        reader = self.spark.read.schema(schema)
        if own["base"]:
            reader = reader.option("basePath", own["base"])
        return reader.parquet(*folders).select(*schema.names)

    def _publish(self, layer: str, name: str, df: DataFrame, by: tuple[str, ...] = (), onto: tuple[str, ...] = ()) -> None:
        label = f"{layer}-{name}"
        folder = publish(df, f"{label}/batch=" if by else label, self.root, by)
        base = f"{self.root}/{label}" if by else None  # above the batches, for Spark to tell partitions
        self.tables[f"{layer}/{name}"] = {"folders": [*onto, folder], "base": base, "schema": df.schema.jsonValue()}

    def build_bronze(self, sources: dict[str, DataFrame]) -> None:
        """Land the sources as they are, with the time of landing and the file of each row."""
        for name, df in sources.items():
            self._publish("bronze", name, with_lineage(df))

    def build_silver(self, order: list[Column], opened: date) -> None:
        read = lambda name: self.read("bronze", name).drop(*LINEAGE)
        self._publish("silver", "customers", silver_customers(read("customers")))
        self._publish("silver", "orders", silver_orders(read("orders"), order))
        self._publish("silver", "payments", silver_payments(read("payments")))
        self._publish("silver", "products", scd2.init(read("products"), opened), BY_STATE)

    def reprice(self, changes: DataFrame, at: date) -> None:
        """Apply one batch of prices. It reads the current versions and writes them with those that
        end now; earlier ones stay where they are. Only a late change has all versions rewritten."""
        folders = self.tables["silver/products"]["folders"]
        open_rows = scd2.current(self._folders("silver", "products", folders[-1]))
        if scd2.is_late(open_rows, changes, "product_id", at):
            open_rows, folders = self.read("silver", "products"), []
        repriced = scd2.apply_changes(open_rows, changes, "product_id", at, ["price"])
        self._publish("silver", "products", repriced, BY_STATE, tuple(folders))

    def build_gold(self, statuses: list[str], segment) -> None:
        orders = self.read("silver", "orders").filter(F.col("order_status").isin(*statuses))
        self._publish("gold", "monthly_revenue", gold_monthly_revenue(orders))
        customers = self.read("silver", "customers")
        self._publish("gold", "customer_360", gold_customer_360(orders, customers, segment))
        products = self.read("silver", "products")
        self._publish("gold", "product_performance", gold_product_performance(orders, products))
