"""Registry of named queries and of the SQL that checks them."""

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.sources.tables import Tables

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name, with the equivalent SQL if there is one."""

    def register(build):
        QUERIES[build.__name__] = build
        if sql:
            ORACLES[build.__name__] = sql.strip()
        return build

    return register


# Parameters of the reports, on the scale of the driver tables.
FULFILLED = ["F", "P"]
SEGMENT_CUTS = [("VIP", 3_700_000), ("High Value", 2_500_000), ("Regular", 1_400_000)]
MONTHLY_CUTS = [("High", 400_000), ("Medium", 150_000)]
ORDER_CUTS = [("High", 350_000), ("Medium", 150_000)]
RISK_GAP_DAYS = 220
AS_OF = date(2001, 8, 1)
CHECKED_ON = date(2001, 1, 1)
REPRICED_ON = date(1998, 1, 1)
REPRICED_AGAIN_ON = date(2000, 1, 1)
OPENED_ON = date(1995, 1, 1)


def fulfilled(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("o_orderstatus").isin(*FULFILLED))


def tier(value, cuts, otherwise: str):
    """The first label whose cut the value reaches."""
    (label, cut), *rest = cuts
    labelled = F.when(value >= cut, label)
    for label, cut in rest:
        labelled = labelled.when(value >= cut, label)
    return labelled.otherwise(otherwise)
