"""Filling, dropping, de-duplicating."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwork.operators.quantiles import exact_quantiles, most_common
from tillwork.sources.shared import pin


def fill_median(df: DataFrame, *columns: str) -> DataFrame:
    """Replace nulls by the exact median of the column."""
    medians = pin(exact_quantiles(df, list(columns), {"median": 0.5}), "medians")

    def filled(c: str) -> Column:
        median = medians.filter(F.col("column_name") == c).select(F.max("median")).scalar()
        return F.coalesce(F.col(c), median.cast(df.schema[c].dataType))

    return df.withColumns({c: filled(c) for c in columns})


def fill_approx_median(df: DataFrame, column: str, relative_error: float = 0.01) -> DataFrame:
    """Replace nulls by a sketched median: one pass, bounded memory."""
    accuracy = max(1, round(1 / relative_error))
    middle = df.agg(F.percentile_approx(column, F.lit(0.5), F.lit(accuracy)).alias("m"))
    return df.withColumn(column, F.coalesce(F.col(column), middle.scalar()))


def fill_mode(df: DataFrame, *columns: str) -> DataFrame:
    """Replace nulls by the most frequent value, the smallest on a tie."""
    return df.withColumns(
        {c: F.coalesce(F.col(c), most_common(df, c).scalar()) for c in columns}
    )


def first_by(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The first row of every key under a total order.

    Catalyst limits each map task to one row per key before the shuffle, so a key with very
    many copies arrives as a handful of rows.
    """
    row = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("_row", row).filter("_row = 1").drop("_row")


def clamp(value: Column, low, high) -> Column:
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))


def require_complete(df: DataFrame, *columns: str) -> DataFrame:
    """The same rows; the job fails if any of the columns holds a null."""
    for c in columns:
        failure = F.raise_error(F.lit(f"null in column {c}")).cast("boolean")
        df = df.filter(F.when(F.col(c).isNull(), failure).otherwise(F.lit(True)))
    return df
