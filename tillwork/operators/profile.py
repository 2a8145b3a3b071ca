"""Profiles: one aggregate pass per question, results in long form."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.functions.money import RATIO, amount, percent
from tillwork.operators.quantiles import exact_quantiles, long_values

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def _per_column(df: DataFrame, tests: dict[str, Column], name: str) -> DataFrame:
    """Count the rows that meet each column's test: (column_name, total_rows, <name>)."""
    counts = df.agg(
        F.count("*").alias("total_rows"), *[F.count_if(test).alias(c) for c, test in tests.items()]
    )
    return counts.unpivot(["total_rows"], list(tests), "column_name", name)


def null_profile(df: DataFrame) -> DataFrame:
    """Columns with nulls: how many and what share."""
    found = _per_column(df, {c: F.col(c).isNull() for c in df.columns}, "null_count")
    share = percent(F.col("null_count"), F.col("total_rows"))
    return found.filter("null_count > 0").select("column_name", "null_count", share.alias("null_percent"))


def blank_profile(df: DataFrame) -> DataFrame:
    """Null or blank cells per column."""
    tests = {
        c: F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "") for c in df.columns
    }
    return _per_column(df, tests, "missing_count").select("column_name", "missing_count")


def schema_profile(df: DataFrame) -> DataFrame:
    """Position, type and non-null count of every column, with the row count."""
    filled = _per_column(df, {c: F.col(c).isNotNull() for c in df.columns}, "non_null_count")
    facts = [
        F.struct(F.lit(f.name).alias("name"), F.lit(i).alias("position"),
                 F.lit(f.dataType.simpleString()).alias("data_type"))
        for i, f in enumerate(df.schema.fields, start=1)
    ]
    found = F.filter(F.array(*facts), lambda s: s["name"] == F.col("column_name"))[0]
    return filled.select(
        "column_name",
        found["position"].cast("bigint").alias("position"),
        found["data_type"].alias("data_type"),
        "non_null_count",
        "total_rows",
    )


def describe_numeric(df: DataFrame, *columns: str) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles, one row per column."""
    def published(c: Column) -> Column:
        return amount(c.cast(RATIO), 4)

    facts = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.count(c).alias("count"),
            published(F.avg(c)).alias("mean"),
            published(F.stddev_samp(c)).alias("std"),
            F.min(c).alias("min"),
            F.max(c).alias("max"),
        )
        for c in columns
    ]
    numbers = df.select([F.col(c).cast("double").alias(c) for c in columns])
    moments = numbers.agg(F.array(*facts).alias("facts")).select(F.inline("facts"))
    quartiles = exact_quantiles(df, list(columns), QUARTILES)
    rounded = [published(F.col(q)).alias(q) for q in QUARTILES]
    return moments.join(quartiles.select("column_name", *rounded), "column_name", "left")


def describe_categorical(df: DataFrame, *columns: str) -> DataFrame:
    """Count, distinct values, the most frequent one and its count, one row per column."""
    counts = long_values(df, list(columns), "string").groupBy("column_name", "value").count()
    return counts.groupBy("column_name").agg(
        F.sum("count").alias("count"),
        F.count("*").alias("unique_values"),
        F.min_by("value", F.struct(-F.col("count"), F.col("value"))).alias("top"),
        F.max("count").alias("freq"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def copies(df: DataFrame, *key: str) -> DataFrame:
    """Rows (or keys) that occur more than once, with their number of copies."""
    key = key or df.columns
    return df.groupBy(*key).agg(F.count("*").alias("copies")).filter("copies > 1")


def surplus(df: DataFrame, *key: str) -> DataFrame:
    """How many rows go beyond the first of each key."""
    groups = df.groupBy(*key).agg(F.count("*").alias("n"))
    return groups.agg(
        F.sum("n").alias("total_rows"),
        F.count("*").alias("distinct_keys"),
        F.sum(F.col("n") - 1).alias("duplicate_rows"),
    )


def attribute_drift(df: DataFrame, key: str, attribute: str) -> DataFrame:
    """Keys that carry several values of an attribute that should be one."""
    pairs = df.select(key, attribute).distinct()
    return pairs.groupBy(key).agg(F.count(attribute).alias("distinct_values")).filter(
        "distinct_values > 1"
    )


def count_rules(df: DataFrame, rules: dict[str, Column], label: str = "rule") -> DataFrame:
    """How many rows meet each predicate, in one pass: (label, n)."""
    counts = df.agg(*[F.count_if(test).alias(name) for name, test in rules.items()])
    return counts.unpivot([], list(rules), label, "n")
