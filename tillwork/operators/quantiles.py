"""Exact quantiles and modes that never gather a column in one task."""

from dataclasses import dataclass
from math import ceil, floor, inf

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def long_values(df: DataFrame, columns: list[str], kind: str) -> DataFrame:
    """One row (column_name, value) per non-null cell."""
    typed = df.select([F.col(c).cast(kind).alias(c) for c in columns])
    return typed.unpivot([], columns, "column_name", "value").filter("value is not null")


ACCURACY = 10_000  # of the sketches: ranks are off by one in so many rows
BAND_ROWS = 200_000  # a band with more is narrowed again


@dataclass
class _Point:
    """The place of one quantile of one column: values from low to high, and what lies below."""

    column: str
    name: str
    share: float
    rows: int
    low: float = -inf
    high: float = inf
    below: int = 0
    inside: int = 0

    @property
    def first(self) -> int:
        return floor(self.share * (self.rows - 1))

    @property
    def last(self) -> int:
        return ceil(self.share * (self.rows - 1))

    @property
    def covered(self) -> bool:
        return self.below <= self.first and self.last < self.below + self.inside

    @property
    def wide(self) -> bool:
        return self.inside > BAND_ROWS and self.low < self.high

    def holds(self, value: Column) -> Column:
        return (value >= F.lit(self.low)) & (value <= F.lit(self.high))


def exact_quantiles(df: DataFrame, columns: list[str], points: dict[str, float]) -> DataFrame:
    """One row per column with its linearly interpolated quantiles; a column without finite
    values has none.

    Nothing is sorted as a whole. A sketch of every column, merged from partial ones, says
    between which values a quantile lies; a second pass counts what is below and between, and
    only the values between, counted per distinct value, are put in order. A band that is still
    wide gets a sketch of its own, one that missed its place is opened on that side. So each
    pass cuts the rows by a factor of some thousands, and the result is exact whatever the
    sketches say. The driver sees some numbers per column and quantile.
    """
    values = {c: _finite(c) for c in columns}
    sizes = df.agg(*[F.count(v).alias(c) for c, v in values.items()]).first()
    spots = [_Point(c, name, q, sizes[c]) for c in columns if sizes[c] for name, q in points.items()]
    for p in spots:
        p.inside = p.rows
    todo = [p for p in spots if p.wide]
    while todo:
        before = [p.inside for p in todo]
        _narrow(df, values, todo)
        _count(df, values, todo)
        for p in todo:
            if not p.covered:
                p.low, p.high = (-inf if p.first < p.below else p.low), (inf if p.last >= p.below + p.inside else p.high)
        _count(df, values, [p for p in todo if not p.covered])
        # Many copies of one value beside others: the band may stay, what counts is distinct.
        todo = [p for p, n in zip(todo, before) if p.wide and p.inside < n / 2]
    return _settled(df, values, spots, list(points))


def _finite(column: str) -> Column:
    value = F.col(column).cast("double")
    return F.when(F.abs(value) < inf, value)


def _narrow(df: DataFrame, values: dict[str, Column], spots: list[_Point]) -> None:
    """Bounds of each band from a sketch of what is in it now."""
    found = []
    for k, p in enumerate(spots):
        at = (p.share * (p.rows - 1) - p.below) / max(p.inside - 1, 1)
        ends = F.array(*[F.lit(min(max(at + d, 0.0), 1.0)) for d in (-2 / ACCURACY, 2 / ACCURACY)])
        inside = F.when(p.holds(values[p.column]), values[p.column])
        found.append(F.percentile_approx(inside, ends, ACCURACY).alias(str(k)))
    for p, (low, high) in zip(spots, df.agg(*found).first()):
        p.low, p.high = low, high


def _count(df: DataFrame, values: dict[str, Column], spots: list[_Point]) -> None:
    found = []
    for k, p in enumerate(spots):
        v = values[p.column]
        found += [F.count_if(v < F.lit(p.low)).alias(f"b{k}"), F.count_if(p.holds(v)).alias(f"i{k}")]
    if found:
        row = df.agg(*found).first()
        for k, p in enumerate(spots):
            p.below, p.inside = row[f"b{k}"], row[f"i{k}"]


def _settled(df: DataFrame, values: dict[str, Column], spots: list[_Point], names: list[str]) -> DataFrame:
    """The rows in the bands, per distinct value, and which of them cover the places."""
    spark = df.sparkSession
    schema = "_spot int, column_name string, _name string, _first long, _last long, _below long, _part double"
    facts = [
        (k, p.column, p.name, p.first - p.below, p.last - p.below, p.below, p.share * (p.rows - 1) - p.first)
        for k, p in enumerate(spots)
    ]
    bands = [
        F.when(p.holds(values[p.column]), F.struct(F.lit(k).alias("_spot"), values[p.column].alias("_value")))
        for k, p in enumerate(spots)
    ]
    inside = df.select(F.explode(F.array_compact(F.array(*bands))).alias("b")) if bands else None
    if inside is None:
        return spark.createDataFrame([], "column_name string, " + ", ".join(f"`{n}` double" for n in names))
    counts = inside.select("b.*").groupBy("_spot", "_value").agg(F.count("*").alias("_n"))
    upto = Window.partitionBy("_spot").orderBy("_value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = counts.withColumn("_upto", F.sum("_n").over(upto))
    known = placed.join(F.broadcast(spark.createDataFrame(facts, schema)), "_spot")

    def value_at(position: str) -> Column:
        covers = (F.col("_upto") > F.col(position)) & (F.col("_upto") - F.col("_n") <= F.col(position))
        return F.max(F.when(covers, F.col("_value")))

    low, high = value_at("_first"), value_at("_last")
    each = known.groupBy("column_name", "_name").agg((low + (high - low) * F.max("_part")).alias("_q"))
    return each.groupBy("column_name").agg(
        *[F.max(F.when(F.col("_name") == n, F.col("_q"))).alias(n) for n in names]
    )


def most_common(df: DataFrame, column: str) -> DataFrame:
    """A one-row frame with the most frequent value, the smallest one on a tie."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).count()
    return counts.orderBy(F.desc("count"), F.asc(column)).limit(1).select(column)
