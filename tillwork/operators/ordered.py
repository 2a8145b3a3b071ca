"""Ranks, running totals and lags over groups of any size.

A plain window sends each group to one task, which fails for a ranking of all customers or
for a customer that owns a third of the orders. Here the rows are laid out once: range-partitioned
on (group, order), so a large group is cut into slices, and written sorted, in a table bucketed by
slice. That is the only full shuffle, and what came before it runs once: it is written first, as
its number of rows and the sample for the ranges are then read from files. There is a slice for
every ROWS_PER_SLICE rows, so slices do not grow with the input.

Windows then run per (group, slice), and one row per (group, slice) is counted together, both
from the bucketed table without a shuffle. The groups at the ends of a slice, two rows a slice at
most, tell each slice what its group holds in the slices before it.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwork.sources.shared import pin, pin_bucketed

SLICE, PLACE = "_slice", "_place"
ROWS_PER_SLICE = 2_000_000


def over_ordered(
    df: DataFrame,
    order: list[tuple[str, str]],
    group: list[str] = (),
    ties: int | None = None,
    row_number: str | None = None,
    rank: str | None = None,
    dense_rank: str | None = None,
    ntile: tuple[str, int] | None = None,
    running: dict[str, str] | None = None,
    totals: dict[str, str] | None = None,
    lag: dict[str, str] | None = None,
) -> DataFrame:
    """Add window columns to ``df``.

    ``order`` lists (column, "asc" | "desc") and must order the rows of a group totally;
    rows that agree on its first ``ties`` columns share a rank. ``running``, ``totals`` and
    ``lag`` map a new column to its source: the sum of the rows so far, the sum of the whole
    group, and the value of the row before.
    """
    group = list(group)
    work = _Windows(
        group, order, ties, bool(rank or dense_rank), running or {}, totals or {}, lag or {}
    )
    laid = layout(df, group, order)
    rows = work.within_slices(laid)
    carried = work.carried(laid)

    # At most two summary rows per slice, so the broadcast is bounded by the slice count.
    match = F.col(SLICE) == F.col("_at_slice")
    for c in group:
        match = match & F.col(c).eqNullSafe(F.col(f"_at_{c}"))
    joined = rows.join(F.broadcast(carried), match, "left")

    before = F.coalesce(F.col("_before"), F.lit(0))
    number = before + F.col("_row")
    continues = F.coalesce(F.col("_continues"), F.lit(False)) if work.ranking else None
    result = {}
    if row_number:
        result[row_number] = number
    if rank:
        result[rank] = F.when(
            continues & (F.col("_rank") == 1), F.col("_carried_rank")
        ).otherwise(before + F.col("_rank"))
    if dense_rank:
        earlier = F.coalesce(F.col("_dense_before"), F.lit(0)) - continues.cast("long")
        result[dense_rank] = earlier + F.col("_dense")
    if ntile:
        result[ntile[0]] = _bucket(number, F.coalesce("_group_rows", "_rows"), ntile[1])
    for name in work.running:
        result[name] = F.coalesce(F.col(f"_prior_{name}") + F.col(f"_run_{name}"), f"_run_{name}")
    for name in work.totals:
        result[name] = F.coalesce(f"_total_{name}", f"_part_{name}")
    for name in work.lag:
        result[name] = F.when(F.col("_row") == 1, F.col(f"_last_{name}")).otherwise(
            F.col(f"_lag_{name}")
        )
    return joined.select(*df.columns, *[c.alias(name) for name, c in result.items()])


def _sorted(order) -> list[Column]:
    return [F.desc(c) if direction == "desc" else F.asc(c) for c, direction in order]


def slice_count(df: DataFrame, per_slice: int = ROWS_PER_SLICE) -> int:
    """A slice for every ``per_slice`` rows, and no fewer than a shuffle has partitions."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-df.count() // per_slice))


def slices(df: DataFrame, group: list[str], order, count: int) -> DataFrame:
    keys = [F.asc(c) for c in group] + _sorted(order)
    ranged = df.repartitionByRange(count, *keys)
    return pin(ranged.withColumn(SLICE, F.spark_partition_id()))


def layout(df: DataFrame, group: list[str], order) -> DataFrame:
    """The rows in slices by (group, order), with their slice and their place in the whole."""
    base = pin(df, "rows")
    count = slice_count(base)
    keys = [F.asc(c) for c in group] + _sorted(order)
    ranged = base.repartitionByRange(count, *keys).sortWithinPartitions(*keys)
    placed = ranged.withColumns({SLICE: F.spark_partition_id(), PLACE: F.monotonically_increasing_id()})
    return pin_bucketed(placed, SLICE, count, "slices")


class _Windows:
    """The window columns asked for, first inside slices and then across them."""

    def __init__(self, group, order, ties, ranking, running, totals, lag):
        self.group, self.order, self.ranking = group, order, ranking
        self.tie_order = order[:ties]
        self.running, self.totals, self.lag = running, totals, lag

    def within_slices(self, laid: DataFrame) -> DataFrame:
        place = Window.partitionBy(*self.group, SLICE)
        local = place.orderBy(*_sorted(self.order))
        so_far = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        columns = {"_row": F.row_number().over(local).cast("long")}
        columns |= {f"_run_{n}": F.sum(c).over(so_far) for n, c in self.running.items()}
        columns |= {f"_lag_{n}": F.lag(c).over(local) for n, c in self.lag.items()}
        if self.ranking:
            tied = place.orderBy(*_sorted(self.tie_order))
            columns["_rank"] = F.rank().over(tied).cast("long")
            columns["_dense"] = F.dense_rank().over(tied).cast("long")
        columns |= {f"_part_{n}": F.sum(c).over(place) for n, c in self.totals.items()}
        columns["_rows"] = F.count("*").over(place)
        return laid.withColumns(columns)

    def summary(self, laid: DataFrame) -> DataFrame:
        """One row per (group, slice): numbers of rows and of ties, sums, the first and last row."""
        sums = {f"_run_{n}": c for n, c in self.running.items()} | {f"_part_{n}": c for n, c in self.totals.items()}
        ends = {f"_end_{n}": c for n, c in self.lag.items()}
        tie = F.struct(*[c for c, _ in self.tie_order])
        keys = [*self.group, SLICE]
        if self.ranking:  # first together what is tied
            laid = laid.groupBy(*keys, tie.alias("_tie")).agg(
                F.count("*").alias("_n"), F.min(PLACE).alias("_first"), F.max(PLACE).alias("_to"),
                *[F.sum(c).alias(n) for n, c in sums.items()], *[F.max_by(c, PLACE).alias(n) for n, c in ends.items()],
            )
            sums, ends = {n: n for n in sums}, {n: n for n in ends}
            more = [
                (F.sum("_n") - F.max_by("_n", "_to") + 1).alias("_rank"), F.count("*").alias("_dense"),
                F.min_by("_tie", "_first").alias("_head"), F.max_by("_tie", "_to").alias("_tail"),
            ]
        else:
            laid = laid.withColumns({"_n": F.lit(1).cast("long"), "_first": F.col(PLACE), "_to": F.col(PLACE)})
            more = []
        return laid.groupBy(*keys).agg(
            F.sum("_n").alias("_rows"), F.min("_first").alias("_first"), F.max("_to").alias("_to"), *more,
            *[F.sum(c).alias(n) for n, c in sums.items()], *[F.max_by(c, "_to").alias(n) for n, c in ends.items()],
        )

    def carried(self, laid: DataFrame) -> DataFrame:
        """What each slice has to add: a row for the first and for the last group of a slice."""
        in_slice = Window.partitionBy(SLICE)
        ends = self.summary(laid).withColumns(
            {"_opens": F.min("_first").over(in_slice), "_closes": F.max("_to").over(in_slice)}
        )
        slices = ends.filter((F.col("_first") == F.col("_opens")) | (F.col("_to") == F.col("_closes")))

        whole = Window.partitionBy(*self.group)
        ordered = whole.orderBy(SLICE)
        earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
        out = {
            "_before": F.coalesce(F.sum("_rows").over(earlier), F.lit(0)),
            "_group_rows": F.sum("_rows").over(whole),
        }
        out |= {f"_prior_{n}": F.sum(f"_run_{n}").over(earlier) for n in self.running}
        out |= {f"_total_{n}": F.sum(f"_part_{n}").over(whole) for n in self.totals}
        out |= {f"_last_{n}": F.lag(f"_end_{n}").over(ordered) for n in self.lag}
        slices = slices.withColumns(out)
        keep = list(out)
        if self.ranking:
            slices = self._ties_across(slices, whole, ordered, earlier)
            keep += ["_continues", "_carried_rank", "_dense_before"]
        names = [F.col(c).alias(f"_at_{c}") for c in self.group]
        return slices.select(*names, F.col(SLICE).alias("_at_slice"), *keep)

    def _ties_across(self, slices, whole, ordered, earlier) -> DataFrame:
        """A run of ties that crosses slices keeps the rank of the row where it began."""
        run = Window.partitionBy(*self.group, "_tail")
        slices = slices.withColumn(
            "_run_start", F.min(F.col("_before") + F.col("_rank")).over(run)
        ).withColumns(
            {
                "_continues": F.coalesce(
                    F.col("_head") == F.lag("_tail").over(ordered), F.lit(False)
                ),
                "_carried_rank": F.lag("_run_start").over(ordered),
            }
        )
        fresh = F.col("_dense") - F.col("_continues").cast("long")
        return slices.withColumn(
            "_dense_before", F.coalesce(F.sum(fresh).over(earlier), F.lit(0))
        )


def _bucket(number: Column, rows: Column, buckets: int) -> Column:
    """The SQL NTILE rule: sizes differ by one row at most, the larger buckets come first."""
    small = F.floor(rows / buckets)
    larger = rows % buckets
    in_larger = larger * (small + 1)
    return F.when(number <= in_larger, F.ceil(number / (small + 1))).otherwise(
        larger + F.ceil(F.try_divide(number - in_larger, small))
    ).cast("long")
