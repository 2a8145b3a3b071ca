"""Slowly changing dimensions, type 2, and row maintenance by rewriting a table.

Every version of a key is valid on the half-open interval [effective_date, end_date); the
current one has no end. One key has one current version and no overlapping intervals.
"""

from collections import defaultdict
from datetime import date
from itertools import groupby

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwork.operators.ordered import SLICE, slice_count, slices
from tillwork.sources.shared import pin

VALIDITY = ["effective_date", "end_date", "is_current"]


def init(df: DataFrame, effective: date) -> DataFrame:
    """Open the first version of every row."""
    return df.withColumns(
        {
            "effective_date": F.lit(effective),
            "end_date": F.lit(None).cast("date"),
            "is_current": F.lit(True),
        }
    )


def one_per_key(changes: DataFrame, key: str) -> DataFrame:
    """The same rows; the job fails if a key occurs twice."""
    values = [c for c in changes.columns if c != key]
    grouped = changes.groupBy(key).agg(F.count("*").alias("_n"), *[F.first(c).alias(c) for c in values])
    twice = F.raise_error(F.concat(F.lit(f"several changes for {key} "), F.col(key).cast("string")))
    valid = F.when(F.col("_n") > 1, twice.cast("boolean")).otherwise(F.lit(True))
    return grouped.filter(valid).select(*changes.columns)


def apply_changes(
    table: DataFrame, changes: DataFrame, key: str, at: date, tracked: list[str]
) -> DataFrame:
    """Split the version of each changed key that is in force on ``at``: it ends there, and one
    with the new values begins and ends when the old one would have.

    ``changes`` holds the key and new values of the tracked columns. Mostly the version in force
    is the current one. A late change splits an older one instead, and what began after it stays
    as it is. Equal values change nothing, so running a batch again changes nothing. A version
    that began on ``at`` itself is replaced; a change dated before the first version of its key
    fails. One join and one pass: each row becomes itself, its ended form, or that and the new one.
    """
    new = {c: f"_new_{c}" for c in tracked}
    batch = one_per_key(changes.select(key, *tracked), key).withColumnsRenamed(new)
    begun = table.groupBy(F.col(key).alias("_of")).agg(F.min("effective_date").alias("_begun"))
    batch = batch.withColumn("_hit", F.lit(True)).withColumnRenamed(key, "_key")
    batch = batch.join(begun, F.col("_key") == F.col("_of")).drop("_of")
    joined = table.join(batch, F.col(key) == F.col("_key"), "left")

    differs = F.lit(False)
    for c in tracked:
        differs = differs | ~F.col(c).eqNullSafe(F.col(new[c]))
    when = F.lit(at)
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    in_force = (F.col("effective_date") <= when) & (F.col("end_date").isNull() | (F.col("end_date") > when))
    changed = hit & in_force & differs

    same = F.struct(*table.columns)
    closed = {"end_date": when, "is_current": F.lit(False)}
    opened = {c: F.col(new[c]) for c in tracked} | {"effective_date": when}

    def version(values: dict[str, Column]) -> Column:
        types = {f.name: f.dataType for f in table.schema.fields}
        return F.struct(
            *[values.get(c, F.col(c)).cast(types[c]).alias(c) for c in table.columns]
        )

    early = F.raise_error(F.lit(f"change at {at} precedes the first version"))
    versions = (
        F.when(~changed, F.array(same))
        .when(F.col("effective_date") == when, F.array(version(opened)))
        .otherwise(F.array(version(closed), version(opened)))
    )
    checked = joined.filter(
        F.when(hit & (F.col("_begun") > when), early.cast("boolean")).otherwise(F.lit(True))
    )
    return checked.select(F.explode(versions).alias("v")).select("v.*")


def is_late(open_rows: DataFrame, changes: DataFrame, key: str, at: date) -> bool:
    """Whether a change at ``at`` concerns a key whose current version began after it."""
    newer = open_rows.filter(F.col("effective_date") > F.lit(at))
    return not newer.join(changes.select(key), key, "left_semi").isEmpty()


def current(table: DataFrame) -> DataFrame:
    return table.filter("is_current")


def as_of(table: DataFrame, at: date) -> DataFrame:
    """The versions in force on a day."""
    open_end = F.col("end_date").isNull() | (F.col("end_date") > F.lit(at))
    return table.filter((F.col("effective_date") <= F.lit(at)) & open_end)


def history(table: DataFrame, key: str, value) -> DataFrame:
    return table.filter(F.col(key) == F.lit(value)).orderBy("effective_date")


def merge_update(target: DataFrame, updates: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Overwrite the columns of matched rows; other rows stay as they are."""
    new = {c: f"_new_{c}" for c in columns}
    batch = one_per_key(updates.select(key, *columns), key).withColumnsRenamed(new)
    batch = batch.withColumn("_hit", F.lit(True)).withColumnRenamed(key, "_key")
    joined = target.join(batch, F.col(key) == F.col("_key"), "left")
    updated = {c: F.when(F.col("_hit"), F.col(new[c])).otherwise(F.col(c)) for c in columns}
    return joined.withColumns(updated).select(*target.columns)


def insert_rows(target: DataFrame, rows: DataFrame) -> DataFrame:
    return target.unionByName(rows)


def delete_rows(target: DataFrame, predicate: Column) -> DataFrame:
    """Keep the rows for which the predicate is false or unknown."""
    return target.filter(~F.coalesce(predicate, F.lit(False)))


def take_stock(stock: DataFrame, demand: DataFrame, key: str, level: str, quantity: str) -> DataFrame:
    """Subtract what was ordered. Demand is summed per key first, so the join is one to one."""
    taken = demand.groupBy(key).agg(F.sum(quantity).alias("_taken")).withColumnRenamed(key, "_key")
    joined = stock.join(taken, F.col(key) == F.col("_key"), "left")
    left = F.col(level) - F.coalesce("_taken", F.lit(0))
    return joined.withColumn(level, left.cast(stock.schema[level].dataType)).select(*stock.columns)


SERVED, COUNTED, REFUSED = 1, 2, 0  # states of a row of demand, none while it is undecided
FEW = 200_000  # rows of demand that one task serves one order after the other


def guard_stock(
    demand: DataFrame, stock: DataFrame, order: str, item: str, quantity: str, level: str, few: int = FEW
) -> DataFrame:
    """Accept the orders whose every item is still in stock when its turn comes.

    ``demand`` has one row per (order, item). Orders are served in the order of their key; a
    refused one takes nothing. What an order finds depends on all orders before it, so each
    round decides those that are certain: accepted if there is enough even if every undecided
    order before it is served, refused if there is not even when none of them is. Only rows of
    undecided and of just accepted orders go into the next round: what earlier ones took before
    a row is carried in the row. So rounds cost in proportion to what is undecided, about half
    as much each time. The last ``few`` rows, in which orders mostly depend on the one before,
    are served in their order by one task. A missing quantity asks for nothing.

    The rows are cut into ranges of orders once. A running sum is a window inside (item, range)
    plus the sums of the ranges before, so an item that most orders want is no single task. An
    order lies in one range, so a round moves its rows once, to their ranges: there they find
    their sums and, together, the verdict. All else that moves is a row per item and range.
    """
    rows = demand.join(stock, item, "left").select(
        order,
        item,
        F.coalesce(quantity, F.lit(0)).alias("_asked"),
        F.coalesce(level, F.lit(-1)).alias("_level"),
        F.lit(0).cast("long").alias("_before"),
        F.lit(None).cast("int").alias("_state"),
    )
    rows = pin(rows, "demand")
    count = slice_count(rows)
    all_rows = slices(rows, [], [(order, "asc")], count)
    rows, decided = all_rows, None
    while True:
        rows = pin(_guard_step(rows, order, item, count), "demand")
        found = rows.filter("_state is not null").select(
            F.col(order).alias("_order"), F.col(SLICE).alias("_in"), (F.col("_state") > 0).alias("_taken")
        )
        decided = found if decided is None else decided.unionByName(found)
        rows = rows.filter(F.col("_state").isNull() | (F.col("_state") == SERVED))
        waiting, left = rows.agg(F.count_if(F.col("_state").isNull()), F.count("*")).first()
        if waiting and left <= few:
            decided = decided.unionByName(pin(_serve_in_turn(rows, order, item), "served"))
        if not waiting or left <= few:
            break

    # What each order found: the accepted ones before it, without itself.
    verdicts = decided.groupBy("_order", "_in").agg(F.max("_taken").alias("_taken")).repartition(count, "_in")
    same = F.col(order).eqNullSafe(F.col("_order")) & (F.col(SLICE) == F.col("_in"))
    last = all_rows.repartition(count, SLICE).join(verdicts, same, "left")
    last = _sums_before(last, last, order, item, count, _before_all=F.when(F.col("_taken"), F.col("_asked")).otherwise(0))
    fits = F.col("_before_all") + F.col("_asked") <= F.col("_level")
    return last.groupBy(order, SLICE).agg(
        F.count("*").alias("items"), F.count_if(fits).alias("items_in_stock"), F.every(fits).alias("accepted")
    ).drop(SLICE)


def _serve_in_turn(rows: DataFrame, order: str, item: str) -> DataFrame:
    """Verdicts on the undecided orders among few rows, from one task that serves them in order."""
    turns = rows.withColumn("_turn", F.dense_rank().over(Window.orderBy(order)))

    def serve(table):
        import pyarrow as pa

        table = table.sort_by("_turn")
        names = ["_turn", item, "_asked", "_before", "_level", "_state"]
        lines = enumerate(zip(*[table.column(c).to_pylist() for c in names]))
        taken, at, verdicts = defaultdict(int), [], []
        for _, own in groupby(lines, key=lambda line: line[1][0]):
            own = list(own)
            wanted = [line[1:5] for _, line in own]
            served = own[0][1][5] == SERVED
            if not served:
                served = all(before + taken[what] + asked <= level for what, asked, before, level in wanted)
                at.append(own[0][0])
                verdicts.append(served)
            if served:
                for what, asked, _, _ in wanted:
                    taken[what] += asked
        named = table.select([order, SLICE]).take(pa.array(at, pa.int64())).rename_columns(["_order", "_in"])
        return named.append_column("_taken", pa.array(verdicts, pa.bool_()))

    kind = rows.schema[order].dataType.simpleString()
    return turns.groupBy(F.lit(0).alias("_all")).applyInArrow(serve, f"_order {kind}, _in int, _taken boolean")


def _guard_step(rows: DataFrame, order: str, item: str, count: int) -> DataFrame:
    """One round: states of the orders that are certain now, and what was taken before the rest."""
    state = F.col("_state")
    served = F.when(state == SERVED, F.col("_asked")).otherwise(0)
    waiting = F.when(state.isNull(), F.col("_asked")).otherwise(0)
    dealt = rows.repartition(count, SLICE)
    known = _sums_before(dealt, rows, order, item, count, _served=served, _waiting=waiting)
    known = known.withColumn("_before", F.col("_before") + F.col("_served"))
    needed = F.col("_before") + F.col("_asked")
    whole = Window.partitionBy(order, SLICE)  # all rows of an order have the same state
    enough = F.every(needed + F.col("_waiting") <= F.col("_level")).over(whole)
    possible = F.every(needed <= F.col("_level")).over(whole)
    known = known.withColumns({"_enough": enough, "_possible": possible})
    now = F.when(F.col("_enough"), SERVED).when(~F.col("_possible"), REFUSED)
    after = F.when(state == SERVED, COUNTED).otherwise(F.coalesce(state, now))
    return known.withColumn("_state", after).select(*rows.columns)


def _sums_before(
    rows: DataFrame, same: DataFrame, order: str, item: str, count: int, **amounts: Column
) -> DataFrame:
    """For each row the sums of the amounts over earlier orders of its item. ``rows`` are dealt to
    ``count`` partitions by their range and stay there; ``same`` are these rows, dealt or not."""
    local = Window.partitionBy(item, SLICE).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("_item").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    parts = same.groupBy(F.col(item).alias("_item"), F.col(SLICE).alias("_at")).agg(
        *[F.sum(a).alias(f"_part{n}") for n, a in amounts.items()]
    )
    parts = parts.select("_item", "_at", *[F.sum(f"_part{n}").over(earlier).alias(f"_part{n}") for n in amounts])
    parts = parts.repartition(count, "_at")
    sums = rows.withColumns({n: F.sum(a).over(local) for n, a in amounts.items()})
    joined = sums.join(parts, F.col(item).eqNullSafe(F.col("_item")) & (F.col(SLICE) == F.col("_at")))
    whole = {n: F.coalesce(n, F.lit(0)) + F.coalesce(f"_part{n}", F.lit(0)) for n in amounts}
    return joined.withColumns(whole).select(*rows.columns, *amounts)
