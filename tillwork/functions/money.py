"""Exact money arithmetic.

Amounts arrive as doubles. One rule turns them into whole units, in lines as in totals: the
decimal that prints the double, rounded half away from zero. Sums add whole numbers of units, so
a total does not depend on the order in which tasks finish, and are rounded once, at the end,
before going out as doubles. Sums keep whole and fractional parts apart: both stay plain longs
on the way, which is several times faster than decimals. An amount or a total beyond what a
long holds in units raises an error; none is cut off silently.
"""

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
RATIO = "decimal(38,6)"
# Above it a double has no room for a fraction that scaling could distort.
PLAIN = 1e14


def money(amount: str) -> Column:
    return F.col(amount).cast(MONEY)


def _units(value: str, places: int) -> Column:
    """Whole units of an amount. Only near a tie, where scaling could tip the rounding, and for
    large numbers is the decimal itself asked; that is slow and rare."""
    number = F.col(value)
    scaled = number * F.lit(10.0**places)
    nearest = F.rint(scaled)
    clear = (F.abs(scaled - nearest) < 0.4999) & (F.abs(scaled) < PLAIN)
    exact = number.cast(f"decimal(38,{places})") * F.lit(10**places)
    beyond = F.raise_error(F.concat(F.lit("amount out of range: "), number.cast("string")))
    return F.when(
        number.isNotNull() & ~F.isnan(number),
        F.when(clear, nearest.cast("bigint"))
        .when(F.abs(scaled) < 9.2e18, exact.cast("bigint"))
        .otherwise(beyond.cast("bigint")),
    )


def _revenue_units(amount: str, discount: str) -> Column:
    """Amount less its discount, a fraction of four digits, in millionths."""
    return _units(amount, 2) * (F.lit(10_000) - _units(discount, 4))


def _total(units: Column, places: int) -> Column:
    step = F.lit(10**places)
    whole = F.sum(F.call_function("div", units, step))
    rest = F.sum(units % step)
    return whole.cast("decimal(20,0)") + rest.cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-places))


def money_sum(amount: str) -> Column:
    """Exact sum of an amount in cents."""
    return _total(_units(amount, 2), 2)


def money_mean(amount: str) -> Column:
    """Mean of the amounts that are there."""
    known = F.count(_units(amount, 2))
    return (money_sum(amount) / F.nullif(known, F.lit(0))).cast(RATIO)


def revenue_sum(
    amount: str = "l_extendedprice", discount: str = "l_discount", where: Column | None = None
) -> Column:
    """Exact sum of line revenue after a discount given as a fraction, of the rows ``where``."""
    units = _revenue_units(amount, discount)
    return _total(units if where is None else F.when(where, units), 6)


def revenue(amount: str = "l_extendedprice", discount: str = "l_discount") -> Column:
    """Revenue of one line, rounded half up to cents, as a double."""
    units = _revenue_units(amount, discount)
    cents = F.call_function("div", F.abs(units) + 5_000, F.lit(10_000))
    return F.when(units < 0, -cents).otherwise(cents).cast("double") / 100


def amount(value: Column, places: int = 2) -> Column:
    """Round an exact value and publish it as a double."""
    return F.round(value, places).cast("double")


def ratio(part: Column, whole: Column, places: int = 2, scale: int = 1) -> Column:
    """``scale * part / whole`` rounded half up; null when the whole is null or zero."""
    quotient = part.cast("double") * scale / F.nullif(whole.cast("double"), F.lit(0.0))
    return amount(quotient.cast(RATIO), places)


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    return ratio(part, whole, places, scale=100)


def percent_change(old: Column, new: Column, places: int = 2) -> Column:
    """Growth from old to new in percent; null when there is no base."""
    return percent(new.cast("double") - old.cast("double"), old, places)
