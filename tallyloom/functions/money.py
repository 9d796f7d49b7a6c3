"""Money arithmetic: sum exactly, divide in double, round half away from zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round2(value: Column) -> Column:
    """Two places, half away from zero, as a decimal; rounded once, from the full value.

    Spark rounds a double by its decimal text: 18165.005 is slightly below the tie in binary, and
    its text is what a reader rounds.
    """
    return F.round(value, 2).cast("decimal(38,2)")


def reported(value: Column) -> Column:
    """``round2`` as the double a report carries."""
    return round2(value).cast("double")


def mean(total: Column, count: Column) -> Column:
    """Exact decimal sum over a count, NULL for no rows."""
    return total.cast("double") / F.nullif(count, F.lit(0).cast("bigint"))


LOW_BITS = 20


def exact_sum(value: Column) -> Column:
    """Aggregate: sum of a bigint column as a decimal.

    A sum of wide decimals leaves long arithmetic on every row, and one bigint sum may overflow.
    The low 20 bits and the rest are summed apart as bigint and put together once per group. That
    holds 2**43 rows of values below 2**40.
    """
    high = F.sum(F.shiftright(value, LOW_BITS)).cast("decimal(20,0)")
    low = F.sum(value.bitwiseAND((1 << LOW_BITS) - 1))
    return high * (1 << LOW_BITS) + low


# Doubles are summed as integers: millionths, and what is left in units of the 18th decimal place.
MILLION = 1_000_000
FINE = 10**12
# From here on millionths times a quantity may leave a bigint.
MOST = 9e12


def double_parts(value: Column) -> tuple[Column, Column]:
    """(millionths, rest) of a double's decimal text to its 18th place: two bigint, rest null where there is none.

    Most prices are whole millionths, found by one division; only others become decimals. Of 17 digits none lies beyond
    the 18th place from 0.01 on. A value that is not a number or too large fails the query: no sum could be right.
    """
    refused = F.when(F.isnan(value), F.raise_error(F.lit("price: not a number"))).when(
        F.abs(value) >= MOST, F.raise_error(F.lit("price: too large to sum exactly"))
    )
    known = F.coalesce(refused.cast("double"), value)
    nearest = F.rint(known * MILLION)
    plain = (nearest / MILLION == known) & (F.abs(nearest) < 2.0**53)
    units = nearest.cast("bigint")
    whole = (units.cast("decimal(19,0)") * F.lit("0.000001").cast("decimal(6,6)")).cast("decimal(31,18)")
    rest = (known.cast("decimal(31,18)") - whole).cast("decimal(18,18)") * F.lit(10**18).cast("decimal(19,0)")
    return units, F.when(~plain, rest.cast("bigint"))


def exact_product_sum(units: Column, rest: Column, times: Column) -> Column:
    """Aggregate: sum of the doubles of ``double_parts`` times an integer, as decimal(35,12).

    Both parts are summed as integers, so the sum is exact and does not depend on the order of the rows; it is rounded once,
    to the 12th place, at which totals of some millions still are one machine word. A product that leaves a bigint fails the query.
    """
    times = times.cast("bigint")
    millionths = exact_sum(units * times).cast("decimal(32,0)")
    # six places at a time, so that more rows fit
    upper, lower = F.sum(_whole(rest) * times), F.sum(rest % MILLION * times)
    fine = upper.cast("decimal(25,0)") * F.lit(MILLION).cast("decimal(7,0)") + lower.cast("decimal(20,0)")
    below = fine % F.lit(FINE).cast("decimal(13,0)")
    carried = ((fine - below) / F.lit(FINE).cast("decimal(13,0)")).cast("decimal(26,0)")
    tail = below.cast("decimal(13,0)") * F.lit("1E-18").cast("decimal(18,18)")
    with_rest = _millions(millionths + carried).cast("decimal(34,12)") + F.round(tail, 12).cast("decimal(34,12)")
    # most groups have no rest
    return F.when(lower.isNull(), _millions(millionths).cast("decimal(35,12)")).otherwise(with_rest.cast("decimal(35,12)"))


def _whole(rest: Column) -> Column:
    return F.floor((rest - rest % MILLION) / MILLION).cast("bigint")


def _millions(millionths: Column) -> Column:
    return millionths.cast("decimal(32,0)") * F.lit("0.000001").cast("decimal(6,6)")


def percent_of(change: Column, base: Column) -> Column:
    """Unrounded change in percent of a positive base, NULL otherwise."""
    return F.when(base > 0, change.cast("double") / base.cast("double") * 100)
