"""Sums and averages of doubles that do not depend on the order of rows.

A sum of doubles depends on the order rows arrive in. Values are therefore split into whole hundredths,
summed as ``bigint``, and the rest below a hundredth, summed as a double. For amounts of two decimals
the rest is exactly 0 and the sum is exact; finer values lose nothing, as their rests are small. This
costs about what two double sums cost, where a DECIMAL(18,2) sum takes about ten times as long.

NaN counts as missing, in sums and averages. An infinite value makes the result infinite (NaN if there
are both). Beyond 9e16 units ANSI mode raises an overflow instead of returning a wrong value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HUNDREDTHS = 100


def _known(amount: Column | str) -> Column:
    """The value as a double; NaN counts as missing."""
    amount = F.col(amount) if isinstance(amount, str) else amount
    return F.nanvl(amount.cast("double"), F.lit(None).cast("double"))


def _finite(known: Column) -> Column:
    return F.when(F.abs(known) != F.lit(float("inf")), known)


def hundredths(amount: Column | str) -> Column:
    """The amount in whole hundredths; NaN and infinite values count as missing."""
    return F.rint(_finite(_known(amount)) * F.lit(float(HUNDREDTHS))).cast("bigint")


def from_hundredths(total: Column) -> Column:
    return total.cast("double") / F.lit(float(HUNDREDTHS))


def _total(amount: Column | str) -> Column:
    known = _known(amount)
    finite = _finite(known)
    # The nearest hundredth as a double: of a two-decimal amount, the amount itself.
    rest = finite - F.rint(finite * F.lit(float(HUNDREDTHS))) / F.lit(float(HUNDREDTHS))
    infinite = F.sum(F.when(F.abs(known) == F.lit(float("inf")), known))
    return F.coalesce(infinite, from_hundredths(F.sum(hundredths(amount))) + F.sum(rest))


def exact_sum(amount: Column | str) -> Column:
    """Sum of the known values as a double; null if there is none."""
    return _total(amount)


def exact_avg(amount: Column | str) -> Column:
    """Average over the known values; null if there is none."""
    return F.try_divide(_total(amount), F.count(_known(amount)))


def partial_sums(amount: Column | str, name: str) -> list[Column]:
    """What is kept of a group's amounts so that groups can be merged: :func:`merged_sum`, :func:`merged_avg`."""
    known = _known(amount)
    finite = _finite(known)
    rest = finite - F.rint(finite * F.lit(float(HUNDREDTHS))) / F.lit(float(HUNDREDTHS))
    return [
        F.sum(hundredths(amount)).alias(f"{name}__hundredths"),
        F.sum(rest).alias(f"{name}__rest"),
        F.sum(F.when(F.abs(known) == F.lit(float("inf")), known)).alias(f"{name}__infinite"),
        F.count(known).alias(f"{name}__known"),
    ]


def merged_sum(name: str) -> Column:
    """The sum over groups of :func:`partial_sums`, as :func:`exact_sum` gives it over their rows."""
    finite = from_hundredths(F.sum(f"{name}__hundredths")) + F.sum(f"{name}__rest")
    return F.coalesce(F.sum(f"{name}__infinite"), finite)


def merged_avg(name: str) -> Column:
    """The average over groups of :func:`partial_sums`."""
    return F.try_divide(merged_sum(name), F.sum(f"{name}__known"))


def unknown_count(amount: Column | str) -> Column:
    """How many values a sum or average leaves out: null or NaN."""
    return F.count(F.lit(1)) - F.count(_known(amount))
