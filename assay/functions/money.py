"""Sums and means of money that do not depend on the order of summing.

A sum of doubles changes in its last digits with the order in which partitions arrive. A group whose
amounts all are whole cents is summed over cents (``bigint``), which is exact. Any other group, or one
whose cents do not fit, is summed over decimals of twelve places, up to 1e26: nothing is rounded to
cents. Only groups with an amount beyond that, infinite or not a number take the plain sum of doubles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WIDE = "decimal(38,12)"
#: How far from a whole cent an amount may be for the error of its binary form: in cents at most, as a
#: part of the amount for small ones, and as a part of a large product.
_CENT_ERROR, _SMALL_ERROR, _LARGE_ERROR = 1e-6, 1e-12, 1e-15


def exact_sum(amount: Column) -> Column:
    hundredfold = amount * F.lit(100.0)
    whole = F.rint(hundredfold)
    size = F.abs(whole)
    # No amount but zero is zero cents.
    allowed = F.greatest(F.least(F.lit(_CENT_ERROR), size * _SMALL_ERROR), size * _LARGE_ERROR)
    near = F.abs(hundredfold - whole) <= allowed
    cents = F.when(near, whole.try_cast("bigint"))
    wide = amount.try_cast(_WIDE)
    in_cents = F.when(F.count(cents) == F.count(amount), F.try_sum(cents))
    in_decimals = F.when(F.count(wide) == F.count(amount), F.try_sum(wide))
    return F.coalesce(in_cents / F.lit(100.0), in_decimals.cast("double"), F.sum(amount))


def exact_mean(amount: Column) -> Column:
    return F.when(F.count(amount) > 0, exact_sum(amount) / F.count(amount))
