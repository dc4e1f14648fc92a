"""Sums of doubles that are exact before they are rounded once, whatever the amounts and their order.

A finite double is a whole number below 2**53 times a power of two. Counted in units of a bin, a power
of 2**32, it is a whole number below 2**86, which four limbs of 22 bits hold. Limbs of a bin are summed as
``bigint``, which is exact for a trillion rows. A group's few bins are then added with carries from the
lowest up; its highest three limbs of 32 bits, and whether anything is left below them, decide the double
that is nearest to the sum.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BITS = 32
_BASE = 1 << _BITS
#: Bits of a limb, and limbs of a bin.
_LIMB, _LIMBS = 22, 4
_WIDE = "decimal(38,0)"


def _scaled(value: Column, power: Column) -> Column:
    """``value * 2**power``, in two steps, as the power alone may be beyond a double."""
    half = F.floor(power / 2)
    return value * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), power - half)


def finite(value: Column) -> Column:
    return F.abs(value) < F.lit(float("inf"))


def with_limbs(df: DataFrame, name: str, amount: Column) -> DataFrame:
    """Add ``__x_<name>``, the amount, ``__bin_<name>``, the bin of its lowest bit, and
    ``__<i>_<name>``, its limbs from there on. Zero has bin 0; bin and limbs are null unless it is finite.

    The exponent is taken one lower than the logarithm says, so its rounding does no harm. Each step is
    a column of its own and reads the one before: nothing is worked out twice, and the code of a row
    stays short enough to be compiled. All steps are exact, for they scale by powers of two or take
    leading bits away; limbs have the sign of the amount.
    """
    x, bin_, left = f"__x_{name}", f"__bin_{name}", f"__left_{name}"
    lowest = F.floor((F.floor(F.log2(F.abs(F.col(x)))) - 53) / _BITS).cast("int")
    df = df.withColumn(x, amount).withColumn(
        bin_, F.when(finite(F.col(x)), F.when(F.col(x) == 0, F.lit(0)).otherwise(lowest))
    )
    df = df.withColumn(left, _scaled(F.col(x), -_BITS * F.col(bin_)))
    for i in reversed(range(_LIMBS)):
        unit = float(1 << _LIMB * i)
        df = df.withColumn(f"__{i}_{name}", (F.col(left) / F.lit(unit)).cast("bigint"))
        df = df.withColumn(left, F.col(left) - F.col(f"__{i}_{name}").cast("double") * F.lit(unit))
    return df.drop(left)


def _nearest(bins: Column, sign: int) -> Column:
    """The double nearest to ``sign`` times the sum of ``bins``, if that is not negative; else null.

    ``bins`` is an array of structs with ``at`` and ``value``.
    """
    lowest = F.array_min(F.transform(bins, lambda b: b["at"]))
    highest = F.array_max(F.transform(bins, lambda b: b["at"]))
    zero = F.lit(0).cast(_WIDE)

    def state(at, carry, first, second, third, rest, top):
        return F.struct(
            at.cast("int").alias("at"),
            carry.cast(_WIDE).alias("carry"),
            first.cast(_WIDE).alias("first"),
            second.cast(_WIDE).alias("second"),
            third.cast(_WIDE).alias("third"),
            rest.alias("rest"),
            top.alias("top"),
        )

    def summary(at, first, second, third, rest):
        return F.struct(
            at.cast("int").alias("at"),
            first.cast(_WIDE).alias("first"),
            second.cast(_WIDE).alias("second"),
            third.cast(_WIDE).alias("third"),
            rest.alias("rest"),
        )

    none = summary(F.lit(0), zero, zero, zero, F.lit(False))

    def step(s: Column, at: Column) -> Column:
        here = F.aggregate(
            F.filter(bins, lambda b: b["at"] == at),
            zero,
            lambda total, b: (total + b["value"] * sign).cast(_WIDE),
        )
        total = (s["carry"] + here).cast(_WIDE)
        limb = F.pmod(total, F.lit(_BASE).cast(_WIDE)).cast(_WIDE)
        carry = ((total - limb) / F.lit(_BASE)).cast(_WIDE)
        rest = s["rest"] | (s["third"] != 0)
        top = F.when(limb != 0, summary(at, limb, s["first"], s["second"], rest)).otherwise(s["top"])
        return state(at, carry, limb, s["first"], s["second"], rest, top)

    # Four bins more take all carries that a trillion rows can make.
    last = F.aggregate(
        F.sequence(lowest, highest + 4), state(F.lit(0), zero, zero, zero, zero, F.lit(False), none), step
    )

    def rounded(found: Column) -> Column:
        top = found["top"]
        base = F.lit(_BASE).cast(_WIDE)
        digits = ((top["first"] * base).cast(_WIDE) + top["second"]).cast(_WIDE)
        digits = ((digits * base).cast(_WIDE) + top["third"]).cast(_WIDE)
        # Whatever is left below breaks a tie, and does nothing else.
        tail = F.when(top["rest"], F.lit(0.5)).otherwise(F.lit(0.0)).cast("decimal(2,1)")
        value = (digits.cast("decimal(38,1)") + tail).cast("double")
        return F.when(found["carry"] == 0, _scaled(value, (top["at"] - 2) * _BITS))

    # Through an array of one, so that the bins are added up once.
    return F.get(F.transform(F.array(last), rounded), F.lit(0))


def exact_totals(df: DataFrame, keys: Sequence[str], amounts: dict[str, Column], *others: Column) -> DataFrame:
    """One row for each group of ``keys``: the exact sum of each of the ``amounts``, its ``<name>_count``
    of values that are not null, and ``others``, which must be sums or counts.

    Sums are those of exact arithmetic, rounded once, as at any parallelism. A group with an infinite
    amount, or one that is not a number, has the plain sum of doubles. Without any value it is null.
    """
    first, columns = [], []
    cut = df
    for name, amount in amounts.items():
        cut = with_limbs(cut, name, amount)
        first += [F.sum(f"__{i}_{name}").alias(f"__{i}_{name}") for i in range(_LIMBS)]
        first += [F.sum(f"__x_{name}").alias(f"__x_{name}"), F.count(f"__x_{name}").alias(f"__n_{name}")]
    bins = [f"__bin_{name}" for name in amounts]
    named = [other.alias(f"__other_{i}") for i, other in enumerate(others)]
    labels = [df.groupBy(*keys).agg(other).columns[-1] for other in others]
    partial = cut.groupBy(*keys, *bins).agg(*first, *named)
    second = []
    for name in amounts:
        bin_ = F.col(f"__bin_{name}")
        # At most a trillion times 2**86, which a decimal holds.
        value = F.lit(0).cast(_WIDE)
        for i in reversed(range(_LIMBS)):
            limb = F.col(f"__{i}_{name}").cast(_WIDE)
            value = ((value * F.lit(1 << _LIMB).cast("decimal(7,0)")).cast(_WIDE) + limb).cast(_WIDE)
        entry = F.struct(bin_.alias("at"), value.alias("value"))
        second += [
            F.collect_list(F.when(bin_.isNotNull(), entry)).alias(f"__bins_{name}"),
            F.sum(f"__x_{name}").alias(f"__x_{name}"),
            F.sum(f"__n_{name}").alias(f"{name}_count"),
            # Amounts without a bin that are not null.
            F.sum(F.when(bin_.isNull(), F.col(f"__n_{name}")).otherwise(F.lit(0))).alias(f"__odd_{name}"),
        ]
        found = F.col(f"__bins_{name}")
        exact = F.coalesce(_nearest(found, 1), -_nearest(found, -1))
        columns.append(
            F.when(F.col(f"{name}_count") == 0, F.lit(None).cast("double"))
            .when(F.col(f"__odd_{name}") > 0, F.col(f"__x_{name}"))
            .otherwise(exact)
            .alias(name)
        )
        columns.append(F.col(f"{name}_count"))
    second += [F.sum(f"__other_{i}").alias(label) for i, label in enumerate(labels)]
    return partial.groupBy(*keys).agg(*second).select(*keys, *columns, *labels)
