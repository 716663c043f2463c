"""Rounding, scaling and summation rules."""

from __future__ import annotations

from decimal import Decimal

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = Decimal("0.000001")

#: Amounts from here on, and infinities, are added as doubles.
LARGE = 1e12
#: A difference from six decimals of less than so many times the amount is how doubles write those decimals.
NOISE = 2.0**-51
#: Whole units are added in blocks of this many and a remainder, so no count of rows that fits a table overflows a sum.
BLOCK_BITS = 24
#: What is left below millionths is added in units of 2^-48 and 2^-76, both under 2^28 for a single amount.
FINE, FINER = 2.0**-48, 2.0**-76

#: Names of the parts of an amount, in the order of :func:`sum_parts`.
PARTS = ("_blocks", "_units", "_micros", "_fine", "_finer", "_other")


def sum_parts(value: Column) -> tuple[Column, ...]:
    """An amount as integers whose sums are exact, and a double beside them; see ``PARTS``.

    The double holds amounts of ``LARGE`` or more, and otherwise what lies below 2^-77. That is nothing for
    amounts of 1e-7 and more, and less than 2^-24 of amounts down to 1e-16.
    """
    normal = F.abs(value) < F.lit(LARGE)
    whole = F.when(normal, value.try_cast("bigint"))
    fraction = value - whole.cast("double")
    micros = F.rint(fraction * F.lit(1e6))
    rest = fraction - micros * F.lit(1e-6)
    rest = F.when(F.abs(rest) > F.abs(value) * F.lit(NOISE), rest).otherwise(F.lit(0.0))
    fine = F.rint(rest * F.lit(1 / FINE))
    below = rest - fine * F.lit(FINE)
    finer = F.rint(below * F.lit(1 / FINER))
    integers = (fine, finer)
    return (
        F.shiftright(whole, BLOCK_BITS),
        whole.bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)),
        micros.cast("bigint"),
        *(F.when(normal, part.cast("bigint")) for part in integers),
        F.when(normal, below - finer * F.lit(FINER)).otherwise(value),
    )


def total(blocks: Column, units: Column, micros: Column, fine: Column, finer: Column, other: Column) -> Column:
    """Summed parts as one double; null where there was nothing to sum."""
    zero = F.lit(0)
    number = lambda part: F.coalesce(part, zero).cast("decimal(20,0)")
    exact = number(blocks) * F.lit(Decimal(1 << BLOCK_BITS)) + number(units) + number(micros) * F.lit(MICROS)
    fine, finer = (F.coalesce(part, zero).cast("double") * F.lit(unit) for part, unit in ((fine, FINE), (finer, FINER)))
    beside = F.coalesce(other, F.lit(0.0))
    small = fine + (finer + beside)
    wide = lambda scale: (exact.cast(f"decimal(38,{scale})") + small.cast(f"decimal(38,{scale})")).cast("double")
    # Rounding the decimals to a double before the rest is added would round twice.
    summed = (
        F.when((small == 0) | (F.abs(beside) >= 1) | (F.abs(small) >= 1) | (F.abs(exact) >= F.lit(Decimal(10**18))), exact.cast("double") + small)
        .when(exact == 0, small)
        .when(F.abs(exact) < F.lit(Decimal(10**9)), wide(28))
        .otherwise(wide(18))
    )
    return F.when(units.isNotNull() | other.isNotNull(), summed)


def exact_sum(value: Column) -> Column:
    """Order-independent sum of doubles, null without values.

    Adding doubles depends on the order rows arrive in, so a retried task could change the last
    digits. The parts of each amount are added as integers instead, which stays in generated
    code with primitive buffers; decimals in the buffer would cost an object per row. Only amounts
    of ``LARGE`` or more, infinities, and what lies below 2^-77 are added as doubles beside them.
    """
    return total(*(F.sum(part) for part in sum_parts(value)))


def significant(value: Column, digits: int) -> Column:
    """A double as text with so many significant digits, rounded once, from the number it is.

    ``format_string`` rounds the shortest text that reads back as the double: what lies next to the middle of two results
    is rounded up whichever side of it the number is on.
    """
    pattern = f"%.{digits - 1}e"

    def text(values: pd.Series) -> pd.Series:
        return values.map(lambda v: pattern % v, na_action="ignore")

    return F.pandas_udf(text, "string")(value)


def half_up(value: Column, digits: int) -> Column:
    """Round half away from zero on the binary double, as ``floor(|x| * 10^n + 0.5) / 10^n``."""
    factor = float(10**digits)
    return F.signum(value) * F.floor(F.abs(value) * factor + F.lit(0.5)) / factor + F.lit(0.0)


def scaled(value: Column, unit: float, digits: int) -> Column:
    """``value`` in units of ``unit`` (1e9 for billions), rounded."""
    return half_up(value / F.lit(float(unit)), digits)


def growth_pct(current: Column, base: Column) -> Column:
    """Percent change, null for a zero base."""
    return half_up(F.lit(100.0) * (current - base) / F.nullif(base, F.lit(0.0)), 1)
