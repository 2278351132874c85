"""Exact sums of numbers in a few long limbs.

A sum of doubles depends on its order, and decimals of 38 digits are slow and
hold neither 1/3 nor the product 0.1 * 3.  Here every value is split into
digits of 22 bits at fixed places, each place is summed as a long (map-side
combined, any order, no carry), and the sums are carried once per group.

What a value stands for: an integer or decimal for itself; a double that
equals its rounding to ``scale`` decimals for that decimal (so that 0.1 and 0.2
make 0.3); any other double for its binary value.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal
from fractions import Fraction
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType

_BITS = 22
_BASE = 1 << _BITS
_LOW, _HIGH = -3, 3  # places of the digits: 2^-66 units to 2^88 units, 2^41 rows a group
_PLACES = range(_LOW, _HIGH + 1)
_FITS = float(1 << 53)


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _digits_of_long(units: Column) -> list[Column]:
    """The digits at each place of a long: floored, so only the top one has a sign."""
    out = [F.lit(0).cast("long")] * -_LOW
    out += [units.bitwiseAND(_BASE - 1), F.shiftright(units, _BITS).bitwiseAND(_BASE - 1), F.shiftright(units, 2 * _BITS)]
    return out + [F.lit(0).cast("long")] * (_HIGH - 2)


def _digits_of_double(units: Column) -> list[Column]:
    """The digits at each place of a double, all of its sign; what is below 2^-66 is cut off."""
    return [((units * float(2.0 ** (-_BITS * j))) % float(_BASE)).try_cast("long") for j in _PLACES]


@dataclass
class ExactSum:
    """Long parts of each row (``rows``), how to sum them and what the sums mean.

    ``scale`` decimals are one unit.  For decimals of more than 18 digits the
    one part is the decimal itself.
    """

    rows: list[Column]
    scale: int
    limbs: bool = True
    wide: Column | None = field(default=None)

    def sums(self, name: str) -> list[Column]:
        """Aggregates to put into ``agg`` or over a window, under names that begin with ``name``."""
        out = [F.sum(p).alias(f"{name}{i}") for i, p in enumerate(self.rows)]
        return out + ([F.sum(self.wide).alias(f"{name}w")] if self.wide is not None else [])

    def resum(self, name: str) -> list[Column]:
        """Sums of such sums, under the same names."""
        out = [F.sum(f"{name}{i}").alias(f"{name}{i}") for i in range(len(self.rows))]
        return out + ([F.sum(f"{name}w").alias(f"{name}w")] if self.wide is not None else [])

    def names(self, name: str) -> list[str]:
        return [f"{name}{i}" for i in range(len(self.rows))] + ([f"{name}w"] if self.wide is not None else [])

    def scaled(self, factor: Column) -> ExactSum:
        """The values times a small whole number (of less than 41 bits)."""
        wide = None if self.wide is None else self.wide * factor
        return ExactSum([p * factor for p in self.rows], self.scale, self.limbs, wide)

    def total(self, name: str) -> Column:
        """One value for the sums under ``name``: equal, less or greater exactly as the totals are; null without values."""
        return self._carried([F.col(f"{name}{i}") for i in range(len(self.rows))], None if self.wide is None else F.col(f"{name}w"))

    def one(self) -> Column:
        """The value itself in the form of ``total``."""
        return self._carried(self.rows, self.wide)

    def _carried(self, parts: list[Column], wide: Column | None) -> Column:
        if not self.limbs:
            return parts[0]
        digits = parts[:1]
        for p in parts[1:]:
            digits.append(p + F.shiftright(digits[-1], _BITS))
        low = [d.bitwiseAND(_BASE - 1) for d in digits[:-1]]
        pair = [low[i] + F.shiftleft(low[i + 1], _BITS) for i in range(0, len(low), 2)]
        beyond = F.lit(0.0) if wide is None else F.coalesce(wide, F.lit(0.0))
        whole = F.struct(beyond.alias("beyond"), digits[-1].alias("top"), pair[2].alias("high"), pair[1].alias("mid"), pair[0].alias("low"))
        return F.when(parts[0].isNotNull(), whole)

    def _units(self, total: Column) -> Column:
        t = total.getField
        return (((t("top") * float(2.0 ** (_BITS * _HIGH)) + t("high") * float(2.0 ** _BITS)) + t("mid") * float(2.0 ** -_BITS))
                + t("low") * float(2.0 ** (_BITS * _LOW)))

    def to_double(self, total: Column) -> Column:
        """A total as a double."""
        if not self.limbs:
            return total.cast("double")
        return self._units(total) / F.lit(float(10 ** self.scale)) + total.getField("beyond")

    def to_decimal(self, total: Column) -> Column:
        """A total as a decimal of ``scale`` decimals, cut off below them (all of it, unless binary values took part)."""
        if not self.limbs:
            return total
        t = total.getField
        units = (t("top").cast("decimal(18,0)") * F.lit(Decimal(2 ** (_BITS * _HIGH))) + (t("high").cast("decimal(18,0)") * F.lit(Decimal(_BASE)))
                 + F.shiftright(t("mid"), _BITS).cast("decimal(18,0)"))
        return units.cast(DecimalType(37 - self.scale, 0)) * F.lit(Decimal(1).scaleb(-self.scale))

    def to_number(self, total: Column) -> Column:
        """A total as a decimal if the values are integers or decimals, as a double if they are doubles."""
        return self.to_decimal(total) if self.wide is None else self.to_double(total)

    def stands_for_decimal(self, total, bits: int = 66) -> Column:
        """Whether a total is a whole number of units below 2^``bits`` (22 to 66) and nothing else."""
        total = _c(total)
        if not self.limbs:
            return F.coalesce(F.abs(total) < F.lit(Decimal(2 ** bits).scaleb(-self.scale)), F.lit(False))
        t = total.getField
        high, edge = t("high"), 1 << bits - _BITS
        small = ((t("top") == 0) & (high < edge)) | ((t("top") == -1) & (high >= (1 << 2 * _BITS) - edge))
        return F.coalesce(small & (t("beyond") == 0.0) & (t("low") == 0) & (t("mid").bitwiseAND(_BASE - 1) == 0), F.lit(False))

    def nonzero(self, total: Column) -> Column:
        """Whether a total is not zero (null counts as zero)."""
        if not self.limbs:
            return F.coalesce(total != 0, F.lit(False))
        return F.coalesce(total != self.literal(0), F.lit(False))

    def literal(self, value) -> Column:
        """The least total that is not below the number ``value``."""
        if not self.limbs:
            return F.lit(Decimal(str(value)))
        n = ceil(Fraction(str(value)) * 10 ** self.scale * (1 << _BITS * -_LOW))
        pair = (1 << 2 * _BITS) - 1
        parts = [n >> 6 * _BITS, n >> 4 * _BITS & pair, n >> 2 * _BITS & pair, n & pair]
        return F.struct(F.lit(0.0).alias("beyond"), *[F.lit(p).cast("long").alias(c) for p, c in zip(parts, ("top", "high", "mid", "low"))])


def exact_sum(df: DataFrame, value, scale: int = 6) -> ExactSum:
    """How to sum ``value`` (a name or an expression on ``df``) exactly.

    Order and partitioning of the rows never matter.  Doubles take part as the
    module says, with bits down to 2^-66 units of 10^-``scale`` (smaller ones
    are cut off value by value) and up to 2^84 units; larger ones, NaN and
    infinities are summed apart as doubles.  Nulls don't count.
    """
    if not 0 <= scale <= 11:
        raise ValueError("scale: 0 to 11 decimals")
    c = _c(value)
    kind = df.select(c.alias("v")).schema["v"].dataType
    if isinstance(kind, IntegralType):
        return ExactSum(_digits_of_long(c.cast("long")), 0)
    if isinstance(kind, DecimalType) and kind.precision <= 18:
        return ExactSum(_digits_of_long((c * F.lit(Decimal(10) ** kind.scale)).cast("decimal(18,0)").cast("long")), kind.scale)
    if isinstance(kind, DecimalType):
        return ExactSum([c], kind.scale, limbs=False)
    return _of_double(c, kind.simpleString(), scale)


def _of_double(c: Column, kind: str, scale: int) -> ExactSum:
    d, unit = c.cast("double"), float(10 ** scale)
    units = F.rint(d * unit)
    whole = F.coalesce(((units / unit).cast(kind) == c) & (F.abs(units) < _FITS), F.lit(False))
    # d = upper + lower with at most 27 bits each: both times 10^scale (5^11 has 26 bits) are exact
    upper = d * float((1 << 27) + 1) - (d * float((1 << 27) + 1) - d)
    near = F.abs(d * unit) < float(2.0 ** 84)
    zero = F.lit(0).cast("long")
    rows = []
    for of_long, a, b in zip(_digits_of_long(units.try_cast("long")), _digits_of_double(upper * unit), _digits_of_double((d - upper) * unit)):
        rows.append(F.when(c.isNull(), F.lit(None).cast("long")).when(whole, of_long).when(near, a + b).otherwise(zero))
    return ExactSum(rows, scale, wide=F.when(whole | near, 0.0).otherwise(d))


def exact_product(df: DataFrame, one, other, scale: int = 6) -> ExactSum:
    """How to sum ``one`` * ``other`` exactly: decimals' products in ``2 * scale`` decimals.

    Doubles that stand for decimals are multiplied as such; a product of
    others is the double that the multiplication gives.
    """
    a, b = _c(one), _c(other)
    kinds = [f.dataType for f in df.select(a.alias("a"), b.alias("b")).schema.fields]
    if any(isinstance(k, (DecimalType, IntegralType)) for k in kinds):
        return exact_sum(df, a * b, scale)
    if 2 * scale > 11:
        raise ValueError("scale of a product of doubles: 0 to 5 decimals")
    unit = float(10 ** scale)
    (x, y) = (F.rint(v.cast("double") * unit) for v in (a, b))
    whole = (F.abs(x) < _FITS) & (F.abs(y) < _FITS) & (F.abs(x * y) < float(1 << 62))
    for v, u, k in zip((a, b), (x, y), kinds):
        whole = whole & ((u / unit).cast(k) == v)
    whole = F.coalesce(whole, F.lit(False))
    apart = _of_double(a.cast("double") * b.cast("double"), "double", 2 * scale)
    digits = _digits_of_long(F.try_multiply(x.try_cast("long"), y.try_cast("long")))
    return ExactSum([F.when(whole, p).otherwise(q) for p, q in zip(digits, apart.rows)], 2 * scale, wide=F.when(whole, 0.0).otherwise(apart.wide))
