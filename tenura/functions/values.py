"""Column expressions shared by the operators: numeric text, trimming, rounding, fixed-point text."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: text that counts as a number. Signs, exponents, ".5", "5." and inf do; "1,000", "0x10", "1d" do not.
NUMBER_PATTERN = r"(?i)^\s*[+-]?(inf|infinity|(\d+\.?\d*|\.\d+)(e[+-]?\d+)?)\s*$"
INFINITY_PATTERN = r"(?i)^\s*[+-]?inf"
# Fixed value: the characters that count as white space at the ends of a text.
WHITE_SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def present(c: Column, dtype: T.DataType) -> Column:
    """SCL-5: not null, and not NaN for floating columns."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return c.isNotNull() & ~F.isnan(c)
    return c.isNotNull()


def to_number(c: Column, dtype: T.DataType) -> Column:
    """SCL-1: the value as double, or null when it is no number; digits too large for a double are null."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(c), c.cast("double"))
    if is_numeric(dtype) or isinstance(dtype, T.BooleanType):
        return c.cast("double")
    text = c.cast("string")
    number = text.try_cast("double")
    finite = F.abs(number) < float("inf")
    return F.when(text.rlike(NUMBER_PATTERN) & (finite | text.rlike(INFINITY_PATTERN)), number)


def to_whole(c: Column, dtype: T.DataType) -> Column:
    """SCL-2: the number truncated toward zero as bigint; whole text keeps all its digits."""
    if isinstance(dtype, T.IntegralType):
        return c.cast("bigint")
    truncated = to_number(c, dtype).try_cast("bigint")
    if is_numeric(dtype) or isinstance(dtype, T.BooleanType):
        return truncated
    return F.coalesce(c.cast("string").try_cast("bigint"), truncated)


def to_text(c: Column, dtype: T.DataType) -> Column:
    """SCL-3: canonical text; whole doubles print without a fraction, null stays null."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        whole = (c == F.floor(c)) & (F.abs(c) < F.lit(1e15))
        return F.when(whole, c.try_cast("bigint").cast("string")).when(~F.isnan(c), c.cast("string"))
    return c.cast("string")


def strip(c: Column) -> Column:
    """Trim white space of every kind; ``trim`` alone removes spaces only."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def strip_lower(c: Column) -> Column:
    """SCL-4."""
    return F.lower(strip(c))


def literal_map(pairs: Mapping[str, str | int]) -> Column:
    """A constant map; Spark folds it into one literal."""
    return F.map_from_arrays(F.lit(list(pairs)), F.lit(list(pairs.values())))


def lookup(c: Column, pairs: Mapping[str, str]) -> Column:
    """The mapped value of ``c``, or null when it is not listed."""
    return F.element_at(literal_map(pairs), c) if pairs else F.lit(None).cast("string")


def number_or(c: Column, default: float = 0.0) -> Column:
    """SCL-6, SCL-8: null and NaN become ``default``."""
    return F.coalesce(F.nanvl(c, F.lit(None).cast("double")), F.lit(float(default)))


def clip(c: Column, low, high) -> Column:
    """SCL-7: held to [low, high]; null stays null, NaN becomes null first because it sorts above every number."""
    value = F.nanvl(c, F.lit(None).cast("double"))
    return F.when(value < low, low).when(value > high, high).otherwise(value)


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double") * 100.0, whole.cast("double"))


def round_to(c: Column, places: int) -> Column:
    """SCL-9, half up on the scaled value, so that SQL engines agree."""
    scale = float(10**places)
    return F.signum(c) * F.floor(F.abs(c) * scale + 0.5) / F.lit(scale)


def fixed_text(c: Column, places: int) -> Column:
    """The number with a set count of decimals, half up, "-" only when something is left after rounding."""
    scale = 10**places
    units = F.floor(F.abs(c) * float(scale) + 0.5).cast("bigint")
    sign = F.when((c < 0) & (units > 0), "-").otherwise("")
    whole = F.floor(units / F.lit(scale)).cast("bigint").cast("string")
    return F.concat(sign, whole, F.lit("."), F.lpad((units % scale).cast("string"), places, "0"))


def signed_text(c: Column, places: int = 2) -> Column:
    """SCL-11: ``+0.23`` / ``-0.08``; a value that rounds to zero from below prints as ``-0.00``."""
    return F.concat(F.when(c >= 0, "+").otherwise("-"), fixed_text(F.abs(c), places))


def join_text(parts: Iterable[Column], sep: str) -> Column:
    """SCL-12."""
    return F.concat_ws(sep, *parts)


def quoted(c: Column) -> Column:
    """Text in single quotes, or in double ones where it holds a single quote and no double one; inner quotes and backslashes escaped."""
    slashed = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    double = F.contains(c, F.lit("'")) & ~F.contains(c, F.lit('"'))
    single = F.concat(F.lit("'"), F.replace(slashed, F.lit("'"), F.lit("\\'")), F.lit("'"))
    return F.when(double, F.concat(F.lit('"'), slashed, F.lit('"'))).otherwise(single)
