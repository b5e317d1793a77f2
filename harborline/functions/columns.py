"""Column expressions whose null, rounding and casting rules matter.

Everything here is a built-in Spark expression, so it stays inside whole-stage
code generation; there are no Python UDFs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Text that counts as a number. Spark's own cast would also take Java suffixes
# such as '1.0d', so the shape is checked before casting.
NUMBER_SHAPE = r"^[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity)$"


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing has one spelling: NaN in any floating column becomes NULL."""
    floating = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floating}) if floating else df


def lenient_double(text: Column) -> Column:
    """Number out of free text, white space around it allowed; anything unreadable is NULL."""
    trimmed = F.lower(F.trim(text, F.lit(" \t\n\r\x0b\x0c")))
    return F.when(trimmed.rlike(NUMBER_SHAPE), trimmed.try_cast("double"))


def strict_int(text: Column) -> Column:
    """Integer out of text; unreadable text fails the job (ANSI cast)."""
    return text.cast("int")


def whole_number(number: Column) -> Column:
    """Drop the fraction, towards zero."""
    return number.cast("bigint")


def equals_or_false(left: Column, right: object) -> Column:
    """Equality in which a NULL operand means False."""
    return F.coalesce(left == right, F.lit(False))


def first_of_month(year: Column, month: Column) -> Column:
    return F.make_date(year.cast("int"), month.cast("int"), F.lit(1))


def round_half_even(number: Column, places: int) -> Column:
    scale = F.lit(float(10**places))
    return F.rint(number * scale) / scale


def growth_rate(end: Column, start: Column, years: int, places: int = 4) -> Column:
    """Compound annual growth; NULL where the ratio is undefined or negative."""
    ratio = F.try_divide(end.cast("double"), start.cast("double"))
    rate = F.power(ratio, F.lit(1.0 / years)) - F.lit(1.0)
    return round_half_even(F.when(~F.isnan(rate), rate), places)


def exact_sum(number: Column) -> Column:
    """SUM over whole numbers that cannot overflow part way."""
    return F.sum(number.cast("decimal(20,0)"))


def rounded_mean(total: Column, n: Column) -> Column:
    """Mean of whole numbers as BIGINT, halves away from zero, in integer arithmetic.

    A decimal average would round twice (once to its own scale, once to 0 places).
    """
    wide = F.abs(total).cast("decimal(36,0)")
    twice = (wide * 2 + n).cast("decimal(37,0)")
    magnitude = F.call_function("div", twice, (n * 2).cast("decimal(37,0)"))
    return F.when(total < 0, -magnitude).otherwise(magnitude)


def schema_of(asset_key: Column) -> Column:
    return F.get(F.split(asset_key, r"\."), F.lit(0))


def table_of(asset_key: Column) -> Column:
    return F.get(F.split(asset_key, r"\."), F.lit(1))
