"""Number parsing, safe arithmetic, rounding and formatting as column expressions."""

from pyspark.sql import Column, functions as F

# Cell texts that mean "no value".
MISSING_MARKERS = ["", "n/a", "na", "null", "unavailable"]
TABLE_NUMBER = r"^([+-]?)\s*[$€£]?\s*((?:\d{1,3}(?:,\d{3})+|\d+)(?:\.\d+)?|\.\d+)\s*(%)?$"


def finite(value: Column) -> Column:
    """``value`` where it is a finite number, else null."""
    number = value.cast("double")
    return F.when(~F.isnan(number) & (F.abs(number) != F.lit(float("inf"))), number)


def ratio(part: Column, whole: Column) -> Column:
    """Quotient of two sums; null where the denominator is null or zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def change(new: Column, old: Column) -> Column:
    """Relative change; null where either side is missing or the base is zero."""
    return ratio(new, old) - 1


def signed_change(new: Column, old: Column) -> Column:
    """Change measured against the size of the base, so a negative base keeps its direction."""
    return ratio(new - old, F.abs(old))


def half_up(value: Column) -> Column:
    return F.floor(value + 0.5)


def fixed(value: Column, places: int = 6) -> Column:
    """Round a derived ratio so that summation order cannot show in the result."""
    return F.round(value, places)


def table_number(text: Column) -> Column:
    """Number in a display cell: thousands commas, a currency sign, a per cent sign, a typographic minus."""
    clean = F.regexp_replace(F.trim(text), "^[−–]", "-")
    sign, digits = F.regexp_extract(clean, TABLE_NUMBER, 1), F.regexp_extract(clean, TABLE_NUMBER, 2)
    percent = F.regexp_extract(clean, TABLE_NUMBER, 3)
    number = F.concat(sign, F.replace(digits, F.lit(","), F.lit(""))).try_cast("double")
    return F.when(percent == "%", number / 100).otherwise(number)


def count_cell(text: Column) -> Column:
    """Struct ``(value, error)`` for a cell that must hold a whole non-negative count or a missing marker."""
    clean = F.lower(F.trim(text))
    number = finite(F.replace(clean, F.lit(","), F.lit("")).try_cast("double"))
    missing = text.isNull() | clean.isin(MISSING_MARKERS)
    whole = number.isNotNull() & (number >= 0) & (number == F.floor(number))
    return F.struct(
        F.when(~missing & whole, number.cast("long")).alias("value"),
        F.when(~missing & number.isNull(), F.lit("NOT_NUMERIC"))
        .when(~missing & ~whole, F.lit("NOT_A_COUNT")).alias("error"),
    )


def lenient_number(text: Column) -> Column:
    """Number of an API cell, where anything unreadable counts as zero."""
    return F.coalesce(finite(text.try_cast("double")), F.lit(0.0))


def share_of_range(low: Column, high: Column, value: Column) -> Column:
    """Position of ``value`` within ``[low, high]`` on 0..100; a point range puts an equal value in the middle."""
    inside = F.greatest(F.lit(0.0), F.least(F.lit(100.0), F.try_divide(value - low, high - low) * 100))
    point = F.when(value == low, 50.0).when(value < low, 0.0).otherwise(100.0)
    return F.when(high < low, F.lit(None).cast("double")).when(high == low, point).otherwise(inside)


def format_percent(value: Column, decimals: int = 1) -> Column:
    return F.when(value.isNull(), "—").otherwise(F.concat(F.format_number(value * 100, decimals), F.lit("%")))


def format_compact(value: Column) -> Column:
    size = F.abs(value)

    def scaled(unit, suffix):
        return F.concat(F.format_number(value / unit, 1), F.lit(suffix))

    return (F.when(value.isNull(), "—").when(size >= 1e9, scaled(1e9, "B")).when(size >= 1e6, scaled(1e6, "M"))
            .when(size >= 1e3, scaled(1e3, "K")).otherwise(F.format_number(value, 0)))


def format_currency(value: Column, symbol: str = "$", decimals: int = 0) -> Column:
    return (F.when(value.isNull(), "—")
            .otherwise(F.concat(F.when(value < 0, "-").otherwise(""), F.lit(symbol),
                                F.format_number(F.abs(value), decimals))))
