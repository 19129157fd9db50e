"""Strict dates, months, zoned timestamps, maturity and report windows as column expressions."""

from pyspark.sql import Column, functions as F

from sightline.schemas import MATURITY_DAYS, REPORTING_ZONE

ZONED = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:?\d{2})$"


def strict_date(text: Column) -> Column:
    """``yyyy-MM-dd`` text as a date; anything else is null."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(text, "yyyy-MM-dd"))


def zoned_timestamp(text: Column) -> Column:
    """Timestamp text that names its offset; text without one is null."""
    return F.when(text.rlike(ZONED), F.try_to_timestamp(text))


def reporting_day(instant: Column, zone: str = REPORTING_ZONE) -> Column:
    return F.to_date(F.from_utc_timestamp(instant, zone))


def reporting_day_of_text(text: Column, zone: str = REPORTING_ZONE) -> Column:
    """Local day of a zoned timestamp text, whatever the session time zone is."""
    return F.to_date(F.convert_timezone(F.current_timezone(), F.lit(zone),
                                        zoned_timestamp(text).cast("timestamp_ntz")))


def month_key(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def month_start(month: Column) -> Column:
    """First day of a ``yyyy-MM`` or ``yyyy-MM-dd`` text; null for an impossible month or day."""
    text = F.trim(month)
    first = F.try_to_date(F.concat(F.substring(text, 1, 7), F.lit("-01")), "yyyy-MM-dd")
    return (F.when(text.rlike(r"^\d{4}-(0[1-9]|1[0-2])$"), first)
            .when(text.rlike(r"^\d{4}-(0[1-9]|1[0-2])-\d{2}$") & strict_date(text).isNotNull(), first))


def mature_on(day: Column) -> Column:
    """Day from which the lead cohort of ``day``'s month counts formally."""
    return F.date_add(F.last_day(day), MATURITY_DAYS)


def serial_date(serial: Column) -> Column:
    """Spreadsheet serial day number as a date."""
    return F.date_add(F.lit("1899-12-30").cast("date"), serial.cast("int"))


def from_parts(parts: Column) -> Column:
    """``{year, month, day}`` struct as a date."""
    return F.make_date(parts["year"], parts["month"], parts["day"])


def compact_date(text: Column) -> Column:
    """``yyyyMMdd`` text as ``yyyy-MM-dd`` text; other text passes through."""
    return (F.when(text.isNull(), "").when(text.rlike(r"^\d{8}$"), F.concat_ws(
        "-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2))).otherwise(text))


def date_part_text(value: Column) -> Column:
    """First ten characters of a date-like text; empty for null."""
    return F.coalesce(F.substring(value.cast("string"), 1, 10), F.lit(""))
