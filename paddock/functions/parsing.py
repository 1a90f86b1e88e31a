"""Null-tolerant parsing of text leaves from the feeds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_CODE = "ddMMyyyy"


def number(text: Column) -> Column:
    """A double, null where the text is not one or is NaN."""
    return F.nanvl(text.try_cast("double"), F.lit(None).cast("double"))


def whole(text: Column) -> Column:
    """A 64-bit integer read through double, so "12" and "12.0" both give 12."""
    return F.floor(number(text) + 0.5)


def small(text: Column) -> Column:
    return whole(text).try_cast("int")


def euros(cents: Column) -> Column:
    """Cents to euros; null or unreadable gives null."""
    return number(cents) / F.lit(100.0)


def comma_number(text: Column) -> Column:
    """A number that may use a decimal comma."""
    return number(F.replace(text, F.lit(","), F.lit(".")))


def cut(text: Column, width: int) -> Column:
    return F.left(text, F.lit(width))


def overflows(text: Column, width: int) -> Column:
    return F.coalesce(F.length(text) > width, F.lit(False))


def seconds(millis: Column) -> Column:
    """Milliseconds to whole seconds, rounded down; 0 and null give null."""
    return F.floor(F.nullif(number(millis), F.lit(0.0)) / 1000).try_cast("int")


def day_of_millis(millis: Column) -> Column:
    """UTC date of an epoch in milliseconds; 0 and null give null."""
    return F.to_date(F.timestamp_millis(F.nullif(whole(millis), F.lit(0).cast("bigint"))))


def day_of_code(code: Column) -> Column:
    """Date of a DDMMYYYY code; null where it is not one."""
    return F.to_date(F.try_to_timestamp(code, F.lit(DATE_CODE)))


def code_of_day(day: Column) -> Column:
    return F.date_format(day, DATE_CODE)


def program_day(code: Column, millis: Column) -> Column:
    """The date code decides; the payload's epoch is used only where the code is invalid."""
    return F.coalesce(day_of_code(code), day_of_millis(millis))


def sex_code(text: Column) -> Column:
    return F.upper(F.left(F.nullif(text, F.lit("")), F.lit(1)))


def birth_year(age: Column, as_of_year: int) -> Column:
    """Year of birth from an age in years; 0 and null give null."""
    return F.lit(as_of_year) - F.nullif(small(age), F.lit(0))


def first_text(first: Column, second: Column) -> Column:
    """The first text unless it is empty or null, else the second."""
    return F.coalesce(F.nullif(first, F.lit("")), second)


def truthy(text: Column) -> Column:
    """Whether a JSON leaf read as text stands for a set flag."""
    return F.coalesce(~F.lower(text).isin("", "false", "0", "0.0", "[]", "{}"), F.lit(False))


def flag(text: Column) -> Column:
    return text.try_cast("boolean")


def subject(runners: Column) -> Column:
    """The first runner flagged as the horse the record is about; null if none."""
    return F.get(F.filter(runners, lambda r: truthy(r["itsHim"])), F.lit(0))


def unreadable(text: Column, value: Column) -> Column:
    """A leaf that is there but did not parse."""
    return text.isNotNull() & value.isNull()


def not_small(text: Column) -> Column:
    """A leaf that is missing or does not fit a 16-bit integer."""
    return whole(text).try_cast("smallint").isNull()


def outside_small(text: Column) -> Column:
    """A leaf that is there but does not fit a 16-bit integer."""
    return text.isNotNull() & not_small(text)


def outside_int(text: Column) -> Column:
    """A leaf that is there but does not fit a 32-bit integer."""
    return unreadable(text, small(text))


def place_part(place: Column, part: str) -> Column:
    """A field of a place that is an object; null where it is a bare value, which is not parsed."""
    return F.when(place.contains("{"), F.get_json_object(place, f"$.{part}"))
