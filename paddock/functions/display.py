"""Strings shown to a reader."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def one_decimal(value: Column) -> Column:
    """Round for display; a value exactly half-way goes to the even digit."""
    halfway = F.pmod(value * 4, F.lit(2.0)) == 1.0
    return F.format_string("%.1f", F.when(halfway, F.bround(value, 1)).otherwise(value))


def percent(value: Column) -> Column:
    return F.concat(one_decimal(value * 100), F.lit("%"))


def signed_percent(value: Column) -> Column:
    return F.concat(F.lit("+"), percent(value))


def race_tag(number: Column) -> Column:
    return F.format_string("C%s", number.cast("string"))


def runner_tag(number: Column, name: Column) -> Column:
    return F.format_string("#%s %s", number.cast("string"), name)


def meeting_label(number: Column, track: Column) -> Column:
    return F.format_string("R%s - %s", number.cast("string"), F.coalesce(track, F.lit("None")))
