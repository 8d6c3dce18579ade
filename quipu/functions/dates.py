"""Calendar expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def date_key(day: Column) -> Column:
    """Date as the integer YYYYMMDD; arithmetic, so no text is formatted per row."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def month_start_of(year: Column, month: Column) -> Column:
    """First day of a (year, month) pair; NULL when the month is not 1..12."""
    return F.when(month.between(1, 12), F.make_date(year, month, F.lit(1)))


def month_start_text(year: Column, month: Column) -> Column:
    """`YYYY-MM-01` text of a (year, month) pair."""
    return F.concat(
        year.cast("string"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"), F.lit("-01")
    )


def day_gap(later: Column, earlier: Column) -> Column:
    """Whole days from `earlier` to `later`, negative when reversed."""
    return F.datediff(later, earlier)


def days_since(day: Column, as_of: dt.date) -> Column:
    return F.datediff(F.lit(as_of), day)


def iso_week(day: Column) -> Column:
    return F.weekofyear(day)


def month_name(day: Column) -> Column:
    return F.date_format(day, "MMMM")


def calendar_columns(day: Column) -> list[Column]:
    """Attributes of one calendar day, typed as the time dimension declares them."""
    return [
        date_key(day).cast("int").alias("dtiem_id"),
        day.alias("fecha"),
        F.dayofmonth(day).cast("short").alias("dia"),
        iso_week(day).cast("short").alias("semana"),
        F.month(day).cast("short").alias("mes"),
        month_name(day).alias("nombre_mes"),
        F.quarter(day).cast("short").alias("trimestre"),
        F.year(day).cast("short").alias("anio"),
    ]


def local_to_utc(stamp: Column, zone: str = "America/Lima") -> Column:
    """Wall-clock time of `zone` as the UTC wall-clock time."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), stamp.cast("timestamp_ntz"))
