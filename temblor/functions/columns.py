"""Column expressions shared by the plans. All are built-in, code-generated functions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def literal_like(df: DataFrame, column: str, value: datetime) -> Column:
    """`value` as a constant of the column's own timestamp type.

    Comparing a timestamp_ntz column with a timestamp constant would cast the column, and
    a cast column is not pushed down to the scan.
    """
    return F.lit(value.isoformat(sep=" ")).cast(df.schema[column].dataType)


def in_period(df: DataFrame, column: str, start: datetime, end: datetime) -> Column:
    """`start <= column < end`, in the form a parquet scan can use (year()/month() cannot)."""
    moment = F.col(column)
    return (moment >= literal_like(df, column, start)) & (moment < literal_like(df, column, end))


def count_where(condition: Column) -> Column:
    """Number of rows meeting `condition`; a NULL condition counts as not met."""
    return F.sum(F.when(condition, 1).otherwise(0))


def ratio(part: Column, whole: Column) -> Column:
    """`part / whole`, NULL where `whole` is 0 (plain division raises under ANSI mode)."""
    return part / F.nullif(whole, F.lit(0))


def hemisphere(latitude: Column) -> Column:
    """'North' from the equator up; everything else, NULL included, is 'South'."""
    return F.when(latitude >= 0, "North").otherwise("South")


def in_band(latitude: Column, degrees: float) -> Column:
    """Within `degrees` of the equator, both edges included."""
    return latitude.between(-degrees, degrees)
