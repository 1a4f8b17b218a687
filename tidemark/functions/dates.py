"""Calendars and spans of days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import YEAR_DAYS


def calendar(spark: SparkSession, start: str, end: str, step: str = "1 day", name: str = "on_date") -> DataFrame:
    return spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)), F.expr(f"interval {step}"))).alias(name))


def quarter_ends(spark: SparkSession, start: str, end: str) -> DataFrame:
    """The last days of March, June, September and December from start to end."""
    months = spark.range(1).select(F.explode(F.sequence(F.trunc(F.to_date(F.lit(start)), "month"), F.to_date(F.lit(end)), F.expr("interval 1 month"))).alias("m"))
    return months.where(F.month("m") % 3 == 0).select(F.last_day("m").alias("on_date")).where(F.col("on_date").between(F.to_date(F.lit(start)), F.to_date(F.lit(end))))


def new_years(spark: SparkSession, first: int, last: int, moved: dict[str, str] | None = None) -> DataFrame:
    """January 1 of each year, some moved to another day."""
    days = calendar(spark, f"{first}-01-01", f"{last}-01-01", "1 year")
    for old, new in (moved or {"2007-01-01": "2007-07-01"}).items():
        days = days.withColumn("on_date", F.when(F.col("on_date") == F.to_date(F.lit(old)), F.to_date(F.lit(new))).otherwise(F.col("on_date")))
    return days


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start)


def years(days: Column) -> Column:
    return days.cast("double") / F.lit(YEAR_DAYS)
