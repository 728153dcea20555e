"""Holiday calendar shaping and the date dimension."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import DEFAULT_DATE_FORMATS, first_element, parse_date

# Landed holiday field -> Silver column.
HOLIDAY_RENAMES = {"name": "holiday_name", "localName": "local_name",
                   "countryCode": "country_code"}


def shape_calendar(holidays: DataFrame, lo: _dt.date, hi: _dt.date,
                   date_col: str = "date", types_col: str = "types",
                   formats: Sequence[str] = DEFAULT_DATE_FORMATS) -> DataFrame:
    """Parse the day, keep the first type, keep [lo, hi] (both inclusive), rename.

    Output: holiday_date, holiday_name, local_name, country_code, fixed, global,
    holiday_type. The window filter runs on the parsed day, so it is pushed to the
    scan only when the input is already typed (Silver), not on landed text. A day that
    does not parse is outside every window; :func:`unparsed_days` is its gate rule.
    """
    day = parse_date(date_col, formats)
    return (holidays
            .select(day.alias("holiday_date"),
                    *[F.col(src).alias(dst) for src, dst in HOLIDAY_RENAMES.items()],
                    "fixed", "global", first_element(types_col).alias("holiday_type"))
            .filter(F.col("holiday_date").between(F.lit(lo), F.lit(hi))))


def unparsed_days(date_col: str = "date", formats: Sequence[str] = DEFAULT_DATE_FORMATS) -> Column:
    """Gate rule: a holiday whose day is absent or parses in no format."""
    return parse_date(date_col, formats).isNull()


def date_spine(spark: SparkSession, lo: _dt.date, hi: _dt.date) -> DataFrame:
    """One row per day in [lo, hi], generated in parallel by ``spark.range``."""
    n = (hi - lo).days + 1
    return spark.range(n).select(F.date_add(F.lit(lo), F.col("id").cast("int")).alias("date"))


def dim_date(spark: SparkSession, lo: _dt.date, hi: _dt.date, holidays: DataFrame,
             country: str) -> DataFrame:
    """Calendar days with ``is_public_holiday`` / ``holiday_name`` for one country.

    Several holidays on one day are merged (name = smallest name, plus a count), so
    the dimension stays one row per day. The holiday side is aggregated per day
    before the join (one row per day at most, whatever the input size).
    """
    per_day = (holidays.filter(F.col("country_code") == F.lit(country))
               .groupBy(F.col("holiday_date").alias("date"))
               .agg(F.min("holiday_name").alias("holiday_name"),
                    F.count("*").alias("n_holidays")))
    d = F.col("date")
    return (date_spine(spark, lo, hi).join(per_day, "date", "left")
            .select("date", F.year(d).alias("year"), F.month(d).alias("month"),
                    F.dayofmonth(d).alias("day"),
                    F.dayofweek(d).isin(1, 7).alias("is_weekend"),
                    F.col("n_holidays").isNotNull().alias("is_public_holiday"),
                    "holiday_name",
                    F.coalesce("n_holidays", F.lit(0)).alias("n_holidays")))
