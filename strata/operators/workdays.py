"""Working days: prefix sums per country, so counting between two days is two lookups.

``working_calendar`` numbers the working days of each country once; a difference of two days is a
difference of two numbers, and the n-th working day after a day is the day that bears the number.
No join has a range condition, and the calendar has one row a (country, day) whatever the data.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

WEEKEND = (1, 7)                                            # Spark's dayofweek: Sunday, Saturday


def working_calendar(countries: DataFrame, holidays: DataFrame, lo: dt.date, hi: dt.date,
                     weekend: Sequence[int] = WEEKEND) -> DataFrame:
    """country, date, is_working, work_no for every day in [lo, hi] of every distinct country.

    ``countries``: (country); ``holidays``: (country, date). ``work_no`` counts the country's working
    days from ``lo`` up to the day itself. Repeated holidays count once; NULL countries and days are
    left out; a country without holidays has weekends only; holidays outside [lo, hi] change nothing.
    """
    known = countries.select("country").filter("country IS NOT NULL").distinct()
    off = holidays.select("country", "date", F.lit(True).alias("__off")).distinct()
    days = F.sequence(F.lit(lo), F.lit(hi)) if lo <= hi else F.array().cast("array<date>")
    every = known.select("country", F.explode(days).alias("date"))
    work = ~F.dayofweek("date").isin(list(weekend)) & F.col("__off").isNull()
    so_far = Window.partitionBy("country").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return (every.join(off, ["country", "date"], "left").select("country", "date", work.alias("is_working"))
            .withColumn("work_no", F.sum(F.col("is_working").cast("long")).over(so_far)))


def working_days_between(df: DataFrame, calendar: DataFrame, country: str, start: str, end: str,
                         out: str = "working_days") -> DataFrame:
    """``df`` with the number of working days after ``start`` up to and including ``end``.

    Negative where ``end`` is before ``start``. NULL where a day or the country is NULL or not in the
    calendar; every row stays once.
    """
    def side(day, no):
        return calendar.select(F.col("country").alias(country), F.col("date").alias(day), F.col("work_no").alias(no))

    return (df.join(side(start, "__from"), [country, start], "left").join(side(end, "__to"), [country, end], "left")
            .select(*[df[c] for c in df.columns], (F.col("__to") - F.col("__from")).alias(out)))


def add_working_days(df: DataFrame, calendar: DataFrame, country: str, start: str, n: int,
                     out: str = "due") -> DataFrame:
    """``df`` with the ``n``-th working day after ``start`` (n >= 1; the first one later than ``start``).

    NULL where ``start`` or the country is NULL or not in the calendar, or the calendar ends earlier.
    """
    if n < 1:
        raise ValueError("n is at least 1")
    now = calendar.select(F.col("country").alias(country), F.col("date").alias(start), (F.col("work_no") + n).alias("__no"))
    then = calendar.filter("is_working").select(F.col("country").alias(country), F.col("work_no").alias("__no"),
                                                F.col("date").alias(out))
    return (df.join(now, [country, start], "left").join(then, [country, "__no"], "left")
            .select(*[df[c] for c in df.columns], out))
