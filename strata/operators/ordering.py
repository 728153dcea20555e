"""Positions of a total order without gathering the rows in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import materialize

_ROWS = 33                                                  # bits of monotonically_increasing_id() that count rows of a task


def with_position(df: DataFrame, order: Sequence[str | Column], name: str = "position") -> DataFrame:
    """``df`` with the position, from 1, of every row in ``order`` (what ``row_number()`` over the
    whole table gives, which would sort all rows in one task).

    Rows are dealt by range and sorted in their partitions; each gets its place in its
    partition, and is written once with it. Partitions are in order, so the numbers of rows in
    those before (one row a partition, small whatever the table's size) are added.

    NULLs come first unless ``order`` says otherwise. Rows equal in ``order`` get neighbouring
    positions in an unspecified order: end ``order`` with a unique column for positions that
    are the same on every run, and so that a hot value is spread over partitions. An empty
    table stays empty. A column called ``name`` is replaced.
    """
    place = F.col("_place")
    placed = materialize(df.drop(name).repartitionByRange(*order).sortWithinPartitions(*order)
                         .withColumn("_place", F.monotonically_increasing_id()), "table")
    home = F.shiftright(place, _ROWS)
    homes = placed.groupBy(home.alias("_home")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_home").rowsBetween(Window.unboundedPreceding, -1)
    offsets = homes.select("_home", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (placed.withColumn("_home", home).join(offsets, "_home")
            .withColumn(name, place.bitwiseAND(F.lit((1 << _ROWS) - 1)) + F.col("_before") + 1)
            .drop("_home", "_place", "_before"))
