"""Headcount that reconciles: what is there at each month end, and how it came to differ.

For every month and group: opening + entries + transfers_in - transfers_out - exits = closing, where
opening is the closing of the month before. All are month-end states: what happens and is undone
within one month does not count.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions import ascending, month_end_of_index, month_index

# The movements, in the order of the result.
MOVES = ("entries", "transfers_in", "transfers_out", "exits")


def _side(groups: str, delta: int, *moves: str) -> Column:
    return F.struct(F.col(groups).alias("_g"), F.lit(delta).alias("_delta"),
                    *[F.lit(1 if m in moves else 0).alias(m) for m in MOVES])


def headcount_movements(versions: DataFrame, key: str | Sequence[str], lo: _dt.date, hi: _dt.date,
                        levels: Sequence[Sequence[str]], valid_from: str = "valid_from",
                        valid_to: str = "valid_to") -> DataFrame:
    """level, month_end, <all columns of levels>, opening, entries, transfers_in, transfers_out,
    exits, closing: one row per level, group and month from ``lo`` to ``hi`` with anyone in it at its
    start or end.

    ``levels`` are grouping sets of columns, () the total; ``level`` names the set (columns joined by
    a comma, ``all`` for the total), and columns outside it are NULL. A key that changes its group of a
    level from one month end to the next transfers there; at a level where its group stays it does not
    move. Absence at one month end makes an exit and a later entry.

    Versions must not overlap per key (the history gate); they are cut to the month ends they cover, and
    one that covers none plays no part. NULL group values are a group of their own. Versions without
    key or dates play no part. An empty history gives no rows. Other columns are ignored.

    One window over the key (whose partitioning a history already has) finds the movements; at most one
    row a month end meets there for a key. Movements are summed per group and month with a map-side step
    before they meet again, so a group holding most rows is a few hundred rows in the running sum.
    """
    keys = [key] if isinstance(key, str) else list(key)
    by = list(dict.fromkeys(c for level in levels for c in level))
    first, end = month_index(F.lit(lo)), month_index(F.lit(hi)) if hi == _last_day(hi) else month_index(F.lit(hi)) - 1
    vf, vt = F.col(valid_from), F.least(F.col(valid_to), F.last_day(F.lit(hi)))
    last = F.when(F.last_day(vt) == vt, month_index(vt)).otherwise(month_index(vt) - 1)
    has_key = F.lit(True)
    for k in keys:
        has_key = has_key & F.col(k).isNotNull()
    lives = (versions.filter(has_key & vf.isNotNull() & F.col(valid_to).isNotNull())
             .select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                     F.struct(F.lit(0).alias("_"), *by).alias("_now"),
                     F.greatest(month_index(vf), first - 1).alias("_a"), F.least(last, end).alias("_z"))
             .filter("_a <= _z"))
    w = Window.partitionBy(*[f"_k{i}" for i in range(len(keys))]).orderBy("_a")
    path = lives.select("_a", "_z", "_now", F.lag("_z").over(w).alias("_pz"), F.lag("_now").over(w).alias("_was"),
                        F.lead("_a").over(w).alias("_na"))
    came = (F.col("_pz").isNull() | (F.col("_pz") < F.col("_a") - 1))
    left = (F.col("_na").isNull() | (F.col("_na") > F.col("_z") + 1)) & (F.col("_z") < end)

    def same(level: Sequence[str]) -> Column:
        out = F.lit(True)
        for c in level:
            out = out & F.col(f"_now.{c}").eqNullSafe(F.col(f"_was.{c}"))
        return out

    moves = []
    for level in levels:
        def at(m: Column, side: Column, level=level) -> Column:
            return F.struct(F.lit(",".join(level) or "all").alias("level"), m.alias("_m"),
                            *[(side[f"_g"][c] if c in level else F.lit(None)).cast(versions.schema[c].dataType).alias(c) for c in by],
                            side["_delta"].alias("_delta"), *[side[x].alias(x) for x in MOVES])
        a, z = F.col("_a"), F.col("_z") + 1
        moves += [F.when(came & (a < first), at(a, _side("_now", 1))),
                  F.when(came & (a >= first), at(a, _side("_now", 1, "entries"))),
                  F.when(~came & ~same(level), at(a, _side("_now", 1, "transfers_in"))),
                  F.when(~came & ~same(level), at(a, _side("_was", -1, "transfers_out"))),
                  F.when(left, at(z, _side("_now", -1, "exits")))]
    steps = (path.select(F.inline(F.array_compact(F.array(*moves))))
             .groupBy("level", *by, "_m").agg(F.sum("_delta").alias("_delta"), *[F.sum(m).alias(m) for m in MOVES]))
    g = Window.partitionBy("level", *by).orderBy("_m")
    runs = steps.select("*", F.sum("_delta").over(g).alias("closing"),
                        F.coalesce(F.lead("_m").over(g) - 1, end).alias("_to"))
    moved = F.col("_i") == F.col("_m")
    counts = (runs.select("*", F.explode(ascending(F.col("_m"), F.col("_to"))).alias("_i"))
              .filter(F.col("_i") >= first)
              .select("level", month_end_of_index("_i").alias("month_end"), *by,
                      F.when(moved, F.col("closing") - F.col("_delta")).otherwise(F.col("closing")).alias("opening"),
                      *[F.when(moved, F.col(m)).otherwise(F.lit(0)).cast("long").alias(m) for m in MOVES], "closing"))
    return counts.filter("opening > 0 or closing > 0")


def _last_day(d: _dt.date) -> _dt.date:
    after = (d.replace(day=28) + _dt.timedelta(days=4)).replace(day=1)
    return after - _dt.timedelta(days=1)
