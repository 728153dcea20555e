"""One person under two keys: names that are equal or one slip apart.

A slip is one letter inserted, left out or replaced, or two neighbours swapped. Blocking keys are the
name itself and the name without each one of its letters: two names are one slip apart exactly if

* one is the other without a letter, or
* both become the same when they lose the letter at the same position (replaced), or
* both become the same when they lose the same letter at neighbouring positions (swapped).

So the join on blocking keys is exact, and no candidate has to be compared letter by letter. Equal
names are one row before the join. A block then holds names that differ in one letter and its place
only, so its size is bounded by the alphabet, however many people there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.session import materialize


def plain_name(name: str | Column) -> Column:
    """Upper case, white space at the ends gone and single in between; blank is NULL."""
    name = F.col(name) if isinstance(name, str) else name
    tidy = F.upper(F.trim(F.regexp_replace(name, r"[\x20\x09-\x0D]+", " ")))
    return F.when(tidy != "", tidy)


def _blocks(names: DataFrame) -> DataFrame:
    """(block, pos, letter, name): pos 0 for the name itself, else the position of the lost letter."""
    cut = names.select("name", F.explode(F.sequence(F.lit(0), F.length("name"))).alias("pos"))
    rest = F.concat(F.expr("substring(name, 1, pos - 1)"), F.expr("substring(name, pos + 1)"))
    return cut.select(F.md5(F.when(F.col("pos") == 0, F.col("name")).otherwise(rest).cast("binary")).alias("block"), "pos",
                      F.when(F.col("pos") > 0, F.expr("substring(name, pos, 1)")).alias("letter"), "name")


def namesakes(people: DataFrame, key: str, name: str) -> DataFrame:
    """<key>, <name> (as ``plain_name``), n_same, n_near, first_key: one row per distinct key and name.

    ``n_same`` counts the other keys with an equal name, ``n_near`` the keys whose name is one slip
    away, ``first_key`` is the smallest key of all these, the own one included.

    A NULL or blank name is like no other. Rows without key play no part, repeated rows count once; a
    key with several names has a row for each (and may be near itself). Names compare by code points.
    An empty table gives no rows. Other columns are ignored. Very long names give one block a letter
    each, made one after another.
    """
    own = materialize(people.filter(F.col(key).isNotNull())
                      .select(F.col(key).alias("key"), plain_name(name).alias("name")).distinct(), "table")
    names = materialize(own.filter(F.col("name").isNotNull()).groupBy("name")
                        .agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("first")), "table")
    a = _blocks(names).alias("a")
    b = _blocks(names).alias("b")
    slip = F.expr("""a.pos = 0 or b.pos = 0 or a.pos = b.pos
                     or (abs(a.pos - b.pos) = 1 and a.letter = b.letter)""")
    pairs = materialize(a.join(b, (F.col("a.block") == F.col("b.block")) & (F.col("a.name") < F.col("b.name")) & slip)
                        .select(F.col("a.name").alias("x"), F.col("b.name").alias("y")).distinct(), "table")
    both = pairs.unionByName(pairs.select(F.col("y").alias("x"), F.col("x").alias("y")))
    near = (both.join(names, both["y"] == names["name"]).groupBy("x")
            .agg(F.sum("n").alias("n_near"), F.min("first").alias("near_first")))
    found = names.join(near, names["name"] == near["x"], "left").select(
        F.col("name").alias("_name"), (F.col("n") - 1).alias("n_same"), F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.least("first", "near_first").alias("first"))
    return own.join(found, own["name"] == found["_name"], "left").select(
        F.col("key").alias(key), F.col("name").alias(name), F.coalesce("n_same", F.lit(0)).cast("long").alias("n_same"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.coalesce("first", "key").alias("first_key"))
