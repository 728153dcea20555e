"""Reading the input tables, and the history every mart query builds on.

The input tables are TPC-H-shaped Parquet files; the HR roles map onto them as:

* event log  -> ``orders``: entity ``o_custkey``, day ``o_orderdate``, event order
  ``o_orderkey``, tracked state (status, priority, price as decimal(18,2));
* exits      -> customers of segment FURNITURE leave 30 days after their last order;
* facts      -> ``lineitem`` (ship day) joined to its order's customer;
* roster / reference tables -> ``customer``, ``nation``, ``region``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.history import scd2

# Fixed values of the mapping above.
EXIT_SEGMENT = "FURNITURE"
EXIT_AFTER_DAYS = 30
# Year buckets of the as-of join end here; later days share the last one (no result changes).
FACT_HORIZON = dt.date(2001, 12, 31)
STATE_COLUMNS = ("o_orderstatus", "o_orderpriority", "price")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as an event log (one state event per order)."""
    return table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey",
        F.col("o_orderdate").cast("date").alias("event_date"),
        "o_orderstatus", "o_orderpriority",
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"))


def customer_exits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_custkey, event_date) exit rows, derived from the data.

    Aggregate orders per customer first (partial aggregation, one row per key),
    then join the key-unique result to the filtered customer table.
    """
    last = (order_log(spark, sf_dir).groupBy("o_custkey")
            .agg(F.max("event_date").alias("last_order")))
    seg = (table(spark, sf_dir, "customer")
           .filter(F.col("c_mktsegment") == EXIT_SEGMENT)
           .select(F.col("c_custkey").alias("o_custkey")))
    return (last.join(seg, "o_custkey")
            .select("o_custkey", F.date_add("last_order", EXIT_AFTER_DAYS).alias("event_date")))


def order_history(spark: SparkSession, sf_dir: str, same_day: str = "last") -> DataFrame:
    return scd2(order_log(spark, sf_dir), key="o_custkey", date="event_date",
                order="o_orderkey", state=STATE_COLUMNS,
                exits=customer_exits(spark, sf_dir), same_day=same_day)


def order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their order's customer and ship day (the fact grain).

    ``orders`` is unique on ``o_orderkey``, so the join never multiplies lines.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("ship_date"))
    od = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return li.join(od, "l_orderkey")


def customer_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer attributes with nation and region names (one row per customer)."""
    c = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment", "c_nationkey")
    n = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("n_regionkey"), "r_name")
    return c.join(n, "c_nationkey", "left").join(r, "n_regionkey", "left").select(
        "o_custkey", "c_name", "c_mktsegment", "n_name", "r_name")


# ------------------------------------------------------------------ landed feeds
# Text renderings of the tables with planted defects, in the shape raw files land
# in. Every row of the source table is kept; the planting rules below are fixed
# values shared with the SQL twins.

def orders_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the order day as text: key % 97 = 0 -> the impossible
    '2026-13-01', key % 97 = 1 -> day-first 'dd-MM-yyyy', otherwise ISO."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    text = (F.when(k % 97 == 0, F.lit("2026-13-01"))
            .when(k % 97 == 1, F.date_format("o_orderdate", "dd-MM-yyyy"))
            .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")))
    return o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
                    F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
                    text.alias("date_text"))


def customer_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer as a landed roster: padded names (key % 4 = 0 two spaces before and
    one after; else key % 5 = 0 a leading tab), blank segments (key % 9 = 0 three
    spaces, key % 9 = 1 empty), balance as '<int>.0' text, active flag as text."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    name = (F.when(k % 4 == 0, F.concat(F.lit("  "), "c_name", F.lit(" ")))
            .when(k % 5 == 0, F.concat(F.lit("\t"), "c_name"))
            .otherwise(F.col("c_name")))
    seg = (F.when(k % 9 == 0, F.lit("   ")).when(k % 9 == 1, F.lit(""))
           .otherwise(F.concat(F.lit(" "), "c_mktsegment")))
    bal = F.concat(F.floor("c_acctbal").cast("bigint").cast("string"), F.lit(".0"))
    active = F.when(F.col("c_acctbal") > 0, F.lit("TRUE")).otherwise(F.lit("false"))
    return c.select("c_custkey", name.alias("name_text"), seg.alias("segment_text"),
                    bal.alias("balance_text"), active.alias("active_text"))


def events_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a landed log: type case/padding (id % 3 = 0 upper, id % 3 = 1
    padded), day as text (id % 7 = 0 day-first), amount as text (id % 4 = 0 with
    '.0'), note blank for id % 5 = 0."""
    e = table(spark, sf_dir, "events")
    i = F.col("event_id")
    typ = (F.when(i % 3 == 0, F.upper("event_type"))
           .when(i % 3 == 1, F.concat(F.lit(" "), "event_type", F.lit(" ")))
           .otherwise(F.col("event_type")))
    day = (F.when(i % 7 == 0, F.date_format("ts", "dd-MM-yyyy"))
           .otherwise(F.date_format("ts", "yyyy-MM-dd")))
    amt = F.floor("value").cast("bigint").cast("string")
    amt = F.when(i % 4 == 0, F.concat(amt, F.lit(".0"))).otherwise(amt)
    note = F.when(i % 5 == 0, F.lit("  ")).otherwise(F.col("props"))
    return e.select("event_id", "user_id", typ.alias("type_text"), day.alias("date_text"),
                    amt.alias("amount_text"), note.alias("note_text"))


def holiday_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders rendered as holiday-API records (date text, names, country, flags,
    types array; status 'P' gets an empty types array)."""
    o = table(spark, sf_dir, "orders")
    types = F.slice(F.split("o_orderpriority", "-"), 1,
                    F.when(F.col("o_orderstatus") == "P", 0).otherwise(2))
    return o.select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
                    F.col("o_orderpriority").alias("localName"),
                    F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("name"),
                    F.col("o_orderstatus").alias("countryCode"),
                    (F.col("o_totalprice") >= 100000).alias("fixed"),
                    F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("global"),
                    types.alias("types"))


def page_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with their URL query as ``array<struct<key,value>>`` (empty when the
    URL has no query)."""
    p = table(spark, sf_dir, "pages")
    q = F.regexp_extract("url", r"\?([^#]*)", 1)
    pairs = F.transform(F.split(q, "&"), lambda x: F.struct(
        F.split_part(x, F.lit("="), F.lit(1)).alias("key"),
        F.split_part(x, F.lit("="), F.lit(2)).alias("value")))
    return p.select("page_id", "url", F.when(q == "", F.array().cast(
        "array<struct<key:string,value:string>>")).otherwise(pairs).alias("params"))


def customer_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer as a nested record: profile{name, segment} and a 3-deep
    address{nation, region{name, key}}; address is a NULL struct for key % 10 = 0."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("n_regionkey"), "r_name")
    j = c.join(n, "c_nationkey", "left").join(r, "n_regionkey", "left")
    addr = F.struct(F.col("n_name").alias("nation"),
                    F.struct(F.col("r_name").alias("name"),
                             F.col("n_regionkey").alias("key")).alias("region"))
    return j.select("c_custkey",
                    F.struct(F.col("c_name").alias("name"),
                             F.col("c_mktsegment").alias("segment")).alias("profile"),
                    F.when(F.col("c_custkey") % 10 != 0, addr).alias("address"))
