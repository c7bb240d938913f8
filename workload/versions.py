"""Newest versions and version ranks, straight on the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import versions as V
from workload.registry import day_of, events_by_day, query, table


@query("newest_row", "SELECT * FROM events ORDER BY ts DESC, event_id DESC LIMIT 1")
def newest_row(spark, sf_dir):
    return V.latest_row(table(spark, sf_dir, "events"), "ts", ["event_id"])


@query("latest_version_rows", """
    SELECT event_id, user_id, event_type, ts FROM events
    WHERE date_trunc('day', ts) = (SELECT max(date_trunc('day', ts)) FROM events)
""")
def latest_version_rows(spark, sf_dir):
    newest = V.latest_version(events_by_day(spark, sf_dir), "day")
    return newest.select("event_id", "user_id", "event_type", "ts")


@query("latest_per_key", """
    SELECT year(ts)::INT AS "year", user_id, event_type, event_id, ts, value, props FROM events
    QUALIFY row_number() OVER (PARTITION BY year(ts), user_id, event_type
                               ORDER BY date_trunc('day', ts) DESC, event_id DESC) = 1
""")
def latest_per_key(spark, sf_dir):
    events = events_by_day(spark, sf_dir).withColumn("year", F.year("ts"))
    newest = V.latest_per_key(events, ["year", "user_id", "event_type"], "day", ["event_id"])
    return newest.select("year", "user_id", "event_type", "event_id", "ts", "value", "props")


@query("latest_order_per_key", """
    SELECT * FROM orders
    QUALIFY row_number() OVER (PARTITION BY year(o_orderdate), o_custkey, o_orderpriority
                               ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
""")
def latest_order_per_key(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    keys = ["year", "o_custkey", "o_orderpriority"]
    return V.latest_per_key(orders, keys, "o_orderdate", ["o_orderkey"]).drop("year")


@query("latest_shipment_per_part", """
    SELECT * FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY l_shipdate DESC,
        l_orderkey DESC, l_linenumber DESC, l_extendedprice DESC, l_quantity DESC) = 1
""")
def latest_shipment_per_part(spark, sf_dir):
    return V.latest_per_key(
        table(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey"], "l_shipdate",
        ["l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity"],
    )


@query("version_rank_global", """
    SELECT DISTINCT o_orderdate AS version, dense_rank() OVER (ORDER BY o_orderdate DESC)::INT AS version_rank
    FROM orders
""")
def version_rank_global(spark, sf_dir):
    dates = table(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("version"))
    return V.version_rank(dates, version="version")


@query("version_rank_of_hours", """
    SELECT DISTINCT date_trunc('hour', ts)::TIMESTAMP AS version,
           dense_rank() OVER (ORDER BY date_trunc('hour', ts) DESC)::INT AS version_rank
    FROM events
""")
def version_rank_of_hours(spark, sf_dir):
    """Many versions within a day."""
    ts = F.col("ts")
    hours = table(spark, sf_dir, "events").select(
        F.timestamp_add("HOUR", F.hour(ts), day_of(ts)).alias("version")
    )
    return V.version_rank(hours, version="version")


@query("version_rank_by_key", """
    SELECT DISTINCT user_id, date_trunc('day', ts)::TIMESTAMP AS version,
           dense_rank() OVER (PARTITION BY user_id ORDER BY date_trunc('day', ts) DESC)::INT AS version_rank
    FROM events
""")
def version_rank_by_key(spark, sf_dir):
    days = events_by_day(spark, sf_dir).withColumnRenamed("day", "version")
    return V.version_rank(days, ["user_id"], "version")


@query("snapshot_pair_by_key", """
    SELECT * FROM (
        SELECT o_custkey, o_orderkey, o_orderdate,
               dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC)::INT AS version_rank
        FROM orders)
    WHERE version_rank <= 2
""")
def snapshot_pair_by_key(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return V.snapshot_pair(orders, ["o_custkey"], "o_orderdate")


@query("top_versions", "SELECT DISTINCT o_orderdate FROM orders ORDER BY 1 DESC LIMIT 5")
def top_versions(spark, sf_dir):
    return V.top_versions(table(spark, sf_dir, "orders"), 5, "o_orderdate")
