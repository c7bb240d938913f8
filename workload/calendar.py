"""The calendar diff: a calendar per day, with one tournament per user seen that day.

A tournament has an address once its user purchased that day. It is current if the user also
viewed something. Half of the addresses are relative.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import diff as D
from tidemark.operators import versions as V
from tidemark.plans import calendar as C
from tidemark.sources import landing as L
from workload.registry import ROOT, events_by_day, query, table

CALENDAR_SQL = """
    seen AS (
        SELECT date_trunc('day', ts)::TIMESTAMP AS day, user_id,
               bool_or(event_type = 'purchase') AS bought, bool_or(event_type = 'view') AS viewed,
               min(event_type) AS first_type, max(event_type) AS last_type
        FROM events GROUP BY ALL),
    cal AS (
        SELECT year(day)::INT AS "year", 'User ' || user_id AS tournament,
               user_id::VARCHAR AS tournament_id, last_type AS category, first_type AS city,
               'Unknown' AS country, strftime(day, '%d %B %Y') AS dates,
               CASE WHEN bought THEN 'Winner ' || user_id END AS singles_winner,
               CASE WHEN bought AND viewed THEN 'Ann ' || user_id || ', Bob ' || user_id
                    WHEN bought THEN 'Cy ' || user_id END AS doubles_winner,
               CASE WHEN bought THEN
                   CASE WHEN user_id % 2 = 0 THEN '' ELSE 'https://www.example.org' END
                   || '/en/scores/' || CASE WHEN viewed THEN 'current' ELSE 'archive' END
                   || '/user-' || user_id || '/' || user_id || '/results' END AS url,
               day AS meta_file_modified
        FROM seen),
    days AS (SELECT DISTINCT meta_file_modified AS d FROM cal ORDER BY 1 DESC LIMIT 2),
    cur AS (SELECT * FROM cal WHERE meta_file_modified = (SELECT max(d) FROM days)),
    prev AS (SELECT * FROM cal WHERE meta_file_modified = (SELECT min(d) FROM days)),
    newly AS (
        SELECT cur.*, prev.meta_file_modified AS previous_meta_file_modified,
               'newly_completed' AS change_type
        FROM cur JOIN prev USING (tournament_id) WHERE prev.url IS NULL AND cur.url IS NOT NULL),
    going AS (
        SELECT cur.*, NULL::TIMESTAMP AS previous_meta_file_modified, 'ongoing' AS change_type
        FROM cur WHERE url IS NOT NULL
          AND split_part(regexp_replace(url, '^https?://', ''), '/', 4) = 'current'),
    changes AS (
        SELECT * FROM newly UNION ALL BY NAME
        SELECT * FROM going WHERE tournament_id NOT IN (SELECT tournament_id FROM newly))
"""


def calendar_rows(spark, sf_dir) -> DataFrame:
    is_type = lambda t: F.max(F.col("event_type") == t)
    seen = events_by_day(spark, sf_dir).groupBy("day", "user_id").agg(
        is_type("purchase").alias("bought"), is_type("view").alias("viewed"),
        F.min("event_type").alias("first_type"), F.max("event_type").alias("last_type"),
    )
    user, bought, viewed = F.col("user_id").cast("string"), F.col("bought"), F.col("viewed")
    named = lambda name: F.concat(F.lit(f"{name} "), user)
    url = F.concat(
        F.when(F.col("user_id") % 2 == 0, "").otherwise(ROOT), F.lit("/en/scores/"),
        F.when(viewed, "current").otherwise("archive"),
        F.lit("/user-"), user, F.lit("/"), user, F.lit("/results"),
    )
    return seen.select(
        "day", "user_id",
        F.year("day").alias("year"), named("User").alias("tournament"), user.alias("tournament_id"),
        F.col("last_type").alias("category"), F.col("first_type").alias("city"),
        F.lit("Unknown").alias("country"), F.date_format("day", "dd MMMM yyyy").alias("dates"),
        F.when(bought, named("Winner")).alias("singles_winner"),
        F.when(bought & viewed, F.array(named("Ann"), named("Bob")))
        .when(bought, F.array(named("Cy"))).alias("doubles_winner"),
        F.when(bought, url).alias("url"),
    )


def calendar_raw(spark, sf_dir) -> DataFrame:
    fields = [f.source for f in C.CALENDAR_FIELDS]
    docs = L.documents(calendar_rows(spark, sf_dir), ["day"], ["user_id"], fields, F.col("day"))
    return L.raw_table(docs)


def latest_two(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """From a stored raw table. Every document has a record, so versions can be ranked alone."""
    return C.latest_two(L.stored(calendar_raw(spark, sf_dir), "calendar"), guarded=True)


def _query(name: str, relation: str):
    return query(name, f"WITH {CALENDAR_SQL} SELECT * FROM {relation}")


@_query("calendar_all_versions", "cal")
def calendar_all_versions(spark, sf_dir):
    return C.calendar(calendar_raw(spark, sf_dir)).drop("meta_file_name")


@_query("snapshot_current", "cur")
def snapshot_current(spark, sf_dir):
    return latest_two(spark, sf_dir)[0].drop("meta_file_name")


@_query("snapshot_previous", "prev")
def snapshot_previous(spark, sf_dir):
    return latest_two(spark, sf_dir)[1].drop("meta_file_name")


@_query("newly_completed", "newly")
def newly_completed(spark, sf_dir):
    return C.newly_completed(*latest_two(spark, sf_dir)).drop("meta_file_name")


@_query("currently_ongoing", "going")
def currently_ongoing(spark, sf_dir):
    current, _ = latest_two(spark, sf_dir)
    return C.ongoing(current).drop("meta_file_name")


@_query("calendar_changes", "changes")
def calendar_changes(spark, sf_dir):
    return C.changes(*latest_two(spark, sf_dir)).drop("meta_file_name")


@query("scrape_targets", f"""
    WITH {CALENDAR_SQL}
    SELECT "year", tournament, tournament_id, change_type,
           CASE WHEN url LIKE '/%' THEN 'https://www.example.org' || url ELSE url END AS url
    FROM changes
""")
def scrape_targets(spark, sf_dir):
    return C.targets(C.changes(*latest_two(spark, sf_dir)), ROOT)


@query("orders_became_final", """
    SELECT c.o_custkey, c.o_orderkey, c.final_price, c.o_orderdate,
           p.o_orderdate AS previous_o_orderdate
    FROM (SELECT *, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS final_price FROM orders
          WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)) c
    JOIN (SELECT o_custkey, o_orderdate FROM orders
          WHERE year(o_orderdate) = (SELECT max(y) FROM (SELECT DISTINCT year(o_orderdate) AS y FROM orders)
                                     WHERE y < (SELECT max(year(o_orderdate)) FROM orders))
            AND o_orderstatus <> 'F') p USING (o_custkey)
    WHERE c.final_price IS NOT NULL
""")
def orders_became_final(spark, sf_dir):
    """The newest two years. Duplicates on both sides: a row appears once per matching earlier row."""
    price = F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", price.alias("final_price"), "o_orderdate", F.year("o_orderdate").alias("year")
    )
    newest, before = (v.drop("year") for v in V.current_and_previous(orders, version="year"))
    return D.became_non_null(newest, before, "o_custkey", "final_price", "o_orderdate")


@query("not_in_null_aware", """
    WITH probe AS (SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS k FROM orders)
    SELECT 'plain' AS case_name, * FROM probe
        WHERE k NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
    UNION ALL SELECT 'with null', * FROM probe
        WHERE k NOT IN (SELECT CASE WHEN c_mktsegment <> 'BUILDING' THEN c_custkey END FROM customer)
    UNION ALL SELECT 'empty', * FROM probe
        WHERE k NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal IS NULL)
""")
def not_in_null_aware(spark, sf_dir):
    key = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey")).alias("k")
    probe = table(spark, sf_dir, "orders").select("o_orderkey", key)
    customer = table(spark, sf_dir, "customer")
    nullable = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_custkey"))
    others = {
        "plain": customer.filter("c_acctbal < 0").select("c_custkey"),
        "with null": customer.select(nullable.alias("c_custkey")),
        "empty": customer.filter("c_acctbal IS NULL").select("c_custkey"),
    }
    plain, with_null, empty = (
        D.not_in(probe, "k", other, "c_custkey").withColumn("case_name", F.lit(name))
        for name, other in others.items()
    )
    return plain.unionByName(with_null).unionByName(empty)


@query("anti_join_new_keys", """
    SELECT c.* FROM customer c LEFT JOIN orders o
        ON c.c_custkey = o.o_custkey AND c.c_mktsegment = 'MACHINERY'
    WHERE c.c_mktsegment = 'MACHINERY' AND o.o_custkey IS NULL
    UNION ALL SELECT * FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
        AND c_mktsegment <> 'MACHINERY'
""")
def anti_join_new_keys(spark, sf_dir):
    """Customers that no order names."""
    named = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return D.new_keys(table(spark, sf_dir, "customer"), named, ["c_custkey"])
