"""Data-quality checks: the failing rows, and one count per check."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import quality as Q
from tidemark.plans.staging import checks, staging
from tidemark.sources import landing as L
from workload.calendar import CALENDAR_SQL, calendar_raw
from workload.landing import order_details
from workload.registry import query, table
from workload.results import AS_WRITTEN_SQL, EVENT_NAMES, MATCH_SQL, match_raw


@query("dq_not_null", """
    SELECT c_custkey, NULL::VARCHAR AS segment FROM customer WHERE c_mktsegment = 'BUILDING'
""")
def dq_not_null(spark, sf_dir):
    segment = F.nullif("c_mktsegment", F.lit("BUILDING"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", segment.alias("segment"))
    return Q.not_null(customers, "segment")


@query("dq_unique", """
    SELECT l_orderkey, count(*) AS n_records FROM lineitem GROUP BY 1 HAVING count(*) > 1
""")
def dq_unique(spark, sf_dir):
    return Q.unique(table(spark, sf_dir, "lineitem"), ["l_orderkey"])


@query("dq_unique_expr", """
    SELECT year(o_orderdate)::INT AS "year", o_custkey, o_orderpriority, count(*) AS n_records
    FROM orders GROUP BY ALL HAVING count(year(o_orderdate) || '|' || o_custkey || '|' || o_orderpriority) > 1
""")
def dq_unique_expr(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    return Q.unique(orders, ["year", "o_custkey", "o_orderpriority"])


@query("dq_all_checks", f"""
    WITH {CALENDAR_SQL}, {MATCH_SQL}, {AS_WRITTEN_SQL.format(**EVENT_NAMES)},
    details AS (SELECT * FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders))
    SELECT * FROM (VALUES
      ('calendar.tournament_id not null', (SELECT count(*) FROM cal WHERE tournament_id IS NULL)),
      ('calendar.meta_file_modified not null', (SELECT count(*) FROM cal WHERE meta_file_modified IS NULL)),
      ('calendar.tournament_id|meta_file_modified unique', (SELECT count(*) FROM (
          SELECT 1 FROM cal GROUP BY tournament_id || '|' || meta_file_modified HAVING count(*) > 1))),
      ('links.url not null', (SELECT count(*) FROM cal WHERE url IS NULL)),
      ('links.url|meta_file_modified unique', (SELECT count(*) FROM (
          SELECT 1 FROM cal WHERE url IS NOT NULL GROUP BY url, meta_file_modified HAVING count(*) > 1))),
      ('calendar_changes.tournament_id not null', (SELECT count(*) FROM changes WHERE tournament_id IS NULL)),
      ('calendar_changes.url not null', (SELECT count(*) FROM changes WHERE url IS NULL)),
      ('calendar_changes.tournament_id unique', (SELECT count(*) FROM (
          SELECT 1 FROM changes GROUP BY tournament_id HAVING count(*) > 1))),
      ('tournaments.tournament_id not null', (SELECT count(*) FROM details WHERE o_orderkey IS NULL)),
      ('tournaments.tournament_id unique', (SELECT count(*) FROM (
          SELECT 1 FROM details GROUP BY o_orderkey HAVING count(*) > 1))),
      ('results.match_id not null', (SELECT count(*) FROM latest WHERE match_id IS NULL)),
      ('results.tournament_id not null', (SELECT count(*) FROM latest WHERE tournament_id IS NULL)),
      ('results.year not null', (SELECT count(*) FROM latest WHERE "year" IS NULL)),
      ('results.year|tournament_id|match_id unique', (SELECT count(*) FROM (
          SELECT 1 FROM latest GROUP BY "year" || '|' || tournament_id || '|' || match_id
          HAVING count(*) > 1))),
      ('new_results.match_id not null', (SELECT count(*) FROM found WHERE match_id IS NULL)),
      ('new_results.tournament_id not null', (SELECT count(*) FROM found WHERE tournament_id IS NULL))
    ) t("check", failures)
""")
def dq_all_checks(spark, sf_dir):
    """Every check of the five relations, and two on a relation where one of them must fail."""
    calendar = L.stored(calendar_raw(spark, sf_dir), "raw-calendar")
    details = L.stored(L.raw_table(order_details(spark, sf_dir)), "details")
    relations = staging(calendar, details, match_raw(spark, sf_dir), guarded=True, whole_version=True, store=True)
    links = Q.suite("links", relations["calendar"], ["url"], ["url", "meta_file_modified"])
    return checks(relations).unionByName(links)
