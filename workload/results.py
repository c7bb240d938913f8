"""Match results: events as matches of users, and orders as matches of customers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans import results as R
from tidemark.sources import landing as L
from workload.registry import ROOT, events_by_day, query, table

# The score carries the event's number, which decides between rows of one match and day.
MATCH_SQL = """
    matches AS (
        SELECT year(ts)::INT AS "year", 'User ' || user_id AS tournament_name,
               user_id::VARCHAR AS tournament_id, 'Round ' || day(ts) AS round,
               event_type AS match_id, 'A' || user_id AS player1_name, 'a' || user_id AS player1_id,
               '' AS player1_seed, 'esp' AS player1_nation, 'B' || event_type AS player2_name,
               'b' || event_type AS player2_id, '2' AS player2_seed, '-' AS player2_nation,
               lpad(event_id::VARCHAR, 12, '0') AS score,
               'https://www.example.org/stats/' || event_id AS url,
               date_trunc('day', ts)::TIMESTAMP AS meta_file_modified
        FROM events),
    latest AS (
        SELECT * FROM matches
        QUALIFY row_number() OVER (PARTITION BY "year", tournament_id, match_id
                                   ORDER BY meta_file_modified DESC, score DESC) = 1)
"""
NEW_COLUMNS = """"year", tournament_name, tournament_id, round, match_id, player1_name, player1_id,
    player2_name, player2_id, score, url, meta_file_modified"""
# As written: versions of the de-duplicated rows, year ignored.
AS_WRITTEN_SQL = """
    ranked AS (
        SELECT *, dense_rank() OVER (PARTITION BY {unit} ORDER BY {version} DESC) AS r FROM latest),
    found AS (
        SELECT cur.* FROM (SELECT * FROM ranked WHERE r = 1) cur
        LEFT JOIN (SELECT DISTINCT {unit}, {match} FROM ranked WHERE r = 2) prev
            ON cur.{unit} = prev.{unit} AND cur.{match} = prev.{match}
        WHERE prev.{match} IS NULL)
"""
# As intended: versions of all rows, duplicates removed within a version, year compared.
INTENDED_SQL = """
    ranked AS (
        SELECT *, dense_rank() OVER (PARTITION BY {unit} ORDER BY {version} DESC) AS r FROM matches),
    single AS (
        SELECT * FROM ranked
        QUALIFY row_number() OVER (PARTITION BY "year", {unit}, {match}, {version}
                                   ORDER BY {tiebreak} DESC) = 1),
    found AS (
        SELECT cur.* FROM (SELECT * FROM single WHERE r = 1) cur
        LEFT JOIN (SELECT DISTINCT "year", {unit}, {match} FROM single WHERE r = 2) prev
            ON cur.{unit} = prev.{unit} AND cur.{match} = prev.{match} AND cur."year" = prev."year"
        WHERE prev.{match} IS NULL)
"""
EVENT_NAMES = dict(unit="tournament_id", match="match_id", version="meta_file_modified", tiebreak="score")


def match_rows(spark, sf_dir) -> DataFrame:
    text = lambda c: F.col(c).cast("string")
    tagged = lambda tag, c: F.concat(F.lit(tag), text(c))
    events = events_by_day(spark, sf_dir).withColumn("in_month", F.dayofmonth("ts"))
    return events.select(
        "day", "event_id",
        F.year("ts").alias("year"), tagged("User ", "user_id").alias("tournament_name"),
        text("user_id").alias("tournament_id"), tagged("Round ", "in_month").alias("round"),
        F.col("event_type").alias("match_id"),
        tagged("A", "user_id").alias("player1_name"), tagged("a", "user_id").alias("player1_id"),
        F.lit("").alias("player1_seed"), F.lit("esp").alias("player1_nation"),
        tagged("B", "event_type").alias("player2_name"), tagged("b", "event_type").alias("player2_id"),
        F.lit("2").alias("player2_seed"), F.lit("-").alias("player2_nation"),
        F.lpad(text("event_id"), 12, "0").alias("score"),
        tagged(f"{ROOT}/stats/", "event_id").alias("url"),
    )


def match_raw(spark, sf_dir) -> DataFrame:
    fields = [f.source for f in R.RESULT_FIELDS]
    docs = L.documents(match_rows(spark, sf_dir), ["day"], ["event_id"], fields, F.col("day"))
    return L.raw_table(docs)


def stored_matches(spark, sf_dir) -> DataFrame:
    return L.stored(R.all_results(match_raw(spark, sf_dir)), "matches")


@query("match_results", f"WITH {MATCH_SQL} SELECT * FROM latest")
def match_results(spark, sf_dir):
    rows = R.all_results(match_raw(spark, sf_dir))
    return R.latest_results(rows, ["score"]).drop("meta_file_name")


@query("new_results_as_written", f"""
    WITH {MATCH_SQL}, {AS_WRITTEN_SQL.format(**EVENT_NAMES)} SELECT {NEW_COLUMNS} FROM found
""")
def new_results_as_written(spark, sf_dir):
    rows = stored_matches(spark, sf_dir)
    return R.new_results(rows, "as_written", ["score"]).drop("meta_file_name")


@query("new_results_intended", f"""
    WITH {MATCH_SQL}, {INTENDED_SQL.format(**EVENT_NAMES)} SELECT {NEW_COLUMNS} FROM found
""")
def new_results_intended(spark, sf_dir):
    rows = stored_matches(spark, sf_dir)
    return R.new_results(rows, "intended", ["score"]).drop("meta_file_name")


# Orders: match ids are priorities, so they come back in later years.
ORDER_SQL = """
    matches AS (
        SELECT year(o_orderdate)::INT AS "year", o_custkey AS tournament_id,
               o_orderpriority AS match_id, o_orderkey AS score, o_orderdate AS meta_file_modified
        FROM orders),
    latest AS (
        SELECT * FROM matches
        QUALIFY row_number() OVER (PARTITION BY "year", tournament_id, match_id
                                   ORDER BY meta_file_modified DESC, score DESC) = 1)
"""
ORDER_COLUMNS = '"year", tournament_id, match_id, score, meta_file_modified'


def order_rows(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").alias("year"), F.col("o_custkey").alias("tournament_id"),
        F.col("o_orderpriority").alias("match_id"), F.col("o_orderkey").alias("score"),
        F.col("o_orderdate").alias("meta_file_modified"),
    )


@query("new_orders_as_written", f"""
    WITH {ORDER_SQL}, {AS_WRITTEN_SQL.format(**EVENT_NAMES)} SELECT {ORDER_COLUMNS} FROM found
""")
def new_orders_as_written(spark, sf_dir):
    return R.new_results(order_rows(spark, sf_dir), "as_written", ["score"])


@query("new_orders_intended", f"""
    WITH {ORDER_SQL}, {INTENDED_SQL.format(**EVENT_NAMES)} SELECT {ORDER_COLUMNS} FROM found
""")
def new_orders_intended(spark, sf_dir):
    return R.new_results(order_rows(spark, sf_dir), "intended", ["score"])
