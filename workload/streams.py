"""Documents that arrive as files, picked up by a stream that runs until nothing is left."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.flatten import flatten
from tidemark.plans import calendar as C
from tidemark.session import shared_dir
from tidemark.sources import landing as L
from tidemark.sources import state as St
from tidemark.streaming import ingest as I
from workload.calendar import CALENDAR_SQL, calendar_rows
from workload.landing import EVENTS_PER_DAY, EVENT_FIELDS, event_documents, records_by_version
from workload.registry import query

KEYS = ["year", "user_id", "event_type"]


@query("stream_ingest", EVENTS_PER_DAY)
def stream_ingest(spark, sf_dir):
    """Two drops of files and one run after each; the second drop holds the older days."""
    incoming, raw, state = (shared_dir(spark, n) for n in ("incoming", "raw", "checkpoint"))
    docs = event_documents(spark, sf_dir).withColumn("month_half", F.when(F.dayofmonth("day") > 15, 2).otherwise(1))
    for half in (2, 1):
        L.write_documents(docs.filter(F.col("month_half") == half), incoming)
        I.load_new(I.new_documents(spark, incoming), raw, state).awaitTermination()
    return records_by_version(spark.read.parquet(raw))


@query("stream_latest_per_key", """
    SELECT year(ts)::INT AS "year", user_id::VARCHAR AS user_id, event_type,
           lpad(event_id::VARCHAR, 12, '0') AS event_id, date_trunc('day', ts)::TIMESTAMP AS meta_file_modified
    FROM events
    QUALIFY row_number() OVER (PARTITION BY year(ts), user_id, event_type
                               ORDER BY date_trunc('day', ts) DESC, event_id DESC) = 1
""")
def stream_latest_per_key(spark, sf_dir):
    """Newest row per key although newer files arrive first. Runs are merged as soon as there are two."""
    incoming, state, checkpoint = (shared_dir(spark, n) for n in ("incoming", "state", "checkpoint"))
    docs = event_documents(spark, sf_dir).withColumn("month_half", F.when(F.dayofmonth("day") > 15, 2).otherwise(1))

    def rows(raw):
        flat = flatten(raw, EVENT_FIELDS)
        return flat.select(
            F.year("meta_file_modified").alias("year"), "user_id", "event_type",
            F.lpad("event_id", 12, "0").alias("event_id"), "meta_file_modified",
        )

    for half in (2, 1):
        L.write_documents(docs.filter(F.col("month_half") == half), incoming)
        stream = I.new_documents(spark, incoming)
        I.keep_latest(stream, rows, KEYS, state, checkpoint, ["event_id"], fanout=2, buckets=4).awaitTermination()
    return I.latest_state(spark, state, KEYS, ["event_id"])


def calendar_stream(spark, sf_dir, drops, name):
    """Calendar documents that arrive in drops; the state behind them and the published changes."""
    incoming, raw, checkpoint, kept, out = (
        shared_dir(spark, f"{name}-{n}") for n in ("incoming", "raw", "checkpoint", "state", "changes")
    )
    state = St.latest_two(spark, kept, ["tournament_id"], buckets=4)
    published = St.every(spark, out, ["tournament_id"], buckets=4)
    fields = [f.source for f in C.CALENDAR_FIELDS]
    docs = L.documents(calendar_rows(spark, sf_dir), ["day"], ["user_id"], fields, F.col("day"))

    def refresh(rows, batch):
        published.replace(C.changes_of(rows), "refresh", batch)

    for drop in drops:
        L.write_documents(docs.filter(drop), incoming)
        stream = I.new_documents(spark, incoming)
        I.after_each_batch(stream, C.calendar, state, raw, checkpoint, refresh).awaitTermination()
    return state, published


@query("stream_calendar_changes", f"WITH {CALENDAR_SQL} SELECT * FROM changes")
def stream_calendar_changes(spark, sf_dir):
    """The calendar diff refreshed after each load from the latest two versions, which are kept; older days come last."""
    older = F.dayofmonth("day") <= 15
    _, published = calendar_stream(spark, sf_dir, (~older, older), "stream")
    return published.rows().drop("meta_file_name")


@query("state_latest_two", f"""
    WITH {CALENDAR_SQL} SELECT * FROM cal WHERE meta_file_modified IN (SELECT d FROM days)
""")
def state_latest_two(spark, sf_dir):
    """The rows that the diff keeps, after three drops of days in no order."""
    thirds = [F.dayofmonth("day") % 3 == k for k in (1, 2, 0)]
    state, _ = calendar_stream(spark, sf_dir, thirds, "thirds")
    return state.rows().drop("meta_file_name")
