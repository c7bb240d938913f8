"""Landing, raw loads, flatten and what is known about files."""

from __future__ import annotations

from pyspark.errors import PySparkException, StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import payload as P
from tidemark.functions import text as T
from tidemark.functions import urls as U
from tidemark.operators import summary as S
from tidemark.operators.flatten import Field, flatten, flatten_structs
from tidemark.plans import analytics as A
from tidemark.plans.tournaments import tournaments
from tidemark.session import shared_dir
from tidemark.sources import documents as D
from tidemark.sources import keyed as K
from tidemark.sources import landing as L
from tidemark.sources import ledger as G
from tidemark.sources import loads as Ld
from tidemark.sources import sql_text as Q
from tidemark.sources.files import Files
from workload.registry import DATA_ROOT, ROOT, day_of, events_by_day, query, table

EVENT_FIELDS = (
    Field("event_id", "event_id"),
    Field("ts", "ts"),
    Field("user_id", "user_id"),
    Field("event_type", "event_type"),
    Field("value", "value"),
    Field("props", "props"),
)


def event_documents(spark, sf_dir, limit: int = L.RECORDS_PER_DOCUMENT) -> DataFrame:
    """One document per day of events, in parts where a day is long."""
    fields = [F.col("ts").cast("string").alias("ts") if f.source == "ts" else F.col(f.source)
              for f in EVENT_FIELDS]
    return L.documents(events_by_day(spark, sf_dir), ["day"], ["event_id"], fields, F.col("day"), limit=limit)


def event_raw(spark, sf_dir, limit: int = L.RECORDS_PER_DOCUMENT) -> DataFrame:
    return L.raw_table(event_documents(spark, sf_dir, limit))


EVENTS_PER_DAY = """
    SELECT date_trunc('day', ts)::TIMESTAMP AS version, count(*) AS n_records
    FROM events GROUP BY 1
"""


def records_by_version(raw: DataFrame) -> DataFrame:
    return raw.groupBy(F.col("meta_file_modified").alias("version")).agg(
        F.sum(D.record_count()).cast("bigint").alias("n_records")
    )


@query("raw_blob_load", EVENTS_PER_DAY)
def raw_blob_load(spark, sf_dir):
    """Documents are written as files, scanned whole and appended to a raw table."""
    files, raw = shared_dir(spark, "landing"), shared_dir(spark, "raw")
    L.write_documents(event_documents(spark, sf_dir).withColumn("year", F.year("day")), files, ["year"])
    D.load_raw(spark, files, raw, require_records=True)
    return records_by_version(D.raw_source(spark, raw))


@query("malformed_documents", """
    SELECT event_id::VARCHAR || '.json' AS meta_file_name, event_type <> 'signup' AS loaded
    FROM events
""")
def malformed_documents(spark, sf_dir):
    """A file per event. Those of sign-ups lack their end or go on behind it, and are set aside."""
    events = table(spark, sf_dir, "events")
    broken = F.when(F.col("value") < 50, F.rtrim("props", F.lit("}"))).otherwise(F.concat("props", F.lit(" }")))
    scanned = events.select(
        F.when(F.col("event_type") == "signup", broken).otherwise(F.col("props")).alias("data"),
        F.concat(F.col("event_id"), F.lit(".json")).alias("meta_file_name"),
    )
    loaded = D.raw_rows(scanned, strict=False).select("meta_file_name", F.lit(True).alias("loaded"))
    aside = D.quarantined(scanned).select("meta_file_name", F.lit(False).alias("loaded"))
    return loaded.unionByName(aside)


@query("records_per_document", EVENTS_PER_DAY)
def records_per_document(spark, sf_dir):
    """A day is one document, in however many parts: tiny ones here."""
    counted = S.records_per_document(event_raw(spark, sf_dir, limit=7))
    return counted.select(F.col("document").cast("timestamp_ntz").alias("version"), "n_records")


@query("idempotent_load", EVENTS_PER_DAY)
def idempotent_load(spark, sf_dir):
    """Three loads of a folder: of half the files, of all, and of nothing new. Each file is loaded once."""
    files, raw, ledger = (shared_dir(spark, n) for n in ("landing", "raw", "ledger"))
    docs = event_documents(spark, sf_dir).withColumn("late", F.dayofmonth("day") > 15)
    for drop in (F.col("late"), ~F.col("late"), F.lit(False)):
        L.write_documents(docs.filter(drop), files)
        Ld.load_new(spark, files, raw, ledger, "events")
    return records_by_version(Ld.loaded(spark, raw))


@query("load_moves", """
    SELECT DISTINCT date_trunc('day', ts)::TIMESTAMP AS version,
           CASE WHEN day(ts) > 15 THEN 'archive' ELSE 'incoming' END AS place, day(ts) > 15 AS loaded
    FROM events
""")
def load_moves(spark, sf_dir):
    """Where files are after a load, and a second one that a malformed file stops: that one's files stay."""
    files, raw, ledger, archive = (shared_dir(spark, n) for n in ("incoming", "raw", "ledger", "archive"))
    docs = event_documents(spark, sf_dir).withColumn("late", F.dayofmonth("day") > 15)
    L.write_documents(docs.filter("late"), files)
    Ld.load_new(spark, files, raw, ledger, "events", archive=archive)
    L.write_documents(docs.filter("NOT late"), files)
    Files(spark, files).write(f"{files}/broken.json", '{"data": [')
    try:
        Ld.load_new(spark, files, raw, ledger, "events", archive=archive)
    except StreamingQueryException:
        pass
    else:
        raise AssertionError("the malformed file was loaded")
    names = Ld.loaded(spark, raw).select("meta_file_modified").distinct().withColumnRenamed("meta_file_modified", "version")
    found = None
    for place, folder in (("archive", archive), ("incoming", files)):
        own = D.raw_rows(D.scan_documents(spark, folder), strict=False)
        own = own.select(F.col("meta_file_modified").alias("version"), F.lit(place).alias("place")).distinct()
        found = own if found is None else found.union(own)
    return found.join(names.withColumn("known", F.lit(True)), "version", "left").select(
        "version", "place", F.coalesce("known", F.lit(False)).alias("loaded")
    )


@query("documents_at_keys", """
    SELECT 'raw/events/year=' || strftime(ts, '%Y') || '/month=' || strftime(ts, '%m') || '/'
               || strftime(date_trunc('day', ts), '%Y%m%d_%H%M%S') AS key,
           count(*) AS n_records, count(*) AS n_listed, true AS all_listed
    FROM events GROUP BY 1
""")
def documents_at_keys(spark, sf_dir):
    """Files and manifest after a write that fails, one that doesn't, and its repetition: records by key without the part."""
    root, manifest = shared_dir(spark, "keyed"), shared_dir(spark, "manifest")
    docs = L.stored(event_documents(spark, sf_dir), "documents")
    key = F.regexp_replace(U.landing_key("events", F.col("day")), "[.]json$", "")
    key = F.concat(key, F.lit("-"), F.col("part"), F.lit(".json"))
    failing = F.when(F.dayofmonth("day") == 3, F.raise_error(F.lit("no space left")).cast("string")).otherwise(key)
    try:
        K.write_documents(docs, failing, root, manifest, "events", "landing", 0)
    except PySparkException:
        pass
    else:
        raise AssertionError("the write did not fail")
    for _ in range(2):
        K.write_documents(docs, key, root, manifest, "events", "landing", 0)
    at = F.regexp_extract("meta_file_name", "(raw/events/.*)$", 1)
    files = D.scan_documents(spark, f"{root}/raw/events").select(at.alias("key"), D.record_count().alias("found"))
    listed = K.listed(spark, manifest).rows().select("key", F.col("count").cast("bigint").alias("listed"))
    both = files.join(listed, "key", "full").withColumn("key", F.regexp_replace("key", "-[0-9]+[.]json$", ""))
    return both.groupBy("key").agg(
        F.sum("found").cast("bigint").alias("n_records"), F.sum("listed").cast("bigint").alias("n_listed"),
        F.every(F.col("found").eqNullSafe(F.col("listed"))).alias("all_listed"),
    )


@query("refused_then_repaired", """
    SELECT date_trunc('day', ts)::TIMESTAMP AS version, count(*) AS n_records,
           (CASE WHEN day(ts) % 5 = 0 THEN 3 WHEN day(ts) % 7 = 0 THEN 2 ELSE 0 END)::INT AS attempt
    FROM events GROUP BY ALL
""")
def refused_then_repaired(spark, sf_dir):
    """Files that lack their end are refused and tried again, one bracket at a time; nothing is lost."""
    files, raw, ledger, refused = (shared_dir(spark, n) for n in ("incoming", "raw", "ledger", "refused"))
    day = F.dayofmonth("meta_file_modified")
    missing = F.when(day % 5 == 0, 2).when(day % 7 == 0, 1).otherwise(0)
    text = F.left("data", F.char_length("data") - missing)
    event_raw(spark, sf_dir).select(text.alias("value")).write.option("maxRecordsPerFile", 1).text(files)
    Ld.load_new(spark, files, raw, ledger, "events", strict=False, refused=refused, glob="*.txt")
    for end in ("}", "]}"):
        Ld.repair(spark, raw, ledger, refused, "events", lambda data, end=end: F.concat(data, F.lit(end)))
    attempts = Ld.refusals(spark, refused).rows().select("meta_file_name", "attempt")
    return Ld.loaded(spark, raw).join(attempts, "meta_file_name", "left").groupBy(
        F.col("meta_file_modified").alias("version"), F.coalesce("attempt", F.lit(0)).alias("attempt")
    ).agg(F.sum(D.record_count()).cast("bigint").alias("n_records"))


@query("flatten_one_level", """
    SELECT event_id, ts, user_id, event_type, value, json_extract(props, '$.k')::INT AS k,
           date_trunc('day', ts)::TIMESTAMP AS version
    FROM events
""")
def flatten_one_level(spark, sf_dir):
    rows = flatten(event_raw(spark, sf_dir), EVENT_FIELDS)
    k = Field("k", "k", "int").read(F.parse_json("props"), strict=True)
    return rows.select(
        F.col("event_id").cast("bigint"), F.col("ts").cast("timestamp_ntz"),
        F.col("user_id").cast("bigint"), "event_type", F.col("value").cast("double"),
        k, F.col("meta_file_modified").alias("version"),
    )


@query("flatten_two_level", """
    SELECT o_custkey::VARCHAR AS customer, o_orderkey::VARCHAR AS order_id, o_orderstatus AS status,
           o_totalprice AS price, date_trunc('year', o_orderdate)::TIMESTAMP AS version
    FROM orders
""")
def flatten_two_level(spark, sf_dir):
    """Documents per year hold groups per customer, which hold orders."""
    orders = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    groups = L.collect_records(
        orders, ["year", "o_custkey"], ["o_orderkey"],
        [F.col("o_custkey").alias("customer"), F.col("o_orderkey").alias("order_id"),
         F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price")],
        "orders", limit=1000,
    ).withColumnRenamed("part", "group_part")
    docs = L.documents(
        groups, ["year"], ["o_custkey", "group_part"], ["orders"],
        F.make_timestamp_ntz("year", F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)), limit=1000,
    )
    fields = (Field("customer", "customer"), Field("order_id", "order_id"),
              Field("status", "status"), Field("price", "price"))
    rows = flatten(L.raw_table(docs), fields, ("data", "orders"))
    return rows.select("customer", "order_id", "status", F.col("price").cast("double"),
                       F.col("meta_file_modified").alias("version"))


def order_details(spark, sf_dir, limit: int = 1000) -> DataFrame:
    """Documents per day of orders: date groups by priority, which hold orders as tournaments."""
    orders = table(spark, sf_dir, "orders")
    text = lambda c: F.col(c).cast("string")
    record = [
        text("o_orderkey").alias("Id"),
        F.concat(F.lit("Order "), text("o_orderkey")).alias("Name"),
        F.concat(F.lit("Customer "), text("o_custkey")).alias("Location"),
        F.date_format("o_orderdate", "dd.MM.yyyy").alias("FormattedDate"),
        F.col("o_orderpriority").alias("Surface"),
        F.when(F.col("o_orderstatus") == "O", "O").alias("IndoorOutdoor"),
        text("o_totalprice").alias("TotalFinancialCommitment"),
        F.lit(None).cast("string").alias("PrizeMoneyDetails"),
        (F.col("o_custkey") % 64).cast("int").alias("SglDrawSize"),
        (F.col("o_custkey") % 32).cast("string").alias("DblDrawSize"),
        F.col("o_orderstatus").alias("Type"),
        F.lit("").alias("ChallengerCategory"),
        F.concat(F.lit("/overview/"), text("o_orderkey")).alias("TournamentOverviewUrl"),
        F.concat(F.lit("http://site/"), text("o_custkey")).alias("TournamentSiteUrl"),
        F.concat(F.lit("/scores/"), text("o_orderkey")).alias("ScoresUrl"),
        (F.col("o_totalprice") > 250000).alias("IsLive"),
        F.when(F.col("o_orderstatus") == "F", "true").otherwise("false").alias("IsPastEvent"),
    ]
    groups = L.collect_records(
        orders, ["o_orderdate", "o_orderpriority"], ["o_orderkey"], record, "Tournaments", limit=limit,
    ).withColumnRenamed("part", "group_part")
    listed = L.collect_records(
        groups, ["o_orderdate"], ["o_orderpriority", "group_part"],
        ["Tournaments"], "TournamentDates", limit=max(1, limit // 10),
    )
    wrapped = P.envelope(
        F.struct("TournamentDates"), F.col("o_orderdate"), F.lit(f"{ROOT}/api"),
        L.document_name(["o_orderdate"]), F.col("part"),
    )
    return listed.select("o_orderdate", "part", wrapped.alias("d")).select("o_orderdate", "part", "d.*")


LATEST_FILE_SQL = """
    SELECT o_orderkey::VARCHAR AS tournament_id, 'Order ' || o_orderkey AS tournament_name,
           'Customer ' || o_custkey AS location, strftime(o_orderdate, '%d.%m.%Y') AS formatted_date,
           o_orderpriority AS surface, CASE WHEN o_orderstatus = 'O' THEN 'O' END AS indoor_outdoor,
           o_totalprice::DOUBLE AS total_financial_commitment, NULL::VARCHAR AS prize_money_details,
           (o_custkey % 64)::INT AS singles_draw_size, (o_custkey % 32)::INT AS doubles_draw_size,
           o_orderstatus AS event_type, '' AS challenger_category,
           '/overview/' || o_orderkey AS tournament_overview_url,
           'http://site/' || o_custkey AS tournament_site_url, '/scores/' || o_orderkey AS scores_url,
           o_totalprice > 250000 AS is_live, o_orderstatus = 'F' AS is_past_event,
           o_orderdate::TIMESTAMP AS meta_file_modified
    FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)
"""


def latest_details(docs: DataFrame, whole_version: bool = False) -> DataFrame:
    raw = L.stored(L.raw_table(docs), "details")
    return tournaments(raw, whole_version=whole_version).drop("meta_file_name").withColumn(
        "total_financial_commitment", F.col("total_financial_commitment").cast("double")
    )


@query("latest_file_only", LATEST_FILE_SQL)
def latest_file_only(spark, sf_dir):
    return latest_details(order_details(spark, sf_dir))


@query("latest_file_in_parts", LATEST_FILE_SQL)
def latest_file_in_parts(spark, sf_dir):
    """Each document is in many parts, which change nothing."""
    return latest_details(order_details(spark, sf_dir, limit=2))


@query("latest_version_in_parts", LATEST_FILE_SQL)
def latest_version_in_parts(spark, sf_dir):
    return latest_details(order_details(spark, sf_dir, limit=1_000_000), whole_version=True)


def typed_documents(spark, sf_dir) -> DataFrame:
    """Orders of a year as one array of structs, with the year in the metadata."""
    orders = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    record = [
        F.concat(F.lit("Order "), F.col("o_orderkey")).alias("tournament"),
        F.col("o_orderstatus").alias("city"),
        F.concat(F.lit("C"), F.col("o_custkey")).alias("country"),
        F.col("o_orderpriority").alias("category"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_custkey").cast("string")).alias("singles_winner"),
    ]
    listed = L.collect_records(orders, ["year"], ["o_orderkey"], record, "tournaments")
    return listed.select(F.struct("year").alias("metadata"), "tournaments")


@query("flatten_struct_filter", """
    SELECT 'Order ' || o_orderkey AS tournament, o_orderstatus AS city, 'C' || o_custkey AS country,
           o_orderpriority AS category,
           CASE WHEN o_orderstatus = 'F' THEN o_custkey::VARCHAR END AS singles_winner
    FROM orders WHERE year(o_orderdate) = 1998
""")
def flatten_struct_filter(spark, sf_dir):
    return A.tournaments_of_year(typed_documents(spark, sf_dir), 1998)


@query("count_by_category", """
    SELECT o_orderpriority AS category, count(*) AS tournament_count FROM orders GROUP BY 1
""")
def count_by_category(spark, sf_dir):
    return A.tournaments_by_category(typed_documents(spark, sf_dir))


@query("flatten_conversations", "SELECT conv_id, turn, role, text FROM conversations")
def flatten_conversations(spark, sf_dir):
    """Collecting turns per conversation and unnesting them again changes nothing."""
    turns = table(spark, sf_dir, "conversations")
    listed = L.collect_records(turns, ["conv_id"], ["turn"], ["turn", "role", "text"], "turns")
    return flatten_structs(listed, "turns", ["conv_id"])


# Files -------------------------------------------------------------------------------------


def day_ledger(spark, sf_dir) -> DataFrame:
    """One ledger row per day file, loaded when its last event came in."""
    events = events_by_day(spark, sf_dir)
    files = events.groupBy("day").agg(
        F.max("ts").alias("loaded_at"), F.count("*").cast("int").alias("rows_loaded")
    )
    return files.select(
        F.concat(F.lit("incoming/"), F.date_format("day", "yyyyMMdd"), F.lit(".json")).alias("file_uri"),
        F.lit("events").alias("endpoint"), F.lit("raw_events").alias("table_name"),
        "rows_loaded", "loaded_at",
    )


LEDGER_SQL = """
    SELECT 'incoming/' || strftime(ts, '%Y%m%d') || '.json' AS file_uri, 'events' AS endpoint,
           'raw_events' AS table_name, count(*)::INT AS rows_loaded, max(ts) AS loaded_at
    FROM events GROUP BY 1
"""


@query("recent_loads_top10", f"SELECT * FROM ({LEDGER_SQL}) ORDER BY loaded_at DESC, file_uri DESC LIMIT 10")
def recent_loads_top10(spark, sf_dir):
    return G.recent_loads(day_ledger(spark, sf_dir), 10)


@query("ledger_new_files", """
    SELECT DISTINCT 'incoming/' || strftime(ts, '%Y%m%d') || '.json' AS meta_file_name FROM events
    WHERE date_trunc('day', ts) NOT IN (SELECT date_trunc('day', ts) FROM events WHERE day(ts) <= 15)
""")
def ledger_new_files(spark, sf_dir):
    """Files of days that the ledger lacks; it holds those up to the middle of the month."""
    name = F.concat(F.lit("incoming/"), F.date_format("day", "yyyyMMdd"), F.lit(".json"))
    days = events_by_day(spark, sf_dir).select("day").distinct()
    ledger = days.filter(F.dayofmonth("day") <= 15).select(name.alias("file_uri"))
    return G.new_files(days.select(name.alias("meta_file_name")), ledger)


@query("ledger_rows", """
    SELECT strftime(ts, '%Y-%m-%d') AS file_uri, 'events' AS endpoint, 'raw_events' AS table_name,
           count(*)::INT AS rows_loaded, TIMESTAMP '2024-02-01 06:00:00' AS loaded_at
    FROM events GROUP BY 1
""")
def ledger_rows(spark, sf_dir):
    rows = flatten(event_raw(spark, sf_dir), EVENT_FIELDS)
    by_file = rows.withColumn("meta_file_name", F.date_format("meta_file_modified", "yyyy-MM-dd"))
    at = F.lit("2024-02-01 06:00:00").cast("timestamp_ntz")
    return G.ledger_rows(by_file, "events", "raw_events", at)


@query("manifest", """
    SELECT 'events' AS endpoint, year(ts)::VARCHAR AS "year", count(*) AS n_records,
           strftime(date_trunc('day', ts), '%Y-%m-%dT00:00:00.000000+00:00') AS scraped_at
    FROM events GROUP BY ALL
""")
def manifest(spark, sf_dir):
    """One row per document, although long days are in parts: tiny ones here."""
    listed = L.manifest(event_documents(spark, sf_dir, limit=11), "events", year=F.year("day"))
    return listed.select("endpoint", "year", "scraped_at", F.col("count").cast("bigint").alias("n_records"))


@query("landing_key", """
    SELECT event_id,
      'raw/' || event_type || '/year=' || strftime(ts, '%Y') || '/month=' || strftime(ts, '%m')
        || '/' || strftime(ts, '%Y%m%d_%H%M%S') || '.json' AS generic_key,
      'raw/atp_results_archive/incoming/year=' || year(ts) || '/atp_calendar_' || year(ts) || '_'
        || strftime(ts, '%Y%m%d_%H%M%S') || '.json' AS calendar_key,
      'raw/atp_tournaments/incoming/year=' || year(ts) || '/atp_tournaments_' || year(ts) || '_'
        || strftime(ts, '%Y%m%d_%H%M%S') || '.json' AS tournaments_key,
      'raw/atp_tournament/year=' || year(ts) || '/tourn=' || user_id || '/atp_tournament_results_'
        || year(ts) || '_' || user_id || '_' || strftime(ts, '%Y%m%d_%H%M%S') || '.json' AS results_key,
      'raw/match-stats/year=' || year(ts) || '/tourn=' || user_id || '/F_User-' || user_id || '_P2_MS'
        || event_id || '_' || event_type || '_' || strftime(ts, '%Y%m%d_%H%M%S') || '.json' AS match_key
    FROM events
""")
def landing_key(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    ts, user = F.col("ts"), F.col("user_id")
    file_name = U.match_file_name(
        F.lit("Final"), F.concat(F.lit("User "), user), F.lit(None).cast("string"),
        F.concat(F.lit("ms"), F.col("event_id")), F.col("event_type"), ts,
    )
    return events.select(
        "event_id",
        U.landing_key("events", ts, endpoint=F.col("event_type")).alias("generic_key"),
        U.landing_key("atp_results_archive", ts).alias("calendar_key"),
        U.landing_key("atp_tournaments", ts).alias("tournaments_key"),
        U.landing_key("atp_tournament", ts, tournament_id=user).alias("results_key"),
        U.landing_key("match_stats", ts, tournament_id=user, filename=file_name).alias("match_key"),
    )


@query("envelope_wrap", """
    SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS retrieved_at,
           'https://data.example.org/stats' AS source_url, json_extract(props, '$.k')::INT AS k,
           'NULL' AS missing_kind
    FROM events
""")
def envelope_wrap(spark, sf_dir):
    """Wrapping a record and reading it back; its NULL field is written as a null."""
    record = F.struct(F.get_json_object("props", "$.k").cast("int").alias("k"),
                      F.lit(None).cast("string").alias("missing"))
    doc = P.document_text(P.envelope(record, F.col("ts"), F.lit(DATA_ROOT)), pretty=True)
    value = F.parse_json("doc")
    get = lambda p, t: F.variant_get(value, p, t)
    kind = F.when(F.is_variant_null(get("$.data.missing", "variant")), "NULL").otherwise("MISSING")
    return table(spark, sf_dir, "events").select("event_id", doc.alias("doc")).select(
        "event_id", get("$.metadata.retrieved_at", "string").alias("retrieved_at"),
        get("$.metadata.source_url", "string").alias("source_url"),
        get("$.data.k", "int").alias("k"), kind.alias("missing_kind"),
    )


@query("key_part", """
    SELECT p_partkey, replace(p_name, ' ', '-') AS name_part,
           coalesce(replace(nullif(p_type, 'PROMO'), ' ', '-'), 'P2') AS type_part
    FROM part
""")
def key_part(spark, sf_dir):
    kind = F.nullif("p_type", F.lit("PROMO"))
    return table(spark, sf_dir, "part").select(
        "p_partkey", T.key_part(F.col("p_name"), "P1").alias("name_part"),
        T.key_part(kind, "P2").alias("type_part"),
    )


# SQL text and views ------------------------------------------------------------------------


@query("table_row_count", "SELECT count(*) AS n_rows FROM lineitem")
def table_row_count(spark, sf_dir):
    return S.row_count(table(spark, sf_dir, "lineitem"))


@query("sql_template", """
    SELECT o_orderstatus AS status, count(*) AS n FROM orders
    WHERE o_orderdate >= TIMESTAMP '1998-01-01' GROUP BY 1
""")
def sql_template(spark, sf_dir):
    Q.register_views(orders_source=table(spark, sf_dir, "orders"))
    return Q.run_sql(
        spark,
        "SELECT o_orderstatus AS status, count(*) AS n FROM IDENTIFIER(:source) "
        "WHERE o_orderdate >= :since GROUP BY ALL",
        source="orders_source", since="1998-01-01",
    )


@query("view_on_view", """
    SELECT event_type, count(*) AS n FROM events
    WHERE ts >= (SELECT max(date_trunc('day', ts)) FROM events) GROUP BY 1
""")
def view_on_view(spark, sf_dir):
    Q.register_views(staged_events=events_by_day(spark, sf_dir))
    newest = Q.run_sql(
        spark, "SELECT * FROM staged_events WHERE day = (SELECT max(day) FROM staged_events)"
    )
    Q.register_views(newest_events=newest)
    return Q.run_sql(spark, "SELECT event_type, count(*) AS n FROM newest_events GROUP BY event_type")


@query("schema_inference", """
    SELECT replace(replace(replace(json_group_structure(props::JSON)::VARCHAR,
           '{"', 'OBJECT<'), '":"', ': '), 'UBIGINT"}', 'BIGINT>') AS json_schema
    FROM events
""")
def schema_inference(spark, sf_dir):
    return D.inferred_schema(table(spark, sf_dir, "events"), F.col("props"))


@query("run_summary", """
    SELECT count(*) AS units, sum(n)::BIGINT AS matches
    FROM (SELECT user_id, count(*) AS n FROM events GROUP BY 1, year(ts))
""")
def run_summary(spark, sf_dir):
    rows = flatten(event_raw(spark, sf_dir), EVENT_FIELDS)
    year = F.year(day_of("meta_file_modified"))
    return S.run_summary(rows.withColumn("year", year), ["user_id", "year"])
