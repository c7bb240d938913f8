"""Cleaning of texts, addresses, scores and payloads."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import payload as P
from tidemark.functions import scores as S
from tidemark.functions import text as T
from tidemark.functions import urls as U
from tidemark.functions.binding import let
from tidemark.operators import extract as E
from tidemark.plans import payloads as M
from workload.registry import DATA_ROOT, ROOT, query, table

LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
LINE_SQL = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


# Addresses ---------------------------------------------------------------------------------


@query("url_segment", """
    SELECT regexp_extract(url, '^https?://[^/]+/([^/]*)', 1) AS segment, count(*) AS n
    FROM pages GROUP BY 1
""")
def url_segment(spark, sf_dir):
    segment = U.path_segment(F.col("url"), 2)
    return table(spark, sf_dir, "pages").groupBy(segment.alias("segment")).agg(F.count("*").alias("n"))


@query("id_from_url", """
    SELECT page_id, CASE WHEN len(p) > 2 THEN p[-2] END AS profile_id, p2[-2] AS player_id
    FROM (SELECT page_id, split(trim(url, '/'), '/') AS p, split(url, '/') AS p2 FROM pages)
""")
def id_from_url(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id", U.profile_id(url).alias("profile_id"), U.player_id(url).alias("player_id")
    )


@query("match_id_from_url", """
    SELECT page_id, split(url, '/')[-1] AS match_id, upper(split(url, '/')[-1]) AS match_id_upper FROM pages
""")
def match_id_from_url(spark, sf_dir):
    match_id = U.last_segment(F.col("url"))
    return table(spark, sf_dir, "pages").select(
        "page_id", match_id.alias("match_id"), F.upper(match_id).alias("match_id_upper")
    )


@query("url_absolute", """
    SELECT page_id, CASE WHEN url LIKE 'https%' THEN 'https://www.example.org' || regexp_replace(url, '^https?://[^/]*', '')
           ELSE url END AS url
    FROM pages
""")
def url_absolute(spark, sf_dir):
    """Addresses of secure pages made relative, then absolute again below another root."""
    url = F.col("url")
    relative = F.when(url.startswith("https"), F.regexp_replace(url, "^https?://[^/]*", "")).otherwise(url)
    return table(spark, sf_dir, "pages").select("page_id", U.absolute_url(relative, ROOT).alias("url"))


@query("url_param_default", """
    SELECT page_id, CASE WHEN contains(url, '/de/') THEN url || '?matchType=doubles'
           ELSE url || '?matchType=singles' END AS url
    FROM pages
""")
def url_param_default(spark, sf_dir):
    url = F.col("url")
    asked = F.when(url.contains("/de/"), F.concat(url, F.lit("?matchType=doubles"))).otherwise(url)
    return table(spark, sf_dir, "pages").select("page_id", U.with_match_type(asked).alias("url"))


@query("endpoint_urls", """
    SELECT p_partkey,
      CASE p_type
        WHEN 'ECONOMY' THEN 'https://www.example.org/-/Hawkeye/MatchStats/Complete/' || p_size || '/' || p_brand || '/MS' || p_partkey
        WHEN 'MEDIUM' THEN 'https://data.example.org/stats/' || p_size || '/' || p_brand || '/MS' || p_partkey || '/keystats.json'
        WHEN 'LARGE' THEN 'https://data.example.org/stats/' || p_size || '/' || p_brand || '/MS' || p_partkey || '/rally-analysis.json'
        WHEN 'SMALL' THEN 'https://data.example.org/stats/' || p_size || '/' || p_brand || '/MS' || p_partkey || '/stroke-analysis.json'
        WHEN 'STANDARD' THEN 'https://data.example.org/stats/' || p_size || '/' || p_brand || '/MS' || p_partkey || '/courtvision.json'
      END AS url
    FROM part
""")
def endpoint_urls(spark, sf_dir):
    """One kind of data per part type; the sixth type names an unknown kind."""
    kinds = {"ECONOMY": "match-info", "MEDIUM": "key-stats", "LARGE": "rally-analysis",
             "SMALL": "stroke-analysis", "STANDARD": "court-vision"}
    kind = F.lit("something-else")
    for name, value in kinds.items():
        kind = F.when(F.col("p_type") == name, value).otherwise(kind)
    url = U.match_data_url(
        kind, F.col("p_size"), F.col("p_brand"), F.concat(F.lit("ms"), F.col("p_partkey")),
        ROOT, DATA_ROOT, strict=False,
    )
    return table(spark, sf_dir, "part").select("p_partkey", url.alias("url"))


# Texts -------------------------------------------------------------------------------------


@query("venue_split", """
    SELECT p_partkey, CASE WHEN p_size <= 10 THEN '' ELSE p_name END AS city,
           CASE WHEN p_size <= 20 THEN 'Unknown' WHEN p_size <= 35 THEN p_brand
                ELSE p_brand || ', ' || p_type END AS country
    FROM part
""")
def venue_split(spark, sf_dir):
    """Venues without a text, with none, one or two commas, each with a bar behind."""
    size = F.col("p_size")
    place = F.concat_ws(
        ", ", "p_name", F.when(size > 20, F.col("p_brand")), F.when(size > 35, F.col("p_type"))
    )
    venue = F.when(size > 10, F.concat(F.lit("\n "), place, F.lit(" | ")))
    return table(spark, sf_dir, "part").select(
        "p_partkey", T.venue_city(venue).alias("city"), T.venue_country(venue).alias("country")
    )


@query("seed_strip", f"""
    SELECT {LINE_SQL}, CASE WHEN l_linenumber <= 4 THEN l_linenumber::VARCHAR ELSE '' END AS seed FROM lineitem
""")
def seed_strip(spark, sf_dir):
    seed = F.when(F.col("l_linenumber") <= 4, F.concat(F.lit("("), F.col("l_linenumber"), F.lit(")")))
    return table(spark, sf_dir, "lineitem").select(*LINE, T.seed_strip(seed).alias("seed"))


@query("nation_code", """
    SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN '-' ELSE lower(n_name) END AS nation
    FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def nation_code(spark, sf_dir):
    flag = F.when(F.col("c_acctbal") < 0, "/assets/flags.svg").otherwise(
        F.concat(F.lit("/assets/flags.svg#flag-"), F.lower("n_name"))
    )
    nation = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    joined = table(spark, sf_dir, "customer").join(nation, "c_nationkey")
    return joined.select("c_custkey", T.nation_code(flag).alias("nation"))


@query("round_title", f"""
    SELECT {LINE_SQL},
           CASE l_linenumber WHEN 1 THEN '1st Round Qualifying' WHEN 2 THEN 'Round Of 16'
                WHEN 3 THEN 'Quarterfinals' WHEN 4 THEN 'Semifinals' WHEN 5 THEN 'Final'
                WHEN 6 THEN 'Unknown Round' ELSE 'Round Robin' END AS round,
           CASE l_linenumber WHEN 1 THEN 'Q1' WHEN 2 THEN 'R16' WHEN 3 THEN 'QF' WHEN 4 THEN 'SF'
                WHEN 5 THEN 'F' WHEN 6 THEN 'UR' ELSE 'RR' END AS round_short
    FROM lineitem
""")
def round_title(spark, sf_dir):
    headings = ["1st  round qualifying - Day 2", "Round of 16 - Court", "Quarter-Finals - 01:22",
                "semi-finals", "FINAL", None, "Round\nRobin - Group"]
    heading = F.element_at(F.array(*[F.lit(h) for h in headings]), F.col("l_linenumber"))
    rows = table(spark, sf_dir, "lineitem").select(*LINE, T.round_title(heading).alias("round"))
    return rows.withColumn("round_short", T.round_short(F.col("round")))


@query("doubles_merge", """
    SELECT o_orderkey, 'C' || o_custkey || ', ' || o_orderpriority AS pair,
           CASE WHEN o_orderstatus <> 'P' THEN 'C' || o_custkey || ', ' || o_orderstatus END AS with_gap
    FROM orders
""")
def doubles_merge(spark, sf_dir):
    lead = F.concat(F.lit("C"), F.col("o_custkey"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", T.pair_text(lead, F.col("o_orderpriority")).alias("pair"),
        T.pair_text(lead, F.nullif("o_orderstatus", F.lit("P"))).alias("with_gap"),
    )


@query("winner_class", """
    SELECT c_custkey,
           CASE WHEN c_nationkey < 5 THEN NULL WHEN c_nationkey < 15 THEN c_name
                ELSE c_mktsegment END AS singles,
           CASE WHEN c_nationkey < 10 THEN NULL WHEN c_acctbal < 0 THEN 'D' || c_custkey
                ELSE 'D' || c_custkey || ', ' || c_mktsegment END AS doubles
    FROM customer
""")
def winner_class(spark, sf_dir):
    """No list, one list and up to three; a later team list replaces the singles winner."""
    nation = F.col("c_nationkey")
    name = lambda link, text: F.struct(
        link.cast("string").alias("link"), text.cast("string").alias("text")
    )
    listed = lambda label, *names: F.struct(
        F.lit(label).alias("label"), F.array(*names).alias("names")
    )
    none = F.lit(None)
    singles = listed("Singles Winner", name(F.col("c_name"), F.lit("ignored")))
    second = F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).otherwise(" ")
    doubles = listed(
        "Doubles Winners", name(F.concat(F.lit(" D"), F.col("c_custkey")), F.lit("")), name(none, second)
    )
    team = listed("TEAM winner", name(none, F.concat(F.col("c_mktsegment"), F.lit(" "))))
    winners = F.array_compact(F.array(
        F.when(nation >= 5, singles), F.when(nation >= 10, doubles), F.when(nation >= 15, team)
    ))
    return table(spark, sf_dir, "customer").select(
        "c_custkey", T.singles_winner(winners).alias("singles"),
        F.array_join(T.doubles_winners(winners), ", ").alias("doubles"),
    )


# Scores ------------------------------------------------------------------------------------


@query("set_scores", f"""
    WITH s AS (SELECT {LINE_SQL}, l_quantity::INT AS q, l_linenumber AS n FROM lineitem)
    SELECT {LINE_SQL}, CASE WHEN n = 7 THEN '' ELSE
        CASE WHEN q % 2 = 1 THEN '76(' || n || ')' ELSE '64' END || ' ' || n
        || CASE WHEN q % 3 = 0 THEN '7(' || q || ')' ELSE '5' END END AS score
    FROM s
""")
def set_scores(spark, sf_dir):
    """The first player has three sets and the second two, with an empty one between them."""
    q, n = F.col("l_quantity").cast("int"), F.col("l_linenumber")
    text = lambda c: c.cast("string")
    with_points = lambda games, points, when, plain: F.when(
        when, F.array(F.lit(games), text(points))
    ).otherwise(F.array(F.lit(plain)))
    first = F.array(
        F.array(F.when(q % 2 == 1, "7").otherwise("6")), F.array(text(n)), F.array(text(q))
    )
    second = F.array(
        with_points("6", n, q % 2 == 1, "4"), F.array().cast("array<string>"),
        with_points("7", q, q % 3 == 0, "5"),
    )
    blocks = F.when(n == 7, F.array(first)).otherwise(F.array(first, second))
    return table(spark, sf_dir, "lineitem").select(*LINE, S.match_score(blocks).alias("score"))


@query("brackets_last", """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN o_custkey || '7(' || o_orderkey || ')'
        WHEN 'O' THEN o_custkey || '(' || o_orderkey || ')(7)' ELSE o_custkey || '7' END AS score
    FROM orders
""")
def brackets_last(spark, sf_dir):
    key, cust, status = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")
    score = (
        F.when(status == "F", F.concat(cust, F.lit("("), key, F.lit(")7")))
        .when(status == "O", F.concat(cust, F.lit("("), key, F.lit(")(7)")))
        .otherwise(F.concat(cust, F.lit("7")))
    )
    expected = F.when(status == "O", F.concat(cust, F.lit("(7)("), key, F.lit(")")))
    moved = S.brackets_last(F.coalesce(expected, score))
    return table(spark, sf_dir, "orders").select("o_orderkey", moved.alias("score"))


# Payloads ----------------------------------------------------------------------------------

KEY_SQL = """
    SELECT event_id, (epoch_us(ts) // 1000) AS t,
      '#' || left(rpad(lower(to_base(('0x' || (epoch_us(ts) // 1000))::BIGINT, 36)) || lower(to_base(
          (year(ts) + reverse(year(ts)::VARCHAR)::BIGINT)
          * (day(ts) + reverse(lpad(day(ts)::VARCHAR, 2, '0'))::BIGINT), 24)), 14, '0'), 14) || '$' AS payload_key
    FROM events
"""


def event_payloads(spark, sf_dir):
    """Events' properties, encrypted as a source would send them."""
    millis = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000).cast("bigint")
    utc = F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col("ts"))
    rows = table(spark, sf_dir, "events").withColumn("ts", utc).select(
        "event_id", "event_type", "props", millis.alias("lastModified")
    )
    message = let(P.payload_key(F.col("lastModified")), lambda key: F.aes_encrypt(
        F.encode("props", "UTF-8"), F.encode(key, "UTF-8"), F.lit("CBC"), F.lit("PKCS"),
        F.encode(F.upper(key), "UTF-8"),
    ))
    # The cipher puts its first vector in front; the source does not send it.
    response = F.base64(F.substring(message, 17, 2147483647))
    return rows.select("event_id", "event_type", "lastModified", response.alias("response"))


@query("payload_key", KEY_SQL)
def payload_key(spark, sf_dir):
    return event_payloads(spark, sf_dir).select(
        "event_id", F.col("lastModified").alias("t"),
        P.payload_key(F.col("lastModified")).alias("payload_key"),
    )


@query("payload_decrypt", "SELECT event_id, props AS data, json_extract(props, '$.k')::INT AS k FROM events")
def payload_decrypt(spark, sf_dir):
    return E.readable_payloads(event_payloads(spark, sf_dir)).select(
        "event_id", "data", F.variant_get(F.parse_json("data"), "$.k", "int").alias("k")
    )


@query("payload_quarantine", "SELECT event_id FROM events WHERE event_type = 'error'")
def payload_quarantine(spark, sf_dir):
    """Payloads of error events arrive cut short; only those are set aside."""
    cut = F.when(F.col("event_type") == "error", F.base64(F.encode(F.lit("broken"), "UTF-8")))
    received = event_payloads(spark, sf_dir).withColumn("response", F.coalesce(cut, "response"))
    return E.unreadable_payloads(received).select("event_id")


@query("payload_chain", """
    WITH p AS (
        SELECT *, year(ts) AS y, 'MS' || event_id AS m, strftime(ts, '%Y%m%d_%H%M%S') AS t,
               ['match-info', 'key-stats', 'rally-analysis', 'stroke-analysis', 'court-vision'][event_id % 5 + 1] AS data_type,
               ['keystats', 'rally-analysis', 'stroke-analysis', 'courtvision'][event_id % 5] AS file
        FROM events)
    SELECT event_id, data_type,
        CASE WHEN data_type = 'match-info'
             THEN 'https://www.example.org/-/Hawkeye/MatchStats/Complete/' || y || '/' || user_id || '/' || m
             ELSE 'https://data.example.org/stats/' || y || '/' || user_id || '/' || m || '/' || file || '.json' END AS url,
        CASE WHEN event_type <> 'error' THEN 'raw/match-stats/year=' || y || '/tourn=' || user_id || '/F_User-' || user_id
             || '_P2_' || m || '_' || data_type || '_' || t || '.json' END AS key,
        CASE WHEN event_type <> 'error' THEN json_extract(props, '$.k')::INT END AS k,
        CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') END AS scraped_at
    FROM p
""")
def payload_chain(spark, sf_dir):
    """All five kinds, from address to document and manifest. Those of error events arrive cut short and are set aside."""
    events = table(spark, sf_dir, "events").withColumnRenamed("props", "plain")
    kinds = F.array(*[F.lit(k) for k in M.fixed.MATCH_DATA_URLS])
    received = event_payloads(spark, sf_dir).drop("event_type").join(events, "event_id").select(
        "event_id", F.col("ts").alias("retrieved_at"), F.year("ts").alias("year"), F.col("user_id").alias("tournament_id"),
        F.concat(F.lit("ms"), "event_id").alias("match_id"), F.lit("Final").alias("round"),
        F.concat(F.lit("User "), "user_id").alias("player1_name"), F.lit(None).cast("string").alias("player2_name"),
        F.get(kinds, (F.col("event_id") % 5).cast("int")).alias("data_type"), "lastModified",
        F.when(F.col("event_type") == "error", F.lit("{ broken"))
        .when(F.col("event_id") % 5 == 0, F.col("plain")).otherwise(F.col("response")).alias("response"),
    )
    asked = M.addresses(received.select("event_id", "year", "tournament_id", "match_id"), ROOT, DATA_ROOT)
    found = M.opened(received.join(asked.select("event_id", "data_type", "url"), ["event_id", "data_type"]))
    documents, listed = M.documents(found), M.manifest(found)
    landed = documents.join(listed, documents["meta_file_name"] == listed["key"]).select(
        F.regexp_extract("match_id", r"(\d+)$", 1).cast("bigint").alias("event_id"), "key", "scraped_at",
        F.get_json_object("data", "$.data.k").cast("int").alias("k"),
    )
    aside = M.set_aside(found).select("event_id", "data_type", "url", *[
        F.lit(None).cast(t).alias(c) for c, t in (("key", "string"), ("k", "int"), ("scraped_at", "string"))
    ])
    whole = M.readable(found).select("event_id", "data_type", "url").join(landed, "event_id")
    return whole.select(*aside.columns).union(aside)
