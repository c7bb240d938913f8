"""Record extraction from pages, and the whole cycle from pages to new results."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import extract as E
from tidemark.plans import history as H
from tidemark.plans.cycle import run_cycle
from tidemark.session import shared_dir
from tidemark.sources import landing as L
from workload.calendar import CALENDAR_SQL, calendar_rows
from workload.registry import ROOT, query, table
from workload.results import match_rows


@query("html_records", """
    WITH p AS (
        SELECT page_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title,
               regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1) AS heading,
               regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1), '(?s)<a href="[^"]*">.*?</a>') AS links
        FROM pages),
    l AS (SELECT page_id, title, heading, generate_subscripts(links, 1) - 1 AS position, unnest(links) AS link FROM p),
    decoded AS (
        SELECT page_id, position::INT AS position, [
            regexp_replace(replace(replace(replace(x, '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&amp;?', '&', 'g')
            for x in [title, heading, regexp_extract(link, 'href="([^"]*)"', 1),
                      regexp_extract(link, '(?s)>(.*?)</a>', 1)]] AS v
        FROM l)
    SELECT page_id, position, v[1] AS title, v[2] AS heading, v[3] AS href, v[4] AS text FROM decoded
""")
def html_records(spark, sf_dir):
    return E.page_links(table(spark, sf_dir, "pages").select("page_id", "html"))


# Pages with known contents are written from the tables, then read again.


def _join(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _pages(rows: DataFrame, keys: list[str], record_id: list[str], block: Column, wrap: tuple[str, str]) -> DataFrame:
    """One page per key, in parts where there are many blocks.

    Reading a page takes far longer than its size suggests. A fixed number of partitions keeps
    small pages from being merged into a few long tasks.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    block = block.alias("b")
    listed = L.collect_records(rows, keys, record_id, [block], "blocks", limit=100, partitions=n)
    html = F.concat(F.lit(wrap[0]), F.array_join("blocks.b", "\n"), F.lit(wrap[1]))
    return listed.select(*keys, "part", html.alias("html"))


def event_block(
    badge: Column, name: Column, profile: Column, venue: Column, dates: Column,
    singles: Column, doubles: Column, results: Column,
) -> Column:
    """One tournament of a calendar page; a NULL argument leaves its element out."""
    optional = lambda *parts: F.coalesce(_join(*parts), F.lit(""))
    winners = F.coalesce(
        _join("<dl class='winner'><dt>Doubles Winners</dt>", F.array_join(F.transform(
            doubles, lambda d: F.concat(F.lit("<dd><a href='#'> "), d, F.lit(" </a></dd>"))), ""), "</dl>"),
        F.lit(""),
    )
    return F.concat(
        F.lit('<ul class="events"><li><div class="tournament-info">'),
        optional('<img class="events_banner" alt=" ', badge, ' " src="x.png">'),
        _join('<a class="tournament__profile other" href="', profile, '"><span class="name"> ', name, "</span>"),
        optional('<span class="venue">', venue, " | </span>"),
        optional('<span class="Date">', dates, "</span>"),
        F.lit('</a></div><div class="cta-holder">'),
        optional("<dl class='winner'><dt>Singles Winner</dt><dd><a>", singles, "</a></dd></dl>"),
        winners,
        F.lit('</div><div class="non-live-cta">'),
        optional('<a class="results" href="', results, '">Results</a>'),
        F.lit("</div></li></ul>"),
    )


CALENDAR_PAGE = ("<!DOCTYPE html><html><body><p>Calendar<br><main>", "</main></body></html>")


@query("calendar_pages", """
    SELECT c_nationkey AS page_id, 2000 + c_nationkey AS "year", c_name AS tournament, c_custkey::VARCHAR AS tournament_id,
           CASE WHEN c_acctbal < 0 THEN 'Other' ELSE c_mktsegment END AS category,
           c_mktsegment AS city, CASE WHEN c_nationkey < 12 THEN 'Unknown' ELSE 'R&D, ' || c_nationkey END AS country,
           CASE WHEN c_nationkey < 5 THEN '' ELSE 'week ' || c_nationkey END AS dates,
           CASE WHEN c_acctbal > 2000 THEN 'S' || c_custkey END AS singles_winner,
           CASE WHEN c_acctbal > 4000 THEN 'D' || c_custkey || ', E' || c_custkey END AS doubles_winner,
           CASE WHEN c_acctbal > 1000 THEN 'https://www.example.org/en/scores/archive/' || c_custkey || '/results' END AS url
    FROM customer
""")
def calendar_pages(spark, sf_dir):
    """A calendar page per nation with a block per customer, among them one that cannot be read."""
    nation, balance, key = F.col("c_nationkey"), F.col("c_acctbal"), F.col("c_custkey")
    block = F.concat(
        F.when(nation == 3, F.lit('<ul class="events"><li><div class="other"></div></li></ul>')).otherwise(""),
        event_block(
            badge=F.when(balance >= 0, F.col("c_mktsegment")),
            name=F.col("c_name"),
            profile=_join("/en/tournaments/", F.replace("c_name", F.lit("#"), F.lit("-")), "/", key, "/overview"),
            venue=F.concat("c_mktsegment", F.when(nation < 12, "").otherwise(_join(" , R&amp;D, ", nation))),
            dates=F.when(nation >= 5, _join(" week ", nation, "\n")),
            singles=F.when(balance > 2000, _join("S", key)),
            doubles=F.when(balance > 4000, F.array(_join("D", key), _join("E", key))),
            results=F.when(balance > 1000, _join("/en/scores/archive/", key, "/results")),
        ),
    )
    pages = _pages(table(spark, sf_dir, "customer"), ["c_nationkey"], ["c_custkey"], block, CALENDAR_PAGE)
    found = E.calendar_records(
        pages.select(nation.alias("page_id"), (nation + 2000).alias("year"), "html"), ROOT
    )
    return found.withColumn("doubles_winner", F.array_join("doubles_winner", ", ")).drop("position")


def player_block(name: Column, ident: Column, seed: Column) -> Column:
    return F.concat(
        _join('<div class="name"><a href="/en/players/', F.lower(name), "/", ident, '/overview">\n ', name, " </a>"),
        F.coalesce(_join("<span>(", seed, ")</span>"), F.lit("")),
        F.lit("</div>"),
    )


def score_block(*sets: Column) -> Column:
    """``sets`` are arrays of the texts of each set."""
    items = [
        F.concat(
            F.lit('<div class="score-item">'),
            F.array_join(F.transform(s, lambda x: F.concat(F.lit("<span>"), x, F.lit("</span>"))), ""),
            F.lit("</div>"),
        )
        for s in sets
    ]
    return F.concat(F.lit('<div class="scores">'), *items, F.lit("</div>"))


def match_block(heading: Column, players: Column, flags: Column, scores: Column, stats: Column) -> Column:
    link = F.coalesce(_join('<a href="', stats, '">Match Stats</a>'), F.lit(""))
    return F.concat(
        _join('<div class="match"><strong>', heading, "</strong>"), players, flags, scores,
        F.lit('<div class="match-cta"><a href="/h2h">H2H</a>'), link, F.lit("</div></div>"),
    )


def flag_block(code: Column) -> Column:
    return _join('<svg><use href="/assets/flags.svg#flag-', code, '"></use></svg>')


RESULTS_PAGE = ('<html><body><div class="atp_accordion-item open">', "</div></body></html>")


@query("results_pages", """
    WITH o AS (SELECT *, o_orderpriority IN ('1-URGENT', '5-LOW') AS doubles, year(o_orderdate) AS y,
                      lower(left(o_orderstatus, 1)) AS f FROM orders)
    SELECT y AS page_id, y AS "year", 'T' || y AS tournament_name, y::VARCHAR AS tournament_id,
           CASE WHEN doubles THEN 'Semifinals' ELSE 'Round Of 16' END AS round,
           CASE WHEN doubles THEN 'A' || o_custkey || ', B' || o_custkey ELSE 'A' || o_custkey END AS player1_name,
           CASE WHEN doubles THEN 'a' || o_orderkey || ', b' || o_orderkey ELSE 'a' || o_orderkey END AS player1_id,
           CASE WHEN doubles THEN '' WHEN o_orderstatus = 'F' THEN '3' ELSE '' END AS player1_seed,
           CASE WHEN doubles THEN f || ', ' || f ELSE f END AS player1_nation,
           CASE WHEN doubles THEN 'C' || o_custkey || ', D' || o_custkey ELSE 'B' || o_custkey END AS player2_name,
           CASE WHEN doubles THEN 'c' || o_orderkey || ', d' || o_orderkey ELSE 'b' || o_orderkey END AS player2_id,
           '' AS player2_seed, CASE WHEN doubles THEN f || ', ' || f ELSE f END AS player2_nation,
           CASE WHEN o_custkey % 3 = 0 THEN '64 76(' || (o_orderkey % 7) || ')' ELSE '64 63' END AS score,
           CASE WHEN o_orderstatus = 'P' THEN '' ELSE 'https://www.example.org/en/stats/' || y || '/ms' || o_orderkey END AS url,
           CASE WHEN o_orderstatus = 'P' THEN '' ELSE 'ms' || o_orderkey END AS match_id
    FROM o
""")
def results_pages(spark, sf_dir):
    """A results page per year with a match per order: singles and doubles, with and without seeds."""
    cust, key, status = F.col("o_custkey"), F.col("o_orderkey"), F.col("o_orderstatus")
    doubles = F.col("o_orderpriority").isin("1-URGENT", "5-LOW")
    none = F.lit(None).cast("string")
    player = lambda tag, seed=none: player_block(
        _join(tag, cust), _join(tag.lower(), key), seed
    )
    lead_seed = F.when((status == "F") & ~doubles, "3")
    lead_name = F.concat(player("A", lead_seed), player("B"))
    players = F.when(doubles, F.concat(lead_name, player("C"), player("D"))).otherwise(lead_name)
    flag = flag_block(F.lower(F.left(status, F.lit(1))))
    flags = F.when(doubles, F.concat(flag, flag, flag, flag)).otherwise(F.concat(flag, flag))
    one = lambda text: F.array(F.lit(text))
    tie = cust % 3 == 0
    scores = F.concat(
        score_block(one("6"), F.when(tie, F.array(F.lit("7"))).otherwise(one("6"))),
        score_block(one("4"), F.when(tie, F.array(F.lit("6"), (key % 7).cast("string"))).otherwise(one("3"))),
    )
    year = F.year("o_orderdate")
    block = match_block(
        heading=F.when(doubles, "Semi-Finals - Day 6").otherwise("Round of 16 - "),
        players=players, flags=flags, scores=scores,
        stats=F.when(status != "P", _join("/en/stats/", year, "/ms", key)),
    )
    orders = table(spark, sf_dir, "orders").withColumn("y", year)
    pages = _pages(orders, ["y"], ["o_orderkey"], block, RESULTS_PAGE)
    y = F.col("y").cast("bigint")
    found = E.match_records(pages.select(
        y.alias("page_id"), y.alias("year"), _join("T", y).alias("tournament_name"),
        _join(y).alias("tournament_id"), "html",
    ), ROOT)
    return found.drop("position")


# The whole cycle ---------------------------------------------------------------------------


def day_calendar_pages(spark, sf_dir) -> DataFrame:
    """The calendar of each day as pages. Their addresses are relative."""
    rows = calendar_rows(spark, sf_dir)
    path = F.regexp_replace("url", f"^{ROOT}", "")
    doubles = F.col("doubles_winner")
    block = event_block(
        badge=F.col("category"), name=F.col("tournament"),
        profile=_join("/en/tournaments/user/", F.col("tournament_id"), "/overview"),
        venue=F.col("city"), dates=F.col("dates"), singles=F.col("singles_winner"),
        doubles=doubles, results=path,
    )
    pages = _pages(rows, ["day"], ["user_id"], block, CALENDAR_PAGE)
    return pages.select(
        _join("calendar ", F.col("day"), "/", F.col("part")).alias("page_id"),
        F.year("day").alias("year"), F.col("day").alias("retrieved_at"), "html",
    )


def user_results_pages(spark, sf_dir) -> DataFrame:
    """For each day and user a page with the user's events of that day as matches."""
    rows = match_rows(spark, sf_dir)
    none = F.lit(None).cast("string")
    block = match_block(
        heading=F.col("round"),
        players=F.concat(
            player_block(F.col("player1_name"), F.col("player1_id"), none),
            player_block(F.col("player2_name"), F.col("player2_id"), F.col("player2_seed")),
        ),
        flags=F.concat(flag_block(F.lit("esp")), flag_block(F.lit("fra"))),
        scores=F.concat(score_block(F.array("score")), score_block(F.array(F.lit("/")))),
        stats=_join("/en/stats/", F.col("match_id")),
    )
    pages = _pages(rows, ["day", "tournament_id"], ["event_id"], block, RESULTS_PAGE)
    seen = calendar_rows(spark, sf_dir).select("day", "tournament_id", "url").filter("url IS NOT NULL")
    address = F.concat(
        F.when(F.col("url").startswith("http"), "").otherwise(ROOT), "url", F.lit("?matchType=singles")
    )
    return pages.join(seen, ["day", "tournament_id"]).select(
        _join("results ", F.col("day"), "/", F.col("tournament_id"), "/", F.col("part")).alias("page_id"),
        address.alias("url"), F.col("day").alias("retrieved_at"), "html",
    )


CYCLE_SQL = f"""
    {CALENDAR_SQL},
    fetched AS (
        SELECT c.tournament_id, c.tournament, c."year" AS target_year, p.day AS meta_file_modified
        FROM changes c JOIN (SELECT day, meta.tournament_id, meta.url FROM seen
            JOIN cal meta ON meta.tournament_id = seen.user_id::VARCHAR AND meta.meta_file_modified = seen.day) p
        ON p.tournament_id = c.tournament_id
           AND regexp_replace(p.url, '^https://[^/]*', '') = regexp_replace(c.url, '^https://[^/]*', '')),
    matches AS (
        SELECT f.target_year AS "year", f.tournament AS tournament_name, f.tournament_id,
               'Round ' || day(e.ts) AS round, e.event_type AS match_id, 'A' || e.user_id AS player1_name,
               'a' || e.user_id AS player1_id, 'B' || e.event_type AS player2_name, 'b' || e.event_type AS player2_id,
               lpad(e.event_id::VARCHAR, 12, '0') || '/' AS score,
               'https://www.example.org/en/stats/' || e.event_type AS url, f.meta_file_modified
        FROM events e JOIN fetched f
        ON f.tournament_id = e.user_id::VARCHAR AND f.meta_file_modified = date_trunc('day', e.ts)),
    latest AS (
        SELECT * FROM matches
        QUALIFY row_number() OVER (PARTITION BY "year", tournament_id, match_id
                                   ORDER BY meta_file_modified DESC, score DESC) = 1)
"""


def _cycle(spark, sf_dir):
    return run_cycle(day_calendar_pages(spark, sf_dir), user_results_pages(spark, sf_dir), ROOT)


@query("cycle_results", f"WITH {CYCLE_SQL} SELECT * FROM latest")
def cycle_results(spark, sf_dir):
    return _cycle(spark, sf_dir).results.drop(
        "meta_file_name", "player1_seed", "player1_nation", "player2_seed", "player2_nation"
    )


@query("cycle_new_results", f"""
    WITH {CYCLE_SQL},
    ranked AS (SELECT *, dense_rank() OVER (PARTITION BY tournament_id ORDER BY meta_file_modified DESC) AS r FROM latest)
    SELECT cur.* EXCLUDE (r) FROM (SELECT * FROM ranked WHERE r = 1) cur
    LEFT JOIN (SELECT DISTINCT tournament_id, match_id FROM ranked WHERE r = 2) prev
        ON cur.tournament_id = prev.tournament_id AND cur.match_id = prev.match_id
    WHERE prev.match_id IS NULL
""")
def cycle_new_results(spark, sf_dir):
    return _cycle(spark, sf_dir).new_results.drop("meta_file_name")


@query("cycle_summary", f"""
    WITH {CYCLE_SQL}
    SELECT count(*) AS units, coalesce(sum(n), 0)::BIGINT AS matches
    FROM (SELECT count(*) AS n FROM latest GROUP BY "year", tournament_id)
""")
def cycle_summary(spark, sf_dir):
    return _cycle(spark, sf_dir).summary


# Two runs over halves of the month, the second on top of the first.


FIRST_HALF_SQL = CYCLE_SQL.replace("FROM events", "FROM (SELECT * FROM events WHERE day(ts) <= 15)")
HISTORY_SQL = f"""
    found AS (
        SELECT 0 AS run, * FROM (WITH {FIRST_HALF_SQL} SELECT * FROM matches)
        UNION ALL SELECT 1, * FROM (WITH {CYCLE_SQL} SELECT * FROM matches) WHERE day(meta_file_modified) > 15),
    latest AS (
        SELECT * EXCLUDE (run) FROM found
        QUALIFY row_number() OVER (PARTITION BY "year", tournament_id, match_id
                                   ORDER BY meta_file_modified DESC, score DESC) = 1)
"""


def history(spark, sf_dir) -> H.History:
    """The history after two runs. The second fails at the results pages at first and is run again."""
    home = shared_dir(spark, "history")
    calendars = L.stored(day_calendar_pages(spark, sf_dir), "calendar-pages")
    pages = L.stored(user_results_pages(spark, sf_dir), "results-pages")
    early = F.dayofmonth("retrieved_at") <= 15
    H.run_cycle(spark, home, 0, calendars.filter(early), pages.filter(early), ROOT)
    broken = pages.withColumn("html", F.raise_error(F.lit("no connection")).cast("string"))
    try:
        H.run_cycle(spark, home, 1, calendars.filter(~early), broken, ROOT)
    except PySparkException:
        pass
    else:
        raise AssertionError("the run did not fail")
    return H.run_cycle(spark, home, 1, calendars.filter(~early), pages.filter(~early), ROOT)


@query("history_results", f"WITH {HISTORY_SQL} SELECT * FROM latest")
def history_results(spark, sf_dir):
    return history(spark, sf_dir).results.drop(
        "meta_file_name", "player1_seed", "player1_nation", "player2_seed", "player2_nation"
    )


@query("history_documents", f"""
    WITH {HISTORY_SQL}
    SELECT 'results' AS kind, run::INT AS run, meta_file_modified, count(*) AS n_records FROM found GROUP BY ALL
    UNION ALL SELECT 'calendar', (day(ts) > 15)::INT, date_trunc('day', ts)::TIMESTAMP, count(DISTINCT user_id) FROM events GROUP BY ALL
""")
def history_documents(spark, sf_dir):
    """Records by run and version over the raw documents of both runs: nothing is lost or landed twice."""
    found = H.documents_of(history(spark, sf_dir))
    return found.groupBy("kind", "run", "meta_file_modified").agg(F.sum("n_records").cast("bigint").alias("n_records"))
