"""Versions, diffs and checks against plain Python, with NULLs, duplicates and ties."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators import diff as D
from tidemark.operators import quality as Q
from tidemark.operators import versions as V
from tidemark.plans import calendar as C
from tidemark.plans import results as R

DAYS = [f"2024-01-0{d} 00:00:00" for d in range(1, 6)]


def stamped(spark, data, schema):
    df = spark.createDataFrame(data, schema.replace("meta_file_modified", "at"))
    return df.withColumn("meta_file_modified", F.col("at").cast("timestamp_ntz")).drop("at")


def test_latest_per_key_is_idempotent_and_keeps_null_keys(spark, rows):
    data = [("a", 1, DAYS[0]), ("a", 2, DAYS[1]), ("a", 3, DAYS[1]), (None, 4, DAYS[0]), (None, 5, None)]
    df = stamped(spark, data, "k string, n int, meta_file_modified string")
    once = V.latest_per_key(df, ["k"], tiebreak=["n"])
    assert rows(once, "k", "n") == [(None, 4), ("a", 3)]
    assert rows(V.latest_per_key(once, ["k"], tiebreak=["n"])) == rows(once)


def test_late_and_repeated_files_do_not_matter(spark, rows):
    data = [("m", "new", DAYS[3]), ("m", "late", DAYS[0]), ("m", "new", DAYS[3])]
    df = stamped(spark, data, "k string, score string, meta_file_modified string")
    assert rows(V.latest_per_key(df, ["k"], tiebreak=["score"]), "score") == [("new",)]


@pytest.mark.parametrize("by", [[], ["k"]])
def test_version_rank(spark, by):
    rnd = random.Random(3)
    data = [(rnd.choice(["a", "b", None]), f"2024-01-{rnd.randint(1, 4):02d} {rnd.randint(0, 5):02d}:00:00") for _ in range(80)]
    data += [("a", None), (None, None), (None, None)]
    df = stamped(spark, data, "k string, meta_file_modified string")
    got = {tuple(str(v) for v in r) for r in V.version_rank(df, by).collect()}
    expected = set()
    for k, at in data:
        peers = {b for a, b in data if not by or a == k}
        rank = str(sorted(peers, key=lambda v: v or "", reverse=True).index(at) + 1)
        k, at = str(k), str(at)
        expected.add((k, at, rank) if by else (at, rank))
    assert got == expected


def test_snapshot_pair_with_one_version(spark):
    df = stamped(spark, [("a", DAYS[0])], "k string, meta_file_modified string")
    current, previous = V.current_and_previous(df)
    assert (current.count(), previous.count()) == (1, 0)


def test_latest_row_takes_one_file(spark):
    data = [("a", DAYS[1]), ("b", DAYS[1]), ("c", None)]
    df = stamped(spark, data, "meta_file_name string, meta_file_modified string")
    assert [r[0] for r in V.latest_row(df, tiebreak=["meta_file_name"]).collect()] == ["b"]
    assert V.latest_version(df).count() == 2


@pytest.mark.parametrize("values", [[], [1, 2], [1, None], [None]])
def test_not_in(spark, rows, values):
    df = spark.createDataFrame([(1,), (3,), (None,)], "k int")
    other = spark.createDataFrame([(v,) for v in values], "v int")
    df.createOrReplaceTempView("probe_keys")
    other.createOrReplaceTempView("other_keys")
    expected = spark.sql("SELECT k FROM probe_keys WHERE k NOT IN (SELECT v FROM other_keys)")
    assert rows(D.not_in(df, "k", other, "v")) == rows(expected)


def test_repeat_rows_over_several_blocks(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2 * D.REPEAT_BLOCK + 7)], "k string, n bigint")
    got = {r["k"]: r["c"] for r in D.repeat_rows(df, "n").groupBy("k").agg(F.count("*").alias("c")).collect()}
    assert got == {"a": 1, "b": 2 * D.REPEAT_BLOCK + 7}


CAL = "tournament_id string, url string, meta_file_modified string"


def calendars(spark, current, previous):
    frame = lambda data, day: stamped(spark, [(*r, day) for r in data], CAL)
    return frame(current, DAYS[1]), frame(previous, DAYS[0])


CURRENT = [
    ("1", "/en/scores/archive/x/1/results"), ("2", None), ("3", "/en/scores/archive/x/3/results"),
    ("4", "https://h/en/scores/current/x/4/results"), ("5", "/en/scores/current/x/5/results"),
    (None, "/en/scores/current/x/0/results"),
]


def test_calendar_changes(spark, rows):
    previous = [("1", None), ("2", None), ("3", "u"), ("4", "u"), ("5", None), ("6", None)]
    got = rows(C.changes(*calendars(spark, CURRENT, previous)), "tournament_id", "change_type")
    assert got == [("1", "newly_completed"), ("4", "ongoing"), ("5", "newly_completed")]


def test_calendar_changes_keep_a_null_id_if_nothing_completed(spark, rows):
    previous = [("3", "u"), (None, None)]
    got = rows(C.changes(*calendars(spark, CURRENT, previous)), "tournament_id", "change_type")
    assert got == [(None, "ongoing"), ("4", "ongoing"), ("5", "ongoing")]


def test_calendar_changes_multiply_duplicates(spark, rows):
    got = rows(
        C.changes(*calendars(spark, [CURRENT[0]] * 3, [("1", None)] * 2)),
        "tournament_id", "previous_meta_file_modified",
    )
    assert len(got) == 6 and {str(r[1]) for r in got} == {DAYS[0]}


def test_calendar_changes_agree_with_the_sql(spark, rows):
    """Random calendars, with the union of the two cases written out in SQL."""
    rnd = random.Random(5)
    urls = [None, "/en/scores/archive/a/1/results", "/en/scores/current/a/1/results"]
    for seed in range(3):
        make = lambda: [
            (rnd.choice(["1", "2", "3", "4", None]), rnd.choice(urls)) for _ in range(rnd.randint(1, 9))
        ]
        current, previous = calendars(spark, make(), make())
        current.createOrReplaceTempView("cur")
        previous.createOrReplaceTempView("prev")
        spark.sql("""
            SELECT cur.*, prev.meta_file_modified AS p, 'newly_completed' AS t FROM cur
            JOIN prev ON cur.tournament_id = prev.tournament_id
            WHERE prev.url IS NULL AND cur.url IS NOT NULL
        """).createOrReplaceTempView("newly")
        expected = spark.sql("""
            SELECT tournament_id, url, t FROM newly UNION ALL
            SELECT tournament_id, url, 'ongoing' FROM cur
            WHERE url LIKE '%/current/%' AND tournament_id NOT IN (SELECT tournament_id FROM newly)
        """)
        got = C.changes(current, previous)
        assert rows(got, "tournament_id", "url", "change_type") == rows(expected)


MATCH = "year int, tournament_id string, match_id string, score string, meta_file_modified string"


def brute_force(data, basis):
    """New results, straight from the definition."""
    order = lambda r: (r[4], r[3])

    def dedupe(rows, extra):
        best = {}
        for r in rows:
            key = (*r[:3], *extra(r))
            if key not in best or order(r) > order(best[key]):
                best[key] = r
        return list(best.values())

    kept = dedupe(data, lambda r: ()) if basis == "as_written" else dedupe(data, lambda r: (r[4],))
    found = []
    for unit in {r[1] for r in kept if r[1] is not None}:
        mine = [r for r in kept if r[1] == unit]
        versions = sorted({r[4] for r in mine}, reverse=True)
        previous = [r for r in mine if len(versions) > 1 and r[4] == versions[1]]
        same = (lambda a, b: a[2] == b[2]) if basis == "as_written" else (lambda a, b: a[0] == b[0] and a[2] == b[2])
        for r in (r for r in mine if r[4] == versions[0]):
            known = r[2] is not None and (basis == "as_written" or r[0] is not None)
            if not (known and any(same(r, p) for p in previous)):
                found.append(r[:4])
    return sorted(found, key=str)


@pytest.mark.parametrize("basis", ["as_written", "intended"])
@pytest.mark.parametrize("seed", range(3))
def test_new_results(spark, basis, seed):
    rnd = random.Random(seed)
    data = [
        (rnd.choice([2023, 2024, None]), rnd.choice(["t1", "t2", None]), rnd.choice(["m1", "m2", "", None]),
         f"{i:04d}", rnd.choice(DAYS[:3]))
        for i in range(40)
    ]
    df = stamped(spark, data, MATCH)
    # The score is the only tiebreak column of these rows.
    got = [tuple(r) for r in R.new_results(df, basis, ["score"]).select("year", "tournament_id", "match_id", "score").collect()]
    assert sorted(got, key=str) == brute_force(data, basis)


def test_one_year_as_written_gives_the_whole_newest_version(spark, rows):
    data = [(2024, "t", m, m, d) for d in DAYS[:2] for m in ("m1", "m2")] + [(2024, "t", "m3", "m3", DAYS[1])]
    df = stamped(spark, data, MATCH)
    ids = lambda basis: [r[0] for r in rows(R.new_results(df, basis, ["score"]), "match_id")]
    assert ids("as_written") == ["m1", "m2", "m3"]
    assert ids("intended") == ["m3"]


def test_checks(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "a"), (None, "a"), (2, None)], "k int, v string")
    assert rows(Q.unique(df, ["k", "v"])) == [(1, "a", 2)]
    assert Q.not_null(df, "v").count() == 1
    got = dict(rows(Q.suite("t", df, ["k", "v"], ["k", "v"])))
    assert got == {"t.k not null": 2, "t.v not null": 1, "t.k|v unique": 1}
    assert Counter(v for _, v in rows(Q.suite("t", df.limit(0), ["k"], ["k"]))) == {0: 2}


def test_rank_uses_all_ranges_within_a_day(spark):
    """All versions on one day are dealt into ranges of about equal size."""
    day = spark.range(10_000).select(
        F.timestamp_add("SECOND", F.col("id") * 8, F.lit("2024-05-01").cast("timestamp_ntz")).alias("version")
    )
    for ranges in (1, 8):
        ranked = V.version_rank(day.union(day), version="version", ranges=ranges)
        found = ranked.select(F.unix_seconds(F.col("version").cast("timestamp")).alias("s"), "version_rank").orderBy("s").collect()
        assert [r["version_rank"] for r in found] == list(range(10_000, 0, -1))
    assert "hashpartitioning(_range" in ranked._jdf.queryExecution().toString()
