"""Documents in parts, repeated loads, pages and files that can't be read, wide blanks, executors without the package."""

import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidemark.functions import text as T
from tidemark.operators import extract as E
from tidemark.operators import summary as S
from tidemark.operators.flatten import Field, flatten
from tidemark.plans.tournaments import tournaments
from tidemark.sources import documents as D
from tidemark.sources import landing as L
from tidemark.sources import loads as Ld
from tidemark.sources.state import State, every
from tidemark.streaming import ingest as I

REPO = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("limit", [1, 3, 1000])
def test_parts_change_nothing(spark, limit):
    rows = spark.range(50).selectExpr("id AS Id", "id % 5 AS g", "'2024' AS year").withColumn(
        "at", F.lit("2024-05-01 10:00:00").cast("timestamp_ntz")
    )
    groups = L.collect_records(rows, ["year", "at", "g"], ["Id"], ["Id"], "Tournaments", limit).withColumnRenamed("part", "p")
    listed = L.collect_records(groups, ["year", "at"], ["g", "p"], ["Tournaments"], "TournamentDates", limit)
    docs = listed.select("year", "part", F.struct(
        F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("retrieved_at"),
        L.document_name(["year"]).alias("document"), "part",
    ).alias("metadata"), F.struct("TournamentDates").alias("data"))
    raw = L.stored(L.raw_table(docs), "raw")
    for whole in (False, True):
        assert tournaments(raw, whole_version=whole).count() == 50
    flat = L.documents(rows, ["year"], ["Id"], ["Id"], F.to_timestamp_ntz(F.lit("2024-05-01 10:00:00")), limit=limit)
    counted = S.records_per_document(L.raw_table(flat)).collect()
    assert [(r["document"], r["n_records"]) for r in counted] == [("2024", 50)]
    assert [r["count"] for r in L.manifest(flat, "e", year=F.col("year")).collect()] == ["50"]


def put(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)


def document(k, day=1):
    return f'{{"metadata": {{"retrieved_at": "2024-01-{day:02d}T00:00:00+00:00"}}, "data": [{{"k": "{k}"}}]}}'


def test_loads_repeat_nothing(spark, tmp_path):
    files, raw, ledger = tmp_path / "in", str(tmp_path / "raw"), str(tmp_path / "ledger")
    load = lambda: Ld.load_new(spark, str(files), raw, ledger, "e").count()
    put(files, "a b.json", document(1))
    assert load() == 1 and load() == 0
    put(files, "c+d.json", document(2))
    assert load() == 1
    assert Ld.loaded(spark, raw).count() == 2 and Ld.ledger(spark, ledger).rows().count() == 2
    # Rows that came in before a run ended without its ledger rows are not loaded again.
    assert Ld.load_new(spark, str(files), raw, str(tmp_path / "lost"), "e").count() == 0


def places(tmp_path):
    return {n: sorted(str(p.relative_to(tmp_path / n)) for p in (tmp_path / n).rglob("*.json")) for n in ("in", "done")}


def test_moves_follow_the_ledger(spark, tmp_path, monkeypatch):
    """Files move once their batch is in the ledger, also if the load ended before it moved them."""
    files, raw, ledger, done = tmp_path / "in", str(tmp_path / "raw"), str(tmp_path / "ledger"), str(tmp_path / "done")
    load = lambda: Ld.load_new(spark, str(files), raw, ledger, "e", archive=done)
    (files / "year=2024").mkdir(parents=True)
    put(files / "year=2024", "a b+c.json", document(1))
    put(files / "year=2024", "d.json", document(2))
    with monkeypatch.context() as patched:
        patched.setattr(Ld, "_make_moves", lambda *a: None)
        assert load().count() == 2
    assert places(tmp_path) == {"in": ["year=2024/a b+c.json", "year=2024/d.json"], "done": []}
    assert load().count() == 0
    assert places(tmp_path) == {"in": [], "done": ["year=2024/a b+c.json", "year=2024/d.json"]}
    put(files / "year=2024", "bad.json", "{")
    with pytest.raises(StreamingQueryException):
        load()
    assert places(tmp_path)["in"] == ["year=2024/bad.json"] and Ld.loaded(spark, raw).count() == 2
    put(files / "year=2024", "bad.json", document(3))
    assert load().count() == 1 and places(tmp_path)["in"] == []
    assert sorted(r["rows_loaded"] for r in Ld.ledger(spark, ledger).rows().collect()) == [1, 1, 1]


@pytest.mark.parametrize("after", ["rows", "ledger"])
def test_repair_stopped_half_way(spark, tmp_path, monkeypatch, after):
    files, raw, ledger, bad = tmp_path / "in", str(tmp_path / "raw"), str(tmp_path / "ledger"), str(tmp_path / "bad")
    for k, text in enumerate((document(1), document(2)[:-1], " \n", "never")):
        put(files, f"{k}.json", text)
    with pytest.raises(ValueError, match="refused"):
        Ld.load_new(spark, str(files), raw, ledger, "e", strict=False)
    Ld.load_new(spark, str(files), raw, ledger, "e", strict=False, refused=bad)
    assert Ld.loaded(spark, raw).count() == 1
    assert sorted(r["reason"] for r in Ld.still_refused(spark, bad).collect()) == ["empty", "not one JSON value", "not one JSON value"]
    fix = lambda: Ld.repair(spark, raw, ledger, bad, "e", lambda d: F.concat(d, F.lit("}")))
    with monkeypatch.context() as patched:
        add = State.add
        stop = lambda state, rows, writer, n: 1 / 0 if writer == "repair" or after == "rows" else add(state, rows, writer, n)
        patched.setattr(State, "add", stop)
        with pytest.raises(ZeroDivisionError):
            fix()
    for _ in range(2):
        fix()
    left = Ld.still_refused(spark, bad).collect()
    assert Ld.loaded(spark, raw).count() == 2 and Ld.ledger(spark, ledger).rows().count() == 2
    assert sorted((r["data"], r["attempt"]) for r in left) == [(" \n", 3), ("never", 3)]


def test_streams_with_other_checkpoints_keep_rows(spark, tmp_path):
    files, raw = tmp_path / "in", str(tmp_path / "raw")
    for k in range(2):
        put(files, f"{k}.json", document(k))
        stream = I.new_documents(spark, str(files))
        I.load_new(stream, raw, str(tmp_path / f"checkpoint{k}")).awaitTermination()
    assert spark.read.parquet(raw).count() == 3  # the second stream sees both files, the first saw one


def test_streams_set_malformed_files_aside(spark, tmp_path):
    files, state, bad = tmp_path / "in", str(tmp_path / "state"), str(tmp_path / "bad")
    put(files, "good.json", document(1))
    put(files, "bad.json", "{")
    rows = lambda raw: flatten(raw, [Field("k", "k")])
    I.keep_latest(I.new_documents(spark, str(files)), rows, ["k"], state, str(tmp_path / "c1"), quarantine_path=bad).awaitTermination()
    assert I.latest_state(spark, state, ["k"]).count() == 1 and spark.read.parquet(bad).count() == 1
    seen = []
    I.after_each_batch(
        I.new_documents(spark, str(files)), rows, every(spark, str(tmp_path / "rows"), ["k"]), str(tmp_path / "raw"),
        str(tmp_path / "c2"), lambda t, n: seen.append(t.count()), bad,
    ).awaitTermination()
    assert seen == [1]


def test_one_bad_page_stops_nothing(spark):
    good = "<nav><a href='/x'>x</a></nav>"
    pages = spark.createDataFrame([(1, good), (2, "<p><![foo[x]]></p>"), (3, None), (4, good)], "page_id long, html string")
    assert sorted(r["page_id"] for r in E.page_links(pages).collect()) == [1, 4]
    for aside in (E.unreadable_pages, E.unreadable_events, E.unreadable_matches):
        assert [(r["page_id"], "unreadable page" in r["error"]) for r in aside(pages).collect()] == [(2, True)]


MATCH = """<div class="atp_accordion-item"><div class="match"><strong>Round&nbsp;of&nbsp;16 - x</strong>{}
<div class="scores"><div class="score-item"><span>6</span></div></div>
<div class="scores"><div class="score-item"><span>3</span></div></div></div></div>"""


@pytest.mark.parametrize(("players", "kept"), [(1, True), (2, False), (3, True), (4, False)])
def test_blank_names_count_where_there_are_two_or_four(spark, players, kept):
    name = '<div class="name"><a href="/en/players/a-b/x1/overview">A B</a></div>'
    html = MATCH.format(name * (players - 1) + '<div class="name"><a href="/en/players/a-b/x1/overview"></a></div>')
    pages = spark.createDataFrame([(2024, "t", "1", html)], "year int, tournament_name string, tournament_id string, html string")
    found = E.match_records(pages, "").collect()
    assert len(found) == kept
    if kept:
        assert found[0]["round"] == "Round Of 16" and found[0]["player1_name"] == ""
    else:
        assert E.unreadable_matches(pages).count() == 1


def test_wide_blanks(spark):
    df = spark.createDataFrame([("\xa0Doha,\xa0Qatar |", "Round\xa0of　16", "\x1c x \x85")], "v string, r string, s string")
    row = df.select(
        T.venue_city(F.col("v")).alias("city"), T.venue_country(F.col("v")).alias("country"),
        T.round_title(F.col("r")).alias("round"), T.strip(F.col("s")).alias("s"),
    ).first()
    assert tuple(row) == ("Doha", "Qatar", "Round Of 16", "x")
    name = "struct<link string, text string>"
    winners = spark.sql(f"SELECT from_json('[{{\"label\": \"Doubles\", \"names\": [{{\"text\": \"\\\\u00a0\"}}, {{\"link\": \"\\\\u00a0A\"}}]}}]', "
                        f"'array<struct<label string, names array<{name}>>>') AS w")
    assert winners.select(T.doubles_winners(F.col("w"))).first()[0] == ["A"]


def test_executors_need_no_package(tmp_path):
    """Workers start in another folder and without the package on their path."""
    script = f"""
import sys
sys.path.insert(0, {str(REPO)!r})
from tidemark.session import get_spark
spark = get_spark("t", "local[2]", **{{"spark.ui.enabled": "false", "spark.checkpoint.dir": {str(tmp_path / "c")!r}}})
from tidemark.operators import extract as E
pages = spark.createDataFrame([(1, "<nav><a href='/x'>x</a></nav>")], "page_id long, html string")
assert E.page_links(pages).count() == 1 and E.page_links(pages).collect()[0]["href"] == "/x"
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=200)
    assert done.returncode == 0, done.stderr[-1500:]
