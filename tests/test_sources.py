"""Files, documents, streams: nothing lost, nothing twice, no document too long."""

import json
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidemark.operators.flatten import Field, flatten
from tidemark.session import shared_dir
from tidemark.sources import documents as D
from tidemark.sources import keyed as K
from tidemark.sources import landing as L
from tidemark.sources import ledger as G
from tidemark.sources import sql_text as Q
from tidemark.streaming import ingest as I

FIELDS = (Field("k", "k"), Field("v", "v"))


def put(folder, name, text):
    Path(folder).mkdir(parents=True, exist_ok=True)
    (Path(folder) / name).write_text(text, encoding="utf-8")


def document(day, *records):
    return json.dumps({"metadata": {"retrieved_at": f"2024-01-{day:02d}T06:00:00+00:00"}, "data": list(records)}, indent=2)


def test_scan_reads_whole_files_of_one_folder(spark, tmp_path, rows):
    put(tmp_path, "a b+c.json", document(1, {"k": "é"}))
    put(tmp_path, "notes.txt", "no")
    put(tmp_path / "loaded", "old.json", document(1))
    got = D.raw_rows(D.scan_documents(spark, str(tmp_path))).collect()
    assert [r["meta_file_name"].rsplit("/", 1)[1] for r in got] == ["a b+c.json"]
    assert str(got[0]["meta_file_modified"]) == "2024-01-01 06:00:00"
    assert json.loads(got[0]["data"])["data"] == [{"k": "é"}]


def test_partition_columns_prune_files(spark, tmp_path):
    for year in (2023, 2024):
        put(tmp_path / f"year={year}", "x.json", document(1))
    scanned = D.scan_documents(spark, str(tmp_path), partitions=["year"]).filter("year = 2024")
    assert len(scanned.collect()) == 1
    assert "PartitionFilters: [isnotnull(year" in scanned._jdf.queryExecution().toString()


def test_malformed_files(spark, tmp_path):
    put(tmp_path, "bad.json", '{"data": [')
    put(tmp_path, "good.json", document(1))
    scanned = D.scan_documents(spark, str(tmp_path))
    assert D.raw_rows(scanned, strict=False).count() == 1
    assert D.quarantined(scanned).first()["meta_file_name"].endswith("bad.json")
    with pytest.raises(Exception, match="malformed JSON in .*bad.json"):
        D.raw_rows(scanned).collect()


@pytest.mark.parametrize("text, expected", [
    ('{"a": 1}', True), (' [1]\n', True), ("null", True), ("", False), (" ", False), ('{"a": 1', False),
    ('{"a": 1} x', False), ('{"a": 1}]', False), ('{"a": 1}}', False), ("1, 2", False), ("1], [0", False),
    ("1,0,null", False), ("1,0", False), (None, False),
])
def test_well_formed(spark, text, expected):
    df = spark.createDataFrame([(text,)], "data string")
    assert df.select(D.well_formed(F.col("data"))).first()[0] is expected


@pytest.mark.parametrize("as_table", [True, False])
def test_load_appends_and_counts(spark, tmp_path, as_table):
    put(tmp_path / "in", "a.json", document(1, {"k": "1"}))
    put(tmp_path / "in", "empty.json", document(2))
    target = "raw_loads" if as_table else str(tmp_path / "raw")
    assert D.load_raw(spark, str(tmp_path / "in"), target) == 2
    assert D.load_raw(spark, str(tmp_path / "in"), target) == 4
    assert D.with_records(D.raw_source(spark, target)).count() == 2
    put(tmp_path / "none", "empty.json", document(2))
    with pytest.raises(ValueError):
        D.load_raw(spark, str(tmp_path / "none"), target, require_records=True)


def test_one_crowded_key_is_split_and_kept_whole(spark, rows):
    """Two thirds of the rows share a key; no document holds them all."""
    df = spark.range(30000).select(
        F.col("id"), F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k")
    )
    docs = L.documents(df, ["k"], ["id"], ["k", F.col("id").alias("v")], F.lit("2024-01-01").cast("timestamp_ntz"), limit=500)
    sizes = docs.groupBy("k").agg(F.max(F.size("data")).alias("m"), F.count("*").alias("n")).collect()
    hot = next(r for r in sizes if r["k"] == "hot")
    assert hot["n"] == 40 and hot["m"] < 1000
    back = flatten(L.raw_table(docs), FIELDS).select("k", F.col("v").cast("bigint").alias("id"))
    assert back.exceptAll(df.select("k", "id")).isEmpty() and df.select("k", "id").exceptAll(back).isEmpty()


def test_null_keys_get_their_document(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a")], "id int, k string")
    got = {r["k"]: r["records"] for r in L.collect_records(df, ["k"], ["id"], ["id"], limit=1).select(
        "k", F.size("records").alias("records")).groupBy("k").agg(F.sum("records").alias("records")).collect()}
    assert got == {None: 2, "a": 1}


def test_written_documents_are_one_pretty_file_each(spark):
    df = spark.createDataFrame([(i, i % 2, None) for i in range(4)], "id int, year int, note string")
    docs = L.documents(df, ["year"], ["id"], ["id", "note"], F.lit("2024-01-01").cast("timestamp_ntz"))
    path = shared_dir(spark, "written")
    L.write_documents(docs, path, ["year"])
    files = sorted(Path(path).rglob("*.json"))
    assert len(files) == 2 and {f.parent.name for f in files} == {"year=0", "year=1"}
    text = files[0].read_text()
    assert "\n" in text.strip() and json.loads(text)["data"][0]["note"] is None
    assert "note" in json.loads(text)["data"][0]


def test_manifest_prefers_the_documents_time(spark):
    df = spark.createDataFrame([(1, 2024)], "id int, year int")
    docs = L.documents(df, ["year"], ["id"], ["id"], F.lit("2024-01-01").cast("timestamp_ntz"))
    at = F.lit("2024-02-02 03:04:05").cast("timestamp_ntz")
    got = L.manifest(docs, "e", at, year=F.col("year")).first().asDict()
    assert got == {
        "endpoint": "e", "year": "2024", "count": "1", "scraped_at": "2024-01-01T00:00:00.000000+00:00",
        "upload_timestamp": "2024-02-02T03:04:05.000000+00:00",
    }


def test_ledger(spark, rows):
    raw = spark.createDataFrame([("a",), ("b",), ("b",)], "meta_file_name string")
    ledger = G.ledger_rows(raw.filter("meta_file_name = 'a'"), "e", "t", F.lit("2024-01-01").cast("timestamp_ntz"))
    assert tuple(ledger.columns) == G.LEDGER_COLUMNS
    assert rows(G.new_files(raw.distinct(), ledger)) == [("b",)]


def test_sql_parameters(spark, tmp_path):
    put(tmp_path, "q.sql", "SELECT :x AS v -- not a :marker\n WHERE 'a:b' <> :y")
    assert Q.run_sql_file(spark, str(tmp_path / "q.sql"), x=3, y="it's").first()["v"] == 3
    with pytest.raises(AnalysisException, match="parameter: y"):
        Q.run_sql(spark, "SELECT :x WHERE 1 < :y", x=1)


def names(df):
    return sorted(r["meta_file_name"].rsplit("/", 1)[1] for r in df.select("meta_file_name").collect())


def test_stream_loads_each_file_once(spark, tmp_path):
    incoming, raw, state = (str(tmp_path / n) for n in ("incoming", "raw", "state"))
    load = lambda: I.load_new(I.new_documents(spark, incoming), raw, state).awaitTermination()
    for n in (1, 2, 3):
        put(incoming, f"{n}.json", document(n, {"k": "x", "v": str(n)}))
    load()
    load()
    put(incoming, "0.json", document(1, {"k": "x", "v": "old"}))
    load()
    assert names(spark.read.parquet(raw)) == ["0.json", "1.json", "2.json", "3.json"]


def test_stream_archives_files_of_earlier_batches(spark, tmp_path):
    incoming, archive, raw, state = (str(tmp_path / n) for n in ("incoming", "archive", "raw", "state"))
    for n in (1, 2, 3):
        put(incoming, f"{n}.json", document(n))
        I.load_new(I.new_documents(spark, incoming, archive), raw, state).awaitTermination()
    archived = [p.name for p in Path(archive).rglob("*.json")]
    assert archived and names(spark.read.parquet(raw)) == ["1.json", "2.json", "3.json"]
    left = [p.name for p in Path(incoming).glob("*.json")]
    assert sorted(archived + left) == ["1.json", "2.json", "3.json"]


def test_stream_sets_malformed_files_aside(spark, tmp_path):
    incoming, raw, bad, state = (str(tmp_path / n) for n in ("incoming", "raw", "bad", "state"))
    put(incoming, "good.json", document(1))
    put(incoming, "bad.json", "{")
    I.load_new(I.new_documents(spark, incoming), raw, state, bad).awaitTermination()
    assert (names(spark.read.parquet(raw)), names(spark.read.parquet(bad))) == (["good.json"], ["bad.json"])


def test_failed_batch_is_loaded_once_it_is_repaired(spark, tmp_path):
    incoming, raw, state = (str(tmp_path / n) for n in ("incoming", "raw", "state"))
    put(incoming, "good.json", document(1))
    put(incoming, "bad.json", "{")
    with pytest.raises(Exception):
        I.load_new(I.new_documents(spark, incoming), raw, state).awaitTermination()
    put(incoming, "bad.json", document(2))
    I.load_new(I.new_documents(spark, incoming), raw, state).awaitTermination()
    assert names(spark.read.parquet(raw)) == ["bad.json", "good.json"]


def test_stream_state_ignores_the_order_of_arrival(spark, tmp_path, rows):
    incoming, state, checkpoint = (str(tmp_path / n) for n in ("incoming", "state", "checkpoint"))
    for day in (3, 1, 2):
        put(incoming, f"{day}.json", document(day, {"k": "x", "v": str(day)}, {"k": f"only{day}", "v": "1"}))
        stream = I.new_documents(spark, incoming)
        I.keep_latest(stream, lambda r: flatten(r, FIELDS), ["k"], state, checkpoint).awaitTermination()
    got = rows(I.latest_state(spark, state, ["k"]), "k", "v")
    assert got == [("only1", "1"), ("only2", "1"), ("only3", "1"), ("x", "3")]


def test_documents_at_keys(spark, tmp_path, rows, monkeypatch):
    """What a stopped write left is replaced; a batch that the manifest knows is not written again."""
    at = F.to_timestamp_ntz(F.lit("2024-05-01 10:00:00"))
    records = spark.createDataFrame([(k % 3, k, f"v{k}") for k in range(9)], "g int, id int, v string")
    root, manifest = str(tmp_path / "root"), str(tmp_path / "manifest")

    def write(tag, batch, key=None):
        docs = L.documents(records.withColumn("v", F.lit(tag)), ["g"], ["id"], ["id", "v"], at)
        key = F.concat(F.lit("raw/a b+c%/g="), "g", F.lit(".json")) if key is None else key
        return K.write_documents(docs, key, root, manifest, "e", "w", batch, g=F.col("g"))

    with monkeypatch.context() as patched:
        patched.setattr(K.St.State, "add", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            write("old", 0)
    assert write("new", 0) and not write("newer", 0)
    files = sorted(Path(root).rglob("*.json"))
    assert [str(f.relative_to(root)) for f in files] == [f"raw/a b+c%/g={g}.json" for g in range(3)]
    assert all(json.loads(f.read_text())["data"][0]["v"] == "new" for f in files)
    found = rows(K.listed(spark, manifest).rows(), "key", "g", "count", "endpoint")
    assert found == [(f"raw/a b+c%/g={g}.json", str(g), "3", "e") for g in range(3)]
    with pytest.raises(ValueError, match="several"):
        write("x", 1, F.lit("same.json"))
    assert not list(Path(root).rglob("same.json")) and K.listed(spark, manifest).rows().count() == 3
