"""State that grows by runs: the same rows for any order of batches, few files, whole versions."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.operators import versions as V
from tidemark.plans import calendar as C
from tidemark.sources import state as St

SCHEMA = "k string, version timestamp_ntz, v int"


@pytest.fixture
def frame(spark):
    def make(*rows):
        plain = spark.createDataFrame([(k, d, v) for k, d, v in rows], "k string, day int, v int")
        at = F.timestamp_add("DAY", F.col("day"), F.lit("2024-01-01").cast("timestamp_ntz"))
        return plain.select("k", F.when(F.col("day").isNotNull(), at).alias("version"), "v")

    return make


def latest(spark, path, **options):
    return St.latest(spark, path, ["k"], ["v"], "version", **options)


def test_batches_are_added_once(spark, tmp_path, frame, rows):
    state = latest(spark, str(tmp_path / "s"))
    with pytest.raises(ValueError, match="nothing"):
        state.rows()
    assert state.add(frame(("a", 1, 1), (None, 1, 2), ("a", 2, 3)), "w", 0)
    assert not state.add(frame(("a", 9, 9)), "w", 0)
    assert state.add(frame(("b", None, 4)), "other", 0) and state.add(frame(), "w", 1)
    assert rows(state.rows(), "k", "v") == [(None, 2), ("a", 3), ("b", 4)]
    assert rows(state.rows_of(frame(("a", 1, 1), (None, 0, 0))), "k", "v") == [(None, 2), ("a", 3)]
    assert rows(latest(spark, str(tmp_path / "s"), buckets=3).rows_of(frame(("b", 1, 1))), "k", "v") == [("b", 4)]


def test_many_batches_leave_few_files(spark, tmp_path, frame, rows):
    rnd = random.Random(1)
    state = latest(spark, str(tmp_path / "s"), buckets=2, fanout=4, versions=2)
    everything = []
    for batch in range(50):
        new = [(rnd.choice("abcdef"), rnd.randint(0, 90), batch * 10 + k) for k in range(4)]
        everything += new
        state.add(frame(*new), "w", batch)
    newest = {k: max((d, v) for kk, d, v in everything if kk == k)[1] for k, _, _ in everything}
    assert rows(state.rows(), "k", "v") == sorted(newest.items())
    assert len(state.version().runs) <= 3 * 3  # fewer than fanout on each of the levels that 50 batches reach
    assert len(state.rows().inputFiles()) <= 2 * 9
    assert len(list((tmp_path / "s" / "runs").iterdir())) <= 9 + 2 * 4
    state.compact()
    assert len(state.version().runs) == 1 and rows(state.rows(), "k", "v") == sorted(newest.items())


def test_reader_sees_one_version(spark, tmp_path, frame, rows, monkeypatch):
    """A reader that began before a merge reads the old runs; a writer that ends half-way changes nothing."""
    state = latest(spark, str(tmp_path / "s"), fanout=9)
    for batch in range(3):
        state.add(frame(("a", batch, batch), (f"only{batch}", 1, 1)), "w", batch)
    before, opened = state.version(), state.rows()
    state.compact()
    expected = [("a", 2), ("only0", 1), ("only1", 1), ("only2", 1)]
    assert rows(opened, "k", "v") == rows(state.rows(before), "k", "v") == rows(state.rows(), "k", "v") == expected

    def stop(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patched:
        patched.setattr(state, "_switch", stop)
        with pytest.raises(RuntimeError):
            state.add(frame(("a", 9, 9)), "w", 3)
        with pytest.raises(RuntimeError):
            state.replace(frame(("a", 9, 9)), "w", 3)
    assert rows(state.rows(), "k", "v") == expected
    assert state.add(frame(("a", 9, 9)), "w", 3) and ("a", 9) in rows(state.rows(), "k", "v")
    listed = {r.name for p in (tmp_path / "s" / "versions").iterdir() if p.name.isdigit() for r in St.Version.of(p.read_text()).runs}
    assert {p.name.split("=")[1] for p in (tmp_path / "s" / "runs").iterdir()} == listed  # what the stopped ones left is gone
    assert state.replace(frame(("z", 1, 1)), "w", 4) and rows(state.rows(), "k", "v") == [("z", 1)]


@pytest.mark.parametrize("by", [[], ["k"]])
def test_two_versions_in_any_order(spark, tmp_path, frame, rows, by):
    rnd = random.Random(len(by))
    everything = [(rnd.choice("abc"), rnd.choice([None, *range(12)]), k) for k in range(60)]
    expected = rows(V.snapshot_pair(frame(*everything), by, "version").drop("version_rank"))
    for turn in range(2):
        rnd.shuffle(everything)
        state = St.latest_two(spark, str(tmp_path / f"s{turn}"), ["k"], by, "version", fanout=2, buckets=2)
        for batch in range(6):
            state.add(frame(*everything[batch * 10:batch * 10 + 10]), "w", batch)
        assert rows(state.rows()) == expected
        assert sum(spark.read.parquet(str(p)).count() for p in Path(state.path, "runs").iterdir()) < 6 * 60


def test_changes_from_state_equal_changes_from_history(spark, tmp_path, rows):
    """Loads in any order, and the diff after each equals that of all documents loaded so far."""
    names = [f.name for f in C.CALENDAR_FIELDS]
    rnd = random.Random(5)

    def day(d, ids):
        return [
            (2024, f"T{i}", None if i == 7 else str(i), "c", "x", "y", "z", None, None,
             rnd.choice([None, "/en/scores/current/a/1", "/en/scores/archive/a/1"]), f"f{d}") for i in ids
        ]

    schema = ", ".join(f"{n} {'int' if n == 'year' else 'string'}" for n in names) + ", meta_file_name string"
    days = {d: day(d, range(3, 12)) for d in range(1, 6)}
    frames = {
        d: spark.createDataFrame(r, schema).withColumn("meta_file_modified", F.lit(f"2024-01-0{d}").cast("timestamp_ntz"))
        for d, r in days.items()
    }
    state = St.latest_two(spark, str(tmp_path / "s"), ["tournament_id"], fanout=2, buckets=2)
    seen = None
    for batch, d in enumerate((3, 1, 5, 2, 4)):
        state.add(frames[d], "w", batch)
        seen = frames[d] if seen is None else seen.unionByName(frames[d])
        assert rows(C.changes_of(state.rows())) == rows(C.changes_of(seen))
