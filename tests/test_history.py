"""Two runs over a history, the second ended behind every step and run again."""

import pytest
from pyspark.sql import functions as F

from tidemark.plans import history as H
from tidemark.plans import results as R
from tidemark.sources import landing as L
from workload import web
from workload.registry import ROOT

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def pages(spark):
    users = F.col("page_id").rlike("/[0-9]?[0-9]/|^calendar")
    results = web.user_results_pages(spark, SF_DIR).filter(users)
    return L.stored(web.day_calendar_pages(spark, SF_DIR), "c"), L.stored(results, "r")


def run(spark, home, number, pages, early):
    half = (F.dayofmonth("retrieved_at") <= 15) == early
    return H.run_cycle(spark, home, number, pages[0].filter(half), pages[1].filter(half), ROOT)


def content(rows, history):
    parts = ("calendar_raw", "results_raw", "results", "changes", "targets", "new_results", "new_within_versions", "summary")
    return {name: rows(getattr(history, name)) for name in parts}


def test_runs_go_on_behind_their_last_step(spark, tmp_path, rows, pages, monkeypatch):
    whole = str(tmp_path / "whole")
    run(spark, whole, 0, pages, True)
    expected = content(rows, run(spark, whole, 1, pages, False))
    assert expected["results"] and expected["changes"]
    # Stopped behind each output, before or after its ledger row, and run on until it is through.
    home, built, stops = str(tmp_path / "stopped"), [], []
    run(spark, home, 0, pages, True)
    finished = H.Steps._finished

    def stop(steps, step, n):
        built.append(step)
        if len(stops) % 2:
            finished(steps, step, n)
        stops.append(step)
        raise InterruptedError(step)

    for _ in range(40):
        with monkeypatch.context() as patched:
            patched.setattr(H.Steps, "_finished", stop)
            try:
                found = run(spark, home, 1, pages, False)
            except InterruptedError:
                continue
            break
    assert content(rows, found) == expected
    assert [built[k] for k in range(0, 20, 2)] == [built[k] for k in range(1, 20, 2)] and len(set(built)) == 10
    assert run(spark, home, 1, pages, False).steps.count() == 20
    # The states stand for the raw documents of both runs.
    every = R.all_results(found.results_raw.drop("run"))
    assert rows(R.latest_results(every)) == expected["results"]
    assert rows(R.new_results(every)) == expected["new_results"]
    assert rows(R.new_results(every, "intended")) == expected["new_within_versions"]
