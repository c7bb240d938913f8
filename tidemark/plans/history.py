"""The cycle over a history that grows: runs that are numbered, made of steps that are each done once.

A step's output is bound to its run. The ledger of steps is written after the output, so a run that ends anywhere
and is run again goes on behind its last finished step: what was written without its ledger row is replaced, and
a state takes a run's rows once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import fixed_values as fixed
from tidemark.operators import summary as S
from tidemark.plans import calendar as C
from tidemark.plans import cycle as Y
from tidemark.plans import results as R
from tidemark.sources import documents as D
from tidemark.sources import state as St

STEPS = "step string, run int, rows long, finished_at timestamp_ntz"


class Steps:
    """The steps of one run of a history that lives in ``home``."""

    def __init__(self, spark: SparkSession, home: str, run: int):
        self.spark, self.home, self.run = spark, home.rstrip("/"), run
        self.ledger = St.every(spark, f"{self.home}/steps", ["step"], buckets=1)

    def done(self, step: str) -> bool:
        return self.ledger.version().batches.get(step, -1) >= self.run

    def output(self, step: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The step's rows, built if this run hasn't built them yet."""
        folder = f"{self.home}/{step}/run={self.run}"
        if not self.done(step):
            build().write.mode("overwrite").parquet(folder)
            self._finished(step, self.spark.read.parquet(folder).count())
        return self.spark.read.parquet(folder)

    def added(self, step: str, state: St.State, build: Callable[[], DataFrame]) -> St.State:
        """The state with the step's rows, added if this run hasn't added them yet."""
        if not self.done(step):
            state.add(build(), step, self.run)
            self._finished(step, None)
        return state

    def _finished(self, step: str, rows: int | None) -> None:
        at = datetime.now(UTC).replace(tzinfo=None)
        self.ledger.add(self.spark.createDataFrame([(step, self.run, rows, at)], STEPS), step, self.run)


@dataclass(frozen=True)
class History:
    """What is known after a run: of all runs so far, and of this one."""

    calendar_raw: DataFrame
    results_raw: DataFrame
    results: DataFrame
    changes: DataFrame
    targets: DataFrame
    new_results: DataFrame
    new_within_versions: DataFrame
    summary: DataFrame
    steps: DataFrame


def run_cycle(
    spark: SparkSession, home: str, run: int, calendar_pages: DataFrame, results_pages: DataFrame, root_url: str,
) -> History:
    """One run on top of the former ones: its calendar pages, what changed by them, and the results of the changes.

    Runs are numbered from 0 upwards. The raw documents of all runs are kept; what later steps need of the history is
    kept as state, so that a run costs its own pages and the latest snapshots, not the history.
    """
    steps = Steps(spark, home, run)
    calendar = St.latest_two(spark, f"{home}/calendar", ["tournament_id"])
    matches = St.latest(spark, f"{home}/matches", R.MATCH_KEY, R.TIEBREAK)
    recent = St.latest_two(spark, f"{home}/recent", R.MATCH_KEY, ["tournament_id"])

    pages = steps.output("calendar_raw", lambda: Y.calendar_raw(calendar_pages, root_url))
    steps.added("calendar", calendar, lambda: C.calendar(pages))
    changes = steps.output("changes", lambda: C.changes_of(calendar.rows()))
    targets = steps.output("targets", lambda: C.targets(changes, root_url))
    fetched = steps.output("results_raw", lambda: Y.results_raw(Y.pages_of_targets(targets, results_pages), root_url))
    steps.added("matches", matches, lambda: R.all_results(fetched))
    steps.added("recent", recent, lambda: R.all_results(fetched))
    new = steps.output("new_results", lambda: R.new_results(matches.rows()))
    within = steps.output("new_within_versions", lambda: R.new_results(recent.rows(), "intended"))
    summary = steps.output("summary", lambda: S.run_summary(R.all_results(fetched), ["year", "tournament_id"]))
    return History(
        calendar_raw=_all_runs(spark, home, "calendar_raw"), results_raw=_all_runs(spark, home, "results_raw"),
        results=matches.rows(), changes=changes, targets=targets, new_results=new, new_within_versions=within, summary=summary,
        steps=steps.ledger.rows(),
    )


def _all_runs(spark: SparkSession, home: str, step: str) -> DataFrame:
    return spark.read.parquet(f"{home}/{step}").select(*fixed.RAW_COLUMNS, F.col("run"))


def documents_of(history: History) -> DataFrame:
    """One row per landed document of all runs, with the number of its records."""
    both = history.calendar_raw.withColumn("kind", F.lit("calendar")).unionByName(
        history.results_raw.withColumn("kind", F.lit("results"))
    )
    return both.select("kind", "run", "meta_file_name", "meta_file_modified", D.record_count().alias("n_records"))
