"""State that grows by runs and is switched from version to version.

A state is a folder. Below ``runs`` lie folders of rows that are never changed; below ``versions`` a small file per
version that lists the runs it is made of. A writer adds rows as a new run and then writes the next version's
file, in one rename; a reader takes the newest version and reads its runs. So a reader sees one version or
the next and nothing between, and a writer that ends half-way leaves a run that no version lists.

What a state holds is what ``keep`` leaves of all rows ever added: the newest row of each key, say, or the rows
of the newest two versions. ``keep`` may be applied early: ``keep(keep(a) + b)`` equals ``keep(a + b)``. So each run holds
what it leaves of a batch, and runs are merged: as soon as ``fanout`` runs of a level are there, they become
one run of the next. A row is written again once a level, and the runs that a reader opens grow with the
logarithm of the number of batches. Rows of a run lie in buckets by their keys, sorted within, so that those of a few
keys are found without reading the others.

There is one writer at a time, as a stream's checkpoint sees to. Each batch is added once: the version's file says
which batch of each writer was the last.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

from tidemark.operators import versions as V
from tidemark.sources.files import Files

RUN, BUCKET = "_run", "_bucket"


@dataclass(frozen=True)
class Run:
    """A folder of rows and how often their like were merged."""

    name: str
    level: int


@dataclass(frozen=True)
class Version:
    """What a version is made of."""

    number: int = 0
    runs: tuple[Run, ...] = ()
    schema: str | None = None
    batches: dict[str, int] = field(default_factory=dict)

    @classmethod
    def of(cls, text: str) -> Version:
        plain = json.loads(text)
        return cls(plain["number"], tuple(Run(**r) for r in plain["runs"]), plain["schema"], plain["batches"])


class State:
    """The state at ``path``; ``buckets`` and ``fanout`` may differ from one writer to the next."""

    def __init__(
        self, spark: SparkSession, path: str, keys: Sequence[str], keep: Callable[[DataFrame], DataFrame],
        buckets: int = 16, fanout: int = 4, versions: int = 8,
    ):
        if fanout < 2:
            raise ValueError("fewer than two runs can't be merged")
        self.spark, self.path, self.keys, self.keep = spark, path.rstrip("/"), list(keys), keep
        self.buckets, self.fanout, self.versions = buckets, fanout, versions
        self._files = Files(spark, path)

    def version(self) -> Version:
        """The newest version; one without runs before anything was added."""
        numbers = self._numbers()
        return Version.of(self._files.read(self._file(max(numbers)))) if numbers else Version()

    def rows(self, version: Version | None = None) -> DataFrame:
        """The rows of a version, the newest by default."""
        version = version or self.version()
        if version.schema is None:
            raise ValueError(f"nothing was added to {self.path} yet")
        return self.keep(self._read(version, version.runs))

    def rows_of(self, keys: DataFrame, version: Version | None = None) -> DataFrame:
        """The rows of some keys. Only the buckets that the keys fall into are read."""
        version = version or self.version()
        wanted = keys.select(*self.keys).distinct()
        hit = [r[0] for r in wanted.select(self._bucket().alias(BUCKET)).distinct().collect()]  # no more than buckets
        found = self._read(version, version.runs, hit)
        same = [found[k].eqNullSafe(wanted[k]) for k in self.keys]
        return self.keep(found.join(wanted, same, "left_semi"))

    def add(self, rows: DataFrame, writer: str, batch: int) -> bool:
        """Add a batch and merge the runs that have become too many. False if the batch was added before."""
        version = self.version()
        if version.batches.get(writer, -1) >= batch:
            return False
        if version.schema is not None:
            rows = rows.select(*StructType.fromJson(json.loads(version.schema)).names)
        run = Run(self._write(self.keep(rows)), 0)
        version = self._switch(version, (*version.runs, run), rows.schema.json(), version.batches | {writer: batch})
        while crowded := self._crowded(version):
            version = self._merge(version, crowded)
        self._tidy()
        return True

    def replace(self, rows: DataFrame, writer: str, batch: int) -> bool:
        """Put other rows in the place of all. False if the batch was written before."""
        version = self.version()
        if version.batches.get(writer, -1) >= batch:
            return False
        run = Run(self._write(rows), 0)
        self._switch(version, (run,), rows.schema.json(), version.batches | {writer: batch})
        self._tidy()
        return True

    def compact(self) -> None:
        """Merge all runs into one."""
        version = self.version()
        if len(version.runs) > 1:
            self._merge(version, version.runs)
            self._tidy()

    def _numbers(self) -> list[int]:
        return [int(n) for n in self._files.names(f"{self.path}/versions") if n.isdigit()]

    def _file(self, number: int) -> str:
        return f"{self.path}/versions/{number}"

    def _bucket(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _read(self, version: Version, runs: Sequence[Run], buckets: Sequence[int] | None = None) -> DataFrame:
        """Rows of runs, which may have been written with other numbers of buckets."""
        schema = StructType.fromJson(json.loads(version.schema))
        if not runs:
            return self.spark.createDataFrame([], schema)
        whole = StructType(schema.fields).add(RUN, StringType()).add(BUCKET, IntegerType())
        found = self.spark.read.schema(whole).option("basePath", f"{self.path}/runs").parquet(
            *[f"{self.path}/runs/{RUN}={r.name}" for r in runs]
        )
        if buckets is not None:
            same = F.col(RUN).endswith(f"-{self.buckets}")
            found = found.filter(~same | F.col(BUCKET).isin([int(b) for b in buckets]))
        return found.drop(RUN, BUCKET)

    def _write(self, rows: DataFrame) -> str:
        name = f"{uuid.uuid4().hex}-{self.buckets}"
        (
            rows.withColumn(BUCKET, self._bucket()).repartition(F.col(BUCKET)).sortWithinPartitions(BUCKET, *self.keys)
            .write.partitionBy(BUCKET).parquet(f"{self.path}/runs/{RUN}={name}")
        )
        return name

    def _crowded(self, version: Version) -> tuple[Run, ...]:
        """The runs of the lowest level that has ``fanout`` of them or more."""
        for level in sorted({r.level for r in version.runs}):
            same = tuple(r for r in version.runs if r.level == level)
            if len(same) >= self.fanout:
                return same
        return ()

    def _merge(self, version: Version, runs: Sequence[Run]) -> Version:
        merged = Run(self._write(self.keep(self._read(version, runs))), max(r.level for r in runs) + 1)
        left = tuple(r for r in version.runs if r not in runs)
        return self._switch(version, (merged, *left), version.schema, version.batches)

    def _switch(self, old: Version, runs: tuple[Run, ...], schema: str, batches: dict[str, int]) -> Version:
        new = Version(old.number + 1, runs, schema, batches)
        self._files.write(self._file(new.number), json.dumps(asdict(new)))
        return new

    def _tidy(self) -> None:
        """Delete all but the latest versions, and the runs that none of those lists.

        A reader may take as long as it takes to write ``versions`` of them.
        """
        numbers = sorted(self._numbers())
        for number in numbers[:-self.versions]:
            self._files.delete(self._file(number))
        listed = {r.name for n in numbers[-self.versions:] for r in Version.of(self._files.read(self._file(n))).runs}
        for name in self._files.names(f"{self.path}/runs"):
            if name.removeprefix(f"{RUN}=") not in listed:
                self._files.delete(f"{self.path}/runs/{name}")


def latest(
    spark: SparkSession, path: str, keys: Sequence[str], tiebreak: Sequence[str] = (), version: str = V.VERSION, **options: int,
) -> State:
    """A state of the newest row per key."""
    return State(spark, path, keys, lambda rows: V.latest_per_key(rows, keys, version, tiebreak), **options)


def latest_two(
    spark: SparkSession, path: str, keys: Sequence[str], by: Sequence[str] = (), version: str = V.VERSION, **options: int,
) -> State:
    """A state of the rows of the newest two versions, overall or of each ``by``. Rows without a version go."""

    def keep(rows: DataFrame) -> DataFrame:
        return V.snapshot_pair(rows.filter(F.col(version).isNotNull()), by, version).drop("version_rank")

    return State(spark, path, keys, keep, **options)


def every(spark: SparkSession, path: str, keys: Sequence[str], **options: int) -> State:
    """A state that keeps all rows."""
    return State(spark, path, keys, lambda rows: rows, **options)
