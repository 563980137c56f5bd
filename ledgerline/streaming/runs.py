"""Incremental runs with durable marks.

An output is a folder of runs.  A run writes its rows, then the list of input files it has read,
then a mark: number, first run of the present snapshot, columns, time of commit and
version of the metadata.  The mark is one file and the commit point; rows of a run without a mark are seen by
nobody and are overwritten when the run is repeated.  Three views of an output are readable:
``current`` (all runs since the last snapshot), ``added`` (the last run) and ``previous``
(``current`` before the last run).

What a run reads is decided by the marks and the files at hand.  Input files are listed by Spark
with path, time and length; their content is not touched.  A run is a snapshot over all files if
it is the first or not asked to be incremental, if metadata committed after the last run changed
the table, or if a file read before is gone or was replaced.  Otherwise it reads added files
only, and builds a second time over everything if its columns turn out to differ from before.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.operators.quality import Expectation, write_expected
from ledgerline.sources.readers import existing
from ledgerline.streaming.changelog import metadata_is_newer, must_rebuild

MARK = (
    "run long, first_run long, kind string, columns array<string>, committed_at timestamp_ntz, version string,"
    " warnings array<string>"
)
FILES = "input string, path string, modified timestamp, length long"


@dataclass(frozen=True)
class Mark:
    run: int
    first_run: int
    kind: str  # snapshot, added or state
    columns: tuple[str, ...]
    committed_at: dt.datetime
    version: str | None  # of the metadata, or of the changes folded in
    warnings: tuple[str, ...] = ()  # expectations that the rows of this run do not meet


@dataclass(frozen=True)
class Output:
    """A folder of runs; also an input of later jobs."""

    root: str

    def marks(self, spark: SparkSession) -> list[Mark]:
        """All marks, oldest first; one short row per run."""
        found = existing(lambda: spark.read.schema(MARK).parquet(f"{self.root}/marks/*"))
        if found is None:
            return []
        return [
            Mark(
                r["run"], r["first_run"], r["kind"], tuple(r["columns"]), r["committed_at"], r["version"],
                tuple(r["warnings"] or ()),
            )
            for r in found.orderBy("run").collect()
        ]

    def last(self, spark: SparkSession) -> Mark | None:
        return next(reversed(self.marks(spark)), None)

    def _runs(self, spark: SparkSession, view: str) -> list[Mark]:
        marks = self.marks(spark)
        if not marks:
            return []
        if view == "added":
            return marks[-1:]
        if view == "previous":
            marks = marks[:-1]
        elif view != "current":
            raise ValueError(f"no view {view}")
        return [m for m in marks if m.run >= marks[-1].first_run] if marks else []

    def read(self, spark: SparkSession, view: str = "current") -> DataFrame | None:
        """Rows of a view; None where it holds no run."""
        runs = self._runs(spark, view)
        if not runs:
            return None
        return spark.read.parquet(*[self.data(m.run) for m in runs]).select(*[f"`{c}`" for c in runs[-1].columns])

    def data(self, run: int) -> str:
        return f"{self.root}/data/{run:09d}"

    def folders(self, spark: SparkSession) -> list[str]:
        return [self.data(m.run) for m in self._runs(spark, "current")]

    def files_read(self, spark: SparkSession, mark: Mark) -> DataFrame:
        """Input files that the present snapshot is made of."""
        runs = [m.run for m in self.marks(spark) if mark.first_run <= m.run <= mark.run]
        return spark.read.schema(FILES).parquet(*[f"{self.root}/files/{n:09d}" for n in runs])

    def commit(
        self,
        df: DataFrame,
        files: DataFrame | None,
        last: Mark | None,
        kind: str,
        version: str | None = None,
        now: dt.datetime | None = None,
        expectations: Sequence[Expectation] = (),
    ) -> Mark:
        """Write a run; rows that fail an expectation stay without a mark, so nobody sees them."""
        spark = df.sparkSession
        number = last.run + 1 if last else 1

        def write(rows: DataFrame) -> DataFrame:
            rows.write.mode("overwrite").parquet(self.data(number))
            return spark.read.schema(df.schema).parquet(self.data(number))

        warnings = write_expected(df, write, expectations)
        mark = Mark(
            number,
            last.first_run if last and kind == "added" else number,
            kind,
            tuple(df.columns),
            (now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)).replace(microsecond=0),
            version,
            tuple(warnings),
        )
        listed = spark.createDataFrame([], FILES) if files is None else files
        listed.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/files/{number:09d}")
        row = (mark.run, mark.first_run, kind, list(mark.columns), mark.committed_at, version, warnings)
        spark.createDataFrame([row], MARK).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/marks/{number:09d}")
        return mark


@dataclass(frozen=True)
class Landing:
    """A folder into which a connector drops Parquet files."""

    path: str

    def folders(self, spark: SparkSession) -> list[str]:
        return [self.path]


def listed_files(spark: SparkSession, inputs: Mapping[str, Landing | Output]) -> DataFrame:
    """``FILES`` rows of what every input holds now."""
    out = spark.createDataFrame([], FILES)
    for name, source in inputs.items():
        for folder in source.folders(spark):
            found = existing(
                lambda: spark.read.format("binaryFile")
                .option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(folder)
            )
            if found is not None:
                out = out.unionAll(
                    found.select(F.lit(name), "path", F.col("modificationTime"), F.col("length"))
                )
    return out


def _frames(spark: SparkSession, files: DataFrame, names: Sequence[str]) -> dict[str, DataFrame]:
    """One table per input that has files."""
    paths: dict[str, list[str]] = {n: [] for n in names}
    for r in files.select("input", "path").collect():  # a scan's own file list is as long
        paths[r["input"]].append(r["path"])
    return {n: spark.read.option("mergeSchema", True).parquet(*sorted(p)) for n, p in paths.items() if p}


@dataclass(frozen=True)
class MetadataState:
    """When the metadata was committed, its version, and whether it changed the table."""

    committed_at: dt.datetime
    changed: bool
    version: str | None = None


def run_incremental(
    spark: SparkSession,
    output: Output,
    inputs: Mapping[str, Landing | Output],
    build: Callable[[Mapping[str, DataFrame], bool], DataFrame | None],
    metadata: MetadataState | None = None,
    incremental: bool = True,
    now: dt.datetime | None = None,
    expectations: Sequence[Expectation] = (),
) -> Mark | None:
    """One run; None if there was nothing new to read.

    ``build`` gets a table per input that has files to read, and whether the run is a snapshot.
    """
    last = output.last(spark)
    files = listed_files(spark, inputs).persist()
    try:
        snapshot = last is None or not incremental
        if not snapshot and metadata is not None:
            newer = metadata_is_newer(metadata.committed_at, last.committed_at)
            snapshot = must_rebuild(True, newer, metadata.changed, last.columns, last.columns)
        fresh = files
        if not snapshot:
            seen = output.files_read(spark, last)
            same = ["input", "path", "modified", "length"]
            if not seen.join(files, same, "left_anti").isEmpty():
                snapshot = True
            else:
                fresh = files.join(seen, same, "left_anti")
        frames = _frames(spark, files if snapshot else fresh, list(inputs))
        if not frames:
            return None
        df = build(frames, snapshot)
        if df is None:
            return None
        if not snapshot and must_rebuild(True, False, False, df.columns, last.columns):
            snapshot = True
            df = build(_frames(spark, files, list(inputs)), True)
        return output.commit(
            df, files if snapshot else fresh, last, "snapshot" if snapshot else "added",
            metadata.version if metadata else None, now, expectations,
        )
    finally:
        files.unpersist()
