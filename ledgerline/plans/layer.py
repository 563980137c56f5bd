"""The stages of one source table as incremental jobs.

    landing folders -> cleaned -> enriched -> current

Every job keeps its output as runs with marks (``ledgerline.streaming.runs``) and decides by
itself whether to read everything or what was added since its last run.  The enriched stage
joins added rows with all customization rows, and earlier rows again with the customization rows
that were added.  The current stage folds what is new into the state it wrote last.  A repeated
primary key is a warning in the mark of an enriched run; an empty state stops its run.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ledgerline.metadata import lookup
from ledgerline.metadata.schemas import Metadata
from ledgerline.operators.quality import not_empty, unique_keys
from ledgerline.plans.staging import SourceSpec, cleaned, current, enriched, renamed
from ledgerline.streaming.runs import Landing, Mark, MetadataState, Output, run_incremental


@dataclass(frozen=True)
class Layer:
    """One source: where its raw components lie and where the outputs of its stages go."""

    source: SourceSpec
    components: Mapping[str, Mapping[str, str]]  # table -> component -> landing folder
    root: str

    def output(self, stage: str, table: str) -> Output:
        return Output(f"{self.root}/{stage}/{table}")

    def clean(
        self,
        spark: SparkSession,
        table: str,
        metadata: Metadata,
        state: MetadataState,
        incremental: bool = True,
        now: dt.datetime | None = None,
    ) -> Mark | None:
        inputs = {name: Landing(path) for name, path in self.components[table].items()}
        return run_incremental(
            spark, self.output("cleaned", table), inputs,
            lambda frames, snapshot: cleaned(frames, self.source, table, metadata),
            state, incremental, now,
        )

    def enrich(
        self, spark: SparkSession, table: str, metadata: Metadata, now: dt.datetime | None = None
    ) -> Mark | None:
        spec = self.source.table(table)
        others = [l.foreign_object for l in lookup.links_of(metadata, table, spec.customizations)]
        inputs = {name: self.output("cleaned", name) for name in dict.fromkeys([table, *others])}
        whole = {name: source.read(spark) for name, source in inputs.items()}

        def build(frames: Mapping[str, DataFrame], snapshot: bool) -> DataFrame | None:
            if whole[table] is None or any(whole[o] is None for o in others):
                return None  # a table this one needs was never built
            tables = {o: whole[o] for o in others}
            if snapshot:
                df = enriched(whole[table], self.source, table, metadata, tables)
            else:
                added = frames.get(table, whole[table].limit(0))
                changed = {o: frames[o] for o in others if o in frames}
                earlier = self._earlier(spark, whole[table], inputs[table], table) if changed else None
                df = enriched(added, self.source, table, metadata, tables, earlier, changed)
            return renamed(df, table, metadata, others)

        return run_incremental(spark, self.output("enriched", table), inputs, build, now=now, expectations=[unique_keys(["primary_key"])])

    def _earlier(self, spark: SparkSession, whole: DataFrame, cleaned_rows: Output, table: str) -> DataFrame:
        """Cleaned rows that the enriched output has seen already."""
        output = self.output("enriched", table)
        seen = output.files_read(spark, output.last(spark)).where(f"input = '{table}'")
        return spark.read.parquet(*[r["path"] for r in seen.select("path").collect()]).select(*whole.columns)

    def keep_current(
        self, spark: SparkSession, table: str, metadata: Metadata, now: dt.datetime | None = None
    ) -> Mark | None:
        """The state of the table; a run replaces it as a whole."""
        changes, state = self.output("enriched", table), self.output("current", table)
        told, last = changes.last(spark), state.last(spark)
        if told is None or (last is not None and last.version == str(told.run)):
            return None
        fold_from = int(last.version) + 1 if last is not None else None
        if fold_from is None or fold_from < told.first_run:
            rows, previous = changes.read(spark), None
        else:
            rows = spark.read.parquet(*[changes.data(n) for n in range(fold_from, told.run + 1)])
            previous = state.read(spark)
        df = current(rows.select(*[f"`{c}`" for c in told.columns]), self.source, table, metadata, previous)
        return state.commit(df, None, last, "state", str(told.run), now, [not_empty()])
