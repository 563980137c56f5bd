"""Batch and incremental scans."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ledgerline.functions.text import snake_name
from ledgerline.operators.columns import quoted
from ledgerline.operators.sets import lineage_union

# The files of the public drug-product release.
DRUG_FILES = (
    "ActionTypes_Lookup.txt",
    "ApplicationDocs.txt",
    "Applications.txt",
    "ApplicationsDocsType_Lookup.txt",
    "MarketingStatus.txt",
    "MarketingStatus_Lookup.txt",
    "Products.txt",
    "SubmissionClass_Lookup.txt",
    "SubmissionPropertyType.txt",
    "Submissions.txt",
    "TE.txt",
)


def read_table(spark: SparkSession, name_or_path: str, fmt: str = "parquet") -> DataFrame:
    """A path is read as files, anything else as a catalogue table."""
    if "/" in name_or_path:
        return spark.read.format(fmt).load(name_or_path)
    return spark.read.table(name_or_path)


def existing(read: Callable[[], DataFrame]) -> DataFrame | None:
    """What ``read`` returns, or None where its path does not exist."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_components(spark: SparkSession, folder: str, names: Sequence[str]) -> DataFrame:
    """Batch components of one table, with the component's name on every row."""
    return lineage_union({n: read_table(spark, f"{folder}/{n}") for n in names})


def read_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 1000) -> DataFrame:
    """New files only; the checkpoint of the query that reads it remembers the seen ones."""
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(path)
    )


def read_changes(
    spark: SparkSession, current_path: str, added_path: str, snapshot: bool
) -> DataFrame:
    """All rows for a rebuild, otherwise the added ones."""
    return read_table(spark, current_path if snapshot else added_path)


def read_tab_file(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Tab-separated text with a header; names in snake case.

    Cells beyond the header are cut off, missing ones are null, and bytes that are not valid
    text are left out.
    """
    raw = (
        spark.read.option("sep", "\t")
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(path)
    )
    return raw.select(
        [F.regexp_replace(quoted(c), "�", "").alias(snake_name(c)) for c in raw.columns]
    )


def read_tab_folder(
    spark: SparkSession, folder: str, files: Sequence[str] = DRUG_FILES, prefix: str = "fda_drug_"
) -> dict[str, DataFrame]:
    """One table per named file, called after the file."""
    return {
        prefix + snake_name(f.rsplit(".", 1)[0]): read_tab_file(spark, f"{folder}/{f}") for f in files
    }


def lookup_table(spark: SparkSession, rows: Sequence[Mapping | tuple], schema: str) -> DataFrame:
    """A small constant table written in the job."""
    return spark.createDataFrame(list(rows), schema)
