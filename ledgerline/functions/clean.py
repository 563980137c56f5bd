"""Cleaning of raw source values as column expressions, plus the registry of named cleaners.

Raw text is dirty, so every conversion is the null-on-failure form (``try_*``): a bad value
costs its own cell and never the job.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

# What counts as null, true and false, the zero sentinels, and the formats.
NULL_WORDS = ("#n/a", "n/a", "null", "(null)", "none", "nil", "undefined", "")
TRUE_WORDS = ("true", "t", "yes", "y", "active", "a", "1")
FALSE_WORDS = ("false", "f", "no", "n", "inactive", "i", "0")
ZERO_DATE = "00000000"
ZERO_TIME = "000000"
DATE_FORMAT = "yyyyMMdd"
STAMP_FORMAT = "yyyyMMddHHmmss"
ISO_MICROS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
UTC_STAMP_DOMAINS = ("TZNTSTMPS", "TZNTSTMPL")
ZONED_STAMP_DOMAIN = "COM_TSTMP"
SOURCE_ZONE = "America/New_York"


@dataclass(frozen=True)
class FieldType:
    """Dictionary entry that drives the cleaning of one raw column."""

    column: str
    kind: str
    domain: str | None = None


def null_words(c: Column) -> Column:
    """Trimmed text, null for the usual spellings of 'nothing'."""
    trimmed = F.trim(c.cast("string"))
    return F.when(~F.lower(trimmed).isin(*NULL_WORDS), trimmed)


def blank_to_null(c: Column) -> Column:
    """Null for blank text; other text keeps its surrounding spaces."""
    return F.when(F.trim(c) != "", c)


def to_boolean(c: Column) -> Column:
    lowered = F.lower(c)
    return (
        F.when(lowered.isin(*TRUE_WORDS), F.lit(True))
        .when(lowered.isin(*FALSE_WORDS), F.lit(False))
        .otherwise(c.try_cast("boolean"))
    )


def to_date(c: Column, fmt: str = DATE_FORMAT) -> Column:
    return F.when(c != ZERO_DATE, F.try_to_date(c, fmt))


def to_time_number(c: Column) -> Column:
    """Time of day ``HH:mm:ss`` or ``HHmmss`` as the number HHmmss."""
    return F.when(c != ZERO_TIME, F.regexp_replace(c, ":", "").try_cast("long"))


def to_stamp(c: Column, fmt: str = STAMP_FORMAT) -> Column:
    return F.try_to_timestamp(c.cast("string"), F.lit(fmt))


def to_decimal_kind(c: Column, domain: str | None) -> Column:
    """Decimals: three domains hold timestamps (one in the source's own zone), the rest are numbers."""
    if domain in UTC_STAMP_DOMAINS:
        return to_stamp(c)
    if domain == ZONED_STAMP_DOMAIN:
        return F.to_utc_timestamp(to_stamp(c), SOURCE_ZONE)
    return c.try_cast("double")


def to_hex(c: Column, binary: bool = False) -> Column:
    """Raw bytes (binary, or base64 text) as upper-case hex text."""
    return F.hex(c) if binary else F.hex(F.try_to_binary(c, F.lit("base64")))


def _typed(df: DataFrame, fields: Iterable[FieldType]) -> dict[str, Column]:
    present = {f.name: f.dataType for f in df.schema.fields}
    out: dict[str, Column] = {}
    for field in fields:
        if field.column not in present:
            continue
        c = F.col(f"`{field.column}`")
        if field.kind == "TIMS":
            out[field.column] = to_time_number(c)
        elif field.kind == "DATS":
            out[field.column] = to_date(c)
        elif field.kind == "DEC":
            out[field.column] = to_decimal_kind(c, field.domain)
        elif "INT" in field.kind:
            out[field.column] = c.try_cast("int")
        elif "RAW" in field.kind:
            out[field.column] = to_hex(c, isinstance(present[field.column], T.BinaryType))
    return out


def clean_types(df: DataFrame, fields: Iterable[FieldType]) -> DataFrame:
    """Convert by dictionary type, then normalise what is still text, boolean or numeric."""
    converted = df.withColumns(_typed(df, fields))
    final: dict[str, Column] = {}
    for field in converted.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            final[field.name] = null_words(c)
        elif isinstance(field.dataType, (T.FloatType, T.DecimalType)):
            final[field.name] = c.cast("double")
    return converted.withColumns(final)


def decode_raw(df: DataFrame, fields: Iterable[FieldType]) -> DataFrame:
    return df.withColumns(_typed(df, [f for f in fields if "RAW" in f.kind]))


def clean_iso_stamps(df: DataFrame, fields: Iterable[FieldType]) -> DataFrame:
    return df.withColumns(
        {
            f.column: to_stamp(F.col(f"`{f.column}`"), ISO_MICROS_FORMAT)
            for f in fields
            if f.kind == "date-time" and f.column in df.columns
        }
    )


def parse_replication_stamp(df: DataFrame, column: str) -> DataFrame:
    """Parsed copy of the replication tool's decimal timestamp, if the table has one."""
    if column not in df.columns:
        return df
    return df.withColumn(f"{column}_PARSED", to_stamp(F.col(f"`{column}`")))


Cleaner = Callable[[DataFrame, list[FieldType]], DataFrame]

CLEANERS: dict[str, Cleaner] = {
    "distinct_rows": lambda df, fields: df.distinct(),
    "typed_columns": clean_types,
    "raw_columns": decode_raw,
    "iso_timestamps": clean_iso_stamps,
}


def register_cleaner(name: str, cleaner: Cleaner) -> None:
    """Add a deployment's own cleaner; a second one under the same name is refused."""
    if name in CLEANERS:
        raise ValueError(f"cleaner {name!r} exists already")
    CLEANERS[name] = cleaner


def apply_cleaners(df: DataFrame, names: Iterable[str], fields: list[FieldType]) -> DataFrame:
    for name in names:
        if name not in CLEANERS:
            raise KeyError(f"no cleaner named {name!r}")
        df = df.transform(CLEANERS[name], fields)
    return df
