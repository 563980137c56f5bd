"""Data-quality checks and column profiles.  Checks return tables, so a caller decides what fails."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from ledgerline.operators.columns import quoted

_NUMERIC = (T.DoubleType, T.LongType, T.DecimalType)


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*[quoted(k) for k in keys]).agg(F.count("*").alias("row_count")).filter(
        "row_count > 1"
    )


def keys_are_unique(df: DataFrame, keys: Sequence[str]) -> bool:
    """One aggregate; the key tuples of a table with no repeated key are as many as its rows."""
    return key_violations(df, keys).isEmpty()


class ExpectationFailed(ValueError):
    """An output did not hold what it must."""


@dataclass(frozen=True)
class Expectation:
    """What an output has to hold: an aggregate over its rows, or keys that occur once.

    ``fails`` stops the run that writes the output; otherwise the run is committed with a warning.
    """

    name: str
    holds: Column | None = None  # a boolean aggregate without DISTINCT
    unique: tuple[str, ...] = ()
    fails: bool = True


def not_empty(fails: bool = True) -> Expectation:
    return Expectation("not empty", F.count(F.lit(1)) > 0, fails=fails)


def filled_columns(columns: Sequence[str], fails: bool = True) -> Expectation:
    """No null in any of the columns."""
    missing = F.count_if(F.greatest(F.lit(False), *[quoted(c).isNull() for c in columns]))
    return Expectation(f"filled: {', '.join(columns)}", missing == 0, fails=fails)


def unique_keys(keys: Sequence[str], fails: bool = False) -> Expectation:
    return Expectation(f"unique: {', '.join(keys)}", unique=tuple(keys), fails=fails)


def write_expected(
    df: DataFrame, write: Callable[[DataFrame], DataFrame], expectations: Sequence[Expectation]
) -> list[str]:
    """Write rows and tell what they do not hold; raises if that must stop the run.

    Aggregates are observed on the write itself, so nothing is computed twice.  Uniqueness needs
    the keys exchanged: it reads the key columns, and only those, of the table ``write`` returns.
    """
    observed = {f"e{i}": e for i, e in enumerate(expectations) if e.holds is not None}
    observation = Observation() if observed else None
    watched = df.observe(observation, *[e.holds.alias(n) for n, e in observed.items()]) if observed else df
    written = write(watched)
    seen = observation.get if observation else {}
    broken = [e for n, e in observed.items() if not seen[n]]
    broken += [e for e in expectations if e.unique and not keys_are_unique(written, e.unique)]
    failed = [e.name for e in broken if e.fails]
    if failed:
        raise ExpectationFailed("; ".join(failed))
    return [e.name for e in expectations if any(e is b for b in broken)]


def require_rows(df: DataFrame, name: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{name} is empty")
    return df


def require_columns(df: DataFrame, columns: Sequence[str], where: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{where}: no columns {missing}, only {df.columns}")


def require_single(rows: Sequence, what: str):
    if len(rows) != 1:
        raise ValueError(f"{what}: expected one entry, found {len(rows)}")
    return rows[0]


def schema_table(df: DataFrame) -> DataFrame:
    """Column names and types as a table."""
    rows = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column_name string, data_type string")


def _value(i: int, f: T.StructField) -> Column:
    """One value of column ``i`` as a narrow struct; equal values and only those are equal in it."""
    c, t = quoted(f.name), f.dataType
    whole, real, text = F.lit(None).cast("long"), F.lit(None).cast("double"), F.lit(None).cast("string")
    if isinstance(t, (T.IntegralType, T.BooleanType)):
        whole = c.cast("long")
    elif isinstance(t, T.DateType):
        whole = F.unix_date(c).cast("long")
    elif isinstance(t, T.TimestampType):
        whole = F.unix_micros(c)
    elif isinstance(t, T.FractionalType) and not isinstance(t, T.DecimalType):
        real = c.cast("double")
    elif isinstance(t, T.BinaryType):
        text = F.hex(c)
    elif isinstance(t, (T.StructType, T.ArrayType, T.MapType)):
        text = F.when(c.isNotNull(), F.to_json(F.struct(c)))
    else:
        text = c.cast("string")
    return F.struct(F.lit(i).alias("i"), whole.alias("whole"), real.alias("real"), text.alias("text"))


def distinct_values(df: DataFrame) -> DataFrame:
    """Exact number of distinct values, nulls apart, by column number: (``i``, ``distinct_values``).

    Rows become narrow (column, value) pairs that are combined before they are exchanged, whatever
    the number of columns.  Zeros of either sign are equal, and so are all NaN.
    """
    pairs = df.select(F.explode(F.array(*[_value(i, f) for i, f in enumerate(df.schema.fields)])).alias("v"))
    held = pairs.select("v.*").where("whole IS NOT NULL OR real IS NOT NULL OR text IS NOT NULL")
    return held.distinct().groupBy("i").agg(F.count("*").alias("distinct_values"))


def column_profile(df: DataFrame, exact: bool = False) -> DataFrame:
    """Count, nulls, distinct values and (for double, long and decimal columns) statistics.

    All columns are measured in one aggregate over one scan; its single row is then turned into
    one row per column.  Exact distinct values are counted from (column, value) pairs by a second
    scan.  A null counts as one distinct value.
    """
    none = F.lit(None).cast("double")
    measures: list[Column] = []
    rows: list[Column] = []
    for i, f in enumerate(df.schema.fields):
        c = quoted(f.name)
        numeric = isinstance(f.dataType, _NUMERIC)
        measures += [F.count(c).alias(f"n{i}"), F.count_if(c.isNull()).alias(f"z{i}")]
        if not exact:
            measures.append(F.approx_count_distinct(c).alias(f"d{i}"))
        if numeric:
            x = c.cast("double")
            measures += [
                F.avg(x).alias(f"a{i}"),
                F.stddev(x).alias(f"s{i}"),
                F.min(x).alias(f"l{i}"),
                F.max(x).alias(f"h{i}"),
            ]
        rows.append(
            F.struct(
                F.lit(i).alias("i"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                (F.col(f"n{i}") if numeric else F.lit(None).cast("long")).alias("count"),
                F.col(f"z{i}").alias("null_count"),
                (F.lit(None).cast("long") if exact else F.col(f"d{i}")).alias("distinct_values"),
                (F.col(f"a{i}") if numeric else none).alias("mean"),
                (F.col(f"s{i}") if numeric else none).alias("stddev"),
                (F.col(f"l{i}") if numeric else none).alias("min"),
                (F.col(f"h{i}") if numeric else none).alias("max"),
            )
        )
    profile = df.agg(*measures).select(F.inline(F.array(*rows)))
    if exact:
        profile = profile.drop("distinct_values").join(distinct_values(df), "i", "left")
    values = F.coalesce("distinct_values", F.lit(0)) + F.when(F.col("null_count") > 0, 1).otherwise(0)
    return profile.select(
        "column_name", "data_type", "count", "null_count", values.alias("unique_values"),
        "mean", "stddev", "min", "max",
    )


def undeclared_columns(
    df: DataFrame,
    declared: Sequence[str],
    ignored: Sequence[str] = (),
    ignored_prefixes: Sequence[str] = (),
) -> list[str]:
    """Columns of the data that its dictionary does not know, sorted."""
    known = set(declared) | set(ignored)
    return sorted(
        c for c in df.columns if c not in known and not c.startswith(tuple(ignored_prefixes) or ("\0",))
    )


def with_schema_report(
    df: DataFrame,
    declared: Sequence[str],
    ignored: Sequence[str] = (),
    ignored_prefixes: Sequence[str] = (),
    column: str = "engine_schema_mismatch",
) -> DataFrame:
    """The table plus, only if it has undeclared columns, a column that lists them."""
    extra = undeclared_columns(df, declared, ignored, ignored_prefixes)
    if not extra:
        return df
    return df.withColumn(column, F.lit(f"columns missing from the dictionary: {', '.join(extra)}"))


def schema_matches(df: DataFrame, column: str = "engine_schema_mismatch") -> bool:
    """No report column, or nothing in it."""
    return column not in df.columns or df.filter(quoted(column).isNotNull()).isEmpty()
