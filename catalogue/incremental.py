"""Queries on incremental jobs: orders arrive in landing folders and are folded run by run."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import functions as F

from catalogue.staging import _CLEANED, _CURRENT, _raw_orders, _raw_texts, SOURCE, metadata
from catalogue.tables import table
from ledgerline.operators.quality import ExpectationFailed, filled_columns, not_empty, unique_keys
from ledgerline.plans.layer import Layer
from ledgerline.session import scratch_folder as scratch
from ledgerline.streaming.runs import MetadataState, Output

DAYS = ("19970101", "19990101")  # the orders come in three parts
START = dt.datetime(2030, 1, 1)
KEPT = MetadataState(START - dt.timedelta(1), False, "1")


def _at(hour):
    return START + dt.timedelta(hours=hour)


def _layer(spark, source=SOURCE):
    folder = scratch(spark)
    landing = {
        "ORD": {name: f"{folder}/landing/{name}" for name in ("orders_open", "orders_rest")},
        "TXT": {"customer_texts": f"{folder}/landing/customer_texts"},
    }
    return Layer(source, landing, f"{folder}/layer")


def _land(layer, name, frames, condition="true"):
    for component, df in frames.items():
        df.filter(condition).write.mode("append").parquet(layer.components[name][component])


def _parts():
    first, second = DAYS
    return f"ERDAT < '{first}'", f"ERDAT >= '{first}' AND ERDAT < '{second}'", f"ERDAT >= '{second}'"


def incremental_current(spark, sf):
    """Current customers after three runs of every stage, each on the rows added to it."""
    layer, meta = _layer(spark), metadata(spark)
    _land(layer, "TXT", _raw_texts(spark, sf))
    layer.clean(spark, "TXT", meta, KEPT, now=_at(0))
    orders = _raw_orders(spark, sf)
    for hour, part in enumerate(_parts()):
        _land(layer, "ORD", orders, part)
        layer.clean(spark, "ORD", meta, KEPT, now=_at(hour))
        layer.enrich(spark, "ORD", meta, now=_at(hour))
        layer.keep_current(spark, "ORD", meta, now=_at(hour))
    return layer.output("current", "ORD").read(spark)


def _cleaned_twice(spark, sf):
    layer, meta = _layer(spark), metadata(spark)
    orders = _raw_orders(spark, sf)
    first, second, _ = _parts()
    _land(layer, "ORD", orders, first)
    layer.clean(spark, "ORD", meta, KEPT, now=_at(0))
    _land(layer, "ORD", orders, second)
    layer.clean(spark, "ORD", meta, KEPT, now=_at(1))
    return layer, meta, orders


def incremental_added(spark, sf):
    """What the second run read and cleaned."""
    layer, _, _ = _cleaned_twice(spark, sf)
    return layer.output("cleaned", "ORD").read(spark, "added")


def incremental_previous(spark, sf):
    """What the output held before the second run."""
    layer, _, _ = _cleaned_twice(spark, sf)
    return layer.output("cleaned", "ORD").read(spark, "previous")


def incremental_marks(spark, sf):
    """Runs on nothing new, on changed metadata, on added rows after it, on a new column and on
    request: kind and rows of each, and rows readable after it."""
    layer, meta, orders = _cleaned_twice(spark, sf)
    output = layer.output("cleaned", "ORD")
    counts = []

    def note(mark):
        if mark is not None:
            rows = spark.read.parquet(output.data(mark.run)).count()
            counts.append((mark.run, mark.kind, len(mark.columns), rows, output.read(spark).count()))

    note(output.marks(spark)[0])
    counts[-1] = (*counts[-1][:4], output.read(spark, "previous").count())
    note(output.last(spark))
    note(layer.clean(spark, "ORD", meta, KEPT, now=_at(2)))  # nothing new, no run
    unchanged = MetadataState(_at(2), False, "2")
    note(layer.clean(spark, "ORD", meta, unchanged, now=_at(3)))  # newer, but not for this table
    changed = MetadataState(_at(3), True, "3")
    note(layer.clean(spark, "ORD", meta, changed, now=_at(4)))
    third = _parts()[2]
    _land(layer, "ORD", orders, third)
    note(layer.clean(spark, "ORD", meta, changed, now=_at(5)))  # older than the last run
    wider = {name: df.filter("ERDAT < '19960101'").withColumn("NEWCOL", F.lit("x")) for name, df in orders.items()}
    _land(layer, "ORD", wider)
    note(layer.clean(spark, "ORD", meta, changed, now=_at(6)))
    note(layer.clean(spark, "ORD", meta, changed, incremental=False, now=_at(7)))
    schema = "run long, kind string, columns int, rows_written long, rows_readable long"
    return spark.createDataFrame(counts, schema)


_CHANGING = replace(
    SOURCE,
    tables=tuple(
        replace(t, comparison_columns=("AEDAT",)) if t.name == "TXT" else t for t in SOURCE.tables
    ),
)


def incremental_customization(spark, sf):
    """Customers of one segment are renamed after their orders were enriched: the orders are
    enriched again, and the state follows."""
    layer, meta = _layer(spark, _CHANGING), metadata(spark)
    texts = _raw_texts(spark, sf)["customer_texts"]
    _land(layer, "TXT", {"customer_texts": texts.withColumn("AEDAT", F.lit("20200101"))})
    _land(layer, "ORD", _raw_orders(spark, sf))
    for name in ("TXT", "ORD"):
        layer.clean(spark, name, meta, KEPT, now=_at(0))
    layer.enrich(spark, "ORD", meta, now=_at(0))
    layer.keep_current(spark, "ORD", meta, now=_at(0))
    renamed = texts.filter("SEGM = 'BUILDING'").withColumns({"SEGM": F.lit("HOUSES"), "AEDAT": F.lit("20210101")})
    _land(layer, "TXT", {"customer_texts": renamed})
    layer.clean(spark, "TXT", meta, KEPT, now=_at(1))
    layer.enrich(spark, "ORD", meta, now=_at(1))
    layer.keep_current(spark, "ORD", meta, now=_at(1))
    kept = layer.output("current", "ORD").read(spark)
    segment = next(c for c in kept.columns if c.startswith("segment_|_segm"))
    return kept.groupBy(F.col(f"`{segment}`").alias("segment")).agg(F.count("*").alias("row_count"))


def expected_outputs(spark, sf):
    """Six runs of outputs with checks: items by keys that repeat (a warning), without a row, with
    null keys and with repeated keys that must not be (all three stopped), then in good order."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    attempts = [
        (lines, [not_empty(), unique_keys(["l_orderkey"])]),
        (lines, [not_empty(), unique_keys(["l_orderkey", "l_linenumber"])]),
        (lines.filter("l_quantity < 0"), [not_empty()]),
        (lines.withColumn("l_orderkey", F.expr("nullif(l_linenumber, 1)")), [filled_columns(["l_orderkey"])]),
        (lines, [not_empty(), unique_keys(["l_orderkey"], fails=True)]),
        (lines.select("l_orderkey").distinct(), [not_empty(), filled_columns(["l_orderkey"]), unique_keys(["l_orderkey"], fails=True)]),
    ]
    output, rows = Output(scratch(spark)), []
    for number, (df, expectations) in enumerate(attempts, 1):
        stopped = ""
        try:
            output.commit(df, None, output.last(spark), "snapshot", now=_at(number), expectations=expectations)
        except ExpectationFailed as e:
            stopped = str(e)
        mark = output.last(spark)
        rows.append((number, stopped, "; ".join(mark.warnings), mark.run, output.read(spark).count()))
    return spark.createDataFrame(rows, "attempt long, stopped string, warnings string, run long, rows_readable long")


_BEFORE = "strftime(CAST(o_orderdate AS TIMESTAMP), '%Y%m%d')"

_MARKS = f"""WITH n AS (SELECT count(*) FILTER ({_BEFORE} < '{DAYS[0]}') AS a,
  count(*) FILTER ({_BEFORE} >= '{DAYS[0]}' AND {_BEFORE} < '{DAYS[1]}') AS b,
  count(*) FILTER ({_BEFORE} >= '{DAYS[1]}') AS c, count(*) FILTER ({_BEFORE} < '19960101') AS d FROM orders)
SELECT 1::BIGINT AS run, 'snapshot' AS kind, 15 AS columns, a AS rows_written, a AS rows_readable FROM n
UNION ALL SELECT 2, 'added', 15, b, a + b FROM n
UNION ALL SELECT 3, 'snapshot', 15, a + b, a + b FROM n
UNION ALL SELECT 4, 'added', 15, c, a + b + c FROM n
UNION ALL SELECT 5, 'snapshot', 17, a + b + c + d, a + b + c + d FROM n
UNION ALL SELECT 6, 'snapshot', 17, a + b + c + d, a + b + c + d FROM n"""

_EXPECTED = """WITH n AS (SELECT count(*) AS a, count(DISTINCT l_orderkey) AS b FROM lineitem),
r AS (SELECT CASE WHEN count(DISTINCT l_orderkey) < count(*) THEN 'unique: l_orderkey' ELSE '' END AS w FROM lineitem),
k AS (SELECT CASE WHEN count(*) > 0 THEN 'unique: l_orderkey, l_linenumber' ELSE '' END AS w
  FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1))
SELECT 1::BIGINT AS attempt, '' AS stopped, r.w AS warnings, 1::BIGINT AS run, a AS rows_readable FROM n, r
UNION ALL SELECT 2, '', k.w, 2, a FROM n, k
UNION ALL SELECT 3, 'not empty', k.w, 2, a FROM n, k
UNION ALL SELECT 4, 'filled: l_orderkey', k.w, 2, a FROM n, k
UNION ALL SELECT 5, r.w, k.w, 2, a FROM n, k, r
UNION ALL SELECT 6, '', '', 3, b FROM n"""

QUERIES = {
    "expected_outputs": (expected_outputs, _EXPECTED),
    "incremental_current": (incremental_current, f"WITH {_CURRENT} SELECT * FROM current_rows"),
    "incremental_added": (
        incremental_added,
        f"""WITH {_CLEANED} SELECT * FROM cleaned WHERE "ERDAT" >= DATE '1997-01-01' AND "ERDAT" < DATE '1999-01-01'""",
    ),
    "incremental_previous": (
        incremental_previous, f"""WITH {_CLEANED} SELECT * FROM cleaned WHERE "ERDAT" < DATE '1997-01-01'"""
    ),
    "incremental_marks": (incremental_marks, _MARKS),
    "incremental_customization": (
        incremental_customization,
        f"""WITH {_CURRENT} SELECT CASE WHEN s = 'BUILDING' THEN 'HOUSES' ELSE s END AS segment, count(*) AS row_count
        FROM (SELECT "segment_|_segm_|_customization_field_TXT_|_MANDT_KUNNR_SPRAS" AS s FROM current_rows) GROUP BY 1""",
    ),
}
