"""Queries on change logs, unions, incremental runs, streams and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.tables import ITEMS, items, table
from ledgerline.metadata.lookup import metadata_diffs
from ledgerline.metadata.schemas import FIELDS, LINKS, OBJECTS, Metadata, conform
from ledgerline.operators.dedup import distinct_rows, latest_rows, one_per_key
from ledgerline.operators.filters import drop_deletions
from ledgerline.operators.joins import upsert
from ledgerline.operators.sets import changed_names, lineage_union, row_counts, wide_union
from ledgerline.session import scratch_folder as scratch
from ledgerline.sources.readers import read_components, read_stream, read_tab_file
from ledgerline.sources.writers import write_batch, write_outputs
from ledgerline.streaming.changelog import current_rows, read_state, reenrich, run_changelog
from ledgerline.streaming.windows import closed_windows, late_rows, tumbling_totals


def changes_of(events):
    """Events as a change log: deletions, an unknown mode, and two comparison columns."""
    return events.select(
        "user_id", "event_id", "ts", "event_type", "value",
        F.when(F.col("event_type") == "error", "D").when(F.col("event_type") != "signup", "U").alias("mode"),
    )


_CHANGES = """changes AS (SELECT user_id, event_id, CAST(ts AS TIMESTAMP) AS ts, event_type, value,
  CASE WHEN event_type = 'error' THEN 'D' WHEN event_type <> 'signup' THEN 'U' END AS mode FROM events)"""


def changelog_current(spark, sf):
    changes = changes_of(table(spark, sf, "events"))
    return drop_deletions(latest_rows(changes, ["user_id"], ["ts", "event_id"], True), "MODE")


def changelog_ties(spark, sf):
    """Every event of a user's last day: ties on the comparison column are kept."""
    changes = changes_of(table(spark, sf, "events")).withColumn("day", F.col("ts").cast("date"))
    return latest_rows(changes, ["user_id"], ["day"])


def changelog_upsert(spark, sf):
    changes = changes_of(table(spark, sf, "events"))
    old = latest_rows(changes.filter("ts < '2024-01-29'"), ["user_id"], ["ts", "event_id"], True)
    new = latest_rows(changes.filter("ts >= '2024-01-29'"), ["user_id"], ["ts", "event_id"], True)
    return upsert(new, old, "user_id")


def changelog_stream(spark, sf):
    """The change log as a stream of files, folded into state by micro-batches.

    The events arrive in four batches that each hold changes of the whole time, so that later
    batches bring records older than the state.
    """
    folder = scratch(spark)
    events = table(spark, sf, "events")
    events.repartition(4, "event_id").write.parquet(f"{folder}/events")
    stream = read_stream(spark, f"{folder}/events", events.schema, files_per_batch=1)
    query = run_changelog(
        changes_of(stream), f"{folder}/state", f"{folder}/offsets", "user_id", ["ts", "event_id"]
    )
    query.awaitTermination()
    return current_rows(read_state(spark, f"{folder}/state"), "mode")


def events_tumbling(spark, sf):
    return tumbling_totals(table(spark, sf, "events"), "ts", "value", ["event_type"], "6 hours")


def events_tumbling_stream(spark, sf):
    """All windows of the events as a stream; a marker behind the last one closes it."""
    schema = table(spark, sf, "events").schema
    windows = closed_windows(
        spark, f"{sf}/events.parquet*", schema, scratch(spark), "ts", "value", ["event_type"], "6 hours", "1 hour"
    )
    return windows.withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")}
    )


def events_late_rows(spark, sf):
    """Events that arrive in three deliveries, ten days each; every tenth event comes one or two
    deliveries after its own.  What comes after its window was closed is counted apart."""
    events, folder = table(spark, sf, "events"), scratch(spark)
    day, slow = F.dayofmonth("ts"), F.when(F.col("event_id") % 10 == 0, F.col("event_id") % 20 / 10 + 1).otherwise(0)
    delivered = events.withColumn("delivery", F.least(F.floor((day - 1) / 10) + slow, F.lit(2)))
    for number in range(3):
        delivered.where(F.col("delivery") == number).drop("delivery").write.mode("append").parquet(f"{folder}/in")
        windows = closed_windows(
            spark, f"{folder}/in", events.schema, f"{folder}/out", "ts", "value", ["event_type"], "6 hours", "1 hour",
            files_per_batch=1_000_000, close=number == 2,
        )
    late = tumbling_totals(
        late_rows(spark, f"{folder}/out").withColumn("ts", F.col("ts").cast("timestamp")), "ts", "value", ["event_type"], "6 hours"
    )
    both = windows.withColumn("late", F.lit(False)).unionByName(late.withColumn("late", F.lit(True)))
    return both.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


def changed_lookup_rows(spark, sf):
    """Recent orders with their customer, and earlier orders again where the customer changed."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("order_date")
    )
    lookup = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    changed = lookup.filter("c_mktsegment = 'BUILDING'")
    return reenrich(
        orders.filter("order_date >= '2000-01-01'"),
        orders.filter("order_date < '2000-01-01'"),
        lookup,
        changed,
        [("o_custkey", "c_custkey")],
    )


def partners_union(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("partner_key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("partner_key"), F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name")
    )
    return wide_union([customers, suppliers])


def component_union(spark, sf):
    """Two batch components of one table with their lineage, counted per component."""
    nation = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return (
        lineage_union({"open": nation.filter("o_orderstatus = 'O'"), "other": nation.filter("o_orderstatus != 'O'")})
        .groupBy("source_dataset_name", "o_orderstatus")
        .agg(F.count("*").alias("row_count"))
    )


def written_components(spark, sf):
    """Components written by append and replace, then scanned together."""
    folder = scratch(spark)
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    write_batch(orders, f"{folder}/a", replace=True)
    write_batch(orders.filter("o_orderstatus = 'O'"), f"{folder}/a", replace=True)
    write_batch(orders.filter("o_orderstatus = 'P'"), f"{folder}/a")
    write_batch(orders.filter("o_orderstatus = 'none'"), f"{folder}/a")
    write_outputs(
        orders,
        {
            f"{folder}/b": lambda df: df.filter("o_orderstatus = 'F'"),
            f"{folder}/c": lambda df: df.filter("o_orderstatus = 'O'").distinct(),
        },
    )
    return (
        read_components(spark, folder, ["a", "b", "c"])
        .groupBy("source_dataset_name", "o_orderstatus")
        .agg(F.count("*").alias("row_count"))
    )


def tab_separated_parts(spark, sf):
    """Products exported as tab-separated text with camel-case headers and read back."""
    folder = scratch(spark)
    table(spark, sf, "part").select(
        F.col("p_partkey").alias("ProductNo"),
        F.col("p_name").alias("DrugName"),
        F.concat(F.lit('say "'), F.col("p_type"), F.lit('"')).alias("TECode"),
        F.col("p_brand").alias("SponsorApplNo_ID"),
    ).write.option("sep", "\t").option("header", True).option("escape", '"').csv(folder)
    return read_tab_file(spark, folder)


def row_count_report(spark, sf):
    tables = {
        "orders": table(spark, sf, "orders").withColumn("source", F.col("o_orderstatus")),
        "lineitem": table(spark, sf, "lineitem").withColumn("source", F.col("l_linestatus")),
        "customer": table(spark, sf, "customer").withColumn("source", F.lit("erp")),
    }
    return row_counts(tables)


def _catalogue(billed):
    """What each supplier delivered, in the shape of metadata."""
    pairs = billed.select(F.col("manufacturer_key").alias("object_name"), F.col("product_key").alias("raw_field_name")).distinct()
    objects = billed.groupBy(F.col("manufacturer_key").alias("object_name")).agg(
        F.array(F.min("plant_key")).alias("primary_key_raw_fields")
    )
    links = billed.filter("billed_quantity > 49").select(
        F.col("manufacturer_key").alias("primary_object_name"), F.col("plant_key").alias("foreign_object_name")
    ).distinct()
    return Metadata(conform(objects, OBJECTS), conform(pairs, FIELDS), conform(links, LINKS))


def _before_last(billed, days):
    """Items up to some days before the last one."""
    last = billed.agg(F.max("billing_date")).first()[0]
    return billed.filter(F.col("billing_date") <= F.date_sub(F.lit(last), days))


def metadata_diff(spark, sf):
    """Suppliers that the last day changed, all deliveries against all before that day."""
    names = table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("table_name"))
    billed = items(spark, sf)
    return metadata_diffs(names, _catalogue(billed), _catalogue(_before_last(billed, 1)))


def _diff_sql() -> str:
    def catalogue(name, days):
        where = f"FROM items WHERE billing_date <= (SELECT max(billing_date) FROM items) - {days}"
        return f"""{name}_f AS (SELECT DISTINCT manufacturer_key, product_key {where}),
          {name}_l AS (SELECT DISTINCT manufacturer_key, plant_key {where} AND billed_quantity > 49),
          {name}_o AS (SELECT DISTINCT manufacturer_key, min(plant_key) AS k {where} GROUP BY 1)"""

    changed = " UNION ".join(
        f"SELECT manufacturer_key FROM (SELECT * FROM {a}_{k} EXCEPT SELECT * FROM {b}_{k})"
        for k in ("f", "l", "o")
        for a, b in (("n", "p"), ("p", "n"))
    )
    return f"""WITH {ITEMS}, {catalogue('n', 0)}, {catalogue('p', 1)},
c AS ({changed})
SELECT CAST(s_suppkey AS VARCHAR) AS table_name, CAST(s_suppkey AS VARCHAR) IN (SELECT manufacturer_key FROM c) AS has_changed FROM supplier"""


def changed_products(spark, sf):
    """Suppliers that delivered a product on the last day that they never had before."""
    billed = items(spark, sf)

    def delivered(df):
        return df.select("manufacturer_key", "product_key").distinct()

    return changed_names(delivered(billed), delivered(_before_last(billed, 1)), "manufacturer_key")


def first_order_per_customer(spark, sf):
    return one_per_key(
        table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus"), ["o_custkey"], ["o_orderkey"]
    )


def distinct_flags(spark, sf):
    return distinct_rows(table(spark, sf, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus"))


_TUMBLING = """SELECT time_bucket(INTERVAL 6 HOUR, CAST(ts AS TIMESTAMP)) AS window_start,
  time_bucket(INTERVAL 6 HOUR, CAST(ts AS TIMESTAMP)) + INTERVAL 6 HOUR AS window_end, event_type,
  count(*) AS event_count, CAST(sum(CAST(value AS DECIMAL(18, 4))) AS DOUBLE) AS total_value FROM events GROUP BY ALL"""

_LATE = """WITH e AS (SELECT *, CAST(ts AS TIMESTAMP) AS t, time_bucket(INTERVAL 6 HOUR, CAST(ts AS TIMESTAMP)) AS window_start,
    least((dayofmonth(CAST(ts AS TIMESTAMP)) - 1) // 10 + CASE WHEN event_id % 10 = 0 THEN event_id % 20 // 10 + 1 ELSE 0 END, 2) AS delivery FROM events),
  seen AS (SELECT delivery, max(max(t)) OVER (ORDER BY delivery ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
    FROM e GROUP BY delivery)
SELECT window_start, window_start + INTERVAL 6 HOUR AS window_end, event_type, count(*) AS event_count,
  CAST(sum(CAST(value AS DECIMAL(18, 4))) AS DOUBLE) AS total_value,
  coalesce(window_start + INTERVAL 6 HOUR <= before - INTERVAL 1 HOUR, false) AS late
FROM e JOIN seen USING (delivery) GROUP BY ALL"""

_LATEST = f"""WITH {_CHANGES} SELECT * FROM changes
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""

QUERIES = {
    "changelog_current": (changelog_current, f"SELECT * FROM ({_LATEST}) WHERE mode <> 'D'"),
    "changelog_ties": (
        changelog_ties,
        f"""WITH {_CHANGES} SELECT *, CAST(ts AS DATE) AS day FROM changes
        QUALIFY rank() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE) DESC) = 1""",
    ),
    "changelog_upsert": (changelog_upsert, _LATEST),
    "changelog_stream": (changelog_stream, f"SELECT * FROM ({_LATEST}) WHERE mode <> 'D'"),
    "events_tumbling": (events_tumbling, _TUMBLING),
    "events_tumbling_stream": (events_tumbling_stream, _TUMBLING),
    "events_late_rows": (events_late_rows, _LATE),
    "changed_lookup_rows": (
        changed_lookup_rows,
        """SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS order_date, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey
        WHERE o_orderdate >= DATE '2000-01-01' OR c_mktsegment = 'BUILDING'""",
    ),
    "wide_union": (
        partners_union,
        """SELECT c_custkey AS partner_key, c_name AS name, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS balance FROM customer
        UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier""",
    ),
    "component_union": (
        component_union,
        "SELECT CASE WHEN o_orderstatus = 'O' THEN 'open' ELSE 'other' END AS source_dataset_name, o_orderstatus, count(*) AS row_count FROM orders GROUP BY ALL",
    ),
    "written_components": (
        written_components,
        """SELECT d AS source_dataset_name, o_orderstatus, count(*) AS row_count FROM (
          SELECT 'a' AS d, o_orderstatus FROM orders WHERE o_orderstatus IN ('O', 'P')
          UNION ALL SELECT 'b', o_orderstatus FROM orders WHERE o_orderstatus = 'F'
          UNION ALL SELECT 'c', o_orderstatus FROM orders WHERE o_orderstatus = 'O') GROUP BY ALL""",
    ),
    "tab_separated_parts": (
        tab_separated_parts,
        """SELECT CAST(p_partkey AS VARCHAR) AS product_no, p_name AS drug_name, 'say "' || p_type || '"' AS te_code,
          p_brand AS sponsor_appl_no_id FROM part""",
    ),
    "row_counts": (
        row_count_report,
        """SELECT o_orderstatus AS source, 'orders' AS "table", count(*) AS count FROM orders GROUP BY ALL
        UNION ALL SELECT l_linestatus, 'lineitem', count(*) FROM lineitem GROUP BY ALL
        UNION ALL SELECT 'erp', 'customer', count(*) FROM customer""",
    ),
    "metadata_diff": (metadata_diff, _diff_sql()),
    "changed_names": (
        changed_products,
        f"""WITH {ITEMS}, a AS (SELECT DISTINCT manufacturer_key, product_key FROM items),
        b AS (SELECT DISTINCT manufacturer_key, product_key FROM items WHERE billing_date <= (SELECT max(billing_date) FROM items) - 1)
        SELECT DISTINCT manufacturer_key AS table_name FROM ((SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL (SELECT * FROM b EXCEPT SELECT * FROM a))""",
    ),
    "first_per_key": (
        first_order_per_customer,
        "SELECT o_custkey, min(o_orderkey) AS o_orderkey, arg_min(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders GROUP BY 1",
    ),
    "distinct_rows": (distinct_flags, "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem"),
}
