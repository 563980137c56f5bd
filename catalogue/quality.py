"""Queries on data quality, profiles and forecasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.tables import HORIZONS, items, spec, table
from ledgerline.functions.forecast import (
    DAYS_PER_MONTH,
    DURATIONS,
    LIFETIME_MONTHS,
    MONTHLY_DISCOUNT,
    PurchaseModel,
    ValueModel,
    with_forecast,
)
from ledgerline.operators.columns import quoted
from ledgerline.operators.quality import (
    column_profile,
    key_violations,
    require_rows,
    schema_table,
    with_schema_report,
)
from ledgerline.operators.rfm import rfm_metrics


def pk_violations(spark, sf):
    return key_violations(require_rows(items(spark, sf), "items"), ["item_key"])


def profile_of_lines(spark, sf):
    lines = table(spark, sf, "lineitem").withColumn(
        "l_discount", F.when(F.col("l_discount") > 0, F.col("l_discount"))
    )
    profile = column_profile(lines, exact=True)
    return profile.withColumns({c: F.round(c, 6) for c in ("mean", "stddev", "min", "max")})


def _profile_sql() -> str:
    types = {
        "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
        "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
        "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz",
    }
    parts = []
    for c, t in types.items():
        numeric = t in ("bigint", "double")
        v = "CASE WHEN l_discount > 0 THEN l_discount END" if c == "l_discount" else c

        def stat(f):
            return f"round(CAST({f}({v}) AS DOUBLE), 6)" if numeric else "CAST(NULL AS DOUBLE)"

        parts.append(
            f"""SELECT '{c}' AS column_name, '{t}' AS data_type, {f'count({v})' if numeric else 'CAST(NULL AS BIGINT)'} AS count,
            count(*) - count({v}) AS null_count, count(DISTINCT {v}) + CAST(count(*) > count({v}) AS INTEGER) AS unique_values,
            {stat('avg')} AS mean, {stat('stddev')} AS stddev, {stat('min')} AS min, {stat('max')} AS max FROM lineitem"""
        )
    return " UNION ALL ".join(parts)


def schema_of_orders(spark, sf):
    """Schema table joined with how often each column is filled."""
    orders = table(spark, sf, "orders")
    filled = column_profile(orders).select("column_name", "null_count")
    return schema_table(orders).join(filled, "column_name")


def schema_drift(spark, sf):
    """Orders against a dictionary that lacks two of their columns."""
    reported = with_schema_report(
        table(spark, sf, "orders"),
        ["o_orderkey", "o_custkey", "o_orderdate"],
        ignored=["o_orderstatus"],
        ignored_prefixes=["o_order"],
    )
    return reported.groupBy("engine_schema_mismatch").agg(F.count("*").alias("row_count"))


PURCHASES = PurchaseModel(r=0.243, alpha=4.414, a=0.793, b=2.426)
VALUES = ValueModel(p=6.25, q=3.74, v=15.44)


def _forecast(spark, sf):
    horizon = [HORIZONS[0]]
    metrics = rfm_metrics(items(spark, sf), ["sold_to_key"], "customer", spec(horizons=horizon))
    return with_forecast(metrics, "customer", horizon[0].alias, PURCHASES, VALUES)


def _shown_decimals(column: str) -> int:
    return 2 if "_value_" in column else 6


def forecast_scores(spark, sf):
    """Alive probability, purchases and value forecasts of every customer from exact counts."""
    scored = _forecast(spark, sf)
    names = [c for c in scored.columns if c.endswith("_forecast")]
    return scored.select("primary_key", *[F.round(quoted(c), _shown_decimals(c)).alias(c) for c in names])


def forecast_closed_form(spark, sf):
    """The closed-form part of the forecast: alive probability and value per purchase."""
    alias = HORIZONS[0].alias
    return _forecast(spark, sf).select(
        "primary_key",
        F.round("customer_alive_probability_forecast", 6).alias("alive"),
        F.round("customer_30_day_average_monetary_value_forecast", 4).alias("value_per_purchase"),
    )


def approximate_rfm(spark, sf):
    """Sketched distinct counts at scale settings, as their largest relative error per metric."""
    horizon = [HORIZONS[0]]
    source = items(spark, sf)
    exact = rfm_metrics(source, ["manufacturer_key"], "m", spec(horizons=horizon))
    near = rfm_metrics(source, ["manufacturer_key"], "m", spec(exact=False, horizons=horizon))
    counts = [c for c in exact.columns if "count_since" in c]
    joined = exact.alias("e").join(near.alias("n"), "primary_key")
    return joined.agg(
        F.count("*").alias("groups"),
        *[
            (F.max(F.abs(F.col(f"e.{c}") - F.col(f"n.{c}")) / F.col(f"e.{c}")) < 0.1).alias(f"close_{i}")
            for i, c in enumerate(counts)
        ],
    )


def _forecast_columns() -> dict[str, str]:
    names = {
        "x": "order_header_count", "t": "recency_in_days", "a": "age_in_days",
        "v": "avg_order_value_per_order_header", "f": "has_billing_documents",
    }
    return {k: f"customer_{v}_since_{HORIZONS[0].alias}" for k, v in names.items()}


def _scores_sql() -> str:
    """Every forecast column; the model's series is summed term by term by a recursive table."""
    from catalogue.tables import ITEMS, rfm_sql

    m = _forecast_columns()
    r, alpha, a, b = (f"{v!r}::DOUBLE" for v in (PURCHASES.r, PURCHASES.alpha, PURCHASES.a, PURCHASES.b))
    p, q, v = (f"{x!r}::DOUBLE" for x in (VALUES.p, VALUES.q, VALUES.v))
    months = [DAYS_PER_MONTH * (i + 1) for i in range(LIFETIME_MONTHS)]
    days = ", ".join(f"({d})" for d in sorted({*DURATIONS, *months}))
    odds = f"CASE WHEN x > 0 THEN {a} / ({b} + x - 1) * pow(({alpha} + age) / ({alpha} + t), {r} + x) ELSE 0 END"
    lifetime = f"sum(CASE WHEN d IN ({', '.join(map(str, months))}) THEN each * gained / pow({1 + MONTHLY_DISCOUNT!r}::DOUBLE, d / {DAYS_PER_MONTH}.0) END)"

    def shown(column: str, value: str) -> str:
        name = f"customer_{column}_forecast"
        return f"round({value}, {_shown_decimals(name)}) AS {name}"

    def at(d: int, value: str) -> str:
        return f"max(CASE WHEN d = {d} THEN {value} END)"

    columns = [shown("alive_probability", "max(alive)"), shown("total_lifetime_value", lifetime)]
    for d in DURATIONS:
        columns += [
            shown(f"{d}_day_frequency", at(d, "n")),
            shown(f"{d}_day_average_monetary_value", "max(each)"),
            shown(f"{d}_day_total_value", at(d, "alive * n * each")),
        ]
    return f"""WITH RECURSIVE {ITEMS}, m AS ({rfm_sql('sold_to_key', 'customer', [HORIZONS[0]])}),
fit AS (SELECT primary_key, CAST({m['x']} AS DOUBLE) AS x, CAST({m['t']} AS DOUBLE) AS t, CAST({m['a']} AS DOUBLE) AS age,
    CAST({m['v']} AS DOUBLE) AS mean FROM m WHERE {m['f']} AND {m['v']} > 0 AND {m['t']} < {m['a']}),
spans AS (SELECT *, {a} + {b} + x - 1 AS c, d / ({alpha} + age + d) AS z, {odds} AS odds FROM fit, (VALUES {days}) span(d)),
terms AS (
  SELECT primary_key, d, c, z, 0 AS k, 1::DOUBLE AS term, 1::DOUBLE AS total FROM spans
  UNION ALL
  SELECT primary_key, d, c, z, k + 1, term * grow, total + term * grow
  FROM (SELECT *, ({a} + {b} - 1 - {r} + k) * ({a} - 1 + k) / ((c + k) * (k + 1)) * z AS grow FROM terms) WHERE abs(term) > 1e-15 * abs(total)
), series AS (SELECT primary_key, d, arg_max(total, k) AS h FROM terms GROUP BY primary_key, d),
counted AS (SELECT primary_key, d, c / ({a} - 1) * (1 - pow(1 - z, {a} - 1) * h) / (1 + odds) AS n, 1 / (1 + odds) AS alive,
    {p} * ({v} + x * mean) / ({p} * x + {q} - 1) AS each FROM spans JOIN series USING (primary_key, d)),
gains AS (SELECT *, n - coalesce((SELECT b.n FROM counted b WHERE b.primary_key = counted.primary_key AND b.d = counted.d - {DAYS_PER_MONTH}), 0) AS gained FROM counted)
SELECT m.primary_key, {', '.join(columns)} FROM m LEFT JOIN gains USING (primary_key) GROUP BY m.primary_key"""


def _closed_sql() -> str:
    from catalogue.tables import ITEMS, rfm_sql

    m = _forecast_columns()
    ok = f"{m['f']} AND {m['v']} > 0 AND {m['t']} < {m['a']}"
    odds = f"0.793 / (2.426 + {m['x']} - 1) * pow((4.414 + {m['a']}) / (4.414 + {m['t']}), 0.243 + {m['x']})"
    return f"""WITH {ITEMS}, m AS ({rfm_sql('sold_to_key', 'customer', [HORIZONS[0]])})
SELECT primary_key, CASE WHEN {ok} THEN round(1 / (1 + CAST({odds} AS DOUBLE)), 6) END AS alive,
  CASE WHEN {ok} THEN round(6.25 * (15.44 + {m['x']} * {m['v']}) / (6.25 * {m['x']} + 3.74 - 1), 4) END AS value_per_purchase FROM m"""


QUERIES = {
    "pk_violations": (
        pk_violations,
        "SELECT concat_ws('_|_', l_orderkey, l_linenumber) AS item_key, count(*) AS row_count FROM lineitem GROUP BY 1 HAVING count(*) > 1",
    ),
    "column_profile": (profile_of_lines, _profile_sql()),
    "schema_table": (
        schema_of_orders,
        """SELECT * FROM (VALUES ('o_orderkey', 'bigint'), ('o_custkey', 'bigint'), ('o_orderstatus', 'string'), ('o_totalprice', 'double'),
          ('o_orderdate', 'timestamp_ntz'), ('o_orderpriority', 'string')) t(column_name, data_type)
        JOIN (SELECT 'o_orderkey' AS column_name, count(*) - count(o_orderkey) AS null_count FROM orders
          UNION ALL SELECT 'o_custkey', count(*) - count(o_custkey) FROM orders UNION ALL SELECT 'o_orderstatus', count(*) - count(o_orderstatus) FROM orders
          UNION ALL SELECT 'o_totalprice', count(*) - count(o_totalprice) FROM orders UNION ALL SELECT 'o_orderdate', count(*) - count(o_orderdate) FROM orders
          UNION ALL SELECT 'o_orderpriority', count(*) - count(o_orderpriority) FROM orders) USING (column_name)""",
    ),
    "schema_drift": (
        schema_drift,
        "SELECT 'columns missing from the dictionary: o_totalprice' AS engine_schema_mismatch, count(*) AS row_count FROM orders",
    ),
    "forecast_scores": (forecast_scores, _scores_sql()),
    "forecast_closed_form": (forecast_closed_form, _closed_sql()),
    "approximate_rfm": (
        approximate_rfm,
        """SELECT count(DISTINCT l_suppkey) AS groups, true AS close_0, true AS close_1, true AS close_2, true AS close_3, true AS close_4 FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate >= DATE '2000-01-01' AND o_orderpriority <> '5-LOW'""",
    ),
}
