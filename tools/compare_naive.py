"""Time the rewritten operators against their plain forms and print a table.

    python tools/compare_naive.py [sf_dir [first words of operator names]]

Shown are seconds and the megabytes written to shuffle files; both forms are checked to give
equally many rows.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

from pyspark.sql import Window, functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from catalogue.tables import HORIZONS, items, spec  # noqa: E402
from ledgerline.operators.filters import is_subset  # noqa: E402
from ledgerline.operators.joins import members_of, merge_metric_sets, subset_pairs  # noqa: E402
from ledgerline.operators.rfm import rfm_metrics, with_ranks_and_shares  # noqa: E402
from ledgerline.operators.series import cumulative_sets, daily_series  # noqa: E402
from ledgerline.session import local_session  # noqa: E402


def horizons_naive(spark, sf):
    source = items(spark, sf)
    return merge_metric_sets(
        [rfm_metrics(source, ["sold_to_key"], "c", spec(horizons=[h])) for h in HORIZONS], "primary_key"
    )


def horizons(spark, sf):
    return rfm_metrics(items(spark, sf), ["sold_to_key"], "c", spec())


def cumulative_naive(spark, sf):
    daily = items(spark, sf).groupBy("manufacturer_key", "billing_date").agg(
        F.collect_set("product_key").alias("products")
    )
    return cumulative_sets(daily, ["manufacturer_key"], "billing_date", "products", "seen").drop("seen", "products")


def cumulative(spark, sf):
    return daily_series(
        items(spark, sf), ["manufacturer_key"], "billing_date", ["sales_value"], {"product": "product_key"}, ["product"]
    )


def _values(spark, sf):
    return items(spark, sf).groupBy(F.concat_ws("-", "sold_to_key", "product_key").alias("primary_key")).agg(
        F.sum("sales_value").alias("value")
    )


def ranks_naive(spark, sf):
    everything = Window.orderBy(F.col("value").desc())
    return _values(spark, sf).withColumns(
        {"rank": F.row_number().over(everything), "running": F.sum("value").over(everything)}
    )


def ranks(spark, sf):
    return with_ranks_and_shares(_values(spark, sf), ["value"])


def _sets(spark, sf):
    source = items(spark, sf)
    small = source.groupBy("header_key").agg(F.collect_set("product_key").alias("s"))
    large = source.groupBy("sold_to_key").agg(F.collect_set("product_key").alias("l"))
    return small, large


def subsets_naive(spark, sf):
    small, large = _sets(spark, sf)
    return small.join(large, is_subset(F.col("s"), F.col("l"))).select("header_key", "sold_to_key")


def subsets(spark, sf):
    small, large = _sets(spark, sf)
    return subset_pairs(
        members_of(small, "header_key", "s"), members_of(large, "sold_to_key", "l"), "header_key", "sold_to_key"
    )


PAIRS = {
    "horizons (AGG-2)": (horizons_naive, horizons),
    "cumulative distinct (WIN-4)": (cumulative_naive, cumulative),
    "global ranks (WIN-5/6)": (ranks_naive, ranks),
    "subset join (JON-11)": (subsets_naive, subsets),
}


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    store = spark.sparkContext._jsc.sc().statusStore()

    def written() -> int:
        executors = store.executorList(False)
        return sum(executors.apply(i).totalShuffleWrite() for i in range(executors.size()))

    print(f"{'operator':30} {'plain s':>9} {'own s':>9} {'plain MB':>9} {'own MB':>9}")
    for name, forms in PAIRS.items():
        if sys.argv[2:] and not name.startswith(tuple(sys.argv[2:])):
            continue
        figures = []
        for form in forms:
            form(spark, sf).limit(1).collect()
            before, start = written(), time.perf_counter()
            form(spark, sf).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            time.sleep(0.5)  # let the last task's figures arrive
            figures.append((took, (written() - before) / 1e6))
        (a, x), (b, y) = figures
        print(f"{name:30} {a:9.1f} {b:9.1f} {x:9.1f} {y:9.1f}", flush=True)


if __name__ == "__main__":
    main()
