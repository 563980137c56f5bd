import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as entry  # noqa: E402
from catalogue import registered  # noqa: E402
from check import bag  # noqa: E402

SMALL = Path("/root/testdata/sf0.001")
CHECKED = (
    "fact_star_enrich", "rfm_multi_horizon", "rank_share_cumulative", "abc_by_trade_name", "ts_pre_agg",
    "ts_cumulative_distinct", "txn_blocks_relative", "series_manufacturer__all", "entity_pairs", "changelog_stream",
    "events_tumbling_stream", "dictionary_links", "array_subset_links", "clean_types", "staged_current", "customer_dimension",
)

needs_tables = pytest.mark.skipif(not SMALL.exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in SMALL.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def test_every_query_is_callable_and_sql_belongs_to_a_query():
    queries, sql = entry.queries(), entry.oracle_sql()
    assert all(callable(q) for q in queries.values())
    assert set(sql) <= set(queries)
    core = registered()
    assert set(core) <= set(queries)
    assert all(text for _, text in core.values())


@needs_tables
@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_its_sql(spark, duck, name):
    df = entry.queries()[name](spark, str(SMALL))
    cursor = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert bag([tuple(r) for r in df.collect()], df.columns) == bag(cursor.fetchall(), columns)


@needs_tables
def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
