import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import Window, functions as F

from ledgerline.operators import blocks, columns, dedup, filters, joins, pareto, quality, rollups, series, sets
from ledgerline.operators.running import Order, running_totals


# columns

def test_labels():
    assert columns.column_label("KUNNR", "Customer No. (sold-to)") == "customer_no_soldto_|_kunnr"
    assert columns.column_label("X", "") == "_|_x"
    assert columns.column_label("RAW", None) == "RAW"
    assert columns.column_label("A", "Price in US$") == "price_in_usd_|_a"


def test_rename_mapping():
    mapping = columns.rename_mapping(
        ["A", "TITLE", "x_|_foreign_key_T", "TBEZ_|_customization_field_T134T_|_MANDT_SPRAS", "title"],
        {"A": "Alpha", "title": "never"},
        {"T134T": {"TBEZ": "Description"}},
    )
    assert mapping == {
        "A": "alpha_|_a",
        "TITLE": "title",
        "x_|_foreign_key_T": "x_|_foreign_key_T",
        "TBEZ_|_customization_field_T134T_|_MANDT_SPRAS": "description_|_tbez_|_customization_field_T134T_|_MANDT_SPRAS",
        "title": "title",
    }


def test_pruning_by_content(spark):
    df = spark.createDataFrame([(1, None, "a", 5), (2, None, None, 5)], "k int, empty string, part string, same int")
    assert columns.drop_null_columns(df).columns == ["k", "part", "same"]
    assert columns.drop_null_columns(df, keep=["empty"]).columns == df.columns
    assert columns.drop_constant_columns(df, exact=True).columns == ["k"]
    assert columns.columns_by_null_count(df) == ["k", "same", "part", "empty"]


def test_null_count_order_as_text(spark):
    df = spark.range(10).select(
        F.when(F.col("id") > 9, 1).alias("ten"), F.when(F.col("id") > 1, 1).alias("two")
    )
    assert columns.columns_by_null_count(df) == ["two", "ten"]
    assert columns.columns_by_null_count(df, textual=True) == ["ten", "two"]


def test_map_columns_can_be_pruned(spark):
    df = spark.sql("select map('a', 1) as m, cast(null as map<string,int>) as n")
    assert columns.drop_null_columns(df).columns == ["m"]


def test_types_and_blanks(spark):
    df = spark.sql("select cast(1.5 as decimal(5,2)) d, array(cast(2 as decimal(4,1))) a, ' ' s, ' x' t, X'01' b, array('') e")
    wide = columns.decimals_to_double(df)
    assert dict(wide.dtypes)["d"] == "double" and dict(wide.dtypes)["a"] == "array<double>"
    out = columns.drop_binary(columns.blanks_to_null(df))
    assert "b" not in out.columns
    assert (out.first()["s"], out.first()["t"], out.first()["e"]) == (None, " x", [""])


def test_literals_replace_columns(spark):
    df = spark.createDataFrame([("old",)], "a string")
    assert tuple(columns.with_literals(df, {"a": "new", "b": "2"}).first()) == ("new", "2")


def test_unshared_and_contract(spark):
    a = spark.createDataFrame([(1, 2, 3)], "k int, x int, y int")
    b = spark.createDataFrame([(1, 5)], "k int, x int")
    assert columns.without_shared_columns(a, b, ["k"]).columns == ["k", "y"]
    assert columns.contract(a, ["y", "k"]).columns == ["y", "k"]
    with pytest.raises(Exception):
        columns.contract(a, ["z"]).columns


# filters

def test_deletion_filters(spark, rows):
    df = spark.createDataFrame([(1, "D"), (2, "U"), (3, None)], "k int, mode string")
    assert rows(filters.drop_deletions(df, "MODE"), "k") == [(2,)]
    assert rows(filters.drop_deletions(df, "mode", keep_unknown=True), "k") == [(2,), (3,)]
    assert rows(filters.not_deleted(df, "mode"), "k") == [(3,)]


def test_recent_includes_the_cutoff(spark, rows):
    days = [dt.date(2024, 1, 30), dt.date(2024, 1, 31), dt.date(2024, 7, 31)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    assert len(rows(filters.recent(df, "d", dt.date(2024, 7, 31), 6))) == 2


def test_business_rules(spark, rows):
    df = spark.createDataFrame(
        [(1, "A", "ZC1"), (2, "A", "F2"), (3, "B", "F2"), (4, "A", None), (5, None, "F2")], "k int, org string, kind string"
    )
    kept = filters.business_rules(df, {"org": ["A"]}, {"kind": ["X"]}, {"kind": ["ZC"]})
    assert rows(kept, "k") == [(2,), (4,)]


def test_members_by_list_and_table(spark, rows):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    allowed = spark.createDataFrame([("a",), ("a",)], "x string")
    assert rows(filters.members(df, "k", ["a"])) == rows(filters.members(df, "k", allowed)) == [("a",)]
    assert rows(df.select(filters.is_member(F.col("k"), ["a"])))[0] == (False,)


def test_array_predicates(spark):
    df = spark.sql("select array('a','a') s, array('b','a') l, array('z') o, array() e")
    got = df.select(
        filters.is_subset(F.col("s"), F.col("l")), filters.is_subset(F.col("o"), F.col("l")),
        filters.is_subset(F.col("e").cast("array<string>"), F.col("l")), filters.differs_from(F.col("o"), ["z"]),
    ).first()
    assert tuple(got) == (True, False, True, False)


# joins

def test_null_safe_left_join_equals_left_join(spark, rows):
    left = spark.createDataFrame([(1, "a", "x"), (2, None, "x"), (3, "b", None), (4, "z", "x")], "id int, k string, m string")
    right = spark.createDataFrame([("a", "x", 10), ("b", "x", 20), ("a", "x", 30), (None, "x", 40)], "rk string, rm string, v int")
    got = joins.null_safe_left_join(left, right, [("k", "rk"), ("m", "rm")])
    want = left.join(right, (left.k == right.rk) & (left.m == right.rm), "left").select("id", "k", "m", "v")
    assert got.columns == ["id", "k", "m", "v"]
    assert rows(got) == rows(want)


def test_null_safe_left_joins_equal_joins_one_by_one(spark, rows):
    left = spark.createDataFrame([(1, "a"), (2, None), (2, None), (3, "b"), (4, "z")], "id int, k string")
    one = spark.createDataFrame([("a", 10), ("a", 30), (None, 40)], "rk string, v int")
    two = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "rk string, w int")
    got = joins.null_safe_left_joins(left, [one, two], [("k", "rk")])
    want = joins.null_safe_left_join(joins.null_safe_left_join(left, one, [("k", "rk")]), two, [("k", "rk")])
    assert got.columns == want.columns == ["id", "k", "v", "w"]
    assert rows(got) == rows(want)
    with pytest.raises(ValueError):
        joins.null_safe_left_joins(left, [one, one], [("k", "rk")])


def test_join_refuses_clashing_columns(spark):
    df = spark.createDataFrame([(1, 2)], "k int, v int")
    with pytest.raises(ValueError):
        joins.null_safe_left_join(df, df, [("k", "k")])


def test_upsert_and_missing_members(spark, rows):
    old = spark.createDataFrame([(1, "o"), (2, "o")], "k int, v string")
    new = spark.createDataFrame([(2, "n"), (3, "n")], "k int, v string")
    assert rows(joins.upsert(new, old, "k")) == [(1, "o"), (2, "n"), (3, "n")]
    assert rows(joins.missing_members(old, new, ["k"])) == [(1, "o")]


def test_null_keys_are_spread_and_never_match(spark):
    left = spark.range(40).selectExpr("if(id % 4 = 0, id % 8, null) AS k", "id")
    right = spark.createDataFrame([(0, "zero"), (None, "none")], "k long, name string")
    got = {r["id"]: r["name"] for r in joins.null_safe_left_join(left, right, [("k", "k")]).collect()}
    assert got == {i: "zero" if i % 8 == 0 else None for i in range(40)}
    alone = joins.null_safe_left_join(left, right, [("k", "k")], "left_anti")
    assert alone.columns == ["k", "id"] and {r["id"] for r in alone.collect()} == {i for i in range(40) if i % 8}
    salted = left.withColumn("s", F.lit(1)).transform(lambda d: joins.null_safe_left_join(d, right, [("k", "k")]))
    assert "__salt" in salted._jdf.queryExecution().toString()
    never_null = spark.range(5).withColumnRenamed("id", "k")
    plain = joins.null_safe_left_join(never_null, right, [("k", "k")])
    assert "__salt" not in plain._jdf.queryExecution().toString() and plain.count() == 5


def test_containment_by_words_equals_brute_force_with_blanks_in_tokens(spark):
    rng = random.Random(4)

    def text(longest):
        return "".join(rng.choice("ab \tÄ\u00a0") for _ in range(rng.randint(0, longest)))

    texts = [text(14) for _ in range(400)] + [None, "", "   ", "ab " * 3000]
    for tokens in ([" "], ["b a"], [" \t"], ["ä"], [text(5) for _ in range(12)], ["", None]):
        df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
        table = spark.createDataFrame([(t,) for t in tokens], "token string")
        got = {r["id"]: r["hit"] for r in joins.containment_flag(df, "t", table, "hit").collect()}
        wanted = [t.upper() for t in tokens if t]
        assert got == {i: any(w in t.upper() for w in wanted) if t is not None else False for i, t in enumerate(texts)}


def test_containment_table_equals_brute_force(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice("abC ") for _ in range(rng.randint(0, 12))) for _ in range(80)] + [None, ""]
    tokens = ["ab", "CA", "b", "abab", "", None, "zz", "c a"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    table = spark.createDataFrame([(x,) for x in tokens], "x string")
    got = {r["id"]: r["hit"] for r in joins.containment_flag(df, "t", table, "hit").collect()}
    real = [x.upper() for x in tokens if x]
    assert got == {i: bool(t) and any(x in t.upper() for x in real) for i, t in enumerate(texts)}
    assert joins.containment_flag(df, "t", table.limit(0), "hit").filter("hit").isEmpty()
    listed = joins.containment_flag(df, "t", ["ab", "zz"], "hit")
    assert listed.count() == len(texts)


def test_subset_pairs_equal_brute_force(spark, rows):
    rng = random.Random(5)
    small = [(f"s{i}", [rng.choice("abcdefgh") for _ in range(rng.randint(0, 3))]) for i in range(40)]
    large = [(f"l{i}", ["a"] + [rng.choice("abcdefg") for _ in range(rng.randint(0, 6))]) for i in range(25)]
    got = joins.subset_pairs(
        joins.members_of(spark.createDataFrame(small, "s string, e array<string>"), "s", "e"),
        joins.members_of(spark.createDataFrame(large, "l string, e array<string>"), "l", "e"), "s", "l",
    )
    want = sorted((s, l) for s, x in small for l, y in large if x and set(x) <= set(y))
    assert rows(got) == want


def test_subset_pairs_of_copies_single_elements_and_foreign_elements(spark, rows):
    rng = random.Random(6)
    small = [(i, ["a", "b"]) for i in range(30)] + [(100 + i, ["a"]) for i in range(5)]
    small += [(200 + i, rng.sample("abcdefgh", rng.randint(1, 5))) for i in range(60)] + [(300, ["a", "zz"]), (301, [])]
    large = [(i, ["a", "b", "c"]) for i in range(20)] + [(50 + i, rng.sample("abcdefgh", rng.randint(1, 7))) for i in range(40)]

    def sets(data):
        return joins.members_of(spark.createDataFrame(data, "id long, e array<string>"), "id", "e")

    got = joins.subset_pairs(sets(small), sets(large), "id", "id")
    assert got.columns == ["small_id", "large_id"]
    assert {tuple(r) for r in got.collect()} == {(s, l) for s, x in small for l, y in large if x and set(x) <= set(y)}
    assert got.count() == len(rows(got))


def test_equal_sets_form_one_class(spark):
    data = [(i, e) for i in range(40) for e in ("x", "y")] + [(99, "x")]
    classes = joins.set_classes(spark.createDataFrame(data, "set_id long, element string"))
    assert {(r["class_id"], r["members"]) for r in classes.collect()} == {(0, 2), (99, 1)} and classes.count() == 41


def test_partner_columns(spark, rows):
    relations = spark.createDataFrame(
        [("c1", "p2", "A1"), ("c1", "p1", "A1"), ("c1", "p3", "A2"), ("c2", "c2", "A1"), ("c3", "none", "A1"), ("c4", "p1", "ZZ")],
        "customer_key string, partner_key string, role string",
    )
    names = spark.createDataFrame([("p1", "One"), ("p3", "Three")], "primary_key string, name string")
    genuine = filters.genuine_relations(relations, "customer_key", "partner_key", "role", ["A1", "A2"], "none")
    got = joins.partner_columns(genuine, names, "customer_key", "partner_key", "role", ["A1", "A2"])
    assert [tuple(r) for r in got.collect()] == [("c1", "p1", "One", "p3", "Three")]


def test_totals_without_keys_is_one_scalar(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "v double")
    out = joins.attach_totals(df, df.agg(F.sum("v").alias("t")), [])
    assert [r["t"] for r in out.collect()] == [4.0, 4.0]
    assert "CartesianProduct" not in out._jdf.queryExecution().toString()


def test_membership_flag_does_not_multiply(spark, rows):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    listed = spark.createDataFrame([("a",), ("a",), (None,)], "l string")
    assert rows(joins.membership_flag(df, "k", listed, "l", "f")) == [(None, False), ("a", True), ("b", False)]


# de-duplication and sets

def test_latest_rows_and_ties(spark, rows):
    df = spark.createDataFrame(
        [("a", 1, 1), ("a", 2, 2), ("a", 2, 3), ("b", None, 4), ("b", None, 5), ("c", None, 6), ("c", 0, 7)], "k string, t int, id int"
    )
    assert rows(dedup.latest_rows(df, ["k"], ["t"]), "id") == [(2,), (3,), (4,), (5,), (7,)]
    assert rows(dedup.latest_rows(df, ["k"], ["t"], True, ["id"]), "id") == [(2,), (4,), (7,)]


def test_latest_rows_limits_groups_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"))
    for one in (True, False):
        plan = dedup.latest_rows(df, ["k"], ["t"], one)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("WindowGroupLimit") == 2


def test_one_per_key(spark, rows):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3)], "k string, v int")
    assert rows(dedup.one_per_key(df, ["k"], ["v"])) == [("a", 1), ("b", 3)]
    assert dedup.one_per_key(df, ["k"]).count() == 2


def test_unions(spark, rows):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([("y", 2)], "b string, k int")
    wide = sets.wide_union([a, b])
    assert wide.columns == ["k", "a", "b"]
    assert rows(wide) == [(1, "x", None), (2, None, "y")]
    lineage = sets.lineage_union({"one": a, "two": a})
    assert rows(lineage, "source_dataset_name") == [("one",), ("two",)]


def test_change_flags(spark, rows):
    names = spark.createDataFrame([("a",), ("b",), ("c",)], "table_name string")
    now = spark.createDataFrame([("a", 1), ("b", 1), ("b", 1)], "object_name string, v int")
    before = spark.createDataFrame([("b", 1), ("c", 9)], "object_name string, v int")
    changed = sets.changed_names(now, before, "object_name")
    assert rows(sets.change_flags(names, [changed])) == [("a", True), ("b", False), ("c", True)]


def test_row_counts(spark, rows):
    t = spark.createDataFrame([("s1",), ("s1",), ("s2",)], "source string")
    assert rows(sets.row_counts({"x": t, "y": t.limit(0)})) == [("s1", "x", 2), ("s2", "x", 1)]


# running totals

@pytest.mark.parametrize("descending", [True, False])
def test_running_totals_equal_a_window(spark, rows, descending):
    rng = random.Random(1)
    data = [
        (rng.choice(["hot"] * 8 + ["b", None]), rng.choice([1] * 5 + [2, 3, None]), i, rng.choice([1.5, -2.25, None, 4.0]))
        for i in range(2000)
    ]
    df = spark.createDataFrame(data, "p string, o int, k int, v double")
    order = F.col("o").desc_nulls_last() if descending else F.col("o").asc_nulls_first()
    got = running_totals(df, ["p"], [Order("o", descending)], [Order("k")], {"c": "v"}, {"t": "c"}, "n", 2)
    w = Window.partitionBy("p")
    want = df.withColumns(
        {
            "n": F.row_number().over(w.orderBy(order, "k")).cast("long"),
            "c": F.sum("v").over(w.orderBy(order)),
            "t": F.sum("v").over(w),
        }
    )
    assert rows(got.select(want.columns)) == rows(want)


def test_running_totals_of_one_partition_and_no_rows(spark, rows):
    df = spark.range(50).select(F.col("id").alias("k"), F.lit(7).alias("same"), F.lit(1.0).alias("v"))
    got = running_totals(df, [], [Order("same")], [Order("k")], {"c": "v"}, rank="n")
    assert rows(got.select("c").distinct()) == [(50.0,)]
    assert sorted(r["n"] for r in got.collect()) == list(range(1, 51))
    assert running_totals(df.limit(0), [], [Order("same")], [], {"c": "v"}, rank="n").isEmpty()


# classification, blocks, roll-ups

def test_abc_classes(spark):
    data = [("a", 80.0), ("b", 10.0), ("c", 6.0), ("d", 4.0), ("e", 0.0)]
    df = spark.createDataFrame(data, "g string, v double")
    got = {r["g"]: r for r in pareto.abc_classification(df, "v", ["g"]).collect()}
    assert {g: r["group_class"] for g, r in got.items()} == {"a": "A", "b": "B", "c": "C", "d": "C", "e": "C"}
    assert got["a"]["group_id"] == '{"g":"a"}' and got["a"]["partition_block_id"] is None
    assert got["e"]["group_rank"] == 5 and got["e"]["group_cumulative_share"] == 1.0
    assert all(r["partition_class"] == "A" for r in got.values())


def test_abc_big_single_group_is_a(spark):
    df = spark.createDataFrame([("p", "a", 99.0), ("p", "b", 1.0), ("q", "a", 0.0)], "p string, g string, v double")
    got = {(r["p"], r["g"]): r["group_class"] for r in pareto.abc_classification(df, "v", ["g"], ["p"]).collect()}
    assert got == {("p", "a"): "A", ("p", "b"): "C", ("q", "a"): "C"}


def test_abc_refuses_other_aggregates(spark):
    with pytest.raises(ValueError):
        pareto.abc_classification(spark.range(1), "id", ["id"], aggregate="max")


BLOCK_ITEMS = "trade string, item_key string, billing_date date, sales_value double, unit_price double, sold_to_key string, product_key string"


def test_blocks(spark):
    day = dt.date(2024, 1, 1)
    data = [("t", f"i{n:03d}", day + dt.timedelta(n // 4), 10.0, 2.0, "c", "p") for n in range(100)]
    data.append(("t", "i000", day, -5.0, 3.0, "c", "p"))
    df = spark.createDataFrame(data, BLOCK_ITEMS)
    labels = {r["item_key"]: r for r in blocks.block_labels(df, ["trade"], absolute=100).collect()}
    assert labels["i000"]["cumulative_total_sales_value"] == 5.0 and labels["i000"]["row_rank"] == 2
    assert labels["i001"]["row_rank"] == 3
    assert labels["i099"]["relative_size_transaction_block_label"] == 100
    assert labels["i010"]["absolute_size_transaction_block_id"] == "t_||_1"
    out = blocks.transaction_blocks(df, ["trade"], absolute=100, exact=True)
    first = {r["absolute_size_transaction_block_id"]: r for r in out["absolute"].collect()}["t_||_0"]
    assert first["uniq_txn_count"] == 10 and first["median_unit_price"] == 2.0 and first["max_unit_price"] == 3.0
    assert first["avg_unit_price"] == 23 / 11 and first["avg_sales_value"] == 95 / 11
    approx = blocks.transaction_blocks(df, ["trade"], absolute=100)["absolute"]
    assert approx.count() == out["absolute"].count()


def test_copies_of_an_item_count_each(spark):
    day = dt.date(2024, 1, 1)
    data = [("t", "a", day, 1.0, 5.0, "c", "p")] * 7 + [("t", "b", day, 3.0, 1.0, "c", "p")]
    r = blocks.transaction_blocks(spark.createDataFrame(data, BLOCK_ITEMS), ["trade"], exact=True)["absolute"].first()
    assert (r["total_sales_value"], r["avg_sales_value"], r["median_unit_price"], r["avg_unit_price"]) == (10.0, 1.25, 5.0, 4.5)
    assert r["uniq_txn_count"] == 2


def test_exact_block_counts_hold_each_row_once(spark, rows):
    rng = random.Random(5)
    day = dt.date(2024, 1, 1)
    data = [
        (rng.choice(["hot"] * 5 + ["x", None]), rng.choice(["i1", "i2", "i3", None, f"n{n}"]), day + dt.timedelta(n % 9),
         rng.choice([None, 1.0, 2.5]), rng.choice([None, 1.0, 3.0]), rng.choice(["c1", "c2", None]), rng.choice(["p1", "p2", None]))
        for n in range(200)
    ]
    df = spark.createDataFrame(data + data[:50], BLOCK_ITEMS)
    out = blocks.transaction_blocks(df, ["trade"], absolute=1e9, exact=True)["absolute"]
    names = ["earliest_txn_date", "latest_txn_date", "uniq_txn_count", "uniq_customer_count", "uniq_product_count", "total_sales_value", "min_unit_price", "max_unit_price", "median_unit_price"]
    d, v, u = "billing_date", "sales_value", "unit_price"
    # a leading row without a value has no running value, so no label, and is a block of its own
    valued = df.groupBy("trade").agg(F.min(F.when(F.col(v).isNotNull(), F.struct(d, "item_key"))).alias("first"))
    same = df["trade"].eqNullSafe(valued["trade"])
    keyed = df.join(valued, same).select(df["*"], (F.struct(d, "item_key") >= F.col("first")).alias("labelled"))
    want = keyed.groupBy("trade", "labelled").agg(
        F.min(d), F.max(d), F.count_distinct("item_key"), F.count_distinct("sold_to_key"), F.count_distinct("product_key"), F.sum(v), F.min(u), F.max(u), F.percentile(u, 0.5)
    ).drop("labelled")
    assert rows(out, "trade", *names) == rows(want)
    assert out.columns[2:7] == names[:5]
    assert "Expand" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_negative_start_counts_to_block_zero(spark):
    day = dt.date(2024, 1, 1)
    df = spark.createDataFrame([("t", "a", day, -50.0, 1.0, "c", "p"), ("t", "b", day, 150.0, 1.0, "c", "p")], BLOCK_ITEMS)
    labels = {r["item_key"]: r["relative_size_transaction_block_label"] for r in blocks.block_labels(df, ["trade"]).collect()}
    assert labels == {"a": 0, "b": 100}


def test_medians_equal_percentile(spark, rows):
    rng = random.Random(9)
    data = [(rng.choice(["hot"] * 5 + ["x", None]), rng.choice([None, 1.0, 2.5, 4.0, 7.0]), rng.randint(1, 3)) for _ in range(300)]
    df = spark.createDataFrame(data, "g string, v double, n int")
    got = blocks.medians(df, ["g"], "v", "n")
    spread = df.select("g", "v", F.explode(F.sequence(F.lit(1), "n")))
    assert rows(got) == rows(spread.filter("v is not null").groupBy("g").agg(F.percentile("v", 0.5)))


def test_attribute_rollup(spark):
    df = spark.createDataFrame(
        [("g", "p1", "m", ["x"]), ("g", "p2", None, ["y", "x"]), ("g", "p2", "m", None), ("", "p3", "m", ["z"]), (None, "p4", "m", ["z"])],
        "name string, p string, m string, labels array<string>",
    )
    got = rollups.attribute_rollup(df, "name", {"first_p": "p"}, {"p": "p", "m": "m"}, ["p"], {"labels": "labels"}).collect()
    assert len(got) == 1
    r = got[0]
    assert (r["primary_key"], r["first_p"], r["p_list"], r["m_list"], r["p_count"]) == ("g", "p1", ["p1", "p2"], ["m"], 2)
    assert (r["labels"], r["labels_count"]) == (["x", "y"], 2)


def test_entity_pairs(spark, rows):
    df = spark.createDataFrame([("a", "a", None, "p"), ("a", "b", "", "p"), ("a", "b", "c", None)], "s string, b string, h string, m string")
    pairs = rollups.entity_pairs(df, ["s", "b", "h"], "m", "pair")
    assert rows(pairs, "primary_key") == [("a_||_p",), ("b_||_p",)]


def test_ordered_names_keep_nulls_in_place(spark):
    df = spark.createDataFrame([("t", 10, "c", None), ("t", 2, "b", "e2"), ("t", 1, "a", "e1")], "t string, pos int, f string, e string")
    r = rollups.ordered_names(df, ["t"], "pos", {"names": "f", "elements": "e"}).first()
    assert (r["names"], r["elements"]) == (["a", "b", "c"], ["e1", "e2", None])


# series

def series_items(spark):
    rng = random.Random(11)
    start = dt.date(2024, 1, 1)
    data = [
        (rng.choice(["hot"] * 6 + ["x", None]), start + dt.timedelta(rng.randint(0, 60)), rng.choice(["m1", "m2", "m3", "m4", None]), float(rng.randint(1, 9)))
        for _ in range(400)
    ]
    return spark.createDataFrame(data, "g string, d date, m string, v double")


def test_cumulative_counts_equal_the_growing_set(spark, rows):
    df = series_items(spark)
    counted = series.daily_series(df, ["g"], "d", ["v"], {"m": "m"}, ["m"])
    daily = df.groupBy("g", "d").agg(F.collect_set("m").alias("ms"))
    grown = series.cumulative_sets(daily, ["g"], "d", "ms", "all_ms")
    order = Window.partitionBy("g").orderBy("d")
    want = grown.select(
        "g", "d", F.size("ms").alias("m_count"), F.col("size_of_all_ms").alias("c"), F.lag("size_of_all_ms").over(order).alias("lag")
    )
    assert rows(counted, "g", "d", "m_count", "cumulative_m_count", "lagged_cumulative_m_count") == rows(want)


def test_series_from_sets_equal_series_from_values(spark, rows):
    df = series_items(spark)
    pre = df.groupBy("g", "d", "v").agg(F.collect_set("m").alias("ms"), F.sum("v").alias("total")).drop("v").withColumnRenamed("total", "v")
    a = series.daily_series(df, ["g"], "d", ["v"], {"m": "m"}, ["m"])
    b = series.daily_series(pre, ["g"], "d", ["v"], {"m": "ms"}, ["m"])
    assert rows(a) == rows(b.select(a.columns))


def test_rolling_window_borders(spark):
    start = dt.date(2024, 1, 1)
    data = [("k", start, 1.0), ("k", start + dt.timedelta(30), 10.0), ("k", start + dt.timedelta(31), 100.0)]
    got = series.rolling_trend(spark.createDataFrame(data, "k string, d date, v double"), ["k"], "d", "v").orderBy("d").collect()
    assert [r["total_v_of_past_30_days"] for r in got] == [1.0, 11.0, 110.0]
    assert got[2]["rolling_30_day_avg_of_daily_v"] == 55.0
    assert got[2]["rolling_90_day_avg_of_daily_v"] == 37.0
    change = "absolute_diff_of_30_vs_90_day_rolling_avg_of_total_v_of_past_30_days"
    assert got[2][change] == pytest.approx((11 + 110) / 2 - (1 + 11 + 110) / 3)


def test_pre_aggregate_writes_key_sets_down(spark):
    df = spark.createDataFrame(
        [("p", None, "c1", "i1", dt.date(2024, 1, 1), 2.0, 3.0), ("p", None, "c2", "i2", dt.date(2024, 1, 1), 0.0, 5.0)],
        "p string, b string, c string, i string, d date, q double, v double",
    )
    r = series.daily_pre_aggregate(df, ["p", "b"], "d", "i", "q", "v", {"p": "p", "b": "b", "c": "c"}).first()
    assert (r["p_set"], r["b_set"], r["c_set"], r["b_count"], r["item_count"]) == (["p"], [], ["c1", "c2"], 0, 2)
    assert r["avg_unit_price"] == 4.0


def test_set_union(spark):
    df = spark.createDataFrame([("a", ["x", "y"]), ("a", ["y", "z"]), ("b", []), ("a", None)], "k string, s array<string>")
    got = {r["k"]: r["s"] for r in series.union_of_sets(df, ["k"], ["s"]).collect()}
    assert got == {"a": ["x", "y", "z"], "b": []}


def test_change_intervals(spark, rows):
    start = dt.date(2024, 1, 1)
    flags = [False, True, True, None, True]
    df = spark.createDataFrame([("k", start + dt.timedelta(i), f, float(i)) for i, f in enumerate(flags)], "k string, d date, f boolean, v double")
    got = series.change_intervals(df, ["k"], "d", "f", ["v"]).orderBy("interval_number").collect()
    assert [(r["f"], r["interval_start"].day, r["interval_end"].day, r["last_v"]) for r in got] == [
        (False, 1, 1, 0.0), (True, 2, 3, 2.0), (False, 4, 4, 3.0), (True, 5, 5, 4.0),
    ]


# quality

def test_quality_checks(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    assert rows(quality.key_violations(df, ["k"])) == [(1, 2)]
    assert quality.keys_are_unique(df, ["k", "v"]) and not quality.keys_are_unique(df, ["k"])
    with pytest.raises(ValueError):
        quality.require_rows(df.limit(0), "t")
    with pytest.raises(ValueError):
        quality.require_columns(df, ["z"], "t")
    with pytest.raises(ValueError):
        quality.require_single([], "t")


def test_profile(spark):
    df = spark.createDataFrame([(1, 1.0, "a"), (2, None, "a"), (2, 4.0, None)], "k bigint, v double, s string")
    got = {r["column_name"]: r for r in quality.column_profile(df, exact=True).collect()}
    assert (got["v"]["count"], got["v"]["null_count"], got["v"]["unique_values"], got["v"]["mean"]) == (2, 1, 3, 2.5)
    assert got["s"]["mean"] is None and got["s"]["unique_values"] == 2 and got["s"]["count"] is None
    assert got["k"]["max"] == 2.0
    assert [r["data_type"] for r in quality.schema_table(df).collect()] == ["bigint", "double", "string"]


def test_exact_profile_counts_values_of_every_type_in_one_narrow_aggregate(spark):
    day, at = dt.date(2024, 1, 1), dt.datetime(2024, 1, 1, 12)
    nan = float("nan")
    df = spark.createDataFrame(
        [
            (1, 0.0, nan, Decimal("1.10"), "1", b"1", day, at, True, [1, None], 1),
            (1, -0.0, nan, Decimal("1.10"), "1.0", b"1", day, at, False, [1], 2),
            (2, None, 1.0, None, "", b"", None, None, None, None, None),
        ],
        "a int, b double, c float, d decimal(9,2), e string, f binary, g date, h timestamp, j boolean, k array<int>, i int",
    )
    got = {r["column_name"]: r["unique_values"] for r in quality.column_profile(df, exact=True).collect()}
    assert got == {"a": 2, "b": 2, "c": 2, "d": 2, "e": 3, "f": 2, "g": 2, "h": 2, "j": 3, "k": 3, "i": 3}
    assert {r["unique_values"] for r in quality.column_profile(df.limit(0), exact=True).collect()} == {0}
    assert "Expand" not in quality.column_profile(df, exact=True)._jdf.queryExecution().toString()


def test_schema_report(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, hx int")
    same = quality.with_schema_report(df, ["a", "b"], ignored_prefixes=["h"])
    assert same is df and quality.schema_matches(same)
    drift = quality.with_schema_report(df, ["a"])
    assert drift.first()["engine_schema_mismatch"].endswith("b, hx") and not quality.schema_matches(drift)


def test_fine_metrics_are_not_rounded_away(spark):
    from ledgerline.operators.blocks import BlockColumns, summarise_blocks
    from ledgerline.operators.pareto import abc_classification

    df = spark.createDataFrame([("p", "a", 0.00003), ("p", "b", 0.00002), ("p", "c", 0.00001)], "p string, g string, m double")
    got = {r["g"]: r for r in abc_classification(df, "m", ["g"], ["p"]).collect()}
    assert got["a"]["group_value"] == pytest.approx(0.00003) and got["a"]["group_share"] == pytest.approx(0.5)
    assert [got[g]["group_rank"] for g in "abc"] == [1, 2, 3]

    daily = spark.createDataFrame([("k", dt.date(2024, 1, 1), 0.00004)], "k string, d date, v double")
    trend = series.rolling_trend(daily, ["k"], "d", "v").first()
    assert trend["total_v_of_past_30_days"] == 0.00004

    rows = [("b", "p", str(i), dt.date(2024, 1, 1), 1.0, 0.00004, "c", "q", 1) for i in range(4)]
    c = BlockColumns()
    labelled = spark.createDataFrame(rows, f"relative_size_transaction_block_id string, p string, {c.item_key} string, {c.billing_date} date, {c.sales_value} double, {c.unit_price} double, {c.customer} string, {c.product} string, items long")
    assert summarise_blocks(labelled, ["p"], "relative").first()["avg_unit_price"] == pytest.approx(0.00004)
