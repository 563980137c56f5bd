import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import clean, dates, keys, text
from ledgerline.functions.exact import exact_sum


def one(spark, column, **values):
    types = {str: "string", int: "bigint", float: "double", type(None): "string", bytes: "binary", bytearray: "binary"}
    schema = ", ".join(f"{k} {types[type(v)]}" for k, v in values.items()) or "x int"
    df = spark.createDataFrame([tuple(values.values()) or (1,)], schema)
    return df.select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("word", ["#N/A", "n/a", " NULL ", "(null)", "None", "nil", "Undefined", "", "   "])
def test_null_words(spark, word):
    assert one(spark, clean.null_words(F.col("c")), c=word) is None


def test_null_words_trim_other_text(spark):
    assert one(spark, clean.null_words(F.col("c")), c="  nilly ") == "nilly"


@pytest.mark.parametrize(
    "word,value",
    [("TRUE", True), ("Y", True), ("active", True), ("1", True), ("f", False), ("No", False), ("I", False), ("0", False), ("maybe", None)],
)
def test_boolean_words(spark, word, value):
    assert one(spark, clean.to_boolean(F.col("c")), c=word) is value


@pytest.mark.parametrize("value,expected", [("20240229", dt.date(2024, 2, 29)), ("00000000", None), ("20240230", None), ("junk", None)])
def test_dates(spark, value, expected):
    assert one(spark, clean.to_date(F.col("c")), c=value) == expected


@pytest.mark.parametrize("value,expected", [("123456", 123456), ("12:34:56", 123456), ("000000", None), ("noon", None), ("000100", 100)])
def test_time_of_day(spark, value, expected):
    assert one(spark, clean.to_time_number(F.col("c")), c=value) == expected


def test_decimal_domains(spark):
    utc = clean.to_decimal_kind(F.col("c"), "TZNTSTMPL").cast("string")
    local = clean.to_decimal_kind(F.col("c"), "COM_TSTMP").cast("string")
    assert one(spark, utc, c="20240701120000") == "2024-07-01 12:00:00"
    assert one(spark, local, c="20240701120000") == "2024-07-01 16:00:00"
    assert one(spark, local, c="20240101120000") == "2024-01-01 17:00:00"
    assert one(spark, clean.to_decimal_kind(F.col("c"), "OTHER"), c="1.50") == 1.5
    assert one(spark, clean.to_decimal_kind(F.col("c"), "OTHER"), c="1,50") is None


def test_raw_to_hex(spark):
    assert one(spark, clean.to_hex(F.col("c")), c="q80B") == "ABCD01"
    assert one(spark, clean.to_hex(F.col("c")), c="***") is None
    assert one(spark, clean.to_hex(F.col("c"), binary=True), c=bytearray(b"\xab\x00")) == "AB00"


def test_iso_micros(spark):
    df = spark.createDataFrame([("2024-01-02T03:04:05.000006",), ("bad",)], "s string")
    out = clean.clean_iso_stamps(df, [clean.FieldType("s", "date-time")]).select(F.col("s").cast("string"))
    assert [r[0] for r in out.collect()] == ["2024-01-02 03:04:05.000006", None]


def test_replication_stamp_only_where_present(spark):
    df = spark.createDataFrame([("20240102030405",)], "s string")
    assert clean.parse_replication_stamp(df, "none") is df
    assert "s_PARSED" in clean.parse_replication_stamp(df, "s").columns


def test_typed_cleaning_converts_by_kind(spark):
    df = spark.createDataFrame([("7", "x", 1.5, " nil ")], "a string, b string, c float, d string")
    out = clean.clean_types(df, [clean.FieldType("a", "INT2"), clean.FieldType("b", "INT4")])
    assert dict(out.dtypes) == {"a": "int", "b": "int", "c": "double", "d": "string"}
    assert tuple(out.first()) == (7, None, 1.5, None)


def test_cleaner_registry(spark):
    df = spark.createDataFrame([(1,), (1,)], "a int")
    assert clean.apply_cleaners(df, ["distinct_rows"], []).count() == 1
    with pytest.raises(KeyError):
        clean.apply_cleaners(df, ["missing"], [])
    with pytest.raises(ValueError):
        clean.register_cleaner("distinct_rows", lambda df, fields: df)


@pytest.mark.parametrize(
    "size,quantity,pack,form,group,expected",
    [
        ("10X10 EA", 1, 100, "", "", 100),
        ("4X6X8 EA", 1, 1, "", "", 192),
        ("4X6X8", 1, 1, "TB", "", 192),
        ("4X6", 1, 1, "CP", "", 24),
        ("6X3X15ML", 1, 15, "", "", 18),
        ("6X1000ML", 1, 1000, "", "", 6),
        ("100+10 EA", 1, 110, "", "", 110),
        ("60EA", 1, 5, "", "", 60),
        ("60 EA", 1, 5, "", "", 60),
        ("473 ML", 1, 473, "", "", 1),
        ("2.5", 4, 9, "", "", 4),
        ("   100", 0, 100, "TB", "", 100),
        ("12 PC", 0, 3, "", "", 12),
        ("", 2, 7, "TB", "", 7),
        (None, 2, 7, "TB", "", 7),
        ("60EA", 1, 0, "", "", 1),
        ("60EA", 1, 5, "", "ZSERVICE", 1),
        ("about EA", 1, 5, "", "", None),
        ("60", 1, -3, "", "", 1),
    ],
)
def test_pack_quantity(spark, size, quantity, pack, form, group, expected):
    c = text.pack_quantity(*[F.col(x) for x in ("s", "q", "p", "f", "g")])
    assert one(spark, c, s=size, q=quantity, p=pack, f=form, g=group) == expected


def test_leading_zeros_and_codes(spark):
    assert one(spark, text.strip_leading_zeros(F.col("c")), c="000120") == "120"
    assert one(spark, text.strip_leading_zeros(F.col("c")), c="0000") is None
    assert one(spark, text.postal_prefix(F.col("c")), c="43017-1234") == "43017"
    assert one(spark, text.numeric_code(F.col("c")), c="0000012345678901") == "12345678901"
    assert one(spark, text.numeric_code(F.col("c")), c="V12") is None


@pytest.mark.parametrize(
    "name,expected",
    [("ActionTypes_LookupDescription", "action_types_lookup_description"), ("ApplNo", "appl_no"), ("TECode", "te_code"), ("TE", "te"), ("ReferenceDrug", "reference_drug")],
)
def test_snake_names(name, expected):
    assert text.snake_name(name) == expected


def test_word_splitting_and_mapping(spark):
    assert one(spark, text.camel_to_words(F.col("c")), c="SalesOrderItem") == "sales_order_item"
    assert one(spark, text.catalogue_type(F.col("c")), c="nvarchar") == "string"
    assert one(spark, text.catalogue_type(F.col("c")), c="xml") is None
    assert one(spark, text.map_values(F.col("c"), {}), c="a") is None
    assert one(spark, text.contains_any(F.col("c"), ["ab"]), c=None) is False


def test_reference_table(spark):
    c = text.reference_table(F.col("d"), F.col("o"))
    assert one(spark, c, d="Key of table abc001 here", o="ln_x_tab") == "ln_x_abc001"
    assert one(spark, c, d="no reference", o="plain") == "None_None"


def test_key_positions(spark):
    df = spark.sql("select array('f1','f2','SPRAS') n, array('e','d','SPRAS') e, array('d','x','SPRAS') w")
    found = df.select(text.key_positions(F.col("n"), F.col("e"), F.col("w"), "SPRAS")).first()[0]
    assert found == ["f2", "SPRAS"]


def test_keys_and_nulls(spark):
    assert one(spark, keys.primary_key("src", ["a", "b"]), a="1", b=None) == "src_|_1"
    assert one(spark, keys.primary_key(" ", ["a"]), a="1") == "1"
    assert one(spark, keys.foreign_key("src", ["a", "b"]), a="1", b=None) is None
    assert one(spark, keys.foreign_key("src", ["a", "b"]), a="1", b="2") == "src_|_1_|_2"
    assert one(spark, keys.template("a ", F.col("c")), c=None) is None
    assert keys.foreign_key_name(["MANDT", "KUNNR"], "KNA1") == "mandt_kunnr_|_foreign_key_KNA1"
    assert keys.customization_name("TBEZ", "T134T", ["MANDT", "SPRAS"]) == "TBEZ_|_customization_field_T134T_|_MANDT_SPRAS"


def test_key_columns_respect_existing(spark):
    df = spark.createDataFrame([("k", "t", "s")], "PRIMARY_KEY string, TITLE string, SOURCE string")
    out = keys.with_title(keys.with_source(keys.with_primary_key(df, "erp", ["x"]), "erp"))
    assert out.columns == ["primary_key", "title", "SOURCE", "engine_source"]


def test_series_ids(spark):
    df = spark.createDataFrame([("7",)], "primary_key string")
    out = keys.with_series_ids(df, "primary_key", "vendor", [], ["m"])
    assert out.first()["vendor_|_all_|_m_|_time_series_id"] == "vendor_||_all_||_7_||_m"
    assert len(keys.with_series_ids(df, "primary_key", "v", ["all", "x"]).columns) == 1 + 18


def test_month_arithmetic(spark):
    assert dates.months_before(dt.date(2024, 3, 31), 1) == dt.date(2024, 2, 29)
    assert dates.months_before(dt.date(2024, 1, 15), 25) == dt.date(2021, 12, 15)
    c = dates.month_difference(dates.day("2024-03-01"), dates.day("2023-12-31"))
    assert one(spark, c) == 3


def test_exact_sum_is_exact(spark):
    df = spark.range(1000).select((F.col("id") * 0.0001 - 0.03).alias("v"))
    assert df.agg(exact_sum("v")).first()[0] == 19.95
    big = spark.createDataFrame([(9e13,), (0.0001,), (-9e13,)], "v double")
    assert big.agg(exact_sum("v")).first()[0] == 0.0001
    assert spark.createDataFrame([(None,)], "v double").agg(exact_sum("v")).first()[0] is None


def test_exact_sum_rounds_no_value(spark):
    for values in ([0.00004, 0.00004, 1.0], [1e15, 0.5], [1e300, 1.0], [0.1, 0.123456789]):
        got = spark.createDataFrame([(v,) for v in values], "v double").agg(exact_sum("v")).first()[0]
        assert got == pytest.approx(sum(values), rel=1e-15)
    for odd in (float("nan"), float("inf")):
        got = spark.createDataFrame([(odd,), (1.0,)], "v double").agg(exact_sum("v")).first()[0]
        assert got == odd or (got != got and odd != odd)
