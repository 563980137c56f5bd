import json

from ledgerline.metadata import DISCOVERY, dictionary, flat_catalogue, json_catalogue, suite_catalogue, system_catalogue
from ledgerline.metadata.lookup import metadata_diffs
from ledgerline.metadata.schemas import FIELDS, LINKS, OBJECTS, Metadata


def dictionary_tables(spark):
    fields = [
        # table, field, element, domain, key, position, type
        ("MARA", "MANDT", "MANDT", "MANDT", "X", "0001", "CLNT"),
        ("MARA", "MATNR", "MATNR", "MATNR", "X", "0002", "CHAR"),
        ("MARA", "MTART", "MTART", "MTART", None, "0010", "CHAR"),
        ("MARA", "EMPTY", "EMPTY", "EMPTY", None, "0011", " "),
        ("MAKT", "MANDT", "MANDT", "MANDT", "X", "0001", "CLNT"),
        ("MAKT", "MATNR", "MATNR", "MATNR", "X", "0002", "CHAR"),
        ("MAKT", "SPRAS", "SPRAS", "SPRAS", "X", "0003", "LANG"),
        ("MAKT", "MAKTX", "MAKTX", "TEXT40", None, "0004", "CHAR"),
        ("T134", "MANDT", "MANDT", "MANDT", "X", "0001", "CLNT"),
        ("T134", "MTART", "MTART", "MTART", "X", "0002", "CHAR"),
        ("T000", "MANDT", "MANDT", "MANDT", "X", "0001", "CLNT"),
        ("VBAP", "CLIENT", "MANDT", "MANDT", "X", "0001", "CLNT"),
        ("VBAP", "POSNR", "POSNR", "POSNR", "X", "0002", "NUMC"),
        ("VBAP", "MATWA", "MATWA", "MATNR", None, "0003", "CHAR"),
        ("VBAP", "MATNR", "MATNR", "MATNR", None, "0004", "CHAR"),
    ]
    tables = ["MARA", "MAKT", "T134", "T000", "VBAP", "BARE"]
    return {
        "DD02L": spark.createDataFrame([(t,) for t in tables], "TABNAME string"),
        "DD02T": spark.createDataFrame([("MARA", "E", "Materials"), ("MARA", "D", "Material"), ("MAKT", "E", "Texts")], "TABNAME string, DDLANGUAGE string, DDTEXT string"),
        "DD03L": spark.createDataFrame(fields, "TABNAME string, FIELDNAME string, ROLLNAME string, DOMNAME string, KEYFLAG string, POSITION string, DATATYPE string"),
        "DD04T": spark.createDataFrame([("MATNR", "E", "Matl", "Material Number"), ("MATNR", "D", "Mat", "Materialnummer")], "ROLLNAME string, DDLANGUAGE string, SCRTEXT_S string, SCRTEXT_L string"),
        "DD08L": spark.createDataFrame([("MARA", "MTART", "T134", "KEY"), ("MAKT", "MATNR", "MARA", "TEXT")], "TABNAME string, FIELDNAME string, CHECKTABLE string, FRKART string"),
        "DD05S": spark.createDataFrame(
            [("MARA", "MTART", "0001", "MANDT", "SYST"), ("MARA", "MTART", "0002", "MTART", "MARA"), ("MAKT", "MATNR", "0001", "MANDT", "MAKT"), ("MAKT", "MATNR", "0002", "MATNR", "MAKT"), ("MAKT", "MATNR", "0003", "GONE", "OTHER")],
            "TABNAME string, FIELDNAME string, PRIMPOS string, FORKEY string, FORTABLE string",
        ),
    }


def test_dictionary_objects_and_fields(spark):
    found = dictionary.discover(dictionary_tables(spark))
    assert found.objects.schema.fieldNames() == OBJECTS.fieldNames()
    objects = {r["object_name"]: r for r in found.objects.collect()}
    assert set(objects) == {"MARA", "MAKT", "T134", "T000", "VBAP"}
    assert objects["MARA"]["primary_key_raw_fields"] == ["MANDT", "MATNR"]
    assert objects["MARA"]["description"] == "Materials" and objects["MARA"]["text_table_names"] == ["MAKT"]
    assert objects["T134"]["description"] is None and objects["T134"]["text_table_names"] == []
    fields = {(r["object_name"], r["raw_field_name"]): r for r in found.fields.collect()}
    assert ("MARA", "EMPTY") not in fields
    assert fields["MARA", "MATNR"]["field_name"] == "Material Number"
    assert fields["MARA", "SPRAS"]["field_literal"] == "E" and fields["MARA", "SPRAS"]["field_order"] == 4
    assert fields["MAKT", "SPRAS"]["field_literal"] is None
    assert fields["BARE", "SPRAS"]["field_order"] == 2


def brute_links(spark):
    """The four list rules and the stated relations, on plain lists."""
    t = dictionary_tables(spark)
    rows = [r for r in t["DD03L"].collect() if r["DATATYPE"].strip()]
    tables = {}
    for r in sorted(rows, key=lambda r: (r["TABNAME"], int(r["POSITION"]))):
        tables.setdefault(r["TABNAME"], []).append((r["FIELDNAME"], r["ROLLNAME"], r["DOMNAME"], r["KEYFLAG"] == "X"))
    for fields in tables.values():
        if all(f[0] != "SPRAS" for f in fields):
            fields.append(("SPRAS", "SPRAS", "SPRAS", False))
    links = set()
    for p, pf in tables.items():
        names = [f[0] for f in pf]
        for f, ff in tables.items():
            keys = [x for x in ff if x[3]]
            for by in (1, 2):
                held, wanted = [x[by] for x in pf], [x[by] for x in keys]
                extra = [] if "SPRAS" in held or "SPRAS" not in [x[0] for x in keys] else ["SPRAS"]
                for have in (held, held + extra):
                    if set(wanted) <= set(have):
                        own = [names.index("SPRAS") if w == "SPRAS" else held.index(w) for w in wanted if w in held]
                        links.add((p, tuple(names[i] for i in own), f, tuple(x[0] for x in keys)))
    links |= {("MARA", ("MANDT", "MTART"), "T134", ("MANDT", "MTART")), ("MAKT", ("MANDT", "MATNR"), "MARA", ("MANDT", "MATNR"))}
    client_only = {("MANDT",), ("SPRAS",), ("CLIENT",)}
    return {l for l in links if l[0] != l[2] and l[1] and len(l[1]) == len(l[3]) and l[1] not in client_only}


def test_dictionary_links_equal_brute_force(spark):
    found = dictionary.discover(dictionary_tables(spark)).links.collect()
    got = [(r["primary_object_name"], tuple(r["primary_object_raw_fields"]), r["foreign_object_name"], tuple(r["foreign_object_raw_fields"])) for r in found]
    assert len(got) == len(set(got))
    assert set(got) == brute_links(spark)
    assert ("VBAP", ("CLIENT", "MATWA"), "MARA", ("MANDT", "MATNR")) in got  # by domain, first field
    assert ("VBAP", ("CLIENT", "MATNR"), "MARA", ("MANDT", "MATNR")) in got  # by element
    assert ("MARA", ("MANDT", "MATNR", "SPRAS"), "MAKT", ("MANDT", "MATNR", "SPRAS")) in got


def system_views(spark):
    make = spark.createDataFrame
    return {
        "tables": make([("OrderTb", 1, 1), ("OrderItem", 2, 1), ("Loose", 3, 1)], "name string, object_id int, schema_id int"),
        "columns": make(
            [("OrderId", 1, 1, 10, 0), ("TenantId", 1, 2, 10, 0), ("LineNo", 2, 1, 10, 0), ("OrderId", 2, 3, 10, 7), ("TenantId", 2, 2, 11, 0)],
            "name string, object_id int, column_id int, user_type_id int, default_object_id int",
        ),
        "types": make([("int", 10), ("geography", 11)], "name string, user_type_id int"),
        "default_constraints": make([(7,)], "object_id int"),
        "indexes": make([(1, 1, True, False), (2, 1, True, False), (2, 5, False, True)], "object_id int, index_id int, is_primary_key boolean, is_unique_constraint boolean"),
        "index_columns": make([(1, 1, 2), (1, 1, 1), (2, 1, 1), (2, 5, 3)], "object_id int, index_id int, column_id int"),
        "foreign_keys": make([("FK_item_order", 100, 2, 1)], "name string, object_id int, parent_object_id int, referenced_object_id int"),
        "foreign_key_columns": make([(100, 2, 3, 1, 1), (100, 2, 2, 1, 2)], "constraint_object_id int, parent_object_id int, parent_column_id int, referenced_object_id int, referenced_column_id int"),
        "check_constraints": make([(2, 1), (2, 1)], "parent_object_id int, parent_column_id int"),
        "extended_properties": make([(2, 1, "MS_Description", "OBJECT_OR_COLUMN"), (2, 2, "other", "OBJECT_OR_COLUMN")], "major_id int, minor_id int, name string, class_desc string"),
        "computed_columns": make([(1, 2)], "object_id int, column_id int"),
    }


def test_system_catalogue(spark):
    found = system_catalogue.discover(system_views(spark))
    objects = {r["object_name"]: r["primary_key_raw_fields"] for r in found.objects.collect()}
    assert objects == {"OrderTb": ["OrderId", "TenantId"], "OrderItem": ["LineNo"], "Loose": []}
    link = found.links.first()
    assert (link["primary_object_name"], link["primary_object_raw_fields"]) == ("OrderItem", ["TenantId", "OrderId"])
    assert (link["foreign_object_name"], link["foreign_object_raw_fields"]) == ("OrderTb", ["TenantId", "OrderId"])
    assert link["link_description"] == "item_order"
    fields = {(r["object_name"], r["field_name"]): r for r in found.fields.collect()}
    assert fields["order_item", "order_id"]["field_type"] == "integer"
    assert fields["order_item", "tenant_id"]["field_type"] is None
    flagged = system_catalogue.field_metadata(system_views(spark), with_flags=True)
    by_name = {(r["object_name"], r["raw_field_name"]): r for r in flagged.collect()}
    assert len(by_name) == flagged.count() == 6
    r = by_name["order_item", "OrderId"]
    assert (r["is_foreign_key"], r["is_unique"], r["has_default"], r["is_primary_key"]) == (True, True, True, False)
    assert by_name["order_item", "LineNo"]["is_described"] and by_name["order_item", "LineNo"]["is_checked"]
    assert by_name["order_tb", "TenantId"]["is_computed"]


def test_suite_catalogue(spark):
    make = spark.createDataFrame
    views = {
        "FND_TABLES": make([(1, 10, "ORDERS", "Orders"), (1, 11, "LINES", "Lines"), (1, 12, "GONE", "x"), (2, 20, "ORDERS", "Old")], "APPLICATION_ID int, TABLE_ID int, TABLE_NAME string, DESCRIPTION string"),
        "ALL_TABLES": make([("ONT", "ORDERS"), ("ONT", "LINES"), ("ONT", "LINES")], "OWNER string, TABLE_NAME string"),
        "FND_COLUMNS": make([(1, 10, 1, "ORDER_ID", "N", "id"), (1, 10, 2, "ALT_ID", "N", None), (1, 11, 1, "LINE_ID", "N", "l"), (1, 11, 2, "ORDER_ID", "N", "o")], "APPLICATION_ID int, TABLE_ID int, COLUMN_ID int, COLUMN_NAME string, COLUMN_TYPE string, DESCRIPTION string"),
        "FND_PRIMARY_KEYS": make(
            [(1, 10, 500, "S", "Y"), (1, 10, 501, "D", "Y"), (1, 10, 502, "S", "N"), (1, 11, 600, "D", "Y"), (1, 10, 503, "S", "Y")],
            "APPLICATION_ID int, TABLE_ID int, PRIMARY_KEY_ID int, PRIMARY_KEY_TYPE string, AUDIT_KEY_FLAG string",
        ),
        "FND_PRIMARY_KEY_COLUMNS": make([(1, 10, 500, 2), (1, 10, 503, 1), (1, 10, 501, 2), (1, 11, 600, 2), (1, 11, 600, 1)], "APPLICATION_ID int, TABLE_ID int, PRIMARY_KEY_ID int, COLUMN_ID int"),
        "FND_FOREIGN_KEYS": make([(1, 11, 900, 10, 503)], "APPLICATION_ID int, TABLE_ID int, FOREIGN_KEY_ID int, PRIMARY_KEY_TABLE_ID int, PRIMARY_KEY_ID int"),
        "FND_FOREIGN_KEY_COLUMNS": make([(1, 11, 900, 2)], "APPLICATION_ID int, TABLE_ID int, FOREIGN_KEY_ID int, COLUMN_ID int"),
    }
    found = suite_catalogue.discover(views)
    # the repeated table entry of another application brings a second description; the greater stays
    objects = {r["object_name"]: (r["primary_key_raw_fields"], r["description"]) for r in found.objects.collect()}
    assert objects == {'"ONT"."ORDERS"': (["ORDER_ID"], "Orders"), '"ONT"."LINES"': (["LINE_ID", "ORDER_ID"], "Lines")}
    link = found.links.first()
    assert (link["primary_object_name"], link["primary_object_raw_fields"]) == ('"ONT"."LINES"', ["ORDER_ID"])
    assert (link["foreign_object_name"], link["foreign_object_raw_fields"]) == ("ORDERS", ["ORDER_ID"])
    assert found.fields.count() == 4


def test_flat_catalogues(spark):
    columns = spark.createDataFrame([("SalesOrder", "Id", "text", "key"), ("SalesOrder", "Owner", "text", None)], "TableName string, ColumnName string, DataTypeName string, Description string")
    links = spark.createDataFrame([("SalesOrder", "Owner", "User", "Id", "owner of")], "TableName string, ColumnName string, ReferencedTableName string, ReferencedColumnName string, ForeignKeyName string")
    found = flat_catalogue.discover(columns, links, flat_catalogue.CRM)
    assert [tuple(r) for r in found.objects.collect()] == [("SalesOrder", ["Id"], "Sales Order", [])]
    assert found.fields.schema.fieldNames() == FIELDS.fieldNames() and found.fields.count() == 2
    assert [tuple(r) for r in found.links.collect()] == [("SalesOrder", ["Owner"], "User", ["Id"], "owner of")]
    cloud = spark.createDataFrame([("Item", "InternalId", "int", "k")], "Table string, Column string, Type string, Description string")
    for table in ("Table", "Fk_Table"):
        keys = spark.createDataFrame([("Item", "Vendor", "Vendor", "InternalId")], f"{table} string, Fk_Column string, Pk_Table string, Pk_Column string")
        link = flat_catalogue.discover(cloud, keys, flat_catalogue.CLOUD_SUITE).links.first()
        assert tuple(link) == ("Item", ["Vendor"], "Vendor", ["InternalId"], "Item to Vendor")


def test_commented_and_constant_sources(spark):
    columns = spark.createDataFrame(
        [("T", "B", "old", "PK", "N"), ("T", "B", "older", None, "N"), ("T", "A", "a", "PK", "N"), ("T", "C", None, None, "S")],
        "TABLE_NAME string, COLUMN_NAME string, COMMENTS string, PRIMARY_KEY string, DATA_TYPE string",
    )
    found = flat_catalogue.discover_commented(columns)
    assert found.objects.first()["primary_key_raw_fields"] == ["A"]  # the greatest comment of B is no key row
    assert {r["raw_field_name"]: r["field_name"] for r in found.fields.collect()} == {"A": "a", "B": "older", "C": None}
    assert found.links.isEmpty()
    constant = DISCOVERY["historian"](spark, "pi")
    assert constant.objects.first()["primary_key_raw_fields"] == ["path"]
    assert constant.fields.count() == 10 and constant.links.schema.fieldNames() == LINKS.fieldNames()


def test_json_catalogue(spark, tmp_path):
    def doc(name, text, columns, key):
        return {"name": name, "schema": {"description": text, "properties": columns}, "properties": {"IdentifierPaths": [key]}}

    first = {"objects": [
        doc("LN_tab001", "LN tab001 Sales Orders, more", {"orno": {"type": "string", "description": "Order"}, "refc": {"type": "integer", "description": "Refers to table tab002 by key"}}, "['orno']"),
        doc("LN_tab002", "LN.tab002.Customers", {"cuno": {"type": "string"}, "date": {"type": "string", "format": "date-time"}}, "/cuno"),
    ]}
    second = {"objects": [doc("LN_tab003", "LN tab003 Lonely", {"ref1": {"type": "string", "description": "no target"}}, "x")]}
    for i, content in enumerate((first, second)):
        (tmp_path / f"{i}.json").write_text(json.dumps(content, indent=1))
    found = json_catalogue.discover(json_catalogue.read_documents(spark, str(tmp_path)))
    objects = {r["object_name"]: (r["primary_key_raw_fields"], r["description"]) for r in found.objects.collect()}
    assert objects == {"ln_tab001": (["orno"], "Sales Orders"), "ln_tab002": (["cuno"], "Customers"), "ln_tab003": (["x"], "Lonely")}
    fields = {r["raw_field_name"]: (r["field_name"], r["field_type"]) for r in found.fields.collect()}
    assert fields["cuno"] == ("cuno", "string") and fields["date"] == ("date", "date-time") and fields["refc"][1] == "integer"
    links = {r["primary_object_name"]: (r["primary_object_raw_fields"], r["foreign_object_name"], r["foreign_object_raw_fields"]) for r in found.links.collect()}
    assert links == {"ln_tab001": (["orno"], "ln_tab002", ["cuno"]), "ln_tab003": (["x"], None, None)}


def test_json_links_read_the_export_twice(spark, tmp_path):
    def doc(name, refs, key):
        columns = {f"ref{i}": {"type": "string", "description": text} for i, text in enumerate(refs)} | {"c": {"type": "string"}}
        return {"name": name, "schema": {"description": None, "properties": columns}, "properties": {"IdentifierPaths": key}}

    to = "Value of table {} here".format
    documents = [
        doc("LN_a", [to("b"), to("b"), "nothing", None], ["a1"]),  # to both tables of a name, twice; the rest leads nowhere
        doc("LN_b", [], ["b1"]), doc("LN_b", [], ["b2"]),
        doc("LN_c", [to("gone"), "nothing"], ["c1"]),  # no target at all
        doc("LN_d", [to("e")], None), doc("LN_d", [], ["d2"]),  # a name that comes twice, references in one of them
        doc("LN_e", [to("e")], ["e1"]),
        doc(None, [to("b")], ["n"]),
        {"name": "LN_f", "schema": None, "properties": None},
    ]
    for i, document in enumerate(documents):
        (tmp_path / f"{i}.json").write_text(json.dumps({"objects": [document]}))
    (tmp_path / "empty.json").write_text(json.dumps({"objects": []}))
    links = json_catalogue.discover(json_catalogue.read_documents(spark, str(tmp_path))).links
    got = sorted([tuple(r)[:4] for r in links.collect()], key=str)
    assert got == sorted([
        *[("ln_a", ["a1"], "ln_b", [k]) for k in ("b1", "b2") for _ in range(2)],
        ("ln_c", ["c1"], None, None),
        ("ln_d", None, "ln_e", ["e1"]), ("ln_d", ["d2"], "ln_e", ["e1"]),
        ("ln_e", ["e1"], "ln_e", ["e1"]),
    ], key=str)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = json_catalogue.discover(json_catalogue.read_documents(spark, str(tmp_path))).links._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("FileScan json") == 2


def test_metadata_diffs(spark, rows):
    def meta(pk, label):
        return Metadata(
            spark.createDataFrame([("T", [pk], None, [])], OBJECTS),
            spark.createDataFrame([("U", label, "F", "CHAR", None, None, None, 1)], FIELDS),
            spark.createDataFrame([], LINKS),
        )

    names = spark.createDataFrame([("T",), ("U",), ("V",)], "table_name string")
    assert rows(metadata_diffs(names, meta("a", "x"), meta("a", "x"))) == [("T", False), ("U", False), ("V", False)]
    assert rows(metadata_diffs(names, meta("b", "x"), meta("a", "y"))) == [("T", True), ("U", True), ("V", False)]
