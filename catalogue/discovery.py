"""Queries on metadata discovery.

Each source's system tables are derived from deliveries: a supplier stands for a table, a
product it delivers for a column.  A column is a key column if one of its deliveries has the
full quantity and no discount.  So the dictionaries grow with the given tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.tables import table
from ledgerline.metadata import dictionary, flat_catalogue, json_catalogue, suite_catalogue, system_catalogue
from ledgerline.operators.rollups import ordered_names
from ledgerline.session import scratch_folder as scratch


def columns_of(spark, sf):
    """(supplier, product) with what a dictionary knows about a column."""
    lines = table(spark, sf, "lineitem")
    part = table(spark, sf, "part")
    full = (F.col("l_quantity") == 50) & (F.col("l_discount") == 0)
    return (
        lines.groupBy(F.col("l_suppkey").alias("t"), F.col("l_partkey").alias("c"))
        .agg(F.max(full).alias("is_key"), F.max("l_linenumber").alias("n"))
        .join(part, F.col("c") == F.col("p_partkey"))
        .select("t", "c", "is_key", "n", "p_name", "p_type", F.concat_ws("-", "p_brand", "p_size").alias("domain"))
    )


COLUMNS = """cols AS (SELECT l_suppkey AS t, l_partkey AS c, max(l_quantity = 50 AND l_discount = 0) AS is_key,
    max(l_linenumber) AS n, any_value(p_name) AS p_name, any_value(p_type) AS p_type,
    any_value(p_brand || '-' || p_size) AS domain
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)"""

KEYS = """keys AS (SELECT t, list(c ORDER BY c) AS ids, count(*) AS k FROM cols WHERE is_key GROUP BY 1)"""


def _join(name):
    return F.array_join(name, "|")


def _shown(df, *lists):
    return df.withColumns({c: _join(c) for c in lists})


def _dictionary(spark, sf):
    cols = columns_of(spark, sf)
    suppliers = table(spark, sf, "supplier")
    name = F.concat(F.lit("T"), F.col("t").cast("string"))
    field = F.concat(F.lit("F"), F.col("c").cast("string"))
    keys = cols.filter("is_key")
    return {
        "DD02L": suppliers.select(F.concat(F.lit("T"), F.col("s_suppkey").cast("string")).alias("TABNAME")),
        "DD02T": suppliers.select(
            F.concat(F.lit("T"), F.col("s_suppkey").cast("string")).alias("TABNAME"),
            F.when(F.col("s_acctbal") > 0, "E").otherwise("D").alias("DDLANGUAGE"),
            F.col("s_name").alias("DDTEXT"),
        ),
        "DD03L": cols.select(
            name.alias("TABNAME"), field.alias("FIELDNAME"),
            F.concat(F.lit("E"), F.col("c").cast("string")).alias("ROLLNAME"),
            F.col("domain").alias("DOMNAME"),
            F.when(F.col("is_key"), "X").alias("KEYFLAG"),
            F.lpad(F.col("c").cast("string"), 9, "0").alias("POSITION"),
            F.when(F.col("p_type") == "PROMO", " ").otherwise("CHAR").alias("DATATYPE"),
        ),
        "DD04T": table(spark, sf, "part").select(
            F.concat(F.lit("E"), F.col("p_partkey").cast("string")).alias("ROLLNAME"),
            F.when(F.col("p_size") > 10, "E").otherwise("D").alias("DDLANGUAGE"),
            F.col("p_type").alias("SCRTEXT_S"), F.col("p_name").alias("SCRTEXT_L"),
        ),
        "DD08L": keys.select(
            name.alias("TABNAME"), field.alias("FIELDNAME"),
            F.concat(F.lit("T"), F.floor(F.col("t") / 2).cast("string")).alias("CHECKTABLE"),
            F.when(F.col("n") > 5, "TEXT").otherwise("KEY").alias("FRKART"),
        ),
        "DD05S": keys.select(
            name.alias("TABNAME"), field.alias("FIELDNAME"), F.lit("0001").alias("PRIMPOS"),
            field.alias("FORKEY"), name.alias("FORTABLE"),
        ),
    }


def dictionary_objects(spark, sf):
    found = dictionary.discover(_dictionary(spark, sf)).objects
    return _shown(found, "primary_key_raw_fields", "text_table_names")


def dictionary_fields(spark, sf):
    return dictionary.discover(_dictionary(spark, sf)).fields


def dictionary_links(spark, sf):
    found = dictionary.discover(_dictionary(spark, sf)).links
    return _shown(found, "primary_object_raw_fields", "foreign_object_raw_fields")


_DD = f"""WITH {COLUMNS},
known AS (SELECT 'T' || t AS tab, 'F' || c AS fld, 'E' || c AS element, domain, is_key, c AS pos, p_type, p_name, n
  FROM cols WHERE p_type <> 'PROMO'),
keyed AS (SELECT * FROM known WHERE is_key),
keylist AS (SELECT tab, list(fld ORDER BY pos) AS names, count(*) AS k FROM keyed GROUP BY 1)"""

_DD_OBJECTS = f"""{_DD}, rel AS (SELECT DISTINCT 'T' || (t // 2) AS check_tab, 'T' || t AS tab FROM cols WHERE is_key AND n > 5),
texts AS (SELECT check_tab, array_to_string(list_sort(list(tab)), '|') AS text_tables FROM rel GROUP BY 1)
SELECT tab AS object_name, array_to_string(names, '|') AS primary_key_raw_fields,
  CASE WHEN s_acctbal > 0 THEN s_name END AS description, coalesce(text_tables, '') AS text_table_names
FROM keylist JOIN supplier ON tab = 'T' || s_suppkey LEFT JOIN texts ON check_tab = tab"""

_DD_FIELDS = f"""{_DD}, sizes AS (SELECT 'T' || s_suppkey AS tab, greatest(count(k.tab), 1) AS n FROM supplier LEFT JOIN known k ON k.tab = 'T' || s_suppkey GROUP BY 1)
SELECT tab AS object_name, CASE WHEN p_size > 10 THEN known.p_name END AS field_name, fld AS raw_field_name, 'CHAR' AS field_type,
  CASE WHEN p_size > 10 THEN known.p_type END AS field_description, domain AS domain_name, CAST(NULL AS VARCHAR) AS field_literal,
  CAST(pos AS INTEGER) AS field_order FROM known JOIN part ON p_partkey = pos
UNION ALL SELECT tab, 'Language Key', 'SPRAS', 'CHAR', 'Language Key', 'SPRAS', 'E', CAST(n + 1 AS INTEGER) FROM sizes
UNION ALL SELECT tab, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM sizes WHERE tab NOT IN (SELECT tab FROM known)"""


def _rule(by: str) -> str:
    return f"""SELECT m.tab AS primary_object_name, list(m.fld ORDER BY m.pos) AS own, m.foreign_tab AS foreign_object_name
FROM (SELECT p.tab, f.tab AS foreign_tab, f.pos, arg_min(p.fld, p.pos) AS fld FROM keyed f JOIN known p ON p.{by} = f.{by} AND p.tab <> f.tab GROUP BY 1, 2, 3) m
JOIN keylist k ON k.tab = m.foreign_tab GROUP BY m.tab, m.foreign_tab, k.k HAVING count(*) = k.k"""


_DD_LINKS = f"""{_DD}, found AS ({_rule('element')} UNION ALL {_rule('domain')}
  UNION ALL SELECT 'T' || t, ['F' || c], 'T' || (t // 2) FROM cols WHERE is_key AND p_type <> 'PROMO')
SELECT DISTINCT primary_object_name, array_to_string(own, '|') AS primary_object_raw_fields, foreign_object_name,
  array_to_string(names, '|') AS foreign_object_raw_fields, CAST(NULL AS VARCHAR) AS link_description
FROM found JOIN keylist ON tab = foreign_object_name WHERE len(own) = k AND primary_object_name <> foreign_object_name"""


def _views(spark, sf):
    """System views: tables, columns, types, one index and one constraint per table."""
    cols = columns_of(spark, sf)
    suppliers = table(spark, sf, "supplier")
    kinds = {"SMALL": 1, "MEDIUM": 2, "LARGE": 3, "ECONOMY": 4, "STANDARD": 5, "PROMO": 6}
    number = F.coalesce(*[F.when(F.col("p_type") == k, F.lit(v)) for k, v in kinds.items()])
    names = {"SMALL": "int", "MEDIUM": "varchar", "LARGE": "datetime", "ECONOMY": "float", "STANDARD": "xml", "PROMO": "char"}
    catalogue_name = F.coalesce(*[F.when(F.col("p_type") == k, F.lit(v)) for k, v in names.items()])
    keys = cols.filter("is_key")
    target = F.floor(F.col("t") / 2)
    return {
        "tables": suppliers.select(
            F.concat(F.lit("SupplierTb"), F.col("s_suppkey").cast("string")).alias("name"),
            F.col("s_suppkey").alias("object_id"), F.lit(1).alias("schema_id"),
        ),
        "columns": cols.select(
            F.concat(F.lit("PartCol"), F.col("c").cast("string")).alias("name"), F.col("t").alias("object_id"),
            F.col("c").alias("column_id"), number.alias("user_type_id"), (F.col("t") * 7).alias("default_object_id"),
        ),
        "types": table(spark, sf, "part").select(catalogue_name.alias("name"), number.alias("user_type_id")).distinct(),
        "default_constraints": suppliers.filter("s_acctbal > 5000").select((F.col("s_suppkey") * 7).alias("object_id")),
        "index_columns": cols.select(
            F.col("t").alias("object_id"), F.col("c").alias("column_id"), F.when(F.col("is_key"), 1).otherwise(2).alias("index_id")
        ),
        "indexes": suppliers.select(
            F.col("s_suppkey").alias("object_id"),
            F.explode(F.array(F.lit(1), F.lit(2))).alias("index_id"),
        ).select("object_id", "index_id", (F.col("index_id") == 1).alias("is_primary_key"), ((F.col("index_id") == 2) & (F.col("object_id") > 50)).alias("is_unique_constraint")),
        "foreign_keys": suppliers.select(
            F.concat(F.lit("FK_"), F.col("s_name")).alias("name"), (F.col("s_suppkey") + 1000000).alias("object_id"),
            F.col("s_suppkey").alias("parent_object_id"), F.floor(F.col("s_suppkey") / 2).alias("referenced_object_id"),
        ),
        "foreign_key_columns": keys.select(
            (F.col("t") + 1000000).alias("constraint_object_id"), F.col("t").alias("parent_object_id"),
            F.col("c").alias("parent_column_id"), F.col("t").alias("referenced_object_id"), F.col("c").alias("referenced_column_id"),
        ),
        "check_constraints": cols.filter("n > 5").select(F.col("t").alias("parent_object_id"), F.col("c").alias("parent_column_id")),
        "extended_properties": cols.filter("n > 4").select(
            F.col("t").alias("major_id"), F.col("c").alias("minor_id"), F.lit("MS_Description").alias("name"), F.lit("OBJECT_OR_COLUMN").alias("class_desc")
        ),
        "computed_columns": cols.filter("n = 3").select(F.col("t").alias("object_id"), F.col("c").alias("column_id")),
    }


def system_objects(spark, sf):
    return _shown(system_catalogue.discover(_views(spark, sf)).objects, "primary_key_raw_fields", "text_table_names")


def system_fields(spark, sf):
    return system_catalogue.field_metadata(_views(spark, sf), with_flags=True)


def system_links(spark, sf):
    return _shown(
        system_catalogue.discover(_views(spark, sf)).links, "primary_object_raw_fields", "foreign_object_raw_fields"
    )


_SYSTEM_TYPE = "CASE p_type WHEN 'SMALL' THEN 'integer' WHEN 'MEDIUM' THEN 'string' WHEN 'LARGE' THEN 'timestamp' WHEN 'ECONOMY' THEN 'double' WHEN 'PROMO' THEN 'string' END"


def _suite(spark, sf):
    """An application suite's dictionary: per table an S key, or only a D key, and one foreign key."""
    cols = columns_of(spark, sf)
    suppliers = table(spark, sf, "supplier")
    keys = cols.filter("is_key")
    app = F.lit(1).alias("APPLICATION_ID")
    name = F.concat(F.lit("T"), F.col("s_suppkey").cast("string"))
    kind = F.explode(F.when(F.col("s_nationkey") > 12, F.array(F.lit("S"), F.lit("D"))).otherwise(F.array(F.lit("D"))))
    key_id = F.col("s_suppkey") * 10 + F.when(F.col("PRIMARY_KEY_TYPE") == "S", 1).otherwise(2)
    nations = suppliers.select(F.col("s_suppkey").alias("t"), "s_nationkey")
    chosen = keys.join(nations, "t").withColumn(
        "key_id", F.col("t") * 10 + F.when(F.col("s_nationkey") > 12, 1).otherwise(2)
    )
    return {
        "FND_TABLES": suppliers.select(
            app, F.col("s_suppkey").alias("TABLE_ID"), name.alias("TABLE_NAME"),
            F.when(F.col("s_acctbal") > 0, F.col("s_name")).alias("DESCRIPTION"),
        ),
        "ALL_TABLES": suppliers.filter("s_acctbal > -900").select(F.lit("APPS").alias("OWNER"), name.alias("TABLE_NAME")),
        "FND_COLUMNS": cols.select(
            app, F.col("t").alias("TABLE_ID"), F.col("c").alias("COLUMN_ID"),
            F.concat(F.lit("C"), F.col("c").cast("string")).alias("COLUMN_NAME"),
            F.col("p_type").alias("COLUMN_TYPE"), F.col("p_name").alias("DESCRIPTION"),
        ),
        "FND_PRIMARY_KEYS": suppliers.select(
            app, F.col("s_suppkey").alias("TABLE_ID"), "s_suppkey", kind.alias("PRIMARY_KEY_TYPE"), F.lit("Y").alias("AUDIT_KEY_FLAG")
        ).withColumn("PRIMARY_KEY_ID", key_id).drop("s_suppkey"),
        "FND_PRIMARY_KEY_COLUMNS": chosen.select(
            app, F.col("t").alias("TABLE_ID"), F.col("c").alias("COLUMN_ID"), F.col("key_id").alias("PRIMARY_KEY_ID")
        ),
        "FND_FOREIGN_KEYS": chosen.select(
            app, F.col("t").alias("TABLE_ID"), F.col("t").alias("FOREIGN_KEY_ID"),
            F.floor(F.col("t") / 2).alias("PRIMARY_KEY_TABLE_ID"), F.col("key_id").alias("PRIMARY_KEY_ID"),
        ).distinct(),
        "FND_FOREIGN_KEY_COLUMNS": cols.filter("n = 7").select(
            app, F.col("t").alias("TABLE_ID"), F.col("c").alias("COLUMN_ID"), F.col("t").alias("FOREIGN_KEY_ID")
        ),
    }


def suite_objects(spark, sf):
    return _shown(suite_catalogue.discover(_suite(spark, sf)).objects, "primary_key_raw_fields").drop("text_table_names")


def suite_fields(spark, sf):
    found = suite_catalogue.discover(_suite(spark, sf)).fields
    return found.select("object_name", "field_name", "raw_field_name", "field_type", "field_description")


def suite_links(spark, sf):
    return _shown(
        suite_catalogue.discover(_suite(spark, sf)).links, "primary_object_raw_fields", "foreign_object_raw_fields"
    )


def _flat(spark, sf):
    cols = columns_of(spark, sf)
    name = F.concat(F.lit("SalesTable"), F.col("t").cast("string"))
    columns = cols.select(
        name.alias("TableName"), F.concat(F.lit("Col"), F.col("c").cast("string")).alias("ColumnName"),
        F.col("p_type").alias("DataTypeName"), F.col("p_name").alias("Description"),
    )
    links = cols.filter("is_key").select(
        name.alias("TableName"), F.concat(F.lit("Col"), F.col("c").cast("string")).alias("ColumnName"),
        F.concat(F.lit("SalesTable"), F.floor(F.col("t") / 2).cast("string")).alias("ReferencedTableName"),
        F.lit("Id").alias("ReferencedColumnName"), F.col("domain").alias("ForeignKeyName"),
    )
    return columns, links


def flat_objects(spark, sf):
    return _shown(
        flat_catalogue.discover(*_flat(spark, sf), flat_catalogue.CRM).objects, "primary_key_raw_fields", "text_table_names"
    )


def flat_links(spark, sf):
    """The second flat layout, whose links are described by their two tables."""
    columns, links = _flat(spark, sf)
    columns = columns.withColumnsRenamed({"TableName": "Table", "ColumnName": "Column", "DataTypeName": "Type"})
    links = links.withColumnsRenamed(
        {"TableName": "Fk_Table", "ColumnName": "Fk_Column", "ReferencedTableName": "Pk_Table", "ReferencedColumnName": "Pk_Column"}
    )
    found = flat_catalogue.discover(columns, links, flat_catalogue.CLOUD_SUITE).links
    return _shown(found, "primary_object_raw_fields", "foreign_object_raw_fields")


def commented_objects(spark, sf):
    cols = columns_of(spark, sf).select(
        F.concat(F.lit("T"), F.col("t").cast("string")).alias("TABLE_NAME"),
        F.concat(F.lit("C"), F.col("c").cast("string")).alias("COLUMN_NAME"),
        F.explode(F.array("p_name", "p_type")).alias("COMMENTS"),
        F.when(F.col("is_key"), "PK").alias("PRIMARY_KEY"),
        F.col("p_type").alias("DATA_TYPE"),
    )
    found = flat_catalogue.discover_commented(cols)
    named = found.fields.groupBy("object_name").agg(F.count("*").alias("fields"), F.min("field_name").alias("first_label"))
    return _shown(found.objects, "primary_key_raw_fields").select("object_name", "primary_key_raw_fields").join(named, "object_name")


def _documents(spark, sf):
    """One JSON file per table, written and read back."""
    cols = columns_of(spark, sf)
    entry = F.struct(
        F.concat(F.when(F.col("is_key"), "ref").otherwise("c"), F.col("c").cast("string")).alias("key"),
        F.struct(
            F.when(F.col("is_key"), F.concat(F.lit("Value of table "), F.lit("t"), F.floor(F.col("t") / 2).cast("string"), F.lit(" here")))
            .when(F.col("p_type") != "PROMO", F.col("p_name")).alias("description"),
            F.lit("string").alias("type"),
            F.when(F.col("p_type") == "LARGE", "date-time").alias("format"),
        ).alias("value"),
    )
    document = cols.groupBy("t").agg(
        F.map_from_entries(F.collect_list(entry)).alias("columns"),
        F.concat(F.lit("/c"), F.min("c").cast("string"), F.lit("/x")).alias("path"),
    )
    folder = scratch(spark)
    document.select(
        F.array(
            F.struct(
                F.concat(F.lit("LN_T"), F.col("t").cast("string")).alias("name"),
                F.struct(
                    F.concat(F.lit("LN t"), F.col("t").cast("string"), F.lit(" Supplier "), F.col("t").cast("string"), F.lit(", more")).alias("description"),
                    F.col("columns").alias("properties"),
                ).alias("schema"),
                F.struct(F.array("path").alias("IdentifierPaths")).alias("properties"),
            )
        ).alias("objects")
    ).write.option("maxRecordsPerFile", 1).json(folder)
    return json_catalogue.read_documents(spark, folder)


def json_objects(spark, sf):
    return _shown(json_catalogue.discover(_documents(spark, sf)).objects, "primary_key_raw_fields").drop("text_table_names")


def json_fields(spark, sf):
    found = json_catalogue.discover(_documents(spark, sf)).fields
    return found.select("object_name", "field_name", "raw_field_name", "field_type", "field_description")


def json_links(spark, sf):
    found = json_catalogue.discover(_documents(spark, sf)).links
    return _shown(found, "primary_object_raw_fields", "foreign_object_raw_fields")


def ordered_key_lists(spark, sf):
    keys = columns_of(spark, sf).filter("is_key")
    lists = ordered_names(keys, ["t"], "c", {"products": "c", "labels": "p_name"})
    return lists.select("t", F.array_join(F.col("products").cast("array<string>"), "|").alias("products"), _join("labels").alias("labels"))


_JSON_DESC = "CASE WHEN is_key THEN 'Value of table t' || (t // 2) || ' here' WHEN p_type <> 'PROMO' THEN p_name ELSE 'c' || c END"

QUERIES = {
    "ordered_key_lists": (
        ordered_key_lists,
        f"""WITH {COLUMNS} SELECT t, array_to_string(list(c ORDER BY c), '|') AS products, array_to_string(list(p_name ORDER BY c), '|') AS labels
        FROM cols WHERE is_key GROUP BY 1""",
    ),
    "dictionary_objects": (dictionary_objects, _DD_OBJECTS),
    "dictionary_fields": (dictionary_fields, _DD_FIELDS),
    "dictionary_links": (dictionary_links, _DD_LINKS),
    "system_objects": (
        system_objects,
        f"""WITH {COLUMNS} SELECT 'SupplierTb' || s_suppkey AS object_name, coalesce(array_to_string(list('PartCol' || c ORDER BY c) FILTER (WHERE is_key), '|'), '') AS primary_key_raw_fields,
          CAST(NULL AS VARCHAR) AS description, '' AS text_table_names FROM supplier LEFT JOIN cols ON t = s_suppkey GROUP BY s_suppkey""",
    ),
    "system_fields": (
        system_fields,
        f"""WITH {COLUMNS} SELECT 'supplier_tb' || t AS object_name, 'part_col' || c AS field_name, 'PartCol' || c AS raw_field_name,
          {_SYSTEM_TYPE} AS field_type, is_key AS is_primary_key, is_key AS is_foreign_key, n > 5 AS is_checked, NOT is_key AND t > 50 AS is_unique,
          n > 4 AS is_described, n = 3 AS is_computed, s_acctbal > 5000 AS has_default FROM cols JOIN supplier ON t = s_suppkey""",
    ),
    "system_links": (
        system_links,
        f"""WITH {COLUMNS} SELECT 'SupplierTb' || t AS primary_object_name, array_to_string(list('PartCol' || c ORDER BY c), '|') AS primary_object_raw_fields,
          'SupplierTb' || (t // 2) AS foreign_object_name, array_to_string(list('PartCol' || c ORDER BY c), '|') AS foreign_object_raw_fields,
          any_value(s_name) AS link_description FROM cols JOIN supplier ON t = s_suppkey WHERE is_key GROUP BY t""",
    ),
    "suite_objects": (
        suite_objects,
        f"""WITH {COLUMNS} SELECT '"APPS"."T' || t || '"' AS object_name, array_to_string(list_sort(list('C' || c)), '|') AS primary_key_raw_fields,
          any_value(CASE WHEN s_acctbal > 0 THEN s_name END) AS description FROM cols JOIN supplier ON t = s_suppkey
        WHERE is_key AND s_acctbal > -900 GROUP BY t""",
    ),
    "suite_fields": (
        suite_fields,
        f"""WITH {COLUMNS} SELECT '"APPS"."T' || t || '"' AS object_name, 'C' || c AS field_name, 'C' || c AS raw_field_name, p_type AS field_type,
          p_name AS field_description FROM cols JOIN supplier ON t = s_suppkey WHERE s_acctbal > -900""",
    ),
    "suite_links": (
        suite_links,
        f"""WITH {COLUMNS}, k AS (SELECT t, array_to_string(list_sort(list('C' || c)), '|') AS fields FROM cols WHERE is_key GROUP BY 1),
        f AS (SELECT t, array_to_string(list_sort(list('C' || c)), '|') AS own FROM cols WHERE n = 7 GROUP BY 1)
        SELECT '"APPS"."T' || t || '"' AS primary_object_name, own AS primary_object_raw_fields, 'T' || t AS foreign_object_name,
          fields AS foreign_object_raw_fields, CAST(NULL AS VARCHAR) AS link_description
        FROM k JOIN f USING (t) JOIN supplier ON t = s_suppkey WHERE s_acctbal > -900""",
    ),
    "flat_objects": (
        flat_objects,
        f"""WITH {COLUMNS} SELECT DISTINCT 'SalesTable' || t AS object_name, 'Id' AS primary_key_raw_fields, 'Sales Table' || t AS description, '' AS text_table_names FROM cols""",
    ),
    "flat_links": (
        flat_links,
        f"""WITH {COLUMNS} SELECT 'SalesTable' || t AS primary_object_name, 'Col' || c AS primary_object_raw_fields, 'SalesTable' || (t // 2) AS foreign_object_name,
          'Id' AS foreign_object_raw_fields, 'SalesTable' || t || ' to SalesTable' || (t // 2) AS link_description FROM cols WHERE is_key""",
    ),
    "commented_objects": (
        commented_objects,
        f"""WITH {COLUMNS}, f AS (SELECT t, count(*) AS fields, min(greatest(p_name, p_type)) AS first_label FROM cols GROUP BY 1)
        SELECT 'T' || t AS object_name, array_to_string(list_sort(list('C' || c) FILTER (WHERE is_key)), '|') AS primary_key_raw_fields,
          any_value(f.fields) AS fields, any_value(f.first_label) AS first_label FROM cols JOIN f USING (t) GROUP BY t HAVING bool_or(is_key)""",
    ),
    "json_objects": (
        json_objects,
        f"""WITH {COLUMNS} SELECT 'ln_t' || t AS object_name, 'c' || min(c) AS primary_key_raw_fields, 'Supplier ' || t AS description FROM cols GROUP BY t""",
    ),
    "json_fields": (
        json_fields,
        f"""WITH {COLUMNS} SELECT 'ln_t' || t AS object_name, {_JSON_DESC} AS field_name, CASE WHEN is_key THEN 'ref' ELSE 'c' END || c AS raw_field_name,
          CASE WHEN p_type = 'LARGE' THEN 'date-time' ELSE 'string' END AS field_type, {_JSON_DESC} AS field_description FROM cols""",
    ),
    "json_links": (
        json_links,
        f"""WITH {COLUMNS}, o AS (SELECT t, 'c' || min(c) AS pk FROM cols GROUP BY 1)
        SELECT 'ln_t' || cols.t AS primary_object_name, o.pk AS primary_object_raw_fields, 'ln_t' || (cols.t // 2) AS foreign_object_name,
          p.pk AS foreign_object_raw_fields, CAST(NULL AS VARCHAR) AS link_description
        FROM cols JOIN o USING (t) JOIN o p ON p.t = cols.t // 2 WHERE is_key""",
    ),
}
