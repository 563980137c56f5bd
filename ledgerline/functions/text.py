"""Text and code expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# Fixed values of the pack-size grammar.
COUNT_UNITS = ("EA", "PC")
VOLUME_UNITS = ("ML", "OZ", "GM")
SOLID_FORMS = ("TB", "CP")
SERVICE_GROUP = "ZSERVICE"

# System-catalogue type names and the engine's names for them.
CATALOGUE_TYPES = {
    "int": "integer",
    "decimal": "decimal",
    "varchar": "string",
    "image": "string",
    "datetimeoffset": "timestamp",
    "datetime": "timestamp",
    "numeric": "decimal",
    "uniqueidentifier": "string",
    "float": "double",
    "char": "string",
    "nvarchar": "string",
}


def strip_leading_zeros(c: Column) -> Column:
    """Identifier without leading zeros; nothing left means null."""
    return F.nullif(F.trim(F.regexp_replace(c, "^0+", "")), F.lit(""))


def postal_prefix(c: Column) -> Column:
    """Postal code up to the first dash."""
    return F.regexp_replace(c, "-.*", "")


def numeric_code(c: Column) -> Column:
    """Code written as a plain whole number, null if it is not one."""
    return c.try_cast("bigint").cast("string")


def camel_to_words(c: Column) -> Column:
    """``SalesOrderItem`` as ``sales_order_item`` (column values)."""
    split = F.regexp_replace(c, "(.)([A-Z][a-z]+)", "$1_$2")
    return F.lower(F.regexp_replace(split, "([a-z0-9])([A-Z])", "$1_$2"))


def snake_name(name: str) -> str:
    """``ApplicationDocsID`` as ``application_docs_id`` (column and file names, plan time)."""
    words = re.findall(r"[A-Z]+(?![a-z])|[A-Z]?[a-z0-9]+|[0-9]+", name)
    tail = "_" if name.endswith("_") else ""
    return "_".join(w.lower() for w in words) + tail


def map_values(c: Column, mapping: dict[str, str]) -> Column:
    """Value looked up in a small mapping; unknown values are null."""
    if not mapping:
        return F.lit(None).cast("string")
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), c)


def catalogue_type(c: Column) -> Column:
    return map_values(c, CATALOGUE_TYPES)


def reference_table(description: Column, owner: Column) -> Column:
    """Table named in a text such as '... table abc ...', with the owner's leading name parts."""
    stem = F.nullif(F.regexp_extract(owner, r"^(\w+)_.*", 1), F.lit(""))
    target = F.nullif(F.regexp_extract(description, r"^.* table (\w+) .*", 1), F.lit(""))
    return F.concat_ws("_", F.coalesce(stem, F.lit("None")), F.coalesce(target, F.lit("None")))


def pack_quantity(
    size: Column, quantity: Column, pack: Column, form: Column, group: Column
) -> Column:
    """Number of units in a package, read from size texts such as ``4X6X8 EA`` or ``6X1000ML``.

    Countable goods (unit EA or PC, or tablet and capsule forms) multiply the factors around
    ``X``; measured goods (ML, OZ, GM, or a decimal size) leave the last factor, the content
    of one container, out.  A text that cannot be read as a number gives null.
    """
    held = F.when(quantity > 0, quantity).otherwise(F.lit(1)).cast("double")
    packed = F.when(pack > 0, pack).otherwise(F.lit(1)).cast("double")

    def factor(pattern: str, index: int) -> Column:
        return F.nullif(F.regexp_extract(size, pattern, index), F.lit("")).try_cast("double")

    def counted(unit: str | None) -> Column:
        product = r"(\d+)X(\d+)(?:X(\d+))?"
        multiplied = (
            factor(product, 1) * factor(product, 2) * F.coalesce(factor(product, 3), F.lit(1.0))
        )
        value = F.when(size.contains("X") & size.rlike(product), multiplied).when(
            size.contains("+"), packed
        )
        if unit is None:
            return value.otherwise(packed)
        first = F.when(size.contains(" "), F.split_part(size, F.lit(" "), F.lit(1))).otherwise(
            F.split_part(size, F.lit(unit), F.lit(1))
        )
        return value.otherwise(first.try_cast("double"))

    pieces = [F.split_part(size, F.lit("X"), F.lit(i)).try_cast("double") for i in (1, 2)]
    measured = (
        F.when(size.rlike(r"\d+X\d+X\d+(\.\d+)?"), pieces[0] * pieces[1])
        .when(size.contains("X"), pieces[0])
        .otherwise(held)
    )
    any_volume = F.lit(False)
    for unit in VOLUME_UNITS:
        any_volume = any_volume | size.contains(unit)

    return (
        F.when((pack == 0) | (group == SERVICE_GROUP), F.lit(1.0))
        .when(size.contains(COUNT_UNITS[0]), counted(COUNT_UNITS[0]))
        .when(any_volume, measured)
        .when(size.contains(COUNT_UNITS[1]), counted(COUNT_UNITS[1]))
        .when((size != "") & form.isin(*SOLID_FORMS), counted(None))
        .when(size.contains("."), measured)
        .otherwise(packed)
    )


def contains_any(c: Column, tokens: list[str]) -> Column:
    """Case-insensitive 'contains one of these texts' for a list written in the job."""
    found = F.lit(False)
    for token in tokens:
        found = found | F.upper(c).contains(token.upper())
    return F.coalesce(found, F.lit(False))


def key_positions(names: Column, elements: Column, wanted: Column, own_name: str | None = None) -> Column:
    """Names found at the positions of the wanted elements.

    ``names`` and ``elements`` are parallel arrays.  A wanted element takes the name at its first
    position; the element ``own_name`` is matched against the names themselves.  Elements that do
    not occur are left out.
    """

    def resolve(element: Column) -> Column:
        position = F.array_position(elements, element)
        if own_name is not None:
            position = F.when(
                element == own_name, F.array_position(names, F.lit(own_name))
            ).otherwise(position)
        return F.try_element_at(names, position.cast("int"))

    present = F.filter(wanted, lambda e: F.array_contains(elements, e))
    return F.transform(present, resolve)
