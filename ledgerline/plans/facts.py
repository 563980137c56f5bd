"""Invoice and sales facts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.functions.keys import role_pair_keys, template
from ledgerline.functions.text import numeric_code
from ledgerline.operators.columns import contract, quoted
from ledgerline.operators.filters import business_rules, is_member, recent, sign_of
from ledgerline.operators.joins import Dimension, null_safe_left_join, prefer_right, star_join

FACT_MONTHS = 25
ROLES = {"soldto": "sold_to_key", "billto": "bill_to_key", "shipto": "ship_to_key"}
MEMBERS = {"product": "product_key", "trade_name": "trade_name"}


def invoice_title(document: str, item: str, ship_to: str, date: str) -> Column:
    return template(
        "Invoice: ", quoted(document), ", Item: ", quoted(item),
        ", Ship To: ", quoted(ship_to), " on ", quoted(date),
    )


def enriched_invoices(
    items: DataFrame,
    dimensions: Sequence[Dimension],
    as_of: dt.date,
    months: int = FACT_MONTHS,
    title: Column | None = None,
    output: Sequence[str] | None = None,
    roles: Mapping[str, str] = ROLES,
    members: Mapping[str, str] = MEMBERS,
) -> DataFrame:
    """Recent invoice items with their dimensions' attributes, unit price, pair keys and title."""
    fact = star_join(recent(items, "billing_date", as_of, months), dimensions)
    fact = fact.withColumns(
        {
            "unit_price": F.try_divide("sales_value", "billed_quantity"),
            **role_pair_keys(dict(roles), dict(members)),
        }
    )
    if title is not None:
        fact = fact.withColumn("title", title)
    return contract(fact, output) if output else fact


def sales_items(
    orders: DataFrame, products: DataFrame, customers: DataFrame, accounts: DataFrame, sort: bool = True
) -> DataFrame:
    """Order items with product, customer and account attributes, newest document first.

    The title names the customer when there is one.
    """
    joined = null_safe_left_join(orders, products, [("product_key", "primary_key")])
    joined = null_safe_left_join(joined, customers, [("customer_key", "primary_key")])
    joined = null_safe_left_join(joined, accounts, [("account_key", "primary_key")])
    joined = joined.withColumn("product_number", numeric_code(F.col("product_code")))
    head = [
        "Sales Document ", F.col("document_number"), ", Item ", F.col("item_number"),
        " (CIN: ", F.col("product_number"),
    ]
    titled = joined.withColumn(
        "title",
        F.when(
            F.col("customer_name").isNotNull(),
            template(*head, ") for ", F.col("customer_name"), " on ", F.col("document_date")),
        ).otherwise(template(*head, ") on ", F.col("document_date"))),
    )
    return titled.orderBy(F.col("document_date").desc()) if sort else titled


def contract_filter_view(items: DataFrame, products: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Chosen item columns under new names, with the product's trade name before the invoice's."""
    view = items.select(
        *[quoted(source).alias(name) for name, source in columns.items()],
        F.col("trade_name").alias("__billed_name"),
    )
    details = products.withColumnsRenamed({"primary_key": "product_fk", "trade_name": "__billed_name"})
    return prefer_right(view, details, "product_fk", "__billed_name", "trade_name").drop("__billed_name")


@dataclass(frozen=True)
class InvoiceRules:
    """Which invoice items count; every list is a deployment's own."""

    keep: dict[str, Sequence] = field(default_factory=dict)
    exclude: dict[str, Sequence] = field(default_factory=dict)
    exclude_prefix: dict[str, Sequence[str]] = field(default_factory=dict)
    excluded_order_types: Sequence[str] = ()
    service_types: Sequence[str] = ()
    negative_categories: Sequence[str] = ()
    specialty_plants: Sequence[str] = ()
    source_contracts: Sequence[str] = ()
    ship_to_role: str = "WE"


def raw_invoices(
    headers: DataFrame,
    items: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    partners: DataFrame,
    rules: InvoiceRules,
) -> DataFrame:
    """Header and item joined, filtered by the business rules, with signed measures and flags.

    Filters run before the joins they do not need; orders of an excluded type and service
    products are removed by anti-join.
    """
    named = {*rules.keep, *rules.exclude, *rules.exclude_prefix}
    if unknown := named - {*items.columns, *headers.columns}:
        raise ValueError(f"rules name columns of neither table: {sorted(unknown)}")

    def part(names: dict, table: DataFrame) -> dict:
        return {c: v for c, v in names.items() if c in table.columns}

    def ruled(table: DataFrame) -> DataFrame:
        return business_rules(
            table,
            part(rules.keep, table),
            part(rules.exclude, table),
            part(rules.exclude_prefix, table),
        )

    excluded_orders = orders.filter(quoted("order_type").isin(list(rules.excluded_order_types)))
    services = products.filter(quoted("product_type").isin(list(rules.service_types)))
    kept = null_safe_left_join(
        ruled(items), excluded_orders.select("order_key"), [("order_key", "order_key")], "left_anti"
    )
    kept = null_safe_left_join(
        kept, services.select("product_key"), [("product_key", "product_key")], "left_anti"
    )
    joined = kept.join(ruled(headers), "header_key")
    ship_to = (
        partners.filter(F.col("role") == rules.ship_to_role)
        .groupBy("header_key")
        .agg(F.min("partner_key").alias("ship_to_key"))
    )
    joined = null_safe_left_join(joined, ship_to, [("header_key", "header_key")])
    sign = sign_of(F.col("document_category"), rules.negative_categories)
    return joined.withColumns(
        {
            "sales_value": (F.col("subtotal") - F.col("rebate")) * sign,
            "total_unit_strength": F.col("billed_quantity") * F.col("strength") * sign,
            "specialty_flag": is_member(F.col("plant_key"), rules.specialty_plants),
            "source_flag": is_member(F.col("contract_type"), rules.source_contracts),
        }
    )
