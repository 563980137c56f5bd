"""Dimensions with the metrics of their invoice items."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from ledgerline.functions.keys import pair_key, template, with_series_ids
from ledgerline.functions.text import numeric_code, pack_quantity, postal_prefix, strip_leading_zeros
from ledgerline.operators.columns import (
    decimals_to_double,
    drop_constant_columns,
    drop_null_columns,
    order_by_null_count,
    quoted,
    without_shared_columns,
)
from ledgerline.operators.dedup import unique
from ledgerline.operators.filters import genuine_relations, is_member, not_deleted
from ledgerline.operators.joins import containment_flag, null_safe_left_join, partner_columns, require_new, spread
from ledgerline.operators.rfm import RfmSpec, enrich_with_rfm, label_sets, packed_roles
from ledgerline.operators.rollups import attribute_rollup
from ledgerline.session import settled

ALL = ("all",)
SPLIT = ("all", "spd_only", "pd_only")

# Partner roles that become columns, and roles that get a table of their own.
PARTNER_COLUMN_ROLES = ("A1", "A2", "A3", "PG")
PARTNER_TABLE_ROLES = ("A1", "A2", "A3", "AL")


def measured(
    entities: DataFrame,
    items: DataFrame,
    roles: Mapping[str, Sequence[str]],
    spec: RfmSpec,
    filters: Sequence[str] = SPLIT,
    ranks: bool = True,
) -> DataFrame:
    """Entities with RFM metrics and time-series pointers for each role."""
    df = enrich_with_rfm(entities, items, roles, spec, ranks)
    for name in roles:
        df = with_series_ids(df, "primary_key", name, filters)
    return df


def with_partners(
    df: DataFrame,
    relations: DataFrame,
    names: DataFrame,
    owner: str,
    roles: Sequence[str] = PARTNER_COLUMN_ROLES,
    sentinel: str | None = None,
) -> DataFrame:
    """Partner key and name per role, from all roles in one grouping."""
    genuine = genuine_relations(relations, "customer_key", "partner_key", "role", roles, sentinel)
    partners = partner_columns(genuine, names, owner, "partner_key", "role", roles)
    return null_safe_left_join(df, partners, [("primary_key", "primary_key")])


def customers(
    base: DataFrame,
    classes: DataFrame,
    states: DataFrame,
    zips: DataFrame,
    territories: DataFrame,
    relations: DataFrame,
    items: DataFrame,
    spec: RfmSpec,
    sentinel: str | None = None,
    ranks: bool = True,
) -> DataFrame:
    """Customers that are not deleted, with class, geography, territory, partners and metrics.

    Tables with several rows for a key are made unique before they are joined.
    """
    df = unique(not_deleted(base, "deletion_flag"), ["primary_key"])
    df = null_safe_left_join(df, unique(classes, ["primary_key"]), [("class_key", "primary_key")])
    df = df.withColumns(
        {"state_code": F.col("region"), "zip_code": postal_prefix(F.col("postal_code"))}
    )
    df = null_safe_left_join(df, unique(states, ["state_code"]), [("state_code", "state_code")])
    df = df.withColumn("zip_code_geo_id", pair_key("state_geo_id", "zip_code"))
    df = null_safe_left_join(df, unique(zips, ["zip_code_geo_id"]), [("zip_code_geo_id", "zip_code_geo_id")])
    df = null_safe_left_join(df, unique(territories, ["primary_key"]), [("primary_key", "primary_key")])
    df = with_partners(df, relations, base, "customer_key", sentinel=sentinel)
    roles = {
        "customer": [spec.columns.sold_to],
        "customer_shipto": [spec.columns.ship_to],
        "customer_billto": [spec.columns.bill_to],
    }
    return measured(df, items, roles, spec, ranks=ranks)


def customer_accounts(
    accounts: DataFrame,
    customer_dimension: DataFrame,
    trade_classes: DataFrame,
    items: DataFrame,
    spec: RfmSpec,
    sold_to_account: str = "account_key",
    bill_to_account: str = "payer_account_key",
    ranks: bool = True,
) -> DataFrame:
    """Accounts that are not deleted, with their customer's columns and metrics of two roles.

    Partner columns are the customer's.
    """
    df = unique(not_deleted(accounts, "deletion_flag"), ["primary_key"])
    extra = [c for c in customer_dimension.columns if c not in accounts.columns]
    brought = [c for c in trade_classes.columns if c != "trade_class"]
    require_new(brought, extra)

    def classed(df: DataFrame) -> DataFrame:
        return null_safe_left_join(df, unique(trade_classes, ["trade_class"]), [("trade_class", "trade_class")])

    of_customer = "trade_class" in extra
    if not of_customer:
        df = classed(df)
    # the customer's hundreds of columns come last and as one struct, as the metrics do
    roles = {"customer_account": [sold_to_account], "customer_account_billto": [bill_to_account]}
    df, metrics = packed_roles(df, items, roles, spec, ranks)
    require_new(list(metrics), extra)
    customer = customer_dimension.select(
        F.col("primary_key").alias("customer_key"), F.struct(*[quoted(c) for c in extra]).alias("__customer")
    )
    df = null_safe_left_join(df, customer, [("customer_key", "customer_key")])
    shown = {c: quoted(c) for c in accounts.columns} | spread("__customer", extra)
    if of_customer:
        df = classed(df.withColumn("trade_class", shown["trade_class"]))
    shown |= {c: quoted(c) for c in brought} | metrics
    df = df.select(*[value.alias(c) for c, value in shown.items()])
    for name in roles:
        df = with_series_ids(df, "primary_key", name, SPLIT)
    return df


def partner_tables(
    relations: DataFrame, roles: Sequence[str] = PARTNER_TABLE_ROLES
) -> dict[str, DataFrame]:
    """Distinct relations per role."""
    return {r: relations.filter(F.col("role") == r).dropDuplicates() for r in roles}


def affiliations(
    customer_dimension: DataFrame, items: DataFrame, role: str, affiliation: str, spec: RfmSpec, ranks: bool = True
) -> DataFrame:
    """Customers that others are affiliated with, measured over the affiliated items."""
    name = f"customer_affiliation__{role}"
    first = spec.horizons[0].alias
    df = enrich_with_rfm(customer_dimension, items, {name: [affiliation]}, spec, ranks)
    df = df.filter(quoted(f"{name}_has_billing_documents_since_{first}").isNotNull())
    return with_series_ids(drop_null_columns(settled(df)), "primary_key", name, SPLIT)


def products(
    base: DataFrame,
    master: DataFrame,
    items: DataFrame,
    spec: RfmSpec,
    identifiers: Mapping[str, str],
    exclusive_names: list[str] | DataFrame,
    ranks: bool = True,
    prune: bool = True,
) -> DataFrame:
    """Products with pack quantity, clean identifiers, flag labels, metrics and an exclusivity flag."""
    df = null_safe_left_join(
        base, without_shared_columns(master, base, ["primary_key"]), [("primary_key", "primary_key")]
    )
    if prune:
        df = drop_constant_columns(df)
    df = decimals_to_double(df).withColumns(
        {
            "corrected_pack_qty": pack_quantity(
                F.col("size_text"), F.col("pack_quantity"), F.col("pack_size"),
                F.col("form"), F.col("product_group"),
            ),
            **{new: strip_leading_zeros(quoted(old)) for old, new in identifiers.items()},
        }
    )
    labels = label_sets(items, [spec.columns.product_key], spec.columns)
    df = null_safe_left_join(df, labels, [("primary_key", "primary_key")]).withColumns(
        {
            "spd_labels_count": F.size("spd_labels"),
            "source_labels_count": F.size("source_labels"),
        }
    )
    df = measured(df, items, {"product": [spec.columns.product_key]}, spec, ALL, ranks)
    return containment_flag(df, "trade_name", exclusive_names, "is_exclusive")


def product_rollup(
    product_dimension: DataFrame,
    items: DataFrame,
    attribute: str,
    name: str,
    spec: RfmSpec,
    ranks: bool = True,
    lists: Mapping[str, str] | None = None,
    first: Mapping[str, str] | None = None,
) -> DataFrame:
    """Products rolled up by one attribute (generic name, trade name, drug code), with metrics."""
    lists = dict(lists or {"product_key": "primary_key", "manufacturer_key": "manufacturer_key"})
    rolled = attribute_rollup(
        product_dimension,
        attribute,
        first=first,
        lists=lists,
        counted=list(lists),
        flattened={"spd_labels": "spd_labels", "source_labels": "source_labels"},
    )
    return decimals_to_double(measured(rolled, items, {name: [attribute]}, spec, ranks=ranks))


def vendors(base: DataFrame, items: DataFrame, spec: RfmSpec, key: str = "manufacturer_key", ranks: bool = True) -> DataFrame:
    """Vendors with a title and the metrics of what they manufacture."""
    df = base.withColumn("vendor_number", numeric_code(F.col("vendor_code"))).withColumn(
        "title", template(F.col("name"), " (", F.col("vendor_number"), ")")
    )
    df = enrich_with_rfm(df, items, {"manufacturer": [key]}, spec, ranks)
    return with_series_ids(df, "primary_key", "vendor", SPLIT)


def tidy_passthrough(base: DataFrame, textual: bool = False) -> DataFrame:
    """Without empty columns, the fullest columns first."""
    return order_by_null_count(base, textual, without_empty=True)


def plant_products(base: DataFrame, plant: str, specialty_plants: Sequence[str]) -> DataFrame:
    return tidy_passthrough(base).withColumn(
        "specialty_flag", is_member(quoted(plant), specialty_plants)
    )


def area_metrics(
    areas: DataFrame, items: DataFrame, code: str, geo_id: str, name: str, spec: RfmSpec, ranks: bool = True
) -> DataFrame:
    """States or zip codes with the metrics of the items billed there; keyed by their geo id."""
    df = enrich_with_rfm(
        areas.withColumnRenamed(code, "primary_key"), items, {name: [code]}, spec, ranks
    )
    df = df.withColumnsRenamed({"primary_key": code, geo_id: "primary_key"})
    tidy = drop_null_columns(settled(df), keep=["primary_key"])
    return with_series_ids(tidy, "primary_key", name, SPLIT)
