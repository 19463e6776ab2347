"""The product catalog: checked rows, and the lookups that come from it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import CATALOG_COLUMNS, LAG_COLUMNS, ORDER_COLUMNS
from ..functions.columns import lag_map, order_struct, split_list, stripped


@dataclass(frozen=True)
class Catalog:
    """groups: one row per group; skus: (Product_Group, sku) with fan-out; first_skus: one group per SKU;
    units: (Product_Group, BU, unit_order); unit_names: (BU, BU_Name); rejected: rows with their reasons."""

    groups: DataFrame
    skus: DataFrame
    first_skus: DataFrame
    units: DataFrame
    unit_names: DataFrame
    rejected: DataFrame


def parse_catalog(rows: DataFrame) -> Catalog:
    """rows have row_id, the catalog's columns as text, and optional lag columns.

    A row with a blank column, without a SKU or with an order that is no number is rejected. Of rows with
    one group, the last gives SKUs, mode, order and lags; units add up; a SKU's first row gives its one
    group; the last name of a unit's code counts.
    """
    blank = F.array_compact(F.array(*[F.when(F.coalesce(stripped(F.col(c)), F.lit("")) == "", c) for c in CATALOG_COLUMNS]))
    read = rows.withColumns({"_blank": blank, "skus": split_list(F.col("sku_list")), "order": order_struct(ORDER_COLUMNS), "Product_Group": stripped(F.col("group_key"))})
    reason = (
        F.when(F.size("_blank") > 0, F.concat(F.lit("blank columns: "), F.array_join("_blank", ", ")))
        .when(F.size("skus") == 0, "no valid SKUs after parsing")
        .when(F.col("order").isNull(), "invalid order value")
    )
    read = read.withColumn("reason", reason)
    valid = read.filter("reason is null")
    lags = F.map_from_entries(F.filter(F.array(*[F.struct(F.lit(feature).alias("key"), lag_map(F.col(c)).alias("value")) for c, feature in LAG_COLUMNS.items() if c in rows.columns]), lambda e: F.size(e["value"]) > 0)) if any(c in rows.columns for c in LAG_COLUMNS) else F.lit(None).cast("map<string,map<string,int>>")
    last = Window.partitionBy("Product_Group").orderBy(F.desc("row_id"))
    mode = stripped(F.col("salesforce_feature_mode"))
    groups = valid.withColumns({"mode": mode, "lags": lags, "_n": F.row_number().over(last)}).filter("_n = 1").select("Product_Group", "skus", "mode", "order", "lags")
    skus = groups.select("Product_Group", F.explode("skus").alias("sku"))
    each = valid.select("row_id", "Product_Group", F.posexplode("skus").alias("at", "sku")).withColumn("sku", stripped(F.col("sku"))).filter("sku <> ''")
    first = Window.partitionBy("sku").orderBy("row_id", "at")
    first_skus = each.withColumns({"_n": F.row_number().over(first), "sku_order": F.struct("row_id", "at")}).filter("_n = 1").select("sku", "Product_Group", "sku_order")
    named = valid.select("row_id", "Product_Group", F.posexplode(F.arrays_zip(split_list(F.col("business_unit_code")).alias("code"), split_list(F.col("business_unit_name")).alias("name"))).alias("at", "unit"))
    name = F.coalesce(stripped(F.col("unit.name")), F.lit(""))
    named = named.withColumn("BU", stripped(F.col("unit.code"))).filter("BU <> ''").withColumn("BU_Name", F.when(name != "", name).otherwise(F.col("BU")))
    units = named.groupBy("Product_Group", "BU").agg(F.min(F.struct("row_id", "at")).alias("unit_order"))
    unit_names = named.groupBy("BU").agg(F.max_by("BU_Name", F.struct("row_id", "at")).alias("BU_Name"))
    return Catalog(groups, skus, first_skus, units, unit_names, read.filter("reason is not null").select("row_id", "group_key", "reason"))


def analysis_skus(rows: DataFrame) -> DataFrame:
    """(sku, Product_Group) for diagnostics: any row with a group counts, the last row of a SKU wins."""
    each = rows.select("row_id", stripped(F.col("group_key")).alias("Product_Group"), F.posexplode(split_list(F.col("sku_list"), trim=True)).alias("at", "sku")).filter("Product_Group <> ''")
    return each.groupBy("sku").agg(F.max_by("Product_Group", F.struct("row_id", "at")).alias("Product_Group"))


def analysis_units(rows: DataFrame) -> DataFrame:
    """(Product_Group, BU) that diagnostics accept."""
    return rows.select(stripped(F.col("group_key")).alias("Product_Group"), F.explode(split_list(F.col("business_unit_code"), trim=True)).alias("BU")).filter("Product_Group <> ''").distinct()
