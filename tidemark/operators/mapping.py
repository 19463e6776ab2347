"""Mapping products to groups and business units to codes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import clean_key, normalize_code, stripped
from .catalog import Catalog

_MATCH = {"lower": lambda c: clean_key(c, lower=True), "exact": clean_key, "normalized": normalize_code}


def map_products(facts: DataFrame, skus: DataFrame, match: str = "lower", product: str = "Product", keep_unmapped: bool = False, once: str | None = None) -> DataFrame:
    """facts with Product_Group, once for each group that lists the product (SKUs listed twice count once).

    match is lower, exact or normalized. Rows that no group lists go, or stay with a null group. once names
    a column that is true in one row of each fact. The lookup is a dimension, which Spark broadcasts when it is small.
    """
    key = _MATCH[match]
    lookup = skus.select(key(F.col("sku")).alias("_sku"), "Product_Group").filter("_sku <> ''").distinct()
    if once:
        lookup = lookup.withColumn(once, F.min("Product_Group").over(Window.partitionBy("_sku")) == F.col("Product_Group"))
    out = facts.withColumn("_sku", key(F.col(product))).join(lookup, "_sku", "left" if keep_unmapped else "inner").drop("_sku")
    return out.withColumn(once, F.coalesce(once, F.lit(True))) if once else out


def unmapped_count(facts: DataFrame) -> DataFrame:
    return facts.agg(F.count_if(F.col("Product_Group").isNull()).alias("unmapped"))


def mapping_totals(mapped: DataFrame) -> DataFrame:
    """One row: how many lines, groups, units and products there are after mapping, and lines that no group lists."""
    return mapped.agg(
        F.count("*").alias("lines"), F.count_distinct("Product_Group").alias("groups"), F.count_distinct("BU").alias("units"), F.count_distinct(normalize_code(F.col("Product"))).alias("products"), F.count_if(F.col("Product_Group").isNull()).alias("unmapped")
    )


def reference_names(reference: DataFrame, groups: DataFrame) -> DataFrame:
    """(name, Product_Group, row_id): pipeline names in lower case with a known group; the first row counts."""
    named = reference.select("row_id", F.lower(stripped(F.col("salesforce_product_name"))).alias("name"), stripped(F.col("group_key")).alias("Product_Group")).filter("name <> '' and Product_Group <> ''")
    known = named.join(groups.select("Product_Group").distinct(), "Product_Group", "left_semi")
    return known.groupBy("name").agg(F.min_by("Product_Group", "row_id").alias("Product_Group"), F.min("row_id").alias("row_id"))


def resolve_names(names: DataFrame, catalog: Catalog, reference: DataFrame) -> DataFrame:
    """(name, Product_Group) for distinct pipeline names: by reference name, its normalised form, group key, SKU,
    normalised SKU, in this order; null if none knows it. Of equal normalised forms the last entry counts."""
    refs = reference_names(reference, catalog.groups)
    by_code = lambda df, c, order: df.select(normalize_code(F.col(c)).alias("code"), "Product_Group", order).filter("code <> ''").groupBy("code").agg(F.max_by("Product_Group", order).alias("Product_Group"))
    steps = [
        (refs.select("name", "Product_Group"), "name", "lower"),
        (by_code(refs, "name", "row_id"), "code", "code"),
        (catalog.groups.select(F.lower("Product_Group").alias("name"), "Product_Group").groupBy("name").agg(F.max("Product_Group").alias("Product_Group")), "name", "lower"),
        (catalog.first_skus.select("sku", "Product_Group"), "sku", "text"),
        (by_code(catalog.first_skus, "sku", "sku_order"), "code", "code"),
    ]
    out = names.select(stripped(F.col("name")).alias("name")).filter("name <> ''").distinct()
    out = out.withColumns({"_text": F.col("name"), "_lower": F.lower("name"), "_code": normalize_code(F.col("name"))})
    for i, (lookup, key, by) in enumerate(steps):
        out = out.join(lookup.select(F.col(key).alias(f"_{by}"), F.col("Product_Group").alias(f"_group{i}")), f"_{by}", "left")
    return out.select("name", F.coalesce(*[F.col(f"_group{i}") for i in range(len(steps))]).alias("Product_Group"))


def map_names(facts: DataFrame, resolved: DataFrame, product: str = "SF_Product_Name", keep_unmapped: bool = False) -> DataFrame:
    """facts with Product_Group by resolved names; rows with an unknown name go, or stay with a null group."""
    found = resolved.filter("Product_Group is not null").withColumnRenamed("name", "_name")
    return facts.withColumn("_name", stripped(F.col(product))).join(found, "_name", "left" if keep_unmapped else "inner").drop("_name")


def unmapped_names(resolved: DataFrame) -> DataFrame:
    return resolved.filter("Product_Group is null").select("name").distinct()


def reference_or_group(facts: DataFrame, reference: DataFrame, groups: DataFrame, on_duplicate: str = "all") -> DataFrame:
    """facts with Product_Group by exact reference name, else by the name of a group itself, else null.

    on_duplicate all repeats a row for every reference row of its name; first takes the first one.
    """
    refs = reference.select("row_id", stripped(F.col("salesforce_product_name")).alias("_name"), stripped(F.col("group_key")).alias("_group")).filter("_name is not null")
    refs = refs.join(groups.select(F.col("Product_Group").alias("_group")).distinct(), "_group", "left_semi")
    if on_duplicate == "first":
        refs = refs.withColumn("_n", F.row_number().over(Window.partitionBy("_name").orderBy("row_id"))).filter("_n = 1")
    own = groups.select(F.col("Product_Group").alias("_own")).distinct()
    out = facts.withColumn("_name", stripped(F.col("SF_Product_Name"))).join(refs.select("_name", "_group"), "_name", "left")
    out = out.join(own, F.col("_name") == F.col("_own"), "left")
    return out.withColumn("Product_Group", F.coalesce("_group", "_own")).drop("_name", "_group", "_own")


def normalize_units(facts: DataFrame, catalog: Catalog, unit: str = "BU") -> DataFrame:
    """BU as a code: a known code stays, a known name (in any case) becomes its code, other text is upper-cased.
    Blank units are null. Of units with one name, the larger code counts."""
    names = catalog.unit_names
    codes = names.select(F.col("BU").alias("_code"))
    by_name = names.select(F.lower(stripped(F.col("BU_Name"))).alias("_lower"), F.col("BU").alias("_by_name")).groupBy("_lower").agg(F.max("_by_name").alias("_by_name"))
    text = stripped(F.col(unit))
    out = facts.withColumn("_text", F.when(text != "", text)).withColumn("_lower", F.lower("_text"))
    out = out.join(codes, F.col("_text") == F.col("_code"), "left").join(by_name, "_lower", "left")
    return out.withColumn(unit, F.coalesce("_code", "_by_name", F.upper("_text"))).drop("_text", "_lower", "_code", "_by_name")


def unit_marks(facts: DataFrame, units: DataFrame, unlisted: str = "pass", mark: str = "_allowed") -> DataFrame:
    """facts with a boolean column mark: whether the group lists the row's unit. Groups that list none pass or drop."""
    listed = units.select("Product_Group", "BU").distinct()
    marked = facts.join(listed.withColumn(mark, F.lit(True)), ["Product_Group", "BU"], "left")
    if unlisted == "drop":
        return marked.withColumn(mark, F.coalesce(F.col(mark), F.lit(False)))
    some = listed.select("Product_Group").distinct().withColumn("_some", F.lit(True))
    return marked.join(some, "Product_Group", "left").withColumn(mark, F.coalesce(F.col(mark), F.col("_some").isNull())).drop("_some")


def valid_units(facts: DataFrame, units: DataFrame, unlisted: str = "pass") -> DataFrame:
    """Rows whose unit the group lists. Groups that list none pass or drop."""
    return unit_marks(facts, units, unlisted).filter("_allowed").drop("_allowed")


def requested_groups(groups: DataFrame, names: list[str] | None) -> tuple[DataFrame, DataFrame]:
    """(groups asked for, names that are no group); without names, all groups."""
    asked = groups.sparkSession.createDataFrame([(n,) for n in dict.fromkeys(n.strip() for n in names or []) if n], "Product_Group string")
    if not names:
        return groups, asked
    return groups.join(asked, "Product_Group", "left_semi"), asked.join(groups, "Product_Group", "left_anti")
