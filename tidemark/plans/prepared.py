"""One aligned dataset of pipeline features and actual quantities for diagnostics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import FEATURES
from ..functions.columns import currency_number, parse_month, stripped
from ..operators.catalog import analysis_skus, analysis_units
from ..operators.features import as_date
from ..operators.mapping import reference_or_group, valid_units


def prepared_dataset(actuals: DataFrame, pipeline: DataFrame, catalog_rows: DataFrame, reference: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((Product_Group, BU, Date, features, Actual_Quantity), one row of unmapped counts).

    Products match exactly after stripping, the last catalog row of a SKU wins; units must be listed; dates
    are as given. Every month of pipeline data has a row, with a null quantity where there are no actuals.
    Pipeline facts are summed by name, unit and date before a name's groups repeat them.
    """
    skus, units = analysis_skus(catalog_rows), analysis_units(catalog_rows)
    groups = catalog_rows.select(stripped(F.col("group_key")).alias("Product_Group")).filter("Product_Group <> ''").distinct()
    day = parse_month(F.col("Month")) if dict(actuals.dtypes)["Month"] == "string" else F.col("Month").cast("date")
    sold = actuals.select(stripped(F.col("Product")).alias("sku"), stripped(F.col("BU")).alias("BU"), day.alias("Date"), F.col("Actuals").try_cast("double").alias("Actuals"))
    sold = sold.groupBy("sku", "BU", "Date").agg(F.sum("Actuals").alias("Actuals"), F.count("*").alias("_rows")).join(skus, "sku", "left")
    missing_actuals = sold.agg(F.coalesce(F.sum(F.when(F.col("Product_Group").isNull(), F.col("_rows"))), F.lit(0)).alias("missing_actual_mappings"))
    quantity = valid_units(sold.dropna(subset=["Product_Group", "BU", "Date"]), units, "drop").groupBy("Product_Group", "BU", "Date").agg(F.coalesce(F.sum("Actuals"), F.lit(0.0)).alias("Actual_Quantity"))
    known = reference.join(groups, stripped(reference["group_key"]) == groups["Product_Group"], "left_semi").select(stripped(F.col("salesforce_product_name")).alias("SF_Product_Name")).union(groups).filter("SF_Product_Name <> ''").distinct()
    named = pipeline.withColumn("SF_Product_Name", stripped(F.col("SF_Product_Name"))).join(known, "SF_Product_Name", "left_semi")
    features = [c for c in FEATURES if c in pipeline.columns]
    number = lambda c: currency_number(F.col(c)) if dict(pipeline.dtypes)[c] == "string" else F.col(c).cast("double")
    named = named.groupBy("SF_Product_Name", stripped(F.col("BU")).alias("BU"), as_date(pipeline, "Timestamp").alias("Date")).agg(*[F.sum(number(c)).alias(c) for c in features], F.count("*").alias("_rows"))
    mapped = reference_or_group(named, reference, groups)
    missing_pipeline = mapped.agg(F.coalesce(F.sum(F.when(F.col("Product_Group").isNull(), F.col("_rows"))), F.lit(0)).alias("missing_pipeline_mappings"))
    rows = valid_units(mapped.dropna(subset=["Product_Group", "BU", "Date"]), units, "drop")
    sums = rows.groupBy("Product_Group", "BU", "Date").agg(*[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in features])
    return sums.join(quantity, ["Product_Group", "BU", "Date"], "left"), missing_pipeline.join(missing_actuals)
