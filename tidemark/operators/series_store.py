"""Stores of series as bucketed tables: months are replaced one by one, and stores that meet do not move."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..config import KEY

#: Without this, Spark moves both sides of a join by all its keys, although buckets by series hold each series whole.
_BY_A_PART_OF_THE_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"
_OVERWRITE = "spark.sql.sources.partitionOverwriteMode"


def open_store(spark: SparkSession, name: str, values: list[str], folder: str, buckets: int = 64) -> DataFrame:
    """The table name over folder, which is made if it is not there and found again, with all its months, if it is.

    (Product_Group, BU, values as doubles, Date): partitions by Date, the month, and buckets by series. Stores
    that are to meet have the same number of buckets, chosen so that a series' bucket of all months fits a task.
    """
    if clash := {v.lower() for v in values} & {c.lower() for c in ("Date", *KEY)}:
        raise ValueError(f"values named as keys: {', '.join(sorted(clash))}")
    columns = ", ".join([*(f"`{k}` STRING" for k in KEY), *(f"`{v}` DOUBLE" for v in values), "`Date` DATE"])
    keys = ", ".join(f"`{k}`" for k in KEY)
    # Partitions are looked for in the folder, so it has to be there; one that is there is left alone.
    spark.range(0).selectExpr(*(f"'' AS `{c}`" for c in (*KEY, "Date"))).write.mode("ignore").partitionBy("Date").parquet(folder)
    place = folder.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY (`Date`) CLUSTERED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{place}'")
    spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name)


def replace_months(rows: DataFrame, name: str, buckets: int = 64) -> None:
    """Writes rows (Product_Group, BU, Date, values; one a series and month) in the place of their months' old rows.

    Months that rows does not have stay as they are; rows without a month go. A run that is repeated, or loses
    tasks, leaves the same rows: a month changes when its write is whole. Each bucket of a month is one file.
    """
    spark = rows.sparkSession
    before = spark.conf.get(_OVERWRITE)
    columns = spark.table(name).columns
    dated = rows.filter("Date is not null").select(*columns).repartition(buckets, *KEY)
    spark.conf.set(_OVERWRITE, "dynamic")
    try:
        dated.write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(_OVERWRITE, before)


def meet(actuals: DataFrame, features: DataFrame) -> DataFrame:
    """Rows of the store actuals with the values of features in their month, 0 where there are none.

    Neither store moves, as both have the buckets of their series, so small ones are not broadcast either. Sets the session's
    spark.sql.requireAllClusterKeysForCoPartition to false, which the plan needs when it is made.
    """
    actuals.sparkSession.conf.set(_BY_A_PART_OF_THE_KEYS, "false")
    values = [c for c in features.columns if c not in ("Date", *KEY)]
    return actuals.join(features.hint("merge"), [*KEY, "Date"], "left").fillna(0.0, values)
