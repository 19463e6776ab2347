"""Readers for the four input tables and the writer for reports. Operators take DataFrames from anywhere."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import CATALOG_COLUMNS, LAG_COLUMNS

#: Headers of catalog files, which tell seasonal parts of an order by capital letters alone.
CATALOG_HEADERS = ("group_key", "sku_list", "business_unit_code", "business_unit_name", "salesforce_feature_mode", "sarima_p", "sarima_d", "sarima_q", "sarima_P", "sarima_D", "sarima_Q", "sarima_s")


AUTO, LATIN, FILE = "auto", "ISO-8859-1", "_source_file"


def read_table(spark: SparkSession, path: str, encoding: str = "UTF-8", multi_line: bool = False) -> DataFrame:
    """A CSV file or folder with a header, all columns as text; or Parquet, by its suffix. Bad bytes do not stop a read.

    With encoding auto, each file is read as UTF-8 if all of its bytes are, else as Latin-1.
    """
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    known = LATIN if encoding == AUTO else encoding
    rows = spark.read.csv(path, header=True, inferSchema=False, encoding=known, multiLine=multi_line, quote='"', escape='"')
    return decoded(rows.withColumn(FILE, F.col("_metadata.file_path")), path).drop(FILE) if encoding == AUTO else rows


def file_encodings(spark: SparkSession, path: str) -> DataFrame:
    """(file, is_utf8) of each text file under path. A line feed is no part of a longer character, so lines are judged one by one."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.is_valid_utf8("value").alias("valid"))
    return lines.groupBy("file").agg(F.bool_and("valid").alias("is_utf8"))


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """rows of CSV files that were read as Latin-1, which keeps every byte, with the text of UTF-8 files as it was meant.

    Separators and quotes are ASCII in both encodings, so the fields are the same. The column FILE tells a row's file.
    """
    told = rows.join(file_encodings(rows.sparkSession, path).withColumnRenamed("file", FILE), FILE, "left")
    text = lambda c: F.when(F.col("is_utf8"), F.decode(F.encode(c, LATIN), "UTF-8")).otherwise(c)
    return told.select(*[F.col(FILE) if c == FILE else text(F.col(f"`{c}`")).alias(header(c)) for c in rows.columns])


def header(name: str) -> str:
    """A header that was read as Latin-1, as UTF-8 where it is that; without a byte order mark."""
    try:
        return name.encode("latin-1").decode("utf-8").lstrip("\ufeff")
    except UnicodeError:
        return name


FIELDS = "number of fields"


def read_checked(spark: SparkSession, path: str, checks: dict[str, Callable[[DataFrame], Column]] | None = None, encoding: str = "UTF-8") -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows) of a CSV with a header; every line but headers is in one of them, once.

    rejected: (source_file, reason, line). A line with fewer or more fields than the header is rejected for
    their number; a row for the first of checks that it fails, each a reason and a condition that is true of
    bad rows. Both tables are one scan each of what they need.
    """
    known = LATIN if encoding == AUTO else encoding
    names = spark.read.csv(path, header=True, inferSchema=False, encoding=known, quote='"', escape='"').columns
    broken, why = "_broken_line", "_reason"
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, broken]])
    # All columns are parsed, as the number of fields is only checked among those that are.
    reader = spark.read.schema(schema).option("columnPruning", False).option("columnNameOfCorruptRecord", broken)
    raw = reader.csv(path, header=True, mode="PERMISSIVE", encoding=known, quote='"', escape='"')
    rows = raw.withColumn(FILE, F.col("_metadata.file_path"))
    if encoding == AUTO:
        rows, names = decoded(rows, path), [header(c) for c in names]
    reason = F.when(F.col(broken).isNotNull(), FIELDS)
    for name, bad in (checks or {}).items():
        reason = reason.when(F.coalesce(bad(rows), F.lit(False)), name)
    marked = rows.withColumn(why, reason)
    good = marked.filter(F.col(why).isNull()).select(*[F.col(f"`{c}`") for c in names])
    line = F.coalesce(F.col(broken), F.to_csv(F.struct(*[F.col(f"`{c}`") for c in names])))
    return good, marked.filter(F.col(why).isNotNull()).select(F.col(FILE).alias("source_file"), F.col(why).alias("reason"), line.alias("line"))


def read_actuals(spark: SparkSession, path: str) -> DataFrame:
    return require(read_table(spark, path), ("Product", "Month", "Actuals"), "actuals")


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """The product catalog with a row_id in file order; quoted fields may hold line feeds, a BOM is dropped.

    Columns are named by their header, case and all, before anything refers to them.
    """
    raw = read_table(spark, path, multi_line=True)
    # Spark adds a column's number to names that differ by case alone.
    bare = [c.lstrip("﻿").strip() for c in raw.columns]
    headers = [c.removesuffix(str(i)) if c.removesuffix(str(i)) in CATALOG_HEADERS else c for i, c in enumerate(bare)]
    if missing := [h for h in CATALOG_HEADERS if h not in headers]:
        raise ValueError(f"catalog misses columns: {', '.join(missing)}")
    known = dict(zip(CATALOG_HEADERS, CATALOG_COLUMNS, strict=True))
    positional = raw.toDF(*[known.get(h, h if h in LAG_COLUMNS else f"other_{i}_{h}") for i, h in enumerate(headers)])
    return positional.withColumn("row_id", F.monotonically_increasing_id())


def read_pipeline(spark: SparkSession, path: str, encoding: str = AUTO) -> DataFrame:
    """Pipeline rows; lines of a CSV whose number of fields is not the header's are left out, as set_aside tells."""
    return read_table(spark, path) if path.rstrip("/").endswith(".parquet") else read_checked(spark, path, None, encoding)[0]


def set_aside(spark: SparkSession, path: str, dates: tuple[str, ...], bad_date: Callable[[DataFrame, str], Column], encoding: str = AUTO) -> DataFrame | None:
    """(source_file, reason, line) of a CSV's lines that a run cannot use: broken ones, and those whose date, in the
    first of the columns dates that there is, is bad. None for Parquet tables."""
    if path.rstrip("/").endswith(".parquet"):
        return None
    column = lambda df: next((c for c in dates if c in df.columns), None)
    return read_checked(spark, path, {"no date": lambda df: bad_date(df, column(df)) if column(df) else F.lit(False)}, encoding)[1]


def read_reference(spark: SparkSession, path: str | None) -> DataFrame:
    """Pipeline product names and their groups; without a path, an empty table."""
    if path is None:
        return spark.createDataFrame([], "row_id long, salesforce_product_name string, group_key string")
    return require(read_table(spark, path), ("salesforce_product_name", "group_key"), "reference").withColumn("row_id", F.monotonically_increasing_id())


def read_backlog(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path)


def require(df: DataFrame, columns: tuple[str, ...], what: str) -> DataFrame:
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"{what} misses columns: {', '.join(missing)}")
    return df


def write_report(df: DataFrame, path: str, order: tuple[str, ...] = (), kind: str = "csv", partition_by: tuple[str, ...] = ()) -> None:
    """Overwrites a report, so that a rerun leaves one result. Rows are put in order here and nowhere before."""
    out = df.orderBy(*order) if order else df
    writer = out.write.mode("overwrite").partitionBy(*partition_by) if partition_by else out.write.mode("overwrite")
    writer.option("header", True).csv(path) if kind == "csv" else writer.parquet(path)
