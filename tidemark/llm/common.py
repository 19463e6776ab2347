"""Helpers shared by the corpus operators."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: ASCII white space, as Java, DuckDB and Python patterns all read it.
SPACE = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, from spark.checkpoint.dir.

    Where the session names none, a local session gets a temporary folder; a cluster raises, as its executors
    would not see one.
    """
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="tidemark-"))
    return context._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Materialise df in the shared folder and go on from those files, so that a lost executor costs no recomputation."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def write_out(df: DataFrame) -> DataFrame:
    """As cut, for many small rows: a compressed Parquet table in the shared folder."""
    return Scratch(df.sparkSession).write("table", df)


class Scratch:
    """Parquet tables of one job in the shared folder; those that are no longer read can go before it ends."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folder = spark, f"{shared_folder(spark)}/tables-{uuid.uuid4()}"

    def write(self, name: str, df: DataFrame) -> DataFrame:
        df.write.parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}")

    def drop(self, *names: str) -> None:
        """Deletes tables, and lets Spark's cleaner take the shuffle files of steps that nothing refers to."""
        jvm = self.spark.sparkContext._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        gc.collect()
        jvm.System.gc()


def running_totals(scratch: Scratch, name: str, df: DataFrame, order: list[str], sums: dict[str, Column]) -> DataFrame:
    """df and the totals of sums over all rows before a row; order's columns tell rows apart.

    Rows are sorted in ranges; a range's totals are one row, and no task sees more than one range's rows.
    """
    ordered = scratch.write(name, df.withColumns(sums).sort(*order).withColumn("_range", F.spark_partition_id()))
    before = W.rowsBetween(W.unboundedPreceding, -1)
    inside = W.partitionBy("_range").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    ranges = ordered.groupBy("_range").agg(*[F.sum(c).alias(c) for c in sums])
    zero = lambda c, over: F.coalesce(F.sum(c).over(over), F.lit(0))
    ahead = ranges.select("_range", *[zero(c, before.orderBy("_range")).alias(f"_ahead_{c}") for c in sums])
    placed = ordered.withColumns({c: zero(c, inside) for c in sums}).join(F.broadcast(ahead), "_range")
    return placed.select(*df.columns, *[(F.col(c) + F.col(f"_ahead_{c}")).alias(c) for c in sums])


def document_key(doc_id: Column, text: Column) -> Column:
    """16 bytes for an id and a text together; texts may differ under one id."""
    return F.unhex(F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("~")), F.lit(" "), F.md5(F.coalesce(text, F.lit("")).cast("binary"))).cast("binary")))


def free_name(df: DataFrame, name: str) -> str:
    """name, with as many underscores behind it as it takes to be no column of df."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def id_bucket(column: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % modulus


def spread_join(left: DataFrame, right: DataFrame, key: str | list[str], how: str = "inner") -> DataFrame:
    """An equi-join on one or more columns in which neither side can reuse an earlier partitioning.

    Both sides then have an exchange of their own, which adaptive execution can split where one key holds
    a large share of the rows. right's key must be unique if left has hot keys.
    """
    keys = [key] if isinstance(key, str) else key
    salted = [df.withColumn("_spread", F.xxhash64(*keys)) for df in (left, right)]
    return salted[0].join(salted[1], [*keys, "_spread"], how).drop("_spread")
