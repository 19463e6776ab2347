"""Counts that Spark takes of rows while a job computes its results, without reading anything twice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..kept import kept

SCHEMA = "source string, reason string, rows bigint"


class Counters:
    """What became of a job's input rows: tables are counted where rows leave them, as they are kept.

    Counts are taken of the rows that are written, on top of the plan that writes them: nothing above can be
    optimised away with them, and a task that runs again after a lost executor counts once.
    """

    def __init__(self) -> None:
        self.rows: list[tuple[str, str, int]] = []

    def keep(self, df: DataFrame, source: str, **counts: Column) -> DataFrame:
        """df, kept; the named sums of its rows are noted under source."""
        observation = Observation()
        out = kept(df.observe(observation, *[F.coalesce(c, F.lit(0)).cast("long").alias(name) for name, c in counts.items()]))
        seen = observation.get
        self.rows += [(source, name, seen[name]) for name in counts]
        return out

    def of(self, source: str, reason: str) -> int:
        return next(n for s, r, n in self.rows if (s, r) == (source, reason))

    def table(self, spark: SparkSession) -> DataFrame:
        """(source, reason, rows): a few for each source."""
        return spark.createDataFrame(self.rows, SCHEMA)


def rows_where(condition: Column, weight: str | None = None) -> Column:
    """How many rows meet a condition, or how many facts those rows stand for."""
    return F.sum(F.when(condition, F.col(weight) if weight else F.lit(1)).otherwise(F.lit(0)))
