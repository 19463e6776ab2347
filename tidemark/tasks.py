"""Dealing out model fits: one row per fit, evenly over the cluster, each series as an array."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame


def run_tasks(tasks: DataFrame, fit: Callable[[pd.Series], list[dict]], schema: str) -> DataFrame:
    """The rows that fit makes of each row of tasks.

    Costs differ from fit to fit, so rows are dealt round, in small Arrow batches by the number of tasks;
    the number of partitions is Spark's, from the configured shuffle partitions.
    """
    names = [c.strip().split(" ")[0] for c in _split(schema)]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = [r for task in pdf.itertuples(index=False) for r in fit(task)]
            yield pd.DataFrame(rows, columns=names)

    n = int(tasks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return tasks.repartition(n).mapInPandas(run, schema)


def _split(schema: str) -> list[str]:
    """Top-level columns of a schema string."""
    out, depth, last = [], 0, 0
    for i, c in enumerate(schema):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append(schema[last:i])
            last = i + 1
    return [*out, schema[last:]]
