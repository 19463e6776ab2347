"""A store of co-moments by series and month: facts are summed once, when they arrive, and merged exactly afterwards."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .diagnostics import ANALYSIS_KEY

MOMENTS = "present int, n bigint, means array<double>, products array<double>, least array<double>, greatest array<double>"


def _triangle(k: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(k) for j in range(i, k)]


def _has(i: int) -> Column:
    return F.col("present").bitwiseAND(F.lit(1 << i)) != 0


def _at(name: str, i: int) -> Column:
    return F.get(F.col(name), F.lit(i))


def month_moments(data: DataFrame, columns: list[str], keys: tuple[str, ...] = ANALYSIS_KEY) -> DataFrame:
    """(keys, month, present, n, means, products, least, greatest): sums of the rows of a month that miss the same columns.

    present has bit i where columns[i] is not null; products are sums of products of deviations from the means,
    by rows of the upper triangle. What a row misses is part of its key, so that rows complete in any choice of
    columns can be told later. At most 31 columns. Rows without a date or key belong to a null month or key.
    """
    values = data.select(*keys, F.trunc("Date", "month").alias("month"), *[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(columns)])
    present = F.lit(0)
    for i in range(len(columns)):
        present = present + F.when(F.col(f"_{i}").isNotNull(), 1 << i).otherwise(0)
    each = lambda f: F.array(*[f(f"_{i}") for i in range(len(columns))])
    products = [F.covar_pop(f"_{i}", f"_{j}") * F.count("*") for i, j in _triangle(len(columns))]
    return values.withColumn("present", present).groupBy(*keys, "month", "present").agg(
        F.count("*").alias("n"), each(F.avg).alias("means"), F.array(*products).alias("products"), each(F.min).alias("least"), each(F.max).alias("greatest")
    )


def add_facts(data: DataFrame, columns: list[str], folder: str, batch: str, keys: tuple[str, ...] = ANALYSIS_KEY) -> None:
    """Adds the moments of a batch of facts to the store in folder; facts of earlier batches are not read.

    Months and batches are partitions: a month may get rows from several batches, so facts may come late, and a
    batch that runs again replaces its own rows in the months that it has.
    """
    rows = month_moments(data, columns, keys).withColumn("batch", F.lit(batch)).hint("rebalance", "month")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month", "batch").parquet(folder)


def read_store(spark: SparkSession, folder: str, keys: tuple[str, ...] = ANALYSIS_KEY) -> DataFrame:
    head = ", ".join(f"{k} string" for k in keys)
    return spark.read.schema(f"{head}, {MOMENTS}, month date, batch string").parquet(folder)


def _judged(store: DataFrame, k: int, min_obs: int, keys: tuple[str, ...], constant_ok: tuple[int, ...] = ()) -> DataFrame:
    """store with, for each column i, its count over all months (_count_i) and whether it is valid (_ok_i)."""
    own = Window.partitionBy(*keys)
    counts = {f"_count_{i}": F.coalesce(F.sum(F.when(_has(i), F.col("n"))).over(own), F.lit(0)) for i in range(k)}
    varies = {i: F.lit(True) if i in constant_ok else F.coalesce(F.min(_at("least", i)).over(own) != F.max(_at("greatest", i)).over(own), F.lit(False)) for i in range(k)}
    return store.withColumns(counts | {f"_varies_{i}": v for i, v in varies.items()}).withColumns({f"_ok_{i}": (F.col(f"_count_{i}") >= min_obs) & F.col(f"_varies_{i}") for i in range(k)})


def merged_moments(store: DataFrame, columns: list[str], min_obs: int, keys: tuple[str, ...] = ANALYSIS_KEY) -> DataFrame:
    """(keys, valid, counts, n_complete, cov) as diagnostics.complete_moments has them, from the store's rows alone.

    Months are merged around the mean of all complete rows, so that no large sums cancel. A column that does
    not vary over the complete rows has a variance of exactly 0. One exchange on the keys.
    """
    k, own = len(columns), Window.partitionBy(*keys)
    rows = _judged(store, k, min_obs, keys)
    used = F.lit(0)
    for i in range(k):
        used = used + F.when(F.col(f"_ok_{i}"), 1 << i).otherwise(0)
    rows = rows.withColumn("_full", F.col("present").bitwiseAND(used) == used)
    weight = F.when(F.col("_full"), F.col("n"))
    rows = rows.withColumn("_all", F.sum(weight).over(own))
    rows = rows.withColumns({f"_d_{i}": _at("means", i) - F.sum(weight * _at("means", i)).over(own) / F.col("_all") for i in range(k)})

    def covariance(p: int, i: int, j: int) -> Column:
        taken = F.col("_full") & F.col(f"_ok_{i}") & F.col(f"_ok_{j}")
        merged = F.sum(F.when(taken, _at("products", p) + F.col("n") * F.col(f"_d_{i}") * F.col(f"_d_{j}"))) / F.max("_all")
        still = [F.min(F.when(taken, _at("least", c))) == F.max(F.when(taken, _at("greatest", c))) for c in {i, j}]
        return F.when(F.greatest(*still) if len(still) > 1 else still[0], F.lit(0.0)).otherwise(merged)

    return rows.groupBy(*keys).agg(
        F.array(*[F.bool_or(f"_ok_{i}") for i in range(k)]).alias("valid"),
        F.array(*[F.max(f"_count_{i}") for i in range(k)]).alias("counts"),
        F.coalesce(F.max("_all"), F.lit(0)).alias("n_complete"),
        F.array(*[covariance(p, i, j) for p, (i, j) in enumerate(_triangle(k))]).alias("cov"),
    )


def merged_correlations(store: DataFrame, columns: list[str], min_obs: int, target: str | None = None, keys: tuple[str, ...] = ANALYSIS_KEY) -> DataFrame:
    """(keys, variable_x, variable_y, pearson_correlation) as diagnostics.pairwise_correlations has them, from the store's rows.

    The store's columns are columns and then target. Each pair is merged over the rows that have both.
    """
    every = columns + ([target] if target else [])
    k, place = len(every), {ij: p for p, ij in enumerate(_triangle(len(every)))}
    rows = _judged(store, k, min_obs, keys, (k - 1,) if target else ())

    def pair(i: int, j: int) -> Column:
        both = _has(i) & _has(j)
        part = {"n": F.col("n"), "mx": _at("means", i), "my": _at("means", j)}
        part |= {name: _at("products", place[ij]) for name, ij in (("xx", (i, i)), ("yy", (j, j)), ("xy", (i, j)))}
        part |= {f"{end}_{name}": _at(end, c) for end in ("least", "greatest") for name, c in (("x", i), ("y", j))}
        head = [F.lit(every[i]).alias("variable_x"), F.lit(every[j]).alias("variable_y"), (F.col(f"_ok_{i}") & F.col(f"_ok_{j}")).alias("ok")]
        return F.struct(*head, *[F.when(both, v).alias(name) for name, v in part.items()])

    pairs = (*keys, "variable_x", "variable_y")
    rows = rows.select(*keys, F.explode(F.array(*[pair(i, j) for i, j in combinations(range(k), 2)])).alias("p")).select(*keys, "p.*").filter("ok")
    own = Window.partitionBy(*pairs)
    centre = lambda m: F.sum(F.col("n") * F.col(m)).over(own) / F.sum("n").over(own)
    rows = rows.withColumns({"dx": F.col("mx") - centre("mx"), "dy": F.col("my") - centre("my")})
    merged = lambda c, a, b: F.sum(F.col(c) + F.col("n") * F.col(a) * F.col(b))
    moves = (F.min("least_x") != F.max("greatest_x")) & (F.min("least_y") != F.max("greatest_y")) & (F.sum("n") >= 2)
    value = F.when(moves, F.try_divide(merged("xy", "dx", "dy"), F.sqrt(merged("xx", "dx", "dx")) * F.sqrt(merged("yy", "dy", "dy"))))
    return rows.groupBy(*pairs).agg(value.alias("pearson_correlation"))
