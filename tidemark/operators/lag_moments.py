"""Errors of all lags of a feature at once, by regressions in closed form; built-in functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import KEY


def lag_errors(pairs: DataFrame, max_lag: int = 6, holdout: int = 6, keys: tuple[str, ...] = (*KEY, "feature"), target: str = "Actuals", value: str = "value") -> DataFrame:
    """(keys, lag, n_train, slope, intercept, mae): per lag from 0 to max_lag, the line through the training rows and
    its mean absolute error in the last holdout rows.

    Rows without a target or value go first, so a lag counts the rows that are left: row rn of the target
    meets row rn - lag of the feature. A lag whose rows are not more than holdout is left out. Where the
    training values do not vary, the line is the targets' mean. One exchange by keys: sums give the line,
    and only the last holdout rows of a lag are kept to be judged by it.
    """
    rows = pairs.filter(F.col(target).isNotNull() & F.col(value).isNotNull())
    own = Window.partitionBy(*keys)
    order = own.orderBy("Date")
    met = F.array(*[F.struct(F.lit(k).alias("lag"), (F.col(value) if k == 0 else F.lag(value, k).over(order)).cast("double").alias("x")) for k in range(max_lag + 1)])
    rows = rows.select(*keys, F.col(target).cast("double").alias("_y"), F.row_number().over(own.orderBy(F.desc("Date"))).alias("_back"), met.alias("_met"))
    rows = rows.select(*keys, "_y", "_back", F.explode("_met").alias("_m")).select(*keys, "_y", "_back", "_m.lag", F.col("_m.x").alias("_x")).filter("_x is not null")
    train, test = F.col("_back") > holdout, F.col("_back") <= holdout
    fit = lambda c: F.when(train, F.col(c))
    sums = rows.groupBy(*keys, "lag").agg(
        F.count_if(train).alias("n_train"), F.when(F.min(fit("_x")) != F.max(fit("_x")), F.regr_slope(fit("_y"), fit("_x"))).otherwise(F.lit(0.0)).alias("slope"),
        F.avg(fit("_y")).alias("_mean_y"), F.avg(fit("_x")).alias("_mean_x"), F.collect_list(F.when(test, F.struct(F.col("_y").alias("y"), F.col("_x").alias("x")))).alias("_test"),
    )
    lines = sums.filter("n_train > 0").withColumn("intercept", F.col("_mean_y") - F.col("slope") * F.col("_mean_x"))
    error = F.aggregate("_test", F.lit(0.0), lambda total, p: total + F.abs(p["y"] - F.col("intercept") - F.col("slope") * p["x"])) / F.size("_test")
    return lines.select(*keys, "lag", "n_train", "slope", "intercept", error.alias("mae"))
