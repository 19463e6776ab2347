"""Accuracy measures, classes of series and strategy; built-in functions only."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import KEY, Settings
from ..functions.distributions import chi_squared_tail


def holdout_metrics(pairs: DataFrame, keys: tuple[str, ...] = KEY, actual: str = "actual", forecast: str = "forecast") -> DataFrame:
    """bias_percent, mae_percent, rmse, mape and cov per series; pairs with a null are left out, and a measure
    whose denominator is zero is null."""
    a, f = F.col(actual), F.col(forecast)
    rows = pairs.withColumn("_ok", a.isNotNull() & f.isNotNull())
    ok = lambda c: F.when(F.col("_ok"), c)
    ratio = lambda x, y: F.try_divide(x, F.nullif(y, F.lit(0.0))) * 100
    mean = F.avg(ok(a))
    return rows.groupBy(*keys).agg(
        ratio(F.avg(ok(f - a)), mean).alias("bias_percent"),
        ratio(F.sum(ok(F.abs(f - a))), F.sum(ok(F.abs(a)))).alias("mae_percent"),
        F.sqrt(F.avg(ok((f - a) * (f - a)))).alias("rmse"),
        (F.avg(F.when(F.col("_ok") & (a != 0), F.abs(F.try_divide(f - a, a)))) * 100).alias("mape"),
        ratio(F.stddev_pop(ok(a)), F.abs(mean)).alias("cov"),
    )


def volatility_class(series: DataFrame, threshold: float = 0.5, value: str = "Actuals", keys: tuple[str, ...] = KEY) -> DataFrame:
    """(keys, n, mean, std, is_volatile): mean not above 0, or deviation over mean at the threshold or above."""
    out = series.groupBy(*keys).agg(F.count("*").alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"))
    return out.withColumn("is_volatile", F.coalesce((F.col("mean") <= 0) | (F.try_divide("std", "mean") >= threshold), F.lit(False)))


def seasonal_parts(series: DataFrame, value: str = "Actuals", keys: tuple[str, ...] = KEY) -> DataFrame:
    """series with trend (2x12 moving average, null at the edges), seasonal (centred) and resid."""
    w = Window.partitionBy(*keys).orderBy("Date")
    total = lambda a, b: F.sum(value).over(w.rowsBetween(a, b))
    full = F.count(value).over(w.rowsBetween(-6, 6)) == 13
    rn = F.row_number().over(w)
    out = series.withColumns({"_rn": rn, "position": (rn - 1) % 12, "trend": F.when(full, (total(-6, 5) + total(-5, 6)) / 24)})
    # All windows have the series' partitioning; a position's level counts once, at its first month.
    out = out.withColumn("_level", F.avg(F.col(value) - F.col("trend")).over(Window.partitionBy(*keys, "position")))
    centre = F.avg(F.when(F.col("_rn") <= 12, F.col("_level"))).over(Window.partitionBy(*keys))
    out = out.withColumn("seasonal", F.col("_level") - centre).drop("_rn", "_level")
    return out.withColumn("resid", F.col(value) - F.col("trend") - F.col("seasonal"))


def seasonal_strength(series: DataFrame, threshold: float = 0.3, min_obs: int = 24, value: str = "Actuals", keys: tuple[str, ...] = KEY) -> DataFrame:
    """(keys, n, strength, is_seasonal); null strength for short series, series with gaps and exact fits."""
    parts = seasonal_parts(series, value, keys)
    out = parts.groupBy(*keys).agg(F.count("*").alias("n"), F.count(value).alias("_full"), F.var_pop("seasonal").alias("_s"), F.var_pop("resid").alias("_r"))
    strength = F.when((F.col("n") >= min_obs) & (F.col("_full") == F.col("n")) & (F.col("_r") > 0), F.try_divide(F.col("_s"), F.col("_s") + F.col("_r")))
    return out.select(*keys, "n", strength.alias("strength"), F.coalesce(strength > threshold, F.lit(False)).alias("is_seasonal"))


def choose_strategy(lengths: DataFrame, settings: Settings, valid_order: Column, n: str = "n") -> DataFrame:
    """lengths with strategy: SARIMA, ARIMA or ETS_THETA by history, whether the group has a usable order, and toggles."""
    size, valid = F.col(n), F.coalesce(valid_order, F.lit(False))
    arima, ets = F.lit(settings.arima_enabled), F.lit(settings.ets_enabled)
    long = F.lit(True) if settings.sarima_min is None else size >= settings.sarima_min
    medium = (size >= settings.arima_min) & (F.lit(True) if settings.sarima_min is None else size < settings.sarima_min)
    forced = F.col("Product_Group").isin(*settings.ets_forced) if settings.ets_forced else F.lit(False)
    rules = [
        (valid & long, "SARIMA"),
        (arima & medium, "ARIMA"),
        (ets & (size < settings.arima_min) & (forced | (size >= settings.min_obs)), "ETS_THETA"),
        (~valid & arima, "ARIMA"),
        (~valid & ets, "ETS_THETA"),
        (long, "SARIMA"),
        (arima & (size >= settings.arima_min), "ARIMA"),
        (ets, "ETS_THETA"),
    ]
    return lengths.withColumn("strategy", reduce(lambda rest, rule: F.when(rule[0], rule[1]).otherwise(rest), reversed(rules), F.lit("SARIMA")))


def usable_order(order: str = "order") -> Column:
    return F.coalesce(F.col(f"{order}.s") > 0, F.lit(False))


def seasonal_naive(series: DataFrame, holdout: int, season: int = 12, value: str = "Actuals", keys: tuple[str, ...] = KEY) -> DataFrame:
    """The last holdout months with the value of a season before as forecast."""
    w = Window.partitionBy(*keys).orderBy("Date")
    rows = series.withColumn("forecast", F.lag(value, season).over(w)).withColumn("_back", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("Date"))))
    return rows.filter(F.col("_back") <= holdout).select(*keys, "Date", F.col(value).alias("actual"), "forecast")


def ljung_box_lags(residuals: DataFrame, lags: Sequence[int], value: str = "resid", keys: tuple[str, ...] = KEY) -> DataFrame:
    """(keys, n, lag, statistic, p_value) at each of the lags, odd ones too; null where a series has no more rows than the lag."""
    w = Window.partitionBy(*keys)
    rows = residuals.filter(F.col(value).isNotNull() & ~F.isnan(value)).withColumn("_x", F.col(value) - F.avg(value).over(w))
    order = w.orderBy("Date")
    most = max(lags)
    products = rows.withColumns({f"_p{k}": F.col("_x") * F.lag("_x", k).over(order) for k in range(1, most + 1)})
    sums = products.groupBy(*keys).agg(F.count("*").alias("n"), F.sum(F.col("_x") * F.col("_x")).alias("_v"), *[F.sum(f"_p{k}").alias(f"_p{k}") for k in range(1, most + 1)])
    n = F.col("n")
    terms = [F.try_divide(F.pow(F.try_divide(f"_p{k}", "_v"), F.lit(2)), F.when(n > k, n - k)) for k in range(1, most + 1)]
    parts = sums.select(*keys, "n", F.array(*terms).alias("_terms"))
    at = F.explode(F.array(*[F.lit(k) for k in sorted(set(lags))])).alias("lag")
    # A lag that has no product makes the sum null.
    q = F.aggregate(F.slice("_terms", 1, F.col("lag")), F.lit(0.0), lambda total, t: total + t) * n * (n + 2)
    rows = parts.select(*keys, "n", "_terms", at).select(*keys, "n", "lag", q.alias("statistic"))
    return rows.withColumn("p_value", chi_squared_tail(F.col("statistic"), F.col("lag"), sorted(set(lags))))


def ljung_box(residuals: DataFrame, lags: int | Sequence[int] = 12, value: str = "resid", keys: tuple[str, ...] = KEY) -> DataFrame:
    """(keys, n, statistic, p_value) at the lag, or at that of several lags whose probability is least, the smallest lag on ties."""
    asked = (lags,) if isinstance(lags, int) else tuple(lags)
    rows = ljung_box_lags(residuals, asked, value, keys)
    least = F.min_by("statistic", F.struct(F.col("p_value").isNull(), "p_value", "lag"))
    return rows.groupBy(*keys).agg(F.max("n").alias("n"), least.alias("statistic"), F.min("p_value").alias("p_value"))


def best_lags(scores: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """(keys, best_lag, validation_mae, lags_evaluated): the smallest error, the smaller lag on ties."""
    rows = scores.filter("mae is not null and not isnan(mae)")
    return rows.groupBy(*keys).agg(F.min_by("lag", F.struct("mae", "lag")).alias("best_lag"), F.min("mae").alias("validation_mae"), F.count("*").alias("lags_evaluated"))


def fold_summary(runs: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """(keys, folds_h1, ok_h1, mean_mae_h1, mae_std_h1, folds_h3, ok_h3, mae_h3) from (keys, horizon, fold, mae): folds, those
    with an error, its mean and its population deviation, one and three months ahead."""
    at = lambda h, c: F.when(F.col("horizon") == h, c)
    one, three = (at(h, F.col("mae")) for h in (1, 3))
    return runs.groupBy(*keys).agg(
        F.count(at(1, F.lit(1))).alias("folds_h1"), F.count(one).alias("ok_h1"), F.avg(one).alias("mean_mae_h1"), F.stddev_pop(one).alias("mae_std_h1"),
        F.count(at(3, F.lit(1))).alias("folds_h3"), F.count(three).alias("ok_h3"), F.avg(three).alias("mae_h3"),
    )
