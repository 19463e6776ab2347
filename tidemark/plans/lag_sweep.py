"""Which lag of each external feature forecasts a series best."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import KEY, Settings
from ..models import arima
from ..operators.metrics import best_lags
from ..operators.series import as_arrays, month_grid
from ..kept import kept
from ..tasks import run_tasks


def lag_sweep(demand: DataFrame, features: DataFrame, groups: DataFrame, settings: Settings) -> DataFrame:
    """(product_group, business_unit, feature, best_lag, validation_mae, lags_evaluated, series_length, train_samples, test_samples).

    features: (Date, Product_Group, BU, feature, value). Rows with a gap on either side go before a lag is
    taken, so a lag counts rows. Each lag is one fit with that feature alone, judged on the last months.
    """
    series = kept(month_grid(demand, fill=None, max_months=settings.max_months))
    lengths = series.groupBy(*KEY).agg(F.count("*").alias("series_length"), F.count("Actuals").alias("known")).filter(F.col("known") > settings.holdout)
    pairs = series.join(features, ["Date", *KEY]).dropna(subset=["Actuals", "value"])
    arrays = as_arrays(pairs, ["Actuals", "value"], (*KEY, "feature")).filter(F.size("dates") > settings.holdout)
    order = F.when(F.col("order").isNotNull(), F.array(*[F.col(f"order.{c}") for c in ("p", "d", "q", "seas_p", "seas_d", "seas_q", "s")])).otherwise(F.array(*map(F.lit, (1, 1, 1, 0, 0, 0, 12))))
    tasks = arrays.join(groups.select("Product_Group", "order"), "Product_Group", "left").withColumn("order", order).withColumn("lag", F.explode(F.sequence(F.lit(0), F.lit(settings.max_lag))))

    def one(task) -> list[dict]:
        y, x, h = np.array(task.Actuals, dtype=float)[task.lag :], np.array(task.value, dtype=float), settings.holdout
        x = x[: len(x) - task.lag] if task.lag else x
        if len(y) <= h:
            return []
        p, d, q, sp, sd, sq, s = (int(v) for v in task.order)
        try:
            fitted = arima.fit(y[:-h], (p, d, q), (sp, sd, sq, s), x[:-h, None], stationary=False, invertible=False)
            mae = float(np.abs(fitted.forecast(h, settings.confidence, x[-h:, None])[0] - y[-h:]).mean())
        except (ValueError, np.linalg.LinAlgError):
            return []
        return [{"Product_Group": task.Product_Group, "BU": task.BU, "feature": task.feature, "lag": task.lag, "mae": mae}] if np.isfinite(mae) else []

    scores = run_tasks(tasks.select(*KEY, "feature", "Actuals", "value", "order", "lag"), one, "Product_Group string, BU string, feature string, lag int, mae double")
    out = best_lags(scores, (*KEY, "feature")).join(lengths, list(KEY))
    return out.select(
        F.col("Product_Group").alias("product_group"), F.col("BU").alias("business_unit"), "feature", "best_lag", "validation_mae", "lags_evaluated", "series_length",
        F.greatest(F.col("series_length") - settings.holdout, F.lit(0)).alias("train_samples"), F.lit(settings.holdout).alias("test_samples"),
    )
