"""The forecast run: strategy, fits, holdout metrics and the report."""

from __future__ import annotations

from dataclasses import replace

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import BACKLOG_FEATURES, KEY, Settings
from ..functions.columns import clipped, two_digits
from ..models import arima, smoothing
from ..operators.features import extrapolate, feature_store, select_backlog, select_mode
from ..operators.metrics import choose_strategy, holdout_metrics, usable_order
from ..operators.series import as_arrays, long_enough, prepared_series
from ..kept import kept
from ..tasks import run_tasks

REPORT = ("Product_Group", "BU", "BU_Name", "Model_Type", "Model_Used", "SARIMA_Params", "Exogenous_Used", "Date", "Forecast", "Lower_CI", "Upper_CI", "MAE%", "Bias%", "RMSE", "MAPE", "CoV")
DEFAULT_ORDER = (1, 1, 1, 1, 1, 1, 12)
TASK_SCHEMA = "Product_Group string, BU string, phase string, step int, actual double, forecast double, lower double, upper double, descriptor string, sarima_params string, exog array<string>"


def extended_store(pipeline: DataFrame | None, backlog: DataFrame | None, settings: Settings) -> DataFrame | None:
    """The feature store over history and horizon: pipeline features are extrapolated after each series' own last
    month; backlog features reach the end of the horizon already."""
    if pipeline is None and backlog is None:
        return None
    if pipeline is not None:
        future = extrapolate(pipeline, settings.horizon).drop("step")
        pipeline = pipeline.unionByName(future.select(*pipeline.columns))
    return feature_store(pipeline, backlog)


def series_features(spans: DataFrame, store: DataFrame, groups: DataFrame, settings: Settings) -> DataFrame:
    """(Product_Group, BU, exog names, x: rows of history and horizon) where both have a value that is not 0.

    spans: (Product_Group, BU, first_month, last_month). Columns are in the order of their names.
    """
    has = lambda p: any(c.startswith(p) for c in store.columns)
    named = select_mode(store, groups, settings).select("Date", *KEY, F.transform("features", lambda f: F.struct(F.concat(F.lit("sf_"), f["feature"]).alias("feature"), f["value"].alias("value"))).alias("features")) if has("sf_") else store.select("Date", *KEY, F.array().cast("array<struct<feature:string,value:double>>").alias("features"))
    if has("backlog_"):
        logs = select_backlog(store).select("Date", *KEY, F.array(*[F.struct(F.lit(f"backlog_{c}").alias("feature"), F.col(c).alias("value")) for c in BACKLOG_FEATURES]).alias("more"))
        named = named.join(logs, ["Date", *KEY]).select("Date", *KEY, F.concat("features", "more").alias("features"))
    named = named.withColumn("features", F.array_sort("features"))
    grid = spans.select(*KEY, "last_month", F.explode(F.sequence("first_month", F.add_months("last_month", settings.horizon), F.expr("interval 1 month"))).alias("Date"))
    rows = grid.join(named, ["Date", *KEY], "left")
    size = F.coalesce(F.aggregate("features", F.lit(0.0), lambda acc, f: acc + F.abs(f["value"])), F.lit(0.0))
    out = rows.groupBy(*KEY).agg(
        F.sum(F.when(F.col("Date") <= F.col("last_month"), size)).alias("_history"),
        F.sum(F.when(F.col("Date") > F.col("last_month"), size)).alias("_future"),
        F.max(F.transform("features", lambda f: f["feature"])).alias("exog"),
        F.array_sort(F.collect_list(F.struct("Date", F.transform("features", lambda f: f["value"]).alias("v")))).alias("_rows"),
    )
    zero = F.transform("exog", lambda _: F.lit(0.0))
    return out.filter("_history > 1e-8 and _future > 1e-8").select(*KEY, "exog", F.transform("_rows", lambda r: F.coalesce(r["v"], zero)).alias("x"))


def fit_strategy(y: np.ndarray, x: np.ndarray | None, future: np.ndarray | None, strategy: str, order: tuple | None, short: tuple, steps: int, settings: Settings) -> tuple[tuple, str, str] | None:
    """((mean, lower, upper), descriptor, parameters); None if nothing can be fitted."""
    try:
        if strategy == "ETS_THETA":
            blend = smoothing.fit_blend(arima.interpolated(y)[0], settings.ets_weights, settings.ets_period, settings.ets_trend is not None, settings.ets_damped)
            return blend.forecast(steps, settings.confidence), f"ETS/Theta blend (theta={blend.weights[0]:.2f}, ets={blend.weights[1]:.2f})", "N/A"
        if strategy == "ARIMA":
            fitted = arima.fit(y, tuple(short), x=x)
            return fitted.forecast(steps, settings.confidence, future), "ARIMA({},{},{})".format(*short), "N/A"
        p, d, q, sp, sd, sq, s = order or DEFAULT_ORDER
        try:
            fitted = arima.fit(y, (p, d, q), (sp, sd, sq, s), x)
            name = f"SARIMA({p},{d},{q})x({sp},{sd},{sq},{s})"
            return fitted.forecast(steps, settings.confidence, future), name, name
        except (ValueError, np.linalg.LinAlgError):
            fitted = arima.fit(y, (1, 1, 1), x=x)
            return fitted.forecast(steps, settings.confidence, future), "Fallback ARIMA(1,1,1)", "N/A"
    except (ValueError, np.linalg.LinAlgError):
        return None


def phase_report(fitted: DataFrame, unit_names: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """(report of 16 columns, holdout pairs) of the rows of both phases, whatever model they are from.

    fitted: (Product_Group, BU, last_month, strategy, phase, step, actual, forecast, lower, upper, descriptor,
    sarima_params, exog). Step 1 is the first month after the history; the holdout's months have steps up to 0.
    Months ahead are those of phase full, and the holdout's own where a series has no full fit.
    """
    value = lambda c: clipped(F.col(c), settings.non_negative).alias(c)
    rows = fitted.select(
        *KEY, "phase", "strategy", F.add_months("last_month", F.col("step")).alias("Date"), "step", F.nanvl("actual", F.lit(None)).alias("actual"),
        "descriptor", "sarima_params", "exog", F.col("forecast").alias("raw"), value("forecast"), value("lower"), value("upper"),
    )
    pairs = rows.filter("phase = 'holdout' and step <= 0").select(*KEY, "Date", "actual", F.col("raw").alias("forecast"))
    metrics = holdout_metrics(pairs)
    ahead = rows.filter("step >= 1")
    has_full = ahead.filter("phase = 'full' and step = 1").select(*KEY, F.lit(True).alias("_full"))
    chosen = ahead.join(has_full, list(KEY), "left").filter("phase = 'full' or _full is null")
    out = chosen.join(metrics, list(KEY), "left").join(unit_names, "BU", "left")
    exog = F.coalesce(F.nullif(F.array_join("exog", ", "), F.lit("")), F.lit("None"))
    report = out.select(
        "Product_Group", "BU", F.coalesce("BU_Name", F.lit("")).alias("BU_Name"), F.col("strategy").alias("Model_Type"), F.col("descriptor").alias("Model_Used"), F.col("sarima_params").alias("SARIMA_Params"), exog.alias("Exogenous_Used"),
        F.date_format("Date", "yyyy-MM").alias("Date"), *[F.bround(c, 0).alias(n) for c, n in (("forecast", "Forecast"), ("lower", "Lower_CI"), ("upper", "Upper_CI"))],
        *[two_digits(F.col(c)).alias(n) for c, n in (("mae_percent", "MAE%"), ("bias_percent", "Bias%"), ("rmse", "RMSE"), ("mape", "MAPE"), ("cov", "CoV"))],
    )
    return report, pairs


def forecast_run(demand: DataFrame, groups: DataFrame, unit_names: DataFrame, settings: Settings, pipeline: DataFrame | None = None, backlog: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(report of 16 columns, holdout pairs, skipped series with reasons).

    demand: (Product_Group, BU, Date, Actuals). Each series is fitted twice, without its last months for the
    metrics and whole for the forecast; if only the first fit works, its own forecast of those months counts.
    """
    series, short = long_enough(kept(prepared_series(demand, settings)), settings.min_series)
    arrays = as_arrays(series, ["Actuals"]).withColumn("n", F.size("dates")).withColumns({"first_month": F.element_at("dates", 1), "last_month": F.element_at("dates", -1)})
    planned = choose_strategy(arrays.join(groups.select("Product_Group", "order", "mode"), "Product_Group", "left"), settings, usable_order())
    store = extended_store(pipeline if settings.use_pipeline else None, backlog if settings.use_backlog else None, settings)
    if store is None:
        planned = planned.withColumns({"exog": F.lit(None).cast("array<string>"), "x": F.lit(None).cast("array<array<double>>")})
    else:
        planned = planned.join(series_features(planned.select(*KEY, "first_month", "last_month"), store, groups, settings), list(KEY), "left")
    by_group = F.lit(None).cast("array<int>")
    for name, o in settings.short_orders.items():
        by_group = F.when(F.col("Product_Group") == name, F.array(*map(F.lit, o))).otherwise(by_group)
    planned = kept(planned.withColumn("short_order", F.coalesce(by_group, F.array(*map(F.lit, settings.short_order)))))
    tasks = planned.withColumn("phase", F.explode(F.array(F.lit("holdout"), F.lit("full")))).filter(F.col("n") > settings.holdout)
    tasks = tasks.select(*KEY, "phase", "strategy", "Actuals", "exog", "x", "short_order", F.when(F.col("order").isNotNull(), F.array(*[F.col(f"order.{c}") for c in ("p", "d", "q", "seas_p", "seas_d", "seas_q", "s")])).alias("order"))

    def fit(task) -> list[dict]:
        y = np.array([np.nan if v is None else v for v in task.Actuals], dtype=float)
        train = len(y) - settings.holdout if task.phase == "holdout" else len(y)
        steps = len(y) - train + settings.horizon
        rows = None if task.x is None or task.strategy == "ETS_THETA" else np.array([list(r) for r in task.x], dtype=float)
        x, future = (None, None) if rows is None else (rows[:train], rows[train : train + steps])
        order = None if task.order is None else tuple(int(v) for v in task.order)
        found = fit_strategy(y[:train], x, future, task.strategy, order, tuple(int(v) for v in task.short_order), steps, settings)
        if found is None:
            return []
        (mean, lower, upper), name, params = found
        head = {"Product_Group": task.Product_Group, "BU": task.BU, "phase": task.phase, "descriptor": name, "sarima_params": params, "exog": None if x is None else list(task.exog)}
        held = [*y[train:].tolist(), *[None] * settings.horizon]
        return [head | {"step": h + 1 - (len(y) - train), "actual": held[h], "forecast": float(m), "lower": float(a), "upper": float(b)} for h, (m, a, b) in enumerate(zip(mean, lower, upper, strict=True))]

    fitted = kept(run_tasks(tasks, fit, TASK_SCHEMA))
    report, pairs = phase_report(fitted.join(planned.select(*KEY, "last_month", "strategy"), list(KEY)), unit_names, settings)
    return report, pairs, short


def run_totals(report: DataFrame) -> DataFrame:
    """Counts that a run ends with: series, forecasts, groups and units."""
    return report.agg(F.count_distinct("Product_Group", "BU").alias("models"), F.count("*").alias("forecasts"), F.count_distinct("Product_Group").alias("groups"), F.count_distinct("BU").alias("units"))


def compare_scenarios(demand: DataFrame, groups: DataFrame, unit_names: DataFrame, settings: Settings, pipeline: DataFrame | None, backlog: DataFrame | None) -> DataFrame:
    """Per series the metrics of two runs, with and without features, and what the features gain."""
    runs = []
    for name, use in (("with_features", True), ("without_features", False)):
        set_ = replace(settings, use_pipeline=use and pipeline is not None, use_backlog=use and backlog is not None)
        _, pairs, _ = forecast_run(demand, groups, unit_names, set_, pipeline, backlog)
        runs.append(holdout_metrics(pairs).withColumn("scenario", F.lit(name)))
    both = runs[0].unionByName(runs[1])
    side = lambda c, s: F.max(F.when(F.col("scenario") == s, F.col(c)))
    return both.groupBy(*KEY).agg(
        *[side(c, s).alias(f"{c}_{s}") for c in ("mae_percent", "bias_percent", "rmse") for s in ("with_features", "without_features")],
        (side("mae_percent", "without_features") - side("mae_percent", "with_features")).alias("mae_percent_gain"),
    )
