"""Order search: candidates, screening, expanding-window validation and the report."""

from __future__ import annotations

from itertools import product

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import KEY, Settings
from ..functions.columns import series_label
from ..models import arima, smoothing
from ..operators.metrics import fold_summary, ljung_box, volatility_class
from ..operators.series import as_arrays, fold_cuts
from ..kept import kept
from ..tasks import run_tasks

NEVER = 1 << 30
SELECTION = ("series_key", "group", "bu", "status", "order", "seasonal_order", "mean_mae_h1", "mae_h3", "aicc", "ljung_box_pvalue", "fallback_model", "volatility_class", "warnings")

# The search space. Each order and seasonal part with the months from which a stable and a volatile
# series tries it (None: never), for a season of 12 months; and what volatile series try first, in this order.
ORDERS = [
    # (p, d, q), stable, volatile
    ((1, 0, 0), 0, 0),
    ((0, 0, 1), 0, 0),
    ((1, 0, 1), 0, 0),
    ((2, 0, 0), 48, 32),
    ((0, 0, 2), 48, 32),
    ((2, 0, 1), 60, 36),
    ((1, 0, 2), 60, 36),
    ((2, 0, 2), 60, 36),
    ((0, 1, 0), 0, 0),
    ((1, 1, 0), 0, 0),
    ((0, 1, 1), 0, 0),
    ((1, 1, 1), 0, 0),
    ((2, 1, 0), 48, 32),
    ((0, 1, 2), 48, 32),
    ((2, 1, 1), 60, 0),
    ((1, 1, 2), 60, 0),
    ((2, 1, 2), 60, 0),
]
SEASONAL_PARTS = [
    # (P, D, Q), stable, volatile
    ((0, 0, 0), 0, 0),
    ((0, 1, 0), 24, 24),
    ((1, 0, 0), 24, 24),
    ((0, 0, 1), 24, 24),
    ((0, 1, 1), None, 24),
    ((1, 0, 1), 48, 48),
    ((1, 1, 0), None, 48),
    ((1, 1, 1), 48, 48),
]
VOLATILE_FIRST_SEASONAL = [(0, 1, 1), (1, 1, 0), (1, 1, 1)]
VOLATILE_FIRST_ORDERS = [(1, 1, 0), (0, 1, 1), (1, 1, 1), (2, 1, 1)]


def candidate_table(season: int = 12) -> list[tuple]:
    """(volatile, p, d, q, seas_p, seas_d, seas_q, min_n, matched, preferred, complexity), one row per model to try.

    Seasonal parts open with so many seasons. A pair is matched if both differences are equal; volatile series
    try matched pairs only, beginning with the preferred ones.
    """
    first = {(o, s): i for i, (s, o) in enumerate(product(VOLATILE_FIRST_SEASONAL, VOLATILE_FIRST_ORDERS))}
    rows = []
    for kind, volatile in ((1, False), (2, True)):
        for order, part in product(ORDERS, SEASONAL_PARTS):
            matched = order[0][1] == part[0][1]
            if part[kind] is None or volatile and not matched:
                continue
            place = first.get((order[0], part[0]), NEVER) if volatile else NEVER
            least = max(order[kind], part[kind] * season // 12)
            rows.append((volatile, *order[0], *part[0], least, matched, place, sum(order[0]) + sum(part[0])))
    return rows


def candidates(spark: SparkSession, series: DataFrame, season: int = 12) -> DataFrame:
    """series (with n and is_volatile) and each model to try, numbered in order; the table is a constant."""
    table = spark.createDataFrame(candidate_table(season), "is_volatile boolean, p int, d int, q int, seas_p int, seas_d int, seas_q int, min_n int, matched boolean, preferred int, complexity int")
    rows = series.join(F.broadcast(table), "is_volatile").filter("n >= min_n")
    order = Window.partitionBy(*KEY).orderBy("preferred", F.desc("matched"), "complexity", "p", "d", "q", "seas_p", "seas_d", "seas_q")
    return rows.withColumn("candidate", F.row_number().over(order))


def shortlist(scores: DataFrame, settings: Settings) -> DataFrame:
    """The best candidates of each series by aicc, last residual, complexity and order; more of them for volatile or short series."""
    least = lambda c: F.when(F.isnan(c) | F.col(c).isNull(), F.lit(float("inf"))).otherwise(F.col(c))
    order = Window.partitionBy(*KEY).orderBy(least("aicc"), least("last_residual"), "complexity", "p", "d", "q", "seas_p", "seas_d", "seas_q")
    limit = F.when(F.col("is_volatile") | (F.col("n") < settings.extended_below), settings.shortlist_extended).otherwise(settings.shortlist)
    return scores.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= limit)


def best_candidate(tried: DataFrame) -> DataFrame:
    """The first by primary error (3 months ahead for volatile series), mean error, aicc and complexity."""
    inf = F.lit(float("inf"))
    ahead = F.when(F.coalesce(F.col("mae_h3"), inf) < inf, F.col("mae_h3"))
    primary = F.when(F.col("is_volatile"), F.coalesce(ahead, F.col("mean_mae_h1"))).otherwise(F.col("mean_mae_h1"))
    blended = 0.5 * (F.col("mean_mae_h1") + F.coalesce(ahead, F.col("mean_mae_h1")))
    order = Window.partitionBy(*KEY).orderBy(primary, blended, F.coalesce("aicc", inf), "complexity", "place")
    return tried.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")


def search_fit(y: np.ndarray, task, settings: Settings) -> arima.Fit | None:
    try:
        fitted = arima.fit(y, (int(task.p), int(task.d), int(task.q)), (int(task.seas_p), int(task.seas_d), int(task.seas_q), settings.season), stationary=True, invertible=True, max_iterations=settings.max_iterations)
    except (ValueError, np.linalg.LinAlgError):
        return None
    return fitted if fitted.converged else None


MODEL = ("p", "d", "q", "seas_p", "seas_d", "seas_q")
ID_SCHEMA = "Product_Group string, BU string, candidate int"


def order_selection(series: DataFrame, settings: Settings) -> DataFrame:
    """The 13-column report from dense, zero-filled series (Product_Group, BU, Date, Actuals).

    Series too short for a validation, or without a model that can be fitted and validated, get a fallback:
    the theta method, else a seasonal naive forecast, judged on a true holdout of 1 and 3 months.
    """
    spark = series.sparkSession
    classes = volatility_class(series, settings.volatility)
    arrays = kept(as_arrays(series, ["Actuals"]).join(classes.select(*KEY, "n", "is_volatile"), list(KEY)))
    long = arrays.filter(F.col("n") >= max(settings.burn_in, 12))
    tried = candidates(spark, long.select(*KEY, "n", "is_volatile", "Actuals"), settings.season)

    def screen(task) -> list[dict]:
        fitted = search_fit(np.array(task.Actuals, dtype=float), task, settings)
        if fitted is None:
            return []
        last = abs(fitted.resid[-1])
        return [{"Product_Group": task.Product_Group, "BU": task.BU, "candidate": task.candidate, "aicc": fitted.aicc if np.isfinite(fitted.aicc) else np.inf, "last_residual": last if np.isfinite(last) else np.inf}]

    scored = kept(run_tasks(tried.select(*KEY, "candidate", *MODEL, "Actuals"), screen, f"{ID_SCHEMA}, aicc double, last_residual double"))
    keep = kept(shortlist(scored.join(tried.drop("Actuals"), [*KEY, "candidate"]), settings))
    with_series = keep.join(arrays.select(*KEY, "Actuals"), list(KEY))
    folds = fold_cuts(with_series, settings, 1).unionByName(fold_cuts(with_series.filter("is_volatile"), settings, 3))
    whole = with_series.withColumns({"cut": F.col("n").cast("int"), "fold": F.lit(0), "horizon": F.lit(0)})

    def validate(task) -> list[dict]:
        y = np.array(task.Actuals, dtype=float)
        fitted = search_fit(y[: task.cut], task, settings)
        row = {"Product_Group": task.Product_Group, "BU": task.BU, "candidate": task.candidate, "horizon": task.horizon, "fold": task.fold, "mae": None, "resid": None}
        if fitted is not None and task.horizon:
            row["mae"] = float(np.abs(fitted.forecast(task.horizon, 0.8)[0] - y[task.cut : task.cut + task.horizon]).mean())
        elif fitted is not None:
            row["resid"] = [float(v) for v in fitted.resid if np.isfinite(v)]
        return [row]

    columns = [*KEY, "candidate", *MODEL, "Actuals", "cut", "fold", "horizon"]
    runs = kept(run_tasks(folds.select(*columns).unionByName(whole.select(*columns)), validate, f"{ID_SCHEMA}, horizon int, fold int, mae double, resid array<double>"))
    own = runs.filter("horizon = 0").groupBy(*KEY, "candidate").agg(F.max("resid").alias("resid"))
    maes = fold_summary(runs, (*KEY, "candidate")).join(own, [*KEY, "candidate"], "left")
    good = maes.filter(F.expr(f"ok_h1 = folds_h1 and ok_h1 >= least({settings.min_folds}, folds_h1) and ok_h1 > 0 and resid is not null"))
    good = good.withColumn("mae_h3", F.when(F.expr("ok_h3 = folds_h3 and ok_h3 > 0"), F.col("mae_h3")))
    best = kept(best_candidate(good.join(keep, [*KEY, "candidate"])))
    residuals = best.select(*KEY, F.posexplode("resid").alias("Date", "resid"))
    tests = ljung_box(residuals, settings.ljung_box_lags or settings.season).select(*KEY, F.col("p_value").alias("ljung_box_pvalue"))
    missing_h3 = F.when(F.col("is_volatile") & F.col("mae_h3").isNull(), "h3_unavailable")
    chosen = best.join(tests, list(KEY), "left").select(
        series_label(F.col("Product_Group"), F.col("BU")).alias("series_key"), F.col("Product_Group").alias("group"), F.col("BU").alias("bu"), F.lit("sarima_selected").alias("status"),
        F.array("p", "d", "q").alias("order"), F.array("seas_p", "seas_d", "seas_q", F.lit(settings.season)).alias("seasonal_order"), "mean_mae_h1", "mae_h3", "aicc", "ljung_box_pvalue",
        F.lit("").alias("fallback_model"), F.when(F.col("is_volatile"), "volatile").otherwise("stable").alias("volatility_class"), F.coalesce(missing_h3, F.lit("")).alias("warnings"),
    )
    screened = scored.select(*KEY).distinct().withColumn("_screened", F.lit(True))
    done = best.select(*KEY).withColumn("_done", F.lit(True))
    rest = arrays.join(done, list(KEY), "left").filter("_done is null").join(screened, list(KEY), "left")
    reason = F.when(F.col("n") < max(settings.burn_in, 12), "short_history").when(F.col("_screened").isNull(), "initial_screen_failed").otherwise("shortlist_evaluation_failed")
    return chosen.unionByName(fallbacks(rest.select(*KEY, "Actuals", reason.alias("reason")), settings))


def fallback_of(y: np.ndarray, settings: Settings) -> tuple[str, list[float | None], str | None]:
    """(name, errors 1 and 3 months ahead on a holdout, error text)."""
    try:
        maes = [float(np.abs(smoothing.fit_theta(y[:-h], settings.season).forecast(h, 0.8)[0] - y[-h:]).mean()) for h in (1, 3)]
        return "Theta", maes, None
    except (ValueError, np.linalg.LinAlgError) as e:
        naive = [float(np.abs(y[-h - settings.season : len(y) - settings.season] - y[-h:]).mean()) if len(y) >= settings.season + h else None for h in (1, 3)]
        return "SeasonalNaive", naive, f"fallback_error: {e}"


def fallbacks(rest: DataFrame, settings: Settings) -> DataFrame:
    def one(task) -> list[dict]:
        name, (h1, h3), error = fallback_of(np.array(task.Actuals, dtype=float), settings)
        return [{"Product_Group": task.Product_Group, "BU": task.BU, "fallback_model": name, "mean_mae_h1": h1, "mae_h3": h3, "warnings": " | ".join(filter(None, ("sarima_unavailable", task.reason, error)))}]

    rows = run_tasks(rest, one, "Product_Group string, BU string, fallback_model string, mean_mae_h1 double, mae_h3 double, warnings string")
    none = F.array().cast("array<int>")
    return rows.select(
        series_label(F.col("Product_Group"), F.col("BU")).alias("series_key"), F.col("Product_Group").alias("group"), F.col("BU").alias("bu"), F.lit("fallback").alias("status"), none.alias("order"), none.alias("seasonal_order"),
        "mean_mae_h1", "mae_h3", F.lit(None).cast("double").alias("aicc"), F.lit(None).cast("double").alias("ljung_box_pvalue"), "fallback_model", F.lit("").alias("volatility_class"), "warnings",
    )


def recommended_orders(report: DataFrame) -> DataFrame:
    """(series_key, orders): selected orders as JSON text."""
    return report.filter("status = 'sarima_selected'").select("series_key", F.to_json(F.concat("order", "seasonal_order")).alias("orders"))
