"""Correlation, collinearity and validity diagnostics in built-in functions; unit-root tests per series in a small helper."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.matrices import condition_number, correlation_matrix, inflation_factors
from ..models.unit_root import adf_test, kpss_test
from ..tasks import run_tasks
from .series import as_arrays

ANALYSIS_KEY = ("Product_Group", "BU")


def pearson(x: str, y: str, extra: Column | None = None) -> Column:
    """Correlation of the rows where both are present; null for fewer than two, or without variance."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    both = both if extra is None else both & extra
    a, b = F.when(both, F.col(x)), F.when(both, F.col(y))
    return F.when(F.count_if(both) >= 2, F.try_divide(F.covar_pop(a, b), F.nullif(F.stddev_pop(a) * F.stddev_pop(b), F.lit(0.0))))


def valid_columns(data: DataFrame, columns: list[str], min_obs: int, keys: tuple[str, ...] = ANALYSIS_KEY) -> DataFrame:
    """(keys, variable, n_obs, is_constant, is_valid) per column."""
    row = lambda c: F.struct(F.lit(c).alias("variable"), F.count(c).alias("n_obs"), F.coalesce(F.min(c) == F.max(c), F.lit(True)).alias("is_constant"))
    out = data.groupBy(*keys).agg(F.array(*[row(c) for c in columns]).alias("_x")).select(*keys, F.explode("_x").alias("x")).select(*keys, "x.*")
    return out.withColumn("is_valid", (F.col("n_obs") >= min_obs) & ~F.col("is_constant"))


def pairwise_correlations(data: DataFrame, columns: list[str], min_obs: int, target: str | None = None, keys: tuple[str, ...] = ANALYSIS_KEY) -> DataFrame:
    """(keys, variable_x, variable_y, pearson_correlation) of the valid columns, each pair once, in column order.

    A target takes part even where it is constant, if it has min_obs values. One pass sums all pairs.
    """
    every = columns + ([target] if target else [])
    enough = lambda c: F.count(c) >= min_obs
    valid = lambda c: enough(c) if c == target else enough(c) & (F.min(c) != F.max(c))
    rows = [F.struct(F.lit(i).alias("_at"), F.lit(x).alias("variable_x"), F.lit(y).alias("variable_y"), pearson(x, y).alias("pearson_correlation"), F.coalesce(valid(x) & valid(y), F.lit(False)).alias("_ok")) for i, (x, y) in enumerate(combinations(every, 2))]
    out = data.groupBy(*keys).agg(F.array(*rows).alias("_x")).select(*keys, F.explode("_x").alias("x")).filter("x._ok")
    return out.select(*keys, "x.variable_x", "x.variable_y", "x.pearson_correlation")


def complete_correlations(data: DataFrame, columns: list[str], keys: tuple[str, ...]) -> DataFrame:
    """As columns corr_x__y: correlations over rows in which all columns are present."""
    full = F.lit(True)
    for c in columns:
        full = full & F.col(c).isNotNull()
    return data.groupBy(*keys).agg(*[pearson(x, y, full).alias(f"corr_{x}__{y}") for x, y in combinations(columns, 2)])


def target_correlations(data: DataFrame, columns: list[str], target: str, keys: tuple[str, ...]) -> DataFrame:
    return data.groupBy(*keys).agg(F.count(target).alias("n_target"), *[pearson(c, target).alias(f"corr_{c}__actuals") for c in columns])


def unpivoted(data: DataFrame, columns: list[str], keys: tuple[str, ...]) -> DataFrame:
    return data.select(*keys, "Date", F.explode(F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).cast("double").alias("value")) for c in columns])).alias("x")).select(*keys, "Date", "x.variable", "x.value")


def feature_summary(data: DataFrame, columns: list[str], keys: tuple[str, ...]) -> DataFrame:
    """Count, mean, deviation, least and greatest value of each feature of each series."""
    return unpivoted(data, columns, keys).groupBy(*keys, "variable").agg(
        F.count("value").alias("series_count"), F.avg("value").alias("series_mean"), F.stddev_pop("value").alias("series_std"), F.min("value").alias("series_min"), F.max("value").alias("series_max")
    )


def complete_moments(data: DataFrame, columns: list[str], min_obs: int, keys: tuple[str, ...]) -> DataFrame:
    """(keys, valid, counts, n_complete, cov): per series one row of sums over the rows in which no valid column is null.

    A column is valid with min_obs values or more that differ; cov lists covariances of all pairs, by rows of
    the upper triangle, null where a column is not valid. All of it is one exchange on the keys.
    """
    own = Window.partitionBy(*keys)
    marked = data.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns])
    marked = marked.withColumns({f"_ok_{c}": F.coalesce((F.count(c).over(own) >= min_obs) & (F.min(c).over(own) != F.max(c).over(own)), F.lit(False)) for c in columns})
    full = F.lit(True)
    for c in columns:
        full = full & (~F.col(f"_ok_{c}") | F.col(c).isNotNull())
    value = lambda c: F.when(F.col("_full") & F.col(f"_ok_{c}"), F.col(c))
    pairs = [F.covar_pop(value(x), value(y)) for i, x in enumerate(columns) for y in columns[i:]]
    return marked.withColumn("_full", full).groupBy(*keys).agg(
        F.array(*[F.bool_or(f"_ok_{c}") for c in columns]).alias("valid"), F.array(*[F.count(c) for c in columns]).alias("counts"), F.count_if("_full").alias("n_complete"), F.array(*pairs).alias("cov")
    )


def inflation(moments: DataFrame, columns: list[str], min_complete: int, keys: tuple[str, ...]) -> DataFrame:
    """(keys, valid, counts, n_complete, vif, condition_number) from complete_moments: inflation factors of all columns as an array.

    Both are null with fewer than two valid columns, with no more complete rows than those, or fewer than
    min_complete, and where a valid column does not vary over the complete rows.
    """
    k = len(columns)
    n_valid = F.size(F.filter("valid", lambda v: v))
    enough = (n_valid >= 2) & (F.col("n_complete") > n_valid) & (F.col("n_complete") >= min_complete)
    rows = moments.select(*keys, "valid", "counts", "n_complete", F.when(enough, correlation_matrix(F.col("cov"), F.col("valid"), k)).alias("_r"))
    rows = rows.withColumn("vif", inflation_factors(F.col("_r"), k)).withColumn("condition_number", condition_number(F.col("_r"), k))
    infinite = F.exists("vif", lambda v: v == float("inf"))
    return rows.withColumn("condition_number", F.when(infinite, F.lit(float("inf"))).otherwise(F.col("condition_number"))).drop("_r")


TOO_FEW = "too few complete rows or columns for inflation factors"


def vif_report(data: DataFrame, columns: list[str], min_obs: int, keys: tuple[str, ...] = ANALYSIS_KEY) -> DataFrame:
    """(keys, variable, vif, condition_number, n_obs, notes) of the valid columns over complete rows.

    A column that follows from the others has an infinite factor, and so have those; the condition number is
    then infinite. Sums are one exchange on the keys, and matrices are worked on as arrays, a row a series.
    """
    return vif_of_moments(complete_moments(data, columns, min_obs, keys), columns, keys)


def vif_of_moments(moments: DataFrame, columns: list[str], keys: tuple[str, ...] = ANALYSIS_KEY) -> DataFrame:
    """The report of vif_report, from moments as complete_moments or a store of them has."""
    solved = inflation(moments, columns, 0, keys)
    each = F.posexplode(F.array(*map(F.lit, columns))).alias("_at", "variable")
    rows = solved.select(*keys, "valid", "counts", "vif", "condition_number", each).filter(F.get("valid", F.col("_at")))
    note = F.when(F.col("vif").isNull(), TOO_FEW).otherwise("")
    return rows.select(*keys, "variable", F.get("vif", F.col("_at")).alias("vif"), "condition_number", F.get("counts", F.col("_at")).alias("n_obs"), note.alias("notes"))


STATIONARITY = "n_obs bigint, is_constant boolean, adf_stat double, adf_pvalue double, adf_lags int, adf_nobs int, kpss_stat double, kpss_pvalue double, kpss_lags int, adf_stationary boolean, kpss_stationary boolean, notes string"


def stationarity_report(data: DataFrame, columns: list[str], min_obs: int = 12, keys: tuple[str, ...] = ANALYSIS_KEY) -> DataFrame:
    """Unit-root and level-stationarity tests of each variable of each series, one small task each."""

    def one(task) -> list[dict]:
        x = np.array([v for v in task.value if v is not None and v == v], dtype=float)
        row = {k: getattr(task, k) for k in (*keys, "variable")} | dict.fromkeys([c.split()[0] for c in STATIONARITY.split(", ")]) | {"n_obs": len(x), "is_constant": False, "notes": ""}
        if len(x) < min_obs:
            row["notes"] = f"fewer than {min_obs} values"
        elif len(np.unique(x)) <= 1:
            row |= {"is_constant": True, "notes": "all values are equal, so no test applies"}
        else:
            notes = []
            try:
                t = adf_test(x)
                row |= {"adf_stat": t.statistic, "adf_pvalue": t.p_value, "adf_lags": t.lags, "adf_nobs": t.n_obs, "adf_stationary": t.p_value < 0.05}
            except (ValueError, np.linalg.LinAlgError) as e:
                notes.append(f"ADF: {e}")
            try:
                stat, p, lags = kpss_test(x)
                row |= {"kpss_stat": stat, "kpss_pvalue": p, "kpss_lags": lags, "kpss_stationary": p > 0.05}
            except (ValueError, ZeroDivisionError) as e:
                notes.append(f"KPSS: {e}")
            row["notes"] = " | ".join(notes)
        return [row]

    head = ", ".join(f"{k} string" for k in (*keys, "variable"))
    tasks = as_arrays(unpivoted(data, columns, keys), ["value"], (*keys, "variable")).drop("dates")
    return run_tasks(tasks, one, f"{head}, {STATIONARITY}")


BACKLOG_COLUMNS = ["raw_data", "log_raw_data", "backlog_standardized"]
ADF_COLUMNS = ("adf_statistic", "adf_pvalue", "adf_used_lag", "adf_nobs", "adf_icbest", "adf_stationary_flag", "adf_crit_1pct", "adf_crit_5pct", "adf_crit_10pct")


def with_actuals(features: DataFrame, actuals: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """features with the actuals of their product, unit and month, null where there are none."""
    return features.join(actuals.select(*keys, "Date", "Actuals"), [*keys, "Date"], "left")


def backlog_relations(data: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """(keys, first_month, last_month, n_target, correlations) in one pass over features with actuals."""
    full = F.lit(True)
    for c in BACKLOG_COLUMNS:
        full = full & F.col(c).isNotNull()
    return data.groupBy(*keys).agg(
        F.min("Date").alias("first_month"),
        F.max("Date").alias("last_month"),
        F.count("Actuals").alias("n_target"),
        *[pearson(x, y, full).alias(f"corr_{x}__{y}") for x, y in combinations(BACKLOG_COLUMNS, 2)],
        *[pearson(c, "Actuals").alias(f"corr_{c}__actuals") for c in BACKLOG_COLUMNS],
    )


def backlog_inflation(data: DataFrame, keys: tuple[str, ...], threshold: float = 5.0, min_obs: int = 12) -> DataFrame:
    """(keys, variable, vif_value, vif_observations, vif_flag_high, _vif_notes) of each backlog feature, of those that vary."""
    solved = inflation(complete_moments(data, BACKLOG_COLUMNS, 1, keys), BACKLOG_COLUMNS, min_obs, keys)
    n_valid = F.size(F.filter("valid", lambda v: v))
    used = F.when(n_valid >= 2, F.col("n_complete")).otherwise(F.lit(0))
    value = F.when(F.get("valid", F.col("_at")), F.get("vif", F.col("_at")))
    few = F.when(n_valid < 2, F.lit("no VIF: fewer than two features vary")).when(F.col("vif").isNull(), F.format_string("no VIF: %d complete rows for %d features", used, n_valid))
    tied = [F.when(F.get("valid", F.lit(i)) & (F.get("vif", F.lit(i)) == float("inf")), F.lit(f"{c} follows from the other features, its VIF is infinite")) for i, c in enumerate(BACKLOG_COLUMNS)]
    rows = solved.select(*keys, "valid", "vif", "n_complete", F.array(few, *tied).alias("_vif_notes"), F.posexplode(F.array(*map(F.lit, BACKLOG_COLUMNS))).alias("_at", "variable"))
    return rows.select(*keys, "variable", value.alias("vif_value"), used.cast("long").alias("vif_observations"), F.coalesce(value >= threshold, F.lit(False)).alias("vif_flag_high"), "_vif_notes")


def backlog_diagnostics(features: DataFrame, actuals: DataFrame, alpha: float = 0.05, vif_threshold: float = 5.0, min_obs: int = 12) -> DataFrame:
    """One row per (Product, BU, feature): span, summary, unit-root test, VIF, correlations and notes.

    features: (Product, BU, Date, backlog features); actuals: (Product, BU, Date, Actuals).
    """
    keys = ("Product", "BU")
    data = with_actuals(features, actuals, keys)
    summary = feature_summary(data, BACKLOG_COLUMNS, keys)
    least = max(3, min_obs)


    def tests(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("Date")
        rows = []
        for c in BACKLOG_COLUMNS:
            x = pdf[c].dropna().to_numpy(dtype=float)
            row = {k: pdf[k].iloc[0] for k in keys} | {"variable": c} | dict.fromkeys(ADF_COLUMNS) | {"adf_stationary_flag": False, "_note": None}
            if len(x) < least:
                row["_note"] = f"no ADF: {len(x)} values, {least} are needed"
            else:
                try:
                    t = adf_test(x)
                    row |= dict(zip(ADF_COLUMNS, (t.statistic, t.p_value, t.lags, t.n_obs, t.criterion, bool(t.p_value <= alpha), *t.critical), strict=True))
                except (ValueError, np.linalg.LinAlgError) as e:
                    row["_note"] = f"ADF: {e}"
            rows.append(row)
        return pd.DataFrame(rows).astype(dict.fromkeys(("adf_used_lag", "adf_nobs"), object))

    kinds = {"adf_used_lag": "int", "adf_nobs": "int", "adf_stationary_flag": "boolean"}
    schema = "Product string, BU string, variable string, " + ", ".join(f"{c} {kinds.get(c, 'double')}" for c in ADF_COLUMNS) + ", _note string"
    tested = data.select(*keys, "Date", *BACKLOG_COLUMNS).groupBy(*keys).applyInPandas(tests, schema)
    out = tested.join(summary, [*keys, "variable"]).join(backlog_inflation(data, keys, vif_threshold, min_obs), [*keys, "variable"]).join(backlog_relations(data, keys), list(keys))
    names = [f"corr_{x}__{y}" for x, y in combinations(BACKLOG_COLUMNS, 2)]
    no_pairs = F.when(F.coalesce(*[F.col(c) for c in names]).isNull(), "no correlations: too few complete rows")
    no_target = F.when(F.col("n_target") < 2, "no correlations with actuals: fewer than two of them")
    notes = F.array_join(F.array_distinct(F.array_compact(F.concat(F.array("_note"), "_vif_notes", F.array(no_pairs, no_target)))), "; ")
    own = [f"corr_{c}__actuals" for c in BACKLOG_COLUMNS]
    # Without actuals no correlation with them is told.
    return out.select(
        F.col("Product").alias("product"), F.col("BU").alias("business_unit"), F.col("variable").alias("feature"), "first_month", "last_month",
        "series_count", "series_mean", "series_std", "series_min", "series_max", *ADF_COLUMNS, "vif_value", "vif_observations", "vif_flag_high", *names, *own, notes.alias("notes"),
    )
