"""Seasonal naive forecasts with drift: a model whose state is folded over each series by Spark's own expressions."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import KEY, Settings
from .series import as_arrays, long_enough, prepared_series

STRATEGY = "SEASONAL_NAIVE"
#: season: the last value of each place in the year and its month's number; base, n, total, squares: the first
#: difference to the year before, how many there are, and the sums of the others' distances to the first, and their squares.
STATE = "struct<season:array<struct<value:double,at:int>>,base:double,n:int,total:double,squares:double,t:int>"


def _advance(state: Column, value: Column, season: int) -> Column:
    t = state["t"]
    old = F.get(state["season"], t % season)
    change = F.when(t - old["at"] == season, value - old["value"])
    base = F.coalesce(state["base"], change)
    off = F.coalesce(change - base, F.lit(0.0))
    here = lambda i: (i == t % season) & value.isNotNull()
    known = F.transform(state["season"], lambda x, i: F.when(here(i), F.struct(value.alias("value"), t.alias("at"))).otherwise(x))
    return F.struct(
        known.alias("season"), base.alias("base"), (state["n"] + change.isNotNull().cast("int")).alias("n"),
        (state["total"] + off).alias("total"), (state["squares"] + off * off).alias("squares"), (t + 1).alias("t"),
    ).cast(STATE)


def folded(values: Column, season: int = 12) -> Column:
    """The state (STATE) after an array of monthly values in order, null where a month has none.

    A month without a value leaves its place in the year as it was, and has no difference. Sums are of distances
    to the first difference, so that those of large values do not cancel.
    """
    empty = F.struct(F.lit(None).cast("double").alias("value"), F.lit(None).cast("int").alias("at"))
    zero, none = F.lit(0.0), F.lit(None).cast("double")
    start = F.struct(
        F.array_repeat(empty, season).alias("season"), none.alias("base"), F.lit(0).alias("n"), zero.alias("total"), zero.alias("squares"), F.lit(0).alias("t")
    ).cast(STATE)
    return F.aggregate(values, start, lambda state, v: _advance(state, v, season))


def drift_of(state: Column) -> Column:
    """Mean change in a season; null without a difference."""
    return state["base"] + F.try_divide(state["total"], state["n"])


def deviation_of(state: Column) -> Column:
    """Sample deviation of the changes in a season; null with fewer than two."""
    n = state["n"]
    spread = F.greatest(state["squares"] - F.try_divide(state["total"] * state["total"], n), F.lit(0.0))
    return F.when(n >= 2, F.sqrt(F.try_divide(spread, n - 1)))


def ahead(state: Column, steps: Column, confidence: float, season: int = 12) -> Column:
    """array<struct<forecast, lower, upper>> of the steps after the state: the place's last value, moved by the drift
    once for each season since, with an interval that widens with the root of the seasons."""
    z = NormalDist().inv_cdf(0.5 + confidence / 2)

    def at(h: Column) -> Column:
        t = state["t"] + h
        last = F.get(state["season"], t % season)
        seasons = (t - last["at"]) / season
        mean, width = last["value"] + seasons * drift_of(state), z * deviation_of(state) * F.sqrt(seasons)
        return F.struct(mean.alias("forecast"), (mean - width).alias("lower"), (mean + width).alias("upper"))

    return F.transform(F.sequence(F.lit(0), steps - 1), at)


def usable(state: Column, max_age: int) -> Column:
    """Whether every place in the year has a value at most max_age months old, and there are two differences."""
    fresh = F.forall(state["season"], lambda x: F.coalesce(state["t"] - x["at"] <= max_age, F.lit(False)))
    return fresh & (state["n"] >= 2)


def naive_phases(demand: DataFrame, settings: Settings, max_age: int = 24) -> tuple[DataFrame, DataFrame]:
    """(rows of both phases as plans.forecast.phase_report reads them, short series with reasons).

    demand: (Product_Group, BU, Date, Actuals), one row a month. Each series is folded twice, without its last
    holdout months and whole; a phase whose state is not usable has no rows. Gaps stay gaps. One exchange puts
    the series together, and nothing leaves the JVM.
    """
    series, short = long_enough(prepared_series(demand, settings), settings.min_series)
    arrays = as_arrays(series, ["Actuals"]).withColumn("_n", F.size("dates")).filter(F.col("_n") > settings.holdout)
    phases = F.array(*[F.struct(F.lit(name).alias("phase"), F.lit(held).alias("held")) for name, held in (("holdout", settings.holdout), ("full", 0))])
    rows = arrays.withColumn("_p", F.explode(phases)).select(
        *KEY, F.element_at("dates", -1).alias("last_month"), "_n", "Actuals", "_p.phase", F.col("_p.held").alias("_held"),
        folded(F.slice("Actuals", 1, F.col("_n") - F.col("_p.held")), settings.season).alias("_state"),
    )
    state, held = F.col("_state"), F.col("_held")
    fitted = rows.filter(usable(state, max_age)).select(
        *KEY, "last_month", "phase", "_n", "_held", "Actuals", F.posexplode(ahead(state, held + settings.horizon, settings.confidence, settings.season)).alias("_h", "_f")
    )
    step = F.col("_h") + 1 - held
    return fitted.select(
        *KEY, "last_month", F.lit(STRATEGY).alias("strategy"), "phase", step.alias("step"), F.get("Actuals", F.col("_n") + step - 1).alias("actual"), "_f.*",
        F.lit(f"Seasonal naive with drift ({settings.season})").alias("descriptor"), F.lit("N/A").alias("sarima_params"), F.lit(None).cast("array<string>").alias("exog"),
    ), short
