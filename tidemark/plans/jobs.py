"""Jobs from files to reports: reading, the run itself, and the report tables that it writes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FEATURES, KEY, Settings
from ..kept import kept
from ..operators import diagnostics, features, mapping, series
from ..operators.catalog import Catalog, parse_catalog
from ..operators.counters import Counters
from ..operators.metrics import holdout_metrics
from ..operators.naive_drift import naive_phases
from ..sources import readers
from .forecast import forecast_run, phase_report, run_totals
from .lag_sweep import lag_sweep
from .prepared import prepared_dataset
from .selection import order_selection, recommended_orders


@dataclass(frozen=True)
class Inputs:
    """Paths of CSV files or, by their suffix, Parquet tables; pipeline, reference and backlog may be missing.

    With pipeline_encoding auto, each pipeline file is UTF-8 if its bytes are, else Latin-1.
    """

    actuals: str
    catalog: str
    pipeline: str | None = None
    reference: str | None = None
    backlog: str | None = None
    pipeline_encoding: str = readers.AUTO


def read_catalog(spark: SparkSession, inputs: Inputs) -> Catalog:
    return parse_catalog(kept(readers.read_catalog(spark, inputs.catalog)))


def asked_groups(catalog: Catalog, names: list[str] | None) -> DataFrame:
    """The catalog's groups, or those named; raises on names that are no group."""
    groups, unknown = mapping.requested_groups(catalog.groups, names)
    if bad := sorted(r.Product_Group for r in unknown.limit(20).collect()) if names else []:
        raise ValueError(f"no such product groups: {', '.join(bad)}")
    return groups


def read_demand(
    spark: SparkSession, inputs: Inputs, catalog: Catalog, settings: Settings, groups: DataFrame, match: str = "lower", counters: Counters | None = None
) -> DataFrame:
    """Monthly demand of the groups, kept; raises if a month cannot be read, with samples.

    Facts are read once: they are counted while they are summed, and read again only to name samples of bad months.
    """
    counters = counters or Counters()
    cleaned = series.clean_actuals(readers.read_actuals(spark, inputs.actuals))
    skus = catalog.skus.join(groups.select("Product_Group"), "Product_Group", "left_semi")
    demand = kept(series.monthly_demand(cleaned, skus, match, settings.by_bu, counters=counters))
    if counters.of("actuals", "bad_date"):
        series.require_months(cleaned)
    return demand


def read_features(spark: SparkSession, inputs: Inputs, catalog: Catalog, settings: Settings, counters: Counters | None = None) -> tuple[DataFrame | None, DataFrame | None]:
    """(pipeline features, backlog features), each None where there is no input for it; their monthly sums are kept."""
    counters = counters or Counters()
    pipeline = backlog = None
    if inputs.pipeline:
        raw = readers.read_pipeline(spark, inputs.pipeline, inputs.pipeline_encoding)
        loaded = features.load_pipeline(raw, catalog, readers.read_reference(spark, inputs.reference), counters=counters)
        pipeline = features.pipeline_features(kept(features.pipeline_monthly(loaded, settings.by_bu)), catalog.groups, settings)
    if inputs.backlog:
        monthly = kept(features.backlog_monthly(readers.read_backlog(spark, inputs.backlog), catalog.skus, settings.by_bu, counters))
        backlog = features.backlog_features(monthly, settings.current_month, settings.horizon, settings.max_months)
    return pipeline, backlog


def forecast_job(spark: SparkSession, inputs: Inputs, folder: str, settings: Settings, groups: list[str] | None = None, kind: str = "csv") -> DataFrame:
    """Writes forecast, metrics, skipped, rejected, counts and quarantine under folder, and returns the run's totals, a row.

    counts tells how many facts of each source were read and why others went; they are counted as they pass.
    quarantine has the lines of a pipeline CSV that are broken (which are not read) or have no date.
    """
    counters = Counters()
    catalog = read_catalog(spark, inputs)
    asked = asked_groups(catalog, groups)
    pipeline, backlog = read_features(spark, inputs, catalog, settings, counters)
    demand = read_demand(spark, inputs, catalog, settings, asked, counters=counters)
    report, pairs, short = forecast_run(demand, asked, catalog.unit_names, settings, pipeline, backlog)
    report = kept(report)
    readers.write_report(report, f"{folder}/forecast", (*KEY, "Date"), kind)
    readers.write_report(holdout_metrics(pairs), f"{folder}/metrics", KEY, kind)
    readers.write_report(short, f"{folder}/skipped", KEY, kind)
    readers.write_report(catalog.rejected, f"{folder}/rejected", ("row_id",), kind)
    readers.write_report(counters.table(spark), f"{folder}/counts", ("source", "reason"), kind)
    if inputs.pipeline:
        bad = lambda df, c: features.as_date(df, c).isNull()
        aside = readers.set_aside(spark, inputs.pipeline, features.PIPELINE_SYNONYMS["Timestamp"], bad, inputs.pipeline_encoding)
        if aside is not None:
            readers.write_report(aside, f"{folder}/quarantine", (), kind)
    return run_totals(report)


def baseline_job(spark: SparkSession, inputs: Inputs, folder: str, settings: Settings, groups: list[str] | None = None, kind: str = "csv", max_age: int = 24) -> DataFrame:
    """Writes baseline, baseline_metrics and baseline_skipped under folder, and returns the run's totals, a row.

    The forecast of a model without features, the seasonal naive one with drift, to set a forecast run against;
    it has the same columns, and the same months are held out. Series with too few months are skipped, and so are
    those that have a place in the year without a value of the last max_age months.
    """
    catalog = read_catalog(spark, inputs)
    asked = asked_groups(catalog, groups)
    cut = kept(series.prepared_series(read_demand(spark, inputs, catalog, settings, asked), settings))
    fitted, short = naive_phases(cut, settings, max_age)
    fitted = kept(fitted)
    report, pairs = phase_report(fitted, catalog.unit_names, settings)
    report = kept(report)
    unfit = series.series_lengths(cut).join(short.select(*KEY), list(KEY), "left_anti").join(fitted.select(*KEY), list(KEY), "left_anti")
    skipped = short.unionByName(unfit.select(*KEY, "n", F.lit("no fit").alias("reason")))
    readers.write_report(report, f"{folder}/baseline", (*KEY, "Date"), kind)
    readers.write_report(holdout_metrics(pairs), f"{folder}/baseline_metrics", KEY, kind)
    readers.write_report(skipped, f"{folder}/baseline_skipped", KEY, kind)
    return run_totals(report)


def order_selection_job(spark: SparkSession, inputs: Inputs, folder: str, settings: Settings, groups: list[str] | None = None, kind: str = "parquet") -> DataFrame:
    """Writes the order selection and the recommended orders (as JSON text) under folder, and returns the latter."""
    catalog = read_catalog(spark, inputs)
    demand = read_demand(spark, inputs, catalog, settings, asked_groups(catalog, groups), match="exact")
    report = kept(order_selection(series.month_grid(demand, max_months=settings.max_months), settings))
    readers.write_report(report, f"{folder}/order_selection", ("series_key",), kind)
    orders = recommended_orders(report)
    readers.write_report(orders, f"{folder}/recommended_orders", ("series_key",), kind)
    return orders


def lag_job(spark: SparkSession, inputs: Inputs, folder: str, settings: Settings, kind: str = "csv") -> DataFrame:
    """Writes the best lag of each pipeline feature of each series under folder, and returns the report."""
    if not inputs.pipeline:
        raise ValueError("a lag report needs pipeline data")
    catalog = read_catalog(spark, inputs)
    pipeline, _ = read_features(spark, inputs, catalog, settings)
    store = features.feature_store(pipeline, None)
    chosen = features.select_mode(store, catalog.groups, settings).selectExpr("Date", *KEY, "inline(features)")
    report = kept(lag_sweep(read_demand(spark, inputs, catalog, settings, catalog.groups), chosen, catalog.groups, settings))
    readers.write_report(report, f"{folder}/lags", (), kind)
    return report


def diagnostics_job(spark: SparkSession, inputs: Inputs, folder: str, min_obs: int = 12, kind: str = "csv") -> DataFrame:
    """Writes stationarity, correlations, collinearity, too_few and unmapped under folder, and returns the last, a row.

    All are of the dataset that aligns pipeline features with actual quantities by group, unit and month.
    too_few has the variables of each series that are left out of correlations and collinearity: those with
    fewer than min_obs values and those that do not vary.
    """
    if not inputs.pipeline:
        raise ValueError("diagnostics need pipeline data")
    rows = kept(readers.read_catalog(spark, inputs.catalog))
    raw = features.rename_pipeline(readers.read_pipeline(spark, inputs.pipeline, inputs.pipeline_encoding))
    data, unmapped = prepared_dataset(readers.read_actuals(spark, inputs.actuals), raw, rows, readers.read_reference(spark, inputs.reference))
    data, unmapped = kept(data), kept(unmapped)
    used = [c for c in FEATURES if c in data.columns]
    every = [*used, "Actual_Quantity"]
    readers.write_report(diagnostics.stationarity_report(data, every, min_obs), f"{folder}/stationarity", (*KEY, "variable"), kind)
    readers.write_report(diagnostics.pairwise_correlations(data, used, min_obs, "Actual_Quantity"), f"{folder}/correlations", (*KEY, "variable_x", "variable_y"), kind)
    readers.write_report(diagnostics.vif_report(data, used, min_obs), f"{folder}/collinearity", (*KEY, "variable"), kind)
    too_few = diagnostics.valid_columns(data, every, min_obs).filter("not is_valid")
    readers.write_report(too_few, f"{folder}/too_few", (*KEY, "variable"), kind)
    readers.write_report(unmapped, f"{folder}/unmapped", (), kind)
    return unmapped
