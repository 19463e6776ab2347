"""Monthly series: aggregation, dense month grids, trimming, splits and folds."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import KEY, Settings
from ..functions.columns import clean_key, month_start, parse_month
from .counters import Counters, rows_where
from .mapping import map_products


def clean_actuals(actuals: DataFrame, off_grid: str = "truncate") -> DataFrame:
    """(Product, BU, Date, Actuals) with months as dates; a missing BU column is empty. Rows whose month cannot
    be read have a null Date. Days inside a month are truncated to its start, or with off_grid drop, go."""
    day = parse_month(F.col("Month")) if dict(actuals.dtypes)["Month"] == "string" else F.col("Month").cast("date")
    unit = clean_key(F.col("BU")) if "BU" in actuals.columns else F.lit("")
    out = actuals.select(F.col("Product"), unit.alias("BU"), day.alias("_day"), "Month", F.col("Actuals").try_cast("double").alias("Actuals"))
    if off_grid == "drop":
        out = out.filter("_day is null or day(_day) = 1")
    return out.withColumn("Date", month_start(F.col("_day"))).drop("_day")


def bad_months(cleaned: DataFrame) -> DataFrame:
    """Up to five different months that are neither dates nor serial days."""
    return cleaned.filter("Date is null and Month is not null").select(F.col("Month").cast("string").alias("Month")).distinct().limit(5)


def require_months(cleaned: DataFrame) -> DataFrame:
    """cleaned without rows of no month; raises and names samples if any month could not be read."""
    if bad := [r.Month for r in bad_months(cleaned).collect()]:
        raise ValueError(f"months that cannot be read: {', '.join(sorted(bad))}")
    return cleaned.filter("Date is not null").drop("Month")


def monthly_demand(cleaned: DataFrame, skus: DataFrame, match: str = "lower", by_bu: bool = True, keep_blank_bu: bool = True, counters: Counters | None = None) -> DataFrame:
    """(Product_Group, BU, Date, Actuals): demand per group, unit and month; BU is empty if units are put together.

    Facts move once, to meet the catalog, and are then few sums. counters are told of the facts that are read
    and that go, under actuals; bad_date are those of no_date that name a month.
    """
    known = F.lit(True) if keep_blank_bu else F.col("BU") != ""
    unit = F.col("BU") if by_bu else F.lit("")
    dated, good = F.col("Date").isNotNull(), F.col("_known")
    rows = cleaned.withColumn("_known", known)
    rows = rows if counters else rows.filter(dated & good)
    named = F.count_if(F.col("_once") & F.col("Month").isNotNull()) if "Month" in cleaned.columns else F.count_if("_once")
    if not counters:
        mapped = map_products(rows.withColumn("BU", unit), skus, match)
        return mapped.groupBy("Product_Group", "BU", "Date").agg(F.coalesce(F.sum("Actuals"), F.lit(0.0)).alias("Actuals"))
    rows = map_products(rows.withColumn("BU", unit), skus, match, keep_unmapped=True, once="_once")
    sums = rows.groupBy("Product_Group", "BU", "Date", "_known").agg(F.sum("Actuals").alias("Actuals"), F.count_if("_once").alias("_rows"), named.alias("_named"))
    group = F.col("Product_Group").isNotNull()
    gone = {"no_date": rows_where(~dated, "_rows"), "bad_date": rows_where(~dated, "_named"), "no_unit": rows_where(dated & ~good, "_rows"), "no_group": rows_where(dated & good & ~group, "_rows")}
    sums = counters.keep(sums, "actuals", read=F.sum("_rows"), **gone).filter(dated & good & group)
    return sums.groupBy("Product_Group", "BU", "Date").agg(F.coalesce(F.sum("Actuals"), F.lit(0.0)).alias("Actuals"))


def demand_levels(cleaned: DataFrame, skus: DataFrame, match: str = "lower") -> DataFrame:
    """Demand per (group, unit, month) and per (group, month) in one pass; by_bu tells the level."""
    mapped = map_products(cleaned.filter("Date is not null").groupBy("Product", "BU", "Date").agg(F.sum("Actuals").alias("Actuals")), skus, match)
    g, b, d = F.col("Product_Group"), F.col("BU"), F.col("Date")
    sets = mapped.groupingSets([[g, b, d], [g, d]], g, b, d)
    return sets.agg(F.coalesce(F.sum("Actuals"), F.lit(0.0)).alias("Actuals"), (F.grouping("BU") == 0).alias("by_bu")).select("Product_Group", F.coalesce("BU", F.lit("")).alias("BU"), "Date", "Actuals", "by_bu")


def month_grid(series: DataFrame, keys: tuple[str, ...] = KEY, end: date | None = None, only_end: bool = False, fill: float | None = 0.0, max_months: int = 1200) -> DataFrame:
    """Every month from a series' first to its last (or to end, if that is later; or to end alone with only_end).

    Missing months get fill, or stay null. Rows after the end go. A grid longer than max_months raises. series
    has one row per month, whose start is its date; each row brings the months up to the next one's, so that
    the input is read once and moves once.
    """
    rows = series.filter("Date is not null") if end is None or not only_end else series.filter(F.col("Date") <= F.lit(end))
    own = Window.partitionBy(*keys).orderBy("Date")
    last = F.col("Date") if end is None else F.lit(end) if only_end else F.greatest("Date", F.lit(end))
    until = F.coalesce(F.add_months(F.lead("Date").over(own), -1), last)
    spaced = rows.withColumns({"_first": F.first("Date").over(own), "_until": until})
    too_long = F.raise_error(F.lit(f"a series spans more than {max_months} months")).cast("date")
    steps = F.sequence("Date", F.when(F.months_between("_until", "_first") < max_months, F.col("_until")).otherwise(too_long), F.expr("interval 1 month"))
    filled = spaced.withColumn("_month", F.explode(steps))
    here = F.col("_month") == F.col("Date")
    values = [c for c in series.columns if c not in (*keys, "Date")]
    value = lambda c: F.when(here, F.col(c)) if fill is None else F.coalesce(F.when(here, F.col(c)), F.lit(fill).cast(series.schema[c].dataType))
    return filled.select(*keys, F.col("_month").alias("Date"), *[value(c).alias(c) for c in values])


def trim_trailing_zeros(series: DataFrame, value: str = "Actuals", keys: tuple[str, ...] = KEY) -> DataFrame:
    """Without the zeros after a series' last other value (null counts as one); all-zero series stay whole."""
    w = Window.partitionBy(*keys)
    last = F.max(F.when(~F.col(value).eqNullSafe(F.lit(0.0)), F.col("Date"))).over(w)
    return series.withColumn("_last", F.coalesce(last, F.max("Date").over(w))).filter(F.col("Date") <= F.col("_last")).drop("_last")


def prepared_series(demand: DataFrame, settings: Settings) -> DataFrame:
    """Dense series up to the current month, trimmed; gaps are null."""
    cut = demand.filter(F.col("Date") <= F.lit(settings.current_month))
    grid = month_grid(cut, fill=None, max_months=settings.max_months)
    return trim_trailing_zeros(grid) if settings.trim_trailing_zeros else grid


def series_lengths(series: DataFrame, keys: tuple[str, ...] = KEY) -> DataFrame:
    return series.groupBy(*keys).agg(F.count("*").alias("n"), F.max("Date").alias("last_month"))


def long_enough(series: DataFrame, least: int = 12, keys: tuple[str, ...] = KEY) -> tuple[DataFrame, DataFrame]:
    """(rows of series with at least so many months, the other series with a reason)."""
    n = F.count("*").over(Window.partitionBy(*keys))
    marked = series.withColumn("_n", n)
    short = marked.filter(F.col("_n") < least).groupBy(*keys).agg(F.first("_n").alias("n"), F.lit("insufficient data").alias("reason"))
    return marked.filter(F.col("_n") >= least).drop("_n"), short


def train_test_split(series: DataFrame, holdout: int = 6, keys: tuple[str, ...] = KEY) -> DataFrame:
    """series with a column part: the last holdout months are test, the others train."""
    back = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("Date")))
    return series.withColumn("part", F.when(back <= holdout, "test").otherwise("train"))


def fold_cuts(lengths: DataFrame, settings: Settings, horizon: int = 1, n: str = "n") -> DataFrame:
    """Expanding windows: one row per series and fold, with the number of months that train it.

    Cuts run from burn_in to n - horizon; the last max_folds of them count; none if n - horizon <= burn_in.
    """
    last = (F.col(n) - horizon).cast("int")
    first = F.greatest(F.lit(settings.burn_in), last - (settings.max_folds - 1))
    rows = lengths.filter(last > settings.burn_in).withColumn("cut", F.explode(F.sequence(first, last)))
    return rows.withColumn("fold", (F.col("cut") - first + 1).cast("int")).withColumn("horizon", F.lit(horizon))


def as_arrays(series: DataFrame, values: list[str], keys: tuple[str, ...] = KEY) -> DataFrame:
    """One row per series: dates and values as arrays in order. A series is bounded by its months."""
    rows = F.array_sort(F.collect_list(F.struct("Date", *values)))
    return series.groupBy(*keys).agg(rows.alias("_rows")).select(*keys, F.col("_rows.Date").alias("dates"), *[F.col(f"_rows.{v}").alias(v) for v in values])


def window_order(keys: tuple[str, ...] = KEY) -> Window:
    return Window.partitionBy(*keys).orderBy("Date")


def month_number(c: Column) -> Column:
    """Months as integers, so that steps are differences."""
    return F.year(c) * 12 + F.month(c) - 1
