"""External features: pipeline and backlog aggregates, lags, differences, extrapolation and the feature store."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import BACKLOG_FEATURES, FEATURES, KEY, TAIL_WEIGHTS, Settings
from ..functions.columns import clean_key, double_or_null, lag_for, month_start, stripped, zero_number
from ..kept import kept
from .catalog import Catalog
from .counters import Counters, rows_where
from .mapping import map_names, map_products, normalize_units, resolve_names, unit_marks
from .series import month_grid

#: Target column -> source columns, by preference after the configured one.
PIPELINE_SYNONYMS = {
    "Timestamp": ("Timestamp", "CloseDate", "Date"),
    "SF_Product_Name": ("Product", "SF_Product_Name", "Product_Name"),
    "BU": ("Business_Unit_Code", "Business_Unit", "BU", "Business_Unit_Name"),
    "Revenue": ("Revenue", "Weighted_Pipeline_Amount", "Weighted_Pipeline_Dollars"),
    "Quantity": ("Quantity", "Weighted_Pipeline_Quantity"),
    "Open_Opportunities": ("Open_Opportunities",),
    "New_Quotes": ("New_Quotes",),
    "Revenue_new_orders": ("Revenue_new_orders",),
    "Quantity_new_orders": ("Quantity_new_orders",),
}
BACKLOG_SYNONYMS = {"Product": ("product", "product_code", "sku", "item"), "Month": ("month", "date"), "BU": ("bu", "business_unit", "business_unit_code"), "Backlog": ("backlog",)}
#: How many facts a loaded row stands for.
ROWS = "_rows"
_NOT_FEATURES = {"Timestamp", "Date", "SF_Product_Name", "BU", "Product_Group", ROWS}


def rename_pipeline(pipeline: DataFrame, configured: dict[str, str] | None = None) -> DataFrame:
    """Columns under their standard names: the configured source, else the first synonym that is there."""
    renames: dict[str, str] = {}
    for target, sources in PIPELINE_SYNONYMS.items():
        named = (configured or {}).get(target)
        found = next((s for s in ((named,) if named else ()) + sources if s in pipeline.columns and s not in renames), None)
        if found:
            renames[found] = target
    taken = set(renames.values())
    out = pipeline.select(*[c for c in pipeline.columns if c in renames or c not in taken]).withColumnsRenamed({s: t for s, t in renames.items() if s != t})
    if missing := [c for c in ("Timestamp", "SF_Product_Name") if c not in out.columns]:
        raise ValueError(f"pipeline data misses columns: {', '.join(missing)}")
    return out


def rename_backlog(backlog: DataFrame) -> DataFrame:
    """Columns under their standard names, whatever their case; BU is empty if there is none."""
    names = {s: t for t, sources in BACKLOG_SYNONYMS.items() for s in sources}
    out = backlog.toDF(*[names.get(c.strip().lower(), c) for c in backlog.columns])
    if missing := [c for c in ("Product", "Month", "Backlog") if c not in out.columns]:
        raise ValueError(f"backlog data misses columns: {', '.join(missing)}")
    return out if "BU" in out.columns else out.withColumn("BU", F.lit(""))


def as_date(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    if not isinstance(kind, T.StringType):
        return F.col(column).cast("date")
    return F.coalesce(*[F.try_to_timestamp(stripped(F.col(column)), F.lit(f)).cast("date") for f in ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "yyyy-MM", "yyyy/MM/dd", "M/d/yyyy")])


def feature_columns(pipeline: DataFrame) -> list[str]:
    """The known features that are there, and then every other numeric column."""
    known = [c for c in FEATURES if c in pipeline.columns]
    return known + [f.name for f in pipeline.schema if isinstance(f.dataType, T.NumericType) and f.name not in known and f.name not in _NOT_FEATURES]


def load_pipeline(
    pipeline: DataFrame, catalog: Catalog, reference: DataFrame, configured: dict[str, str] | None = None, check_units: bool = True, counters: Counters | None = None
) -> DataFrame:
    """(Product_Group, BU, Date, features, rows): named, dated, mapped to groups and units, with numbers for features.

    Rows without a date, a known group or a unit go; so do units that the group does not list. Facts are
    summed by name, unit and month as they are written, and kept: only those sums, of rows facts each, meet
    the catalog, and the facts are read once for names and sums. counters are told of the facts that are read
    and that go, under pipeline; what meets the catalog is then kept, too.
    """
    renamed = rename_pipeline(pipeline, configured)
    features = feature_columns(renamed)
    dated = renamed.withColumn("Date", month_start(as_date(renamed, "Timestamp")))
    dated = dated if counters else dated.filter("Date is not null")
    sums = [F.coalesce(F.sum(zero_number(F.col(c))), F.lit(0.0)).alias(c) for c in features]
    dated = dated.groupBy("SF_Product_Name", "BU", "Date").agg(*sums, F.count("*").alias(ROWS))
    if counters:
        dated = counters.keep(dated, "pipeline", read=F.sum(ROWS), no_date=rows_where(F.col("Date").isNull(), ROWS)).filter("Date is not null")
    else:
        dated = kept(dated)
    resolved = resolve_names(dated.select(F.col("SF_Product_Name").alias("name")), catalog, reference)
    mapped = normalize_units(map_names(dated, resolved, keep_unmapped=counters is not None), catalog)
    mapped = unit_marks(mapped, catalog.units, "pass") if check_units else mapped.withColumn("_allowed", F.lit(True))
    group, unit, listed = F.col("Product_Group").isNotNull(), F.col("BU").isNotNull(), F.col("_allowed")
    if counters:
        gone = {"no_group": ~group, "no_unit": group & ~unit, "unit_not_listed": group & unit & ~listed, "loaded": group & unit & listed}
        mapped = counters.keep(mapped, "pipeline", **{reason: rows_where(c, ROWS) for reason, c in gone.items()})
    return mapped.filter(group & unit & listed).select("Product_Group", "BU", "Date", *features, ROWS)


def coverage(loaded: DataFrame) -> DataFrame:
    return loaded.agg(F.coalesce(F.sum(ROWS), F.lit(0)).alias("rows"), F.min("Date").alias("first_month"), F.max("Date").alias("last_month"))


def pipeline_monthly(loaded: DataFrame, by_bu: bool = True) -> DataFrame:
    """Sums of all features per group, unit and month."""
    features = feature_columns(loaded)
    unit = F.col("BU") if by_bu else F.lit("")
    return loaded.groupBy("Product_Group", unit.alias("BU"), "Date").agg(*[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in features])


def difference_features(grid: DataFrame, features: list[str], keys: tuple[str, ...] = KEY) -> DataFrame:
    """First differences as further columns, the first month 0."""
    w = Window.partitionBy(*keys).orderBy("Date")
    return grid.withColumns({f"{c}_Diff": F.coalesce(F.col(c) - F.lag(c).over(w), F.lit(0.0)) for c in features})


def apply_lags(grid: DataFrame, lags: DataFrame, features: list[str]) -> DataFrame:
    """Features of a dense grid shifted by the months that the catalog asks for; months before the data are 0.

    lags: (Product_Group, lags), maps from feature to unit to months. Lags differ by row, so the features are
    unpivoted, moved by their months and joined back to the grid, side by side with it on the same key.
    """
    if not features:
        return grid
    spec = grid.join(lags.select("Product_Group", "lags"), "Product_Group", "left")
    long = spec.select(*KEY, "Date", F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("value"), F.greatest(lag_for(F.try_element_at("lags", F.lit(c)), F.col("BU")), F.lit(0)).alias("lag")) for c in features])).alias("x"))
    moved = long.select(*KEY, F.add_months("Date", F.col("x.lag")).alias("Date"), "x.feature", "x.value")
    wide = moved.groupBy(*KEY, "Date").agg(*[F.max(F.when(F.col("feature") == c, F.col("value"))).alias(c) for c in features])
    return grid.drop(*features).join(wide, [*KEY, "Date"], "left").fillna(0.0, features).select(*grid.columns)


def pipeline_features(monthly: DataFrame, lags: DataFrame, settings: Settings) -> DataFrame:
    """The dense pipeline features up to the current month or the last month of data, differenced and lagged."""
    features = feature_columns(monthly)
    grid = month_grid(monthly, end=settings.current_month, max_months=settings.max_months)
    grid = difference_features(grid, features) if settings.difference_features else grid
    return apply_lags(grid, lags, features)


def backlog_monthly(backlog: DataFrame, skus: DataFrame, by_bu: bool = True, counters: Counters | None = None) -> DataFrame:
    """(Product_Group, BU, Date, Backlog) by normalised product code; blank units go if series are by unit.

    counters are told of the facts that are read and that go, under backlog.
    """
    renamed = rename_backlog(backlog)
    rows = renamed.select("Product", clean_key(F.col("BU")).alias("BU"), month_start(as_date(renamed, "Month")).alias("Date"), zero_number(F.col("Backlog")).alias("Backlog"))
    dated, known = F.col("Date").isNotNull(), F.col("BU") != "" if by_bu else F.lit(True)
    rows = rows if by_bu else rows.withColumn("BU", F.lit(""))
    rows = rows if counters else rows.filter(dated & known)
    if not counters:
        return map_products(rows, skus, "normalized").groupBy(*KEY, "Date").agg(F.sum("Backlog").alias("Backlog"))
    rows = map_products(rows, skus, "normalized", keep_unmapped=True, once="_once")
    sums = rows.groupBy(*KEY, "Date").agg(F.sum("Backlog").alias("Backlog"), F.count_if("_once").alias(ROWS))
    group = F.col("Product_Group").isNotNull()
    gone = {"no_date": ~dated, "no_unit": dated & ~known, "no_group": dated & known & ~group}
    sums = counters.keep(sums, "backlog", read=F.sum(ROWS), **{reason: rows_where(c, ROWS) for reason, c in gone.items()}).filter(dated & known & group)
    return sums.groupBy(*KEY, "Date").agg(F.sum("Backlog").alias("Backlog"))


def backlog_features(monthly: DataFrame, current_month: date, horizon: int, max_months: int = 1200) -> DataFrame:
    """Backlog up to the end of the horizon (0 after its last month), its lags 1 and 3, and its 3-month mean."""
    end = date(current_month.year + (current_month.month - 1 + horizon) // 12, (current_month.month - 1 + horizon) % 12 + 1, 1)
    grid = month_grid(monthly, end=end, only_end=True, max_months=max_months)
    w = Window.partitionBy(*KEY).orderBy("Date")
    return grid.withColumns({"Backlog_Lag1": F.lag("Backlog", 1, 0.0).over(w), "Backlog_Lag3": F.lag("Backlog", 3, 0.0).over(w), "Backlog_MA3": F.avg("Backlog").over(w.rowsBetween(-2, 0))})


def feature_store(pipeline: DataFrame | None, backlog: DataFrame | None) -> DataFrame:
    """(Date, Product_Group, BU, sf_*, backlog_*): both sources side by side, 0 where one has no row."""
    keys = ["Date", *KEY]
    named = [df.select(*keys, *[F.col(c).cast("double").alias(prefix + c) for c in df.columns if c not in keys]) for df, prefix in ((pipeline, "sf_"), (backlog, "backlog_")) if df is not None]
    return reduce(lambda a, b: a.join(b, keys, "full_outer"), named).fillna(0.0)


def select_mode(store: DataFrame, modes: DataFrame, settings: Settings) -> DataFrame:
    """The store's pipeline columns by the group's mode, in three columns whose names tell the choice.

    (Date, Product_Group, BU, mode, features: array<struct<feature, value>>); a mode without a set uses the
    default one, and columns that the store misses are 0.
    """
    sets = settings.feature_sets
    pick = lambda names: F.array(*[F.struct(F.lit(n).alias("feature"), (F.col(f"sf_{n}") if f"sf_{n}" in store.columns else F.lit(0.0)).alias("value")) for n in names])
    out = store.join(modes.select("Product_Group", "mode"), "Product_Group", "left").withColumn("mode", F.coalesce("mode", F.lit("quantity")))
    chosen = pick(sets["default"])
    for mode, names in sets.items():
        chosen = F.when(F.col("mode") == mode, pick(names)).otherwise(chosen)
    return out.select("Date", *KEY, "mode", chosen.alias("features"))


def select_backlog(store: DataFrame, wanted: tuple[str, ...] = BACKLOG_FEATURES) -> DataFrame:
    return store.select("Date", *KEY, *[(F.col(f"backlog_{c}") if f"backlog_{c}" in store.columns else F.lit(0.0)).alias(c) for c in wanted])


def slice_store(store: DataFrame, spans: DataFrame) -> DataFrame:
    """The store's rows within each series' months, every month of the span present and 0 where it has no row.

    spans: (Product_Group, BU, first_month, last_month). Series whose values are all (nearly) 0 have no rows.
    """
    values = sorted(c for c in store.columns if c not in ("Date", *KEY))
    grid = spans.select(*KEY, F.explode(F.sequence("first_month", "last_month", F.expr("interval 1 month"))).alias("Date"))
    rows = grid.join(store.select("Date", *KEY, *values), ["Date", *KEY], "left").fillna(0.0, values)
    size = reduce(Column.__add__, [F.abs(c) for c in values])
    return rows.withColumn("_size", F.sum(size).over(Window.partitionBy(*KEY))).filter("_size > 1e-8").select("Date", *KEY, *values)


def tail_coefficients(horizon: int, weights: tuple[float, ...] = TAIL_WEIGHTS) -> list[list[float]]:
    """Per month ahead, the weights of the last six known months that the recursion comes to."""
    n = len(weights)
    rows = [[float(i == j) for j in range(n)] for i in range(n)]
    for _ in range(horizon):
        rows.append([sum(w * r[j] for w, r in zip(weights, rows[-n:], strict=True)) for j in range(n)])
    return rows[n:]


def extrapolate(features: DataFrame, horizon: int, columns: list[str] | None = None, start: date | None = None) -> DataFrame:
    """(Product_Group, BU, Date, step, columns) for horizon months after each series' own last month (before start,
    if given, from which on the months then count).

    Each month is the weighted mean of the six before it, extrapolated ones included. That recursion is
    linear, so each step is one weighted sum of the last six known months. Series with fewer have no rows.
    """
    columns = columns or [c for c in features.columns if c not in ("Date", *KEY)]
    known = features if start is None else features.filter(F.col("Date") < F.lit(start))
    n = len(TAIL_WEIGHTS)
    recent = known.withColumn("_back", F.row_number().over(Window.partitionBy(*KEY).orderBy(F.desc("Date")))).filter(F.col("_back") <= n)
    tail = recent.groupBy(*KEY).agg(F.max("Date").alias("_last"), F.count("*").alias("_n"), *[F.transform(F.array_sort(F.collect_list(F.struct("Date", F.col(c).alias("v")))), lambda x: x["v"]).alias(c) for c in columns]).filter(F.col("_n") == n)
    weights = F.array(*[F.struct(F.lit(h + 1).alias("step"), F.array(*map(F.lit, row)).alias("w")) for h, row in enumerate(tail_coefficients(horizon))])
    rows = tail.withColumn("_h", F.explode(weights))
    value = lambda c: F.aggregate(F.zip_with(c, "_h.w", lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x).alias(c)
    day = F.add_months("_last", F.col("_h.step")) if start is None else F.add_months(F.lit(start), F.col("_h.step") - 1)
    return rows.select(*KEY, day.alias("Date"), F.col("_h.step").alias("step"), *[value(c) for c in columns])


def merge_with_actuals(actuals: DataFrame, features: DataFrame) -> DataFrame:
    """Actuals with the features of their month, 0 where there are none."""
    values = [c for c in features.columns if c not in ("Date", *KEY)]
    return actuals.join(features, [*KEY, "Date"], "left").fillna(0.0, values)


def prefer_future(history: DataFrame, future: DataFrame) -> DataFrame:
    """Rows of both; of one series' month the future's row counts."""
    both = history.withColumn("_f", F.lit(0)).unionByName(future.select(*history.columns).withColumn("_f", F.lit(1)))
    first = Window.partitionBy(*KEY, "Date").orderBy(F.desc("_f"))
    return both.withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n", "_f")


def last_per_date(rows: DataFrame, order: str, keys: tuple[str, ...] = KEY) -> DataFrame:
    """Of several rows of a series on one date, the last by order; for input that is not summed yet."""
    values = [c for c in rows.columns if c not in ("Date", *keys)]
    last = rows.groupBy(*keys, "Date").agg(F.max_by(F.struct(*values), order).alias("_last"))
    return last.select(*keys, "Date", "_last.*")


def log_features(backlog: DataFrame) -> DataFrame:
    """(Product, BU, Date, backlog_standardized, raw_data, log_raw_data); rows without any value go."""
    raw, standard = double_or_null(F.col("raw_data")), double_or_null(F.col("Backlog"))
    out = backlog.select("Product", "BU", "Date", raw.alias("raw_data"), F.when(raw > 0, F.log(raw)).alias("log_raw_data"), standard.alias("backlog_standardized"))
    return out.dropna(how="all", subset=["raw_data", "log_raw_data", "backlog_standardized"])
