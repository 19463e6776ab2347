"""The registered queries over the star schema, each with SQL of its own for the same rows where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import FEATURES, KEY, Settings
from ..functions.columns import clipped, currency_number, lag_for, normalize_code, parse_month, series_label, two_digits, zero_number
from ..kept import kept
from ..operators import diagnostics, features, mapping, metrics, series
from ..operators.catalog import Catalog, parse_catalog
from ..sources import star_schema as star
from .forecast import compare_scenarios, forecast_run
from .lag_sweep import lag_sweep
from .prepared import prepared_dataset
from .selection import best_candidate, candidates, order_selection, shortlist

SETTINGS = Settings(current_month=date.fromisoformat(star.CURRENT_MONTH))
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with the body of its SQL."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = f"WITH {star.SQL_VIEWS.strip()}\n{sql}"
        return f

    return add


def _catalog_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Kept, as each lookup reads it; few rows of long lists, dealt round so that they are split side by side."""
    return kept(star.catalog(spark, folder).repartition(spark.sparkContext.defaultParallelism))


def _catalog(spark: SparkSession, folder: str) -> Catalog:
    return parse_catalog(_catalog_rows(spark, folder))


def _demand(spark: SparkSession, folder: str, read: Catalog | None = None) -> DataFrame:
    return series.monthly_demand(series.clean_actuals(star.actuals(spark, folder)), (read or _catalog(spark, folder)).skus)


def _dense(spark: SparkSession, folder: str) -> DataFrame:
    return series.month_grid(_demand(spark, folder))


def _pipe(spark: SparkSession, folder: str, read: Catalog | None = None) -> DataFrame:
    return features.pipeline_monthly(features.load_pipeline(star.pipeline(spark, folder), read or _catalog(spark, folder), star.reference(spark, folder)))


def _pipe_features(spark: SparkSession, folder: str, settings: Settings = SETTINGS, read: Catalog | None = None) -> DataFrame:
    read = read or _catalog(spark, folder)
    return features.pipeline_features(_pipe(spark, folder, read), read.groups, settings)


def _backlog(spark: SparkSession, folder: str, read: Catalog | None = None) -> DataFrame:
    monthly = features.backlog_monthly(star.backlog(spark, folder), (read or _catalog(spark, folder)).skus)
    return features.backlog_features(monthly, SETTINGS.current_month, SETTINGS.horizon)


def _store(spark: SparkSession, folder: str, read: Catalog | None = None) -> DataFrame:
    read = read or _catalog(spark, folder)
    grid = series.month_grid(_pipe(spark, folder, read), end=SETTINGS.current_month)
    return features.feature_store(grid, _backlog(spark, folder, read))


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Sums of doubles depend on their order in the last digits."""
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


_SUMS = ", ".join(f"round({c}, 2) AS {c}" for c in FEATURES)
_NAMES = "grp AS Product_Group, bu AS BU, d AS Date"


@query(f"SELECT {_NAMES}, v AS Actuals FROM demand")
def monthly_demand(spark: SparkSession, folder: str) -> DataFrame:
    return _demand(spark, folder)


@query("""SELECT grp AS Product_Group, coalesce(bu, '') AS BU, d AS Date, sum(v) AS Actuals, grouping(bu) = 0 AS by_bu
FROM demand GROUP BY GROUPING SETS ((grp, bu, d), (grp, d))""")
def monthly_demand_rollup_levels(spark: SparkSession, folder: str) -> DataFrame:
    return series.demand_levels(series.clean_actuals(star.actuals(spark, folder)), _catalog(spark, folder).skus)


@query(f"SELECT {_NAMES}, v AS Actuals FROM dense")
def dense_month_grid(spark: SparkSession, folder: str) -> DataFrame:
    return _dense(spark, folder)


@query(f"""SELECT {_NAMES}, v AS Actuals FROM (
  SELECT *, max(d) FILTER (v <> 0) OVER (PARTITION BY grp, bu) AS last FROM dense WHERE d <= DATE '2001-06-01') WHERE d <= coalesce(last, d)""")
def trim_trailing_zeros(spark: SparkSession, folder: str) -> DataFrame:
    return series.trim_trailing_zeros(_dense(spark, folder).filter(F.col("Date") <= F.lit(SETTINGS.current_month)))


@query("SELECT grp AS Product_Group, count(*) AS lines, count(DISTINCT part) AS products, sum(actuals) AS Actuals FROM v_actuals JOIN part_groups USING (part) GROUP BY grp")
def sku_group_fanout(spark: SparkSession, folder: str) -> DataFrame:
    rows = mapping.map_products(star.actuals(spark, folder), _catalog(spark, folder).skus)
    return rows.groupBy("Product_Group").agg(F.count("*").alias("lines"), F.count_distinct(normalize_code(F.col("Product"))).alias("products"), F.sum("Actuals").alias("Actuals"))


@query("""SELECT grp AS Product_Group, count(*) AS lines, sum(actuals) AS Actuals FROM v_actuals LEFT JOIN first_groups USING (part) GROUP BY grp""")
def sku_group_first_wins(spark: SparkSession, folder: str) -> DataFrame:
    rows = mapping.map_products(star.actuals(spark, folder), _catalog(spark, folder).first_skus, keep_unmapped=True)
    return rows.groupBy("Product_Group").agg(F.count("*").alias("lines"), F.sum("Actuals").alias("Actuals"))


@query("SELECT grp AS Product_Group, 'Prod_' || part AS sku FROM part_groups")
def catalog_explode(spark: SparkSession, folder: str) -> DataFrame:
    return _catalog(spark, folder).skus


@query("""SELECT number, coalesce(CASE number % 4 WHEN 0 THEN 2 WHEN 1 THEN CASE WHEN code = 'EU' THEN 3 ELSE 1 END WHEN 2 THEN 3 ELSE 0 END, 0) AS quantity_lag,
  CASE WHEN number % 2 = 0 THEN 2 WHEN code = 'AS' THEN 1 ELSE 0 END AS revenue_lag, code AS BU FROM groups, units WHERE kind = 'brand'""")
def lag_spec_lookup(spark: SparkSession, folder: str) -> DataFrame:
    read = _catalog(spark, folder)
    number = F.regexp_extract("Product_Group", r"#(\d+)", 1).try_cast("int")
    rows = read.groups.join(read.units, "Product_Group").filter("Product_Group <> 'Bundle'")
    lag = lambda f: lag_for(F.try_element_at("lags", F.lit(f)), F.col("BU"))
    return rows.select(number.alias("number"), lag("Quantity").alias("quantity_lag"), lag("Revenue").alias("revenue_lag"), "BU")


@query("SELECT part::VARCHAR AS code, count(*) AS lines FROM v_actuals GROUP BY part")
def normalize_product_code(spark: SparkSession, folder: str) -> DataFrame:
    return star.actuals(spark, folder).groupBy(normalize_code(F.col("Product")).alias("code")).agg(F.count("*").alias("lines"))


@query("""SELECT date_trunc('month', o_orderdate)::DATE AS Date, count(*) AS orders FROM orders GROUP BY 1""")
def excel_month_parse(spark: SparkSession, folder: str) -> DataFrame:
    """Order dates written as serial days, ISO dates and months, in turn."""
    day = F.col("o_orderdate").cast("date")
    serial = F.datediff(day, F.lit("1899-12-30").cast("date")).cast("string")
    text = F.when(F.col("o_orderkey") % 3 == 0, serial).when(F.col("o_orderkey") % 3 == 1, day.cast("string")).otherwise(F.date_format(day, "yyyy-MM"))
    rows = star.table(spark, folder, "orders").select(series.month_start(parse_month(text)).alias("Date"))
    return rows.groupBy("Date").agg(F.count("*").alias("orders"))


@query("""SELECT l_linestatus, round(sum(CASE WHEN l_linenumber % 4 = 3 THEN 0 ELSE l_extendedprice END), 2) AS zero_filled,
  count(*) FILTER (l_linenumber % 4 <> 3) AS numbers, round(sum(CASE WHEN l_linenumber % 4 <> 3 THEN l_quantity END), 2) AS currency FROM lineitem GROUP BY l_linestatus""")
def numeric_coercion(spark: SparkSession, folder: str) -> DataFrame:
    """Numbers written plainly, with currency signs, and as text that is none."""
    bad = F.col("l_linenumber") % 4 == 3
    plain = F.when(bad, "nan").otherwise(F.col("l_extendedprice").cast("string"))
    money = F.when(bad, "None").otherwise(F.concat(F.lit(" $"), F.format_number("l_quantity", 2), F.lit(" ")))
    rows = star.table(spark, folder, "lineitem").select("l_linestatus", zero_number(plain).alias("a"), currency_number(money).alias("b"))
    return rows.groupBy("l_linestatus").agg(F.round(F.sum("a"), 2).alias("zero_filled"), F.count("b").alias("numbers"), F.round(F.sum("b"), 2).alias("currency"))


@query("SELECT bu AS BU, count(*) AS lines FROM v_pipeline GROUP BY bu")
def bu_normalize(spark: SparkSession, folder: str) -> DataFrame:
    return mapping.normalize_units(star.pipeline(spark, folder), _catalog(spark, folder)).groupBy("BU").agg(F.count("*").alias("lines"))


@query("SELECT DISTINCT trim(name) AS name, grp AS Product_Group FROM mapped")
def name_cascade(spark: SparkSession, folder: str) -> DataFrame:
    return mapping.resolve_names(star.pipeline(spark, folder).select(F.col("SF_Product_Name").alias("name")), _catalog(spark, folder), star.reference(spark, folder))


@query("SELECT DISTINCT trim(name) AS name FROM mapped WHERE grp IS NULL")
def unmapped_names(spark: SparkSession, folder: str) -> DataFrame:
    return mapping.unmapped_names(name_cascade(spark, folder))


@query("""SELECT p AS policy, grp AS Product_Group, bu AS BU, count(*) AS lines FROM v_actuals JOIN part_groups USING (part), (VALUES ('pass'), ('drop')) policies(p)
WHERE bu <> 'AF' AND grp <> 'Bundle' OR (grp = 'Bundle' AND p = 'pass') GROUP BY ALL""")
def bu_validity(spark: SparkSession, folder: str) -> DataFrame:
    """With one unit taken off the lists, and one group without a list."""
    read = _catalog(spark, folder)
    rows = mapping.map_products(star.actuals(spark, folder), read.skus)
    units = read.units.filter("BU <> 'AF' and Product_Group <> 'Bundle'")
    kept = [mapping.valid_units(rows, units, p).withColumn("policy", F.lit(p)) for p in ("pass", "drop")]
    return kept[0].unionByName(kept[1]).groupBy("policy", "Product_Group", "BU").agg(F.count("*").alias("lines"))


@query(f"SELECT {_NAMES}, {_SUMS} FROM pipe")
def pipeline_monthly(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_pipe(spark, folder), 2)


@query("SELECT count(*) AS rows, min(d) AS first_month, max(d) AS last_month FROM mapped WHERE grp IS NOT NULL")
def pipeline_coverage(spark: SparkSession, folder: str) -> DataFrame:
    return features.coverage(features.load_pipeline(star.pipeline(spark, folder), _catalog(spark, folder), star.reference(spark, folder)))


@query(f"""SELECT {_NAMES.replace("grp", "g.grp").replace("bu AS", "g.bu AS").replace("d AS", "g.d AS")}, round(coalesce(q.Quantity, 0), 2) AS Quantity, round(coalesce(r.Revenue, 0), 2) AS Revenue
FROM (SELECT p.*, CASE WHEN number % 4 = 0 THEN 2 WHEN number % 4 = 1 AND bu = 'EU' THEN 3 WHEN number % 4 = 1 THEN 1 WHEN number % 4 = 2 THEN 3 ELSE 0 END AS lq,
  CASE WHEN number % 2 = 0 THEN 2 WHEN number % 2 = 1 AND bu = 'AS' THEN 1 ELSE 0 END AS lr FROM pipe_grid p JOIN groups USING (grp)) g
LEFT JOIN pipe_grid q ON g.grp = q.grp AND g.bu = q.bu AND q.d = g.d - to_months(lq) LEFT JOIN pipe_grid r ON g.grp = r.grp AND g.bu = r.bu AND r.d = g.d - to_months(lr)""")
def pipeline_configured_lag(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_pipe_features(spark, folder).select(*KEY, "Date", "Quantity", "Revenue"), 2)


@query(f"""SELECT {_NAMES}, round(coalesce(Quantity - lag(Quantity) OVER w, 0), 2) AS Quantity_Diff, round(coalesce(Revenue - lag(Revenue) OVER w, 0), 2) AS Revenue_Diff
FROM pipe_grid WINDOW w AS (PARTITION BY grp, bu ORDER BY d)""")
def pipeline_diff(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_pipe_features(spark, folder, replace(SETTINGS, difference_features=True)).select(*KEY, "Date", "Quantity_Diff", "Revenue_Diff"), 2)


@query(f"SELECT {_NAMES}, Backlog, Backlog_Lag1, Backlog_Lag3, round(Backlog_MA3, 6) AS Backlog_MA3 FROM backlog_feat")
def backlog_features(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_backlog(spark, folder))


_STORE_COLUMNS = ", ".join(f"round(coalesce({c}, 0), 2) AS sf_{c}" for c in FEATURES) + ", " + ", ".join(f"round(coalesce({c}, 0), 2) AS backlog_{c}" for c in ("Backlog", "Backlog_Lag1", "Backlog_Lag3", "Backlog_MA3"))


@query(f"""SELECT d AS Date, grp AS Product_Group, bu AS BU, {_STORE_COLUMNS} FROM pipe_grid FULL JOIN backlog_feat USING (grp, bu, d)""")
def feature_store(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_store(spark, folder), 2)


@query("""SELECT g.d AS Date, g.grp AS Product_Group, g.bu AS BU, round(coalesce(Revenue, 0), 2) AS sf_Revenue, round(coalesce(Backlog, 0), 2) AS backlog_Backlog
FROM (SELECT grp, bu, unnest(range(DATE '2000-07-01', DATE '2001-08-01', INTERVAL 1 MONTH))::DATE AS d FROM (SELECT DISTINCT grp, bu FROM demand)) g
LEFT JOIN (SELECT * FROM pipe_grid FULL JOIN backlog_feat USING (grp, bu, d)) s ON g.grp = s.grp AND g.bu = s.bu AND g.d = s.d
QUALIFY sum(coalesce(abs(Revenue), 0) + coalesce(abs(Backlog), 0)) OVER (PARTITION BY g.grp, g.bu) > 1e-8""")
def feature_slice(spark: SparkSession, folder: str) -> DataFrame:
    read = _catalog(spark, folder)
    spans = _demand(spark, folder, read).select(*KEY).distinct().select(*KEY, F.lit(date(2000, 7, 1)).alias("first_month"), F.lit(date(2001, 7, 1)).alias("last_month"))
    return _rounded(features.slice_store(_store(spark, folder, read).select("Date", *KEY, "sf_Revenue", "backlog_Backlog"), spans), 2)


@query("""SELECT d AS Date, grp AS Product_Group, bu AS BU, mode, f.feature, round(f.value, 2) AS value FROM (
  SELECT d, p.grp, bu, mode, unnest(CASE WHEN mode = 'dollars' THEN [{'feature': 'Revenue', 'value': Revenue}, {'feature': 'New_Quotes', 'value': New_Quotes}, {'feature': 'Revenue_new_orders', 'value': Revenue_new_orders}]
  ELSE [{'feature': 'Quantity', 'value': Quantity}, {'feature': 'New_Quotes', 'value': New_Quotes}, {'feature': 'Quantity_new_orders', 'value': Quantity_new_orders}] END) AS f FROM pipe_grid p JOIN groups USING (grp))""")
def feature_mode_select(spark: SparkSession, folder: str) -> DataFrame:
    store = features.feature_store(series.month_grid(_pipe(spark, folder), end=SETTINGS.current_month), None)
    out = features.select_mode(store, _catalog(spark, folder).groups, SETTINGS)
    return _rounded(out.select("Date", *KEY, "mode", F.explode("features").alias("f")).select("Date", *KEY, "mode", "f.feature", "f.value"), 2)


@query("""SELECT Product_Group, BU, Date, step, round(q[6 + step] + 1e-9, 4) AS Quantity FROM (
  WITH RECURSIVE tail AS (
    SELECT grp, bu, list(Quantity ORDER BY d) AS q, max(d) AS last FROM (SELECT *, row_number() OVER (PARTITION BY grp, bu ORDER BY d DESC) AS back FROM pipe_grid) WHERE back <= 6 GROUP BY grp, bu HAVING count(*) = 6),
  steps AS (
    SELECT grp, bu, last, q, 0 AS step FROM tail
    UNION ALL SELECT grp, bu, last, list_append(q, 0.10 * q[step + 1] + 0.10 * q[step + 2] + 0.15 * q[step + 3] + 0.15 * q[step + 4] + 0.25 * q[step + 5] + 0.25 * q[step + 6]), step + 1 FROM steps WHERE step < 12)
  SELECT grp AS Product_Group, bu AS BU, (last + to_months(step))::DATE AS Date, step, q FROM steps WHERE step > 0)""")
def future_extrapolation(spark: SparkSession, folder: str) -> DataFrame:
    grid = series.month_grid(_pipe(spark, folder), end=SETTINGS.current_month)
    return features.extrapolate(grid, SETTINGS.horizon, ["Quantity"]).withColumn("Quantity", F.round(F.col("Quantity") + 1e-9, 4))


def _prepared(spark: SparkSession, folder: str) -> DataFrame:
    """Pipeline rows with units as codes, as the dataset takes no other form."""
    rows = _catalog_rows(spark, folder)
    pipe = mapping.normalize_units(star.pipeline(spark, folder), parse_catalog(rows)).withColumn("Timestamp", F.trunc(F.col("Timestamp").cast("date"), "MM"))
    return prepared_dataset(star.actuals(spark, folder), pipe, rows, star.reference(spark, folder))[0]


_PREPARED = f"""prepared AS (
  SELECT p.grp, p.bu, p.d, {", ".join(f"sum({c}) AS {c}" for c in FEATURES)}, any_value(q.v) AS Actual_Quantity
  FROM (SELECT r.p_brand AS grp, v.* EXCLUDE (p_brand, r_name) FROM v_pipeline v JOIN v_reference r ON v.name = r.p_name) p
  LEFT JOIN (SELECT coalesce(max(CASE WHEN part % 50 = 0 THEN 'Bundle' END), any_value(p_brand)) AS grp, bu, d, sum(actuals) AS v
             FROM (SELECT CASE WHEN l_part % 50 = 0 THEN 'Bundle' ELSE p_brand END AS p_brand, l_part AS part, bu, d, actuals
                   FROM (SELECT part AS l_part, bu, d, actuals FROM v_actuals WHERE part % 3 = 1) JOIN part ON l_part = p_partkey) GROUP BY p_brand, bu, d) q
  ON p.grp = q.grp AND p.bu = q.bu AND p.d = q.d GROUP BY p.grp, p.bu, p.d)"""


def _with_prepared(sql: str) -> str:
    return f"SELECT * FROM (WITH {_PREPARED} {sql})"


@query(_with_prepared(f"SELECT {_NAMES}, {_SUMS}, Actual_Quantity FROM prepared"))
def prepared_dataset_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_prepared(spark, folder), 2)


@query(f"SELECT {_NAMES}, v AS Actuals, CASE WHEN n - rn < 6 THEN 'test' ELSE 'train' END AS part FROM numbered")
def train_test_split(spark: SparkSession, folder: str) -> DataFrame:
    return series.train_test_split(_dense(spark, folder), SETTINGS.holdout)


@query("""SELECT grp AS Product_Group, bu AS BU, h AS horizon, cut, cut - greatest(24, n - h - 5) + 1 AS fold FROM (
  SELECT grp, bu, n, h, unnest(range(greatest(24, n - h - 5), n - h + 1)) AS cut FROM (SELECT grp, bu, count(*) AS n FROM dense GROUP BY ALL), (VALUES (1), (3)) hs(h) WHERE n - h > 24)""")
def cv_folds(spark: SparkSession, folder: str) -> DataFrame:
    lengths = series.series_lengths(_dense(spark, folder))
    both = series.fold_cuts(lengths, SETTINGS, 1).unionByName(series.fold_cuts(lengths, SETTINGS, 3))
    return both.select(*KEY, "horizon", "cut", "fold")


_LENGTHS = "(SELECT grp, bu, count(*) AS n FROM (SELECT *, max(d) FILTER (v <> 0) OVER (PARTITION BY grp, bu) AS last FROM dense WHERE d <= DATE '2001-06-01') WHERE d <= coalesce(last, d) GROUP BY ALL)"


@query(f"""SELECT l.grp AS Product_Group, bu AS BU, n, CASE WHEN usable AND n >= 36 THEN 'SARIMA' WHEN n BETWEEN 12 AND 35 THEN 'ARIMA' WHEN NOT usable THEN 'ARIMA' WHEN n >= 36 THEN 'SARIMA' WHEN n >= 12 THEN 'ARIMA' ELSE 'SARIMA' END AS strategy
FROM {_LENGTHS} l JOIN groups USING (grp)""")
def strategy_choice(spark: SparkSession, folder: str) -> DataFrame:
    trimmed = trim_trailing_zeros(spark, folder)
    lengths = series.series_lengths(trimmed).join(_catalog(spark, folder).groups.select("Product_Group", "order"), "Product_Group")
    return metrics.choose_strategy(lengths, SETTINGS, metrics.usable_order()).select(*KEY, "n", "strategy")


@query("SELECT grp AS Product_Group, bu AS BU, count(*) AS n, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std, coalesce(avg(v) <= 0 OR stddev_samp(v) / avg(v) >= 0.5, false) AS is_volatile FROM dense GROUP BY ALL")
def volatility_class(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(metrics.volatility_class(_dense(spark, folder)))


@query("""SELECT grp AS Product_Group, bu AS BU, n, round(strength, 6) AS strength, coalesce(strength > 0.3, false) AS is_seasonal FROM (
  WITH trended AS (
    SELECT *, (rn - 1) % 12 AS pos, CASE WHEN rn > 6 AND rn <= n - 6 THEN (sum(v) OVER (PARTITION BY grp, bu ORDER BY d ROWS BETWEEN 6 PRECEDING AND 5 FOLLOWING) + sum(v) OVER (PARTITION BY grp, bu ORDER BY d ROWS BETWEEN 5 PRECEDING AND 6 FOLLOWING)) / 24 END AS trend FROM numbered),
  levels AS (SELECT grp, bu, pos, avg(v - trend) AS level FROM trended GROUP BY ALL),
  centred AS (SELECT grp, bu, pos, level - avg(level) OVER (PARTITION BY grp, bu) AS s FROM levels)
  SELECT grp, bu, count(*) AS n, CASE WHEN count(*) >= 24 AND var_pop(v - trend - s) > 0 THEN var_pop(s) / (var_pop(s) + var_pop(v - trend - s)) END AS strength FROM trended JOIN centred USING (grp, bu, pos) GROUP BY grp, bu)""")
def seasonal_strength(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(metrics.seasonal_strength(_dense(spark, folder)))


@query(f"SELECT {_NAMES}, v AS actual, prior AS forecast FROM (SELECT *, lag(v, 12) OVER (PARTITION BY grp, bu ORDER BY d) AS prior FROM numbered) WHERE n - rn < 6")
def seasonal_naive_holdout(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.seasonal_naive(_dense(spark, folder), SETTINGS.holdout)


@query("""SELECT grp AS Product_Group, bu AS BU, round(avg(f - a) / nullif(avg(a), 0) * 100, 4) AS bias_percent, round(sum(abs(f - a)) / nullif(sum(abs(a)), 0) * 100, 4) AS mae_percent,
  round(sqrt(avg((f - a) * (f - a))), 4) AS rmse, round(avg(CASE WHEN a <> 0 THEN abs((f - a) / a) END) * 100, 4) AS mape, round(stddev_pop(a) / nullif(abs(avg(a)), 0) * 100, 4) AS cov
FROM (SELECT grp, bu, CASE WHEN f IS NOT NULL THEN v END AS a, f FROM (SELECT *, lag(v, 12) OVER (PARTITION BY grp, bu ORDER BY d) AS f FROM numbered) WHERE n - rn < 6) GROUP BY ALL""")
def holdout_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(metrics.holdout_metrics(seasonal_naive_holdout(spark, folder)), 4)


@query("""SELECT grp AS Product_Group, bu AS BU, row_number() OVER (PARTITION BY grp, bu ORDER BY preferred, matched DESC, p + d + q + sp + sd + sq, p, d, q, sp, sd, sq) AS candidate, p, d, q, sp AS seas_p, sd AS seas_d, sq AS seas_q FROM (
  SELECT s.*, o.* EXCLUDE (stable_n, volatile_n), t.* EXCLUDE (stable_m, volatile_m), d = sd AS matched,
    CASE WHEN vol THEN coalesce(list_position([(0,1,1), (1,1,0), (1,1,1)], (sp, sd, sq)) * 4 + list_position([(1,1,0), (0,1,1), (1,1,1), (2,1,1)], (p, d, q)), 1000) ELSE 1000 END AS preferred
  FROM (SELECT grp, bu, count(*) AS n, coalesce(avg(v) <= 0 OR stddev_samp(v) / avg(v) >= 0.5, false) AS vol FROM dense GROUP BY ALL) s,
    (VALUES (1,0,0,0,0), (0,0,1,0,0), (1,0,1,0,0), (0,1,0,0,0), (1,1,0,0,0), (0,1,1,0,0), (1,1,1,0,0), (2,0,0,48,32), (0,0,2,48,32), (2,1,0,48,32), (0,1,2,48,32),
            (2,0,1,60,36), (1,0,2,60,36), (2,0,2,60,36), (2,1,1,60,0), (1,1,2,60,0), (2,1,2,60,0)) o(p, d, q, stable_n, volatile_n),
    (VALUES (0,0,0,0,0), (0,1,0,24,24), (1,0,0,24,24), (0,0,1,24,24), (0,1,1,99999,24), (1,0,1,48,48), (1,1,0,99999,48), (1,1,1,48,48)) t(sp, sd, sq, stable_m, volatile_m)
  WHERE n >= CASE WHEN vol THEN greatest(volatile_n, volatile_m) ELSE greatest(stable_n, stable_m) END AND (NOT vol OR d = sd))""")
def candidate_grid(spark: SparkSession, folder: str) -> DataFrame:
    out = candidates(spark, metrics.volatility_class(_dense(spark, folder)))
    return out.select(*KEY, "candidate", "p", "d", "q", "seas_p", "seas_d", "seas_q")


@query("""SELECT grp AS Product_Group, bu AS BU, arg_min(lag, (mae, lag)) AS best_lag, round(min(mae), 6) AS validation_mae, count(*) AS lags_evaluated FROM (
  SELECT grp, bu, k AS lag, avg(abs(v - prior)) AS mae FROM (
    SELECT a.grp, a.bu, a.v, k, b.v AS prior FROM numbered a, (SELECT unnest(range(1, 8)) AS k) JOIN numbered b ON a.grp = b.grp AND a.bu = b.bu AND b.rn = a.rn - k WHERE a.n - a.rn < 6) GROUP BY ALL) GROUP BY ALL""")
def best_lag_rank(spark: SparkSession, folder: str) -> DataFrame:
    """Which of seven lags of a series itself is nearest to its last months."""
    w = series.window_order()
    rows = _dense(spark, folder).withColumns({f"_{k}": F.lag("Actuals", k).over(w) for k in range(1, 8)}).withColumn("_back", F.row_number().over(w.orderBy(F.desc("Date"))))
    errors = F.array(*[F.struct(F.lit(k).alias("lag"), F.abs(F.col("Actuals") - F.col(f"_{k}")).alias("e")) for k in range(1, 8)])
    scores = rows.filter(F.col("_back") <= SETTINGS.holdout).select(*KEY, F.explode(errors).alias("x")).groupBy(*KEY, F.col("x.lag").alias("lag")).agg(F.avg("x.e").alias("mae"))
    return _rounded(metrics.best_lags(scores, KEY))


@query("""SELECT grp AS Product_Group, bu AS BU, lag AS candidate, row_number() OVER (PARTITION BY grp, bu ORDER BY aicc, mae, lag) AS place FROM (
  SELECT grp, bu, any_value(n) AS n, any_value(vol) AS vol, k AS lag, round(any_value(n) * ln(avg((v - prior) * (v - prior)) + 1), 6) AS aicc, arg_max(abs(v - prior), rn) AS mae FROM (
    SELECT a.grp, a.bu, a.n, a.rn, a.v, vol, k, b.v AS prior FROM numbered a JOIN (SELECT grp, bu, coalesce(avg(v) <= 0 OR stddev_samp(v) / avg(v) >= 0.5, false) AS vol FROM dense GROUP BY ALL) c ON a.grp = c.grp AND a.bu = c.bu,
    (SELECT unnest(range(1, 13)) AS k) JOIN numbered b ON a.grp = b.grp AND a.bu = b.bu AND b.rn = a.rn - k) GROUP BY grp, bu, k)
QUALIFY place <= CASE WHEN vol OR n < 48 THEN 5 ELSE 3 END""")
def shortlist_rank(spark: SparkSession, folder: str) -> DataFrame:
    """Twelve naive models, one per lag, ranked as candidates are."""
    w = series.window_order()
    rows = _dense(spark, folder).join(metrics.volatility_class(_dense(spark, folder)).select(*KEY, "n", "is_volatile"), list(KEY))
    rows = rows.withColumns({f"_{k}": F.lag("Actuals", k).over(w) for k in range(1, 13)})
    errors = F.array(*[F.struct(F.lit(k).alias("candidate"), (F.col("Actuals") - F.col(f"_{k}")).alias("e")) for k in range(1, 13)])
    scores = rows.select(*KEY, "n", "is_volatile", "Date", F.explode(errors).alias("x")).filter("x.e is not null").groupBy(*KEY, "n", "is_volatile", F.col("x.candidate").alias("candidate"))
    scores = scores.agg(F.round(F.col("n") * F.log(F.avg(F.col("x.e") * F.col("x.e")) + 1), 6).alias("aicc"), F.max_by(F.abs("x.e"), "Date").alias("last_residual"))
    model = {"complexity": F.col("candidate"), **{c: F.lit(0) for c in ("p", "d", "q", "seas_p", "seas_d", "seas_q")}}
    return shortlist(scores.withColumns(model), SETTINGS).select(*KEY, "candidate", "place")


def _pairs(columns: list[str]) -> list[tuple[str, str]]:
    return [(x, y) for i, x in enumerate(columns) for y in columns[i + 1 :]]


def _corr(x: str, y: str, where: str = "true") -> str:
    ok = f"FILTER ({x} IS NOT NULL AND {y} IS NOT NULL AND {where})"
    return f"CASE WHEN count(*) {ok} >= 2 THEN round(covar_pop({x}, {y}) {ok} / nullif(stddev_pop({x}) {ok} * stddev_pop({y}) {ok}, 0), 6) END"


_USED = ["Revenue", "Quantity", "New_Quotes"]


@query(_with_prepared("SELECT grp AS Product_Group, bu AS BU, x.* FROM (SELECT grp, bu, unnest([" + ", ".join(f"{{'variable_x': '{x}', 'variable_y': '{y}', 'pearson_correlation': {_corr(x, y)}, 'ok': " + " AND ".join(f"count({c}) >= 12" + ("" if c == "Actual_Quantity" else f" AND min({c}) <> max({c})") for c in (x, y)) + "}" for x, y in _pairs([*_USED, "Actual_Quantity"])) + "]) AS x FROM prepared GROUP BY grp, bu) WHERE x.ok").replace("x.* FROM", "x.variable_x, x.variable_y, x.pearson_correlation FROM"))
def pairwise_correlation(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(diagnostics.pairwise_correlations(_prepared(spark, folder), _USED, 12, "Actual_Quantity"))


@query(_with_prepared("SELECT grp AS Product_Group, bu AS BU, " + ", ".join(f"{_corr(x, y, 'Revenue IS NOT NULL AND Quantity IS NOT NULL AND Actual_Quantity IS NOT NULL')} AS corr_{x}__{y}" for x, y in _pairs(["Revenue", "Quantity", "Actual_Quantity"])) + " FROM prepared GROUP BY grp, bu"))
def complete_case_correlation(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(diagnostics.complete_correlations(_prepared(spark, folder), ["Revenue", "Quantity", "Actual_Quantity"], KEY))


@query(_with_prepared("SELECT grp AS Product_Group, bu AS BU, count(Actual_Quantity) AS n_target, " + ", ".join(f"{_corr(x, 'Actual_Quantity')} AS corr_{x}__actuals" for x in _USED) + " FROM prepared GROUP BY grp, bu"))
def target_correlation(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(diagnostics.target_correlations(_prepared(spark, folder), _USED, "Actual_Quantity", KEY))


@query(_with_prepared("SELECT grp AS Product_Group, bu AS BU, variable, count(value) AS series_count, round(avg(value) + 1e-7, 4) AS series_mean, round(stddev_pop(value), 4) AS series_std, round(min(value), 4) AS series_min, round(max(value), 4) AS series_max FROM (UNPIVOT (SELECT grp, bu, d, Revenue, Quantity, New_Quotes FROM prepared) ON Revenue, Quantity, New_Quotes INTO NAME variable VALUE value) GROUP BY grp, bu, variable"))
def feature_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Means of amounts in cents can end in a five, which the order of a sum may move either way."""
    out = diagnostics.feature_summary(_prepared(spark, folder), _USED, KEY)
    return _rounded(out.withColumn("series_mean", F.col("series_mean") + 1e-7), 4)


@query(_with_prepared("SELECT grp AS Product_Group, bu AS BU, variable, count(value) AS n_obs, min(value) = max(value) AS is_constant, count(value) >= 12 AND min(value) <> max(value) AS is_valid FROM (UNPIVOT (SELECT grp, bu, d, Revenue, Quantity, Open_Opportunities FROM prepared) ON Revenue, Quantity, Open_Opportunities INTO NAME variable VALUE value) GROUP BY grp, bu, variable"))
def validity_screen(spark: SparkSession, folder: str) -> DataFrame:
    return diagnostics.valid_columns(_prepared(spark, folder), ["Revenue", "Quantity", "Open_Opportunities"], 12)


@query(_with_prepared("SELECT grp AS Product_Group, bu AS BU, unnest(['Revenue', 'New_Quotes']) AS variable, round(1 / (1 - power(corr(Revenue, New_Quotes), 2)), 4) AS vif, count(*) AS n_obs FROM prepared GROUP BY grp, bu HAVING count(*) >= 12 AND min(New_Quotes) <> max(New_Quotes)"))
def vif_two_features(spark: SparkSession, folder: str) -> DataFrame:
    out = diagnostics.vif_report(_prepared(spark, folder), ["Revenue", "New_Quotes"], 12).filter("vif is not null")
    return _rounded(out.select(*KEY, "variable", "vif", "n_obs"), 4)


@query("""SELECT grp AS Product_Group, bu AS BU, n, round(q, 6) AS statistic, round(exp(-q / 2) * (1 + q / 2 + power(q / 2, 2) / 2 + power(q / 2, 3) / 6 + power(q / 2, 4) / 24 + power(q / 2, 5) / 120), 6) AS p_value FROM (
  SELECT grp, bu, any_value(n) AS n, any_value(n * (n + 2)) * sum(power(s / v, 2) / (n - k)) AS q FROM (
    SELECT a.grp, a.bu, a.n, k, any_value(t.v) AS v, sum(a.x * b.x) AS s FROM (SELECT *, v - avg(v) OVER (PARTITION BY grp, bu) AS x FROM numbered) a, (SELECT unnest(range(1, 13)) AS k)
    JOIN (SELECT *, v - avg(v) OVER (PARTITION BY grp, bu) AS x FROM numbered) b ON a.grp = b.grp AND a.bu = b.bu AND b.rn = a.rn - k
    JOIN (SELECT grp, bu, var_pop(v) * count(*) AS v FROM dense GROUP BY ALL) t ON a.grp = t.grp AND a.bu = t.bu GROUP BY a.grp, a.bu, a.n, k) GROUP BY grp, bu)""")
def ljung_box(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(metrics.ljung_box(_dense(spark, folder).filter("Date is not null"), 12, "Actuals"))


def _run(spark: SparkSession, folder: str) -> tuple[DataFrame, Catalog]:
    read = _catalog(spark, folder)
    return _demand(spark, folder, read), read


@query()
def forecast_report(spark: SparkSession, folder: str) -> DataFrame:
    demand, read = _run(spark, folder)
    used = replace(SETTINGS, use_pipeline=True, use_backlog=True)
    return forecast_run(demand, read.groups, read.unit_names, used, _pipe_features(spark, folder, read=read), _backlog(spark, folder, read))[0]


@query()
def order_selection_report(spark: SparkSession, folder: str) -> DataFrame:
    """Series over brands and units; matching is exact but for blanks, as in the search itself."""
    demand = series.monthly_demand(series.clean_actuals(star.actuals(spark, folder)), _catalog(spark, folder).skus, match="exact")
    return order_selection(series.month_grid(demand), SETTINGS)


@query()
def lag_sweep_report(spark: SparkSession, folder: str) -> DataFrame:
    demand, read = _run(spark, folder)
    store = features.feature_store(_pipe_features(spark, folder, read=read), None)
    chosen = features.select_mode(store, read.groups, SETTINGS).select("Date", *KEY, F.explode("features").alias("f")).select("Date", *KEY, "f.feature", "f.value")
    return lag_sweep(demand, chosen, read.groups, SETTINGS)


@query()
def stationarity_report(spark: SparkSession, folder: str) -> DataFrame:
    return diagnostics.stationarity_report(_prepared(spark, folder), [*FEATURES, "Actual_Quantity"])


@query()
def vif_report(spark: SparkSession, folder: str) -> DataFrame:
    return diagnostics.vif_report(_prepared(spark, folder), list(FEATURES), 12)


@query()
def backlog_diagnostics(spark: SparkSession, folder: str) -> DataFrame:
    """By product group as product."""
    actuals = _demand(spark, folder).withColumnRenamed("Product_Group", "Product")
    return diagnostics.backlog_diagnostics(_backlog_log(spark, folder), actuals)


@query()
def scenario_compare(spark: SparkSession, folder: str) -> DataFrame:
    """History cut six months earlier, with and without features."""
    demand, read = _run(spark, folder)
    past = replace(SETTINGS, current_month=date(2000, 12, 1))
    pipe = features.pipeline_features(_pipe(spark, folder).filter("Date <= date'2000-12-01'"), read.groups, past)
    return compare_scenarios(demand, read.groups, read.unit_names, past, pipe, None)


@query("""SELECT grp AS Product_Group, bu AS BU, s.d AS Date, v AS Actuals, round(coalesce(Revenue, 0), 2) AS Revenue, round(coalesce(Quantity, 0), 2) AS Quantity
FROM demand s LEFT JOIN pipe USING (grp, bu, d)""")
def actuals_with_features(spark: SparkSession, folder: str) -> DataFrame:
    demand, read = _run(spark, folder)
    return _rounded(features.merge_with_actuals(demand, _pipe(spark, folder, read).select(*KEY, "Date", "Revenue", "Quantity")), 2)


@query("""SELECT count(*) AS lines, count(DISTINCT grp) AS groups, count(DISTINCT bu) AS units, count(DISTINCT part) AS products, count(*) FILTER (grp IS NULL) AS unmapped
FROM v_actuals LEFT JOIN part_groups USING (part)""")
def mapping_totals(spark: SparkSession, folder: str) -> DataFrame:
    rows = mapping.map_products(star.actuals(spark, folder), _catalog(spark, folder).skus, keep_unmapped=True)
    return mapping.mapping_totals(rows)


@query("SELECT grp AS Product_Group, bu AS BU, d AS Date, CASE WHEN d >= DATE '2001-01-01' THEN 2 * v ELSE v END AS Actuals FROM demand")
def future_over_history(spark: SparkSession, folder: str) -> DataFrame:
    """History, and a future that begins within it."""
    demand = _demand(spark, folder)
    future = demand.filter("Date >= date'2001-01-01'").withColumn("Actuals", 2 * F.col("Actuals"))
    return features.prefer_future(demand, future)


@query("""SELECT grp AS Product_Group, bu AS BU, d AS Date, round(sum(Revenue), 2) AS Revenue, round(sum(Quantity), 2) AS Quantity, round(sum(2 * Quantity), 2) AS Deal_Size
FROM mapped WHERE grp IS NOT NULL GROUP BY ALL""")
def pipeline_synonyms(spark: SparkSession, folder: str) -> DataFrame:
    """Columns under other names that are known, and one more numeric column, which becomes a feature."""
    rows = star.pipeline(spark, folder).select(
        F.col("Timestamp").alias("CloseDate"),
        F.col("SF_Product_Name").alias("Product_Name"),
        F.col("BU").alias("Business_Unit"),
        F.col("Revenue").alias("Weighted_Pipeline_Amount"),
        F.col("Quantity").alias("Weighted_Pipeline_Quantity"),
        (2 * F.col("Quantity")).alias("Deal_Size"),
    )
    return _rounded(features.pipeline_monthly(features.load_pipeline(rows, _catalog(spark, folder), star.reference(spark, folder))), 2)


@query("""SELECT number::BIGINT AS row_id, grp AS group_key, 'blank columns: sarima_p, sarima_d, sarima_q, seas_p, seas_d, seas_q, sarima_s' AS reason FROM brands WHERE number = 7""")
def catalog_rejections(spark: SparkSession, folder: str) -> DataFrame:
    return _catalog(spark, folder).rejected


@query("SELECT DISTINCT 'month ' || (o_orderkey % 4) AS Month FROM orders WHERE o_orderkey % 50 = 0")
def bad_month_samples(spark: SparkSession, folder: str) -> DataFrame:
    """Order dates of which some are no dates."""
    text = F.when(F.col("o_orderkey") % 50 == 0, F.concat(F.lit("month "), (F.col("o_orderkey") % 4).cast("string"))).otherwise(F.col("o_orderdate").cast("date").cast("string"))
    rows = star.table(spark, folder, "orders").select(F.lit("x").alias("Product"), text.alias("Month"), F.col("o_totalprice").alias("Actuals"))
    return series.bad_months(series.clean_actuals(rows))


@query("SELECT o_orderstatus AS BU, o_orderdate::DATE AS Date, arg_max(o_totalprice, o_orderkey) AS price, arg_max(o_custkey, o_orderkey) AS customer FROM orders GROUP BY ALL")
def last_per_date(spark: SparkSession, folder: str) -> DataFrame:
    rows = star.table(spark, folder, "orders").select(F.col("o_orderstatus").alias("BU"), F.col("o_orderdate").cast("date").alias("Date"), "o_orderkey", F.col("o_totalprice").alias("price"), F.col("o_custkey").alias("customer"))
    return features.last_per_date(rows, "o_orderkey", ("BU",)).select("BU", "Date", "price", "customer")


_BACKLOG_LOG = """backlog_log AS (
  SELECT grp, bu, d, sum(backlog) AS backlog_standardized, sum(raw) AS raw_data, CASE WHEN sum(raw) > 0 THEN ln(sum(raw)) END AS log_raw_data
  FROM v_backlog JOIN part_groups USING (part) GROUP BY ALL)"""


def _backlog_log(spark: SparkSession, folder: str) -> DataFrame:
    """By product group as product, which has months enough for the tests."""
    rows = mapping.map_products(star.backlog(spark, folder), _catalog(spark, folder).skus, "normalized")
    monthly = rows.groupBy(F.col("Product_Group").alias("Product"), "BU", F.col("Month").alias("Date")).agg(F.sum("Backlog").alias("Backlog"), F.sum("raw_data").alias("raw_data"))
    return features.log_features(monthly)


@query(f"SELECT * FROM (WITH {_BACKLOG_LOG} SELECT grp AS Product, bu AS BU, d AS Date, backlog_standardized, round(raw_data, 2) AS raw_data, round(log_raw_data, 6) AS log_raw_data FROM backlog_log)")
def backlog_log_features(spark: SparkSession, folder: str) -> DataFrame:
    out = _backlog_log(spark, folder)
    return out.select("Product", "BU", "Date", "backlog_standardized", F.round("raw_data", 2).alias("raw_data"), F.round("log_raw_data", 6).alias("log_raw_data"))


@query(
    f"""SELECT * FROM (WITH {_BACKLOG_LOG}, both_sides AS (SELECT l.*, q.v AS Actuals FROM backlog_log l LEFT JOIN demand q ON l.grp = q.grp AND l.bu = q.bu AND l.d = q.d)
SELECT grp AS Product, bu AS BU, min(d) AS first_month, max(d) AS last_month, count(Actuals) AS n_target, """
    + ", ".join(f"{_corr(x, y)} AS corr_{x}__{y}" for x, y in _pairs(diagnostics.BACKLOG_COLUMNS))
    + ", "
    + ", ".join(f"{_corr(x, 'Actuals')} AS corr_{x}__actuals" for x in diagnostics.BACKLOG_COLUMNS)
    + " FROM both_sides GROUP BY grp, bu)"
)
def backlog_relations(spark: SparkSession, folder: str) -> DataFrame:
    """The relational columns of the backlog diagnostics: span, correlations of features, and those with actuals."""
    keys = ("Product", "BU")
    data = diagnostics.with_actuals(_backlog_log(spark, folder), _demand(spark, folder).withColumnRenamed("Product_Group", "Product"), keys)
    return _rounded(diagnostics.backlog_relations(data, keys))


@query("""SELECT grp AS Product_Group, bu AS BU, d AS Date, Backlog, Backlog_MA3, 0.0::DOUBLE AS Backlog_Next FROM (SELECT grp, bu, d, Backlog, round(Backlog_MA3, 6) AS Backlog_MA3 FROM backlog_feat)""")
def backlog_column_choice(spark: SparkSession, folder: str) -> DataFrame:
    """Columns of the store by name; one that it does not have is 0."""
    return _rounded(features.select_backlog(features.feature_store(None, _backlog(spark, folder)), ("Backlog", "Backlog_MA3", "Backlog_Next")))


_FOLDS = """folds AS (SELECT grp, bu, n, h, unnest(range(greatest(24, n - h - 5), n - h + 1)) AS cut FROM (SELECT grp, bu, count(*) AS n FROM dense GROUP BY ALL), (VALUES (1), (3)) hs(h) WHERE n - h > 24),
fold_errors AS (
  SELECT f.grp, f.bu, k AS candidate, h, cut, avg(abs(a.v - b.v)) AS mae FROM folds f JOIN numbered a ON a.grp = f.grp AND a.bu = f.bu AND a.rn > cut AND a.rn <= cut + h, (VALUES (3), (6), (12)) ks(k)
  JOIN numbered b ON b.grp = a.grp AND b.bu = a.bu AND b.rn = a.rn - k GROUP BY ALL),
fold_sums AS (
  SELECT grp, bu, candidate, count(*) FILTER (h = 1) AS folds_h1, avg(mae) FILTER (h = 1) AS mean_mae_h1, stddev_pop(mae) FILTER (h = 1) AS mae_std_h1, count(*) FILTER (h = 3) AS folds_h3, avg(mae) FILTER (h = 3) AS mae_h3
  FROM fold_errors GROUP BY grp, bu, candidate)"""


def _naive_folds(spark: SparkSession, folder: str) -> DataFrame:
    """Folds of three naive models, each of which repeats the value some months before."""
    dense, w = _dense(spark, folder), series.window_order()
    rows = dense.withColumns({"_at": F.row_number().over(w), **{f"_{k}": F.lag("Actuals", k).over(w) for k in (3, 6, 12)}})
    lengths = series.series_lengths(dense)
    cuts = series.fold_cuts(lengths, SETTINGS, 1).unionByName(series.fold_cuts(lengths, SETTINGS, 3)).select(*KEY, "horizon", "cut", "fold")
    errors = F.array(*[F.struct(F.lit(k).alias("candidate"), F.abs(F.col("Actuals") - F.col(f"_{k}")).alias("e")) for k in (3, 6, 12)])
    tested = cuts.join(rows, list(KEY)).filter("_at > cut and _at <= cut + horizon").select(*KEY, "horizon", "fold", F.explode(errors).alias("x"))
    return tested.groupBy(*KEY, "horizon", "fold", F.col("x.candidate").alias("candidate")).agg(F.avg("x.e").alias("mae"))


@query(f"""SELECT * FROM (WITH {_FOLDS} SELECT grp AS Product_Group, bu AS BU, candidate, folds_h1, folds_h1 AS ok_h1, round(mean_mae_h1, 6) AS mean_mae_h1, round(mae_std_h1, 6) AS mae_std_h1,
  folds_h3, folds_h3 AS ok_h3, round(mae_h3, 6) AS mae_h3 FROM fold_sums)""")
def fold_statistics(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(metrics.fold_summary(_naive_folds(spark, folder), (*KEY, "candidate")))


@query(f"""SELECT * FROM (WITH {_FOLDS}, classes AS (SELECT grp, bu, coalesce(avg(v) <= 0 OR stddev_samp(v) / avg(v) >= 0.5, false) AS vol FROM dense GROUP BY ALL)
SELECT grp AS Product_Group, bu AS BU, candidate, round(mean_mae_h1, 6) AS mean_mae_h1, round(mae_h3, 6) AS mae_h3 FROM fold_sums JOIN classes USING (grp, bu)
QUALIFY row_number() OVER (PARTITION BY grp, bu ORDER BY round(CASE WHEN vol THEN coalesce(mae_h3, mean_mae_h1) ELSE mean_mae_h1 END, 6), round(0.5 * (mean_mae_h1 + coalesce(mae_h3, mean_mae_h1)), 6), candidate) = 1)""")
def best_candidate_choice(spark: SparkSession, folder: str) -> DataFrame:
    """The best of the naive models by their folds; aicc is the same for all, and complexity is the lag."""
    sums = _rounded(metrics.fold_summary(_naive_folds(spark, folder), (*KEY, "candidate")))
    classes = metrics.volatility_class(_dense(spark, folder)).select(*KEY, "is_volatile")
    tried = sums.join(classes, list(KEY)).withColumns({"aicc": F.lit(0.0), "complexity": F.col("candidate"), "place": F.col("candidate")})
    return best_candidate(tried).select(*KEY, "candidate", "mean_mae_h1", "mae_h3")


_R = {f"r{x}{y}": f"corr({a}, {b})" for x, y, a, b in ((1, 2, "Revenue", "Quantity"), (1, 3, "Revenue", "Revenue_new_orders"), (2, 3, "Quantity", "Revenue_new_orders"))}


@query(
    _with_prepared(
        "SELECT grp AS Product_Group, bu AS BU, x.variable, round(x.vif, 3) AS vif, n AS n_obs FROM (SELECT grp, bu, n, unnest(["
        + ", ".join(f"{{'variable': '{v}', 'vif': (1 - {r} * {r}) / (1 + 2 * r12 * r13 * r23 - r12 * r12 - r13 * r13 - r23 * r23)}}" for v, r in (("Revenue", "r23"), ("Quantity", "r13"), ("Revenue_new_orders", "r12")))
        + "]) AS x FROM (SELECT grp, bu, count(*) AS n, "
        + ", ".join(f"{c} AS {n}" for n, c in _R.items())
        + " FROM prepared GROUP BY grp, bu HAVING count(*) >= 12 AND min(Revenue) <> max(Revenue) AND min(Quantity) <> max(Quantity) AND min(Revenue_new_orders) <> max(Revenue_new_orders)))"
    )
)
def vif_three_features(spark: SparkSession, folder: str) -> DataFrame:
    out = diagnostics.vif_report(_prepared(spark, folder), ["Revenue", "Quantity", "Revenue_new_orders"], 12).filter("vif is not null")
    whole = out.withColumn("_n", F.count("*").over(Window.partitionBy(*KEY))).filter("_n = 3")
    return _rounded(whole.select(*KEY, "variable", "vif", "n_obs"), 3)


@query(f"""SELECT CASE WHEN bu <> '' THEN grp || '__' || bu ELSE grp END AS series_key, name AS BU_Name, d AS Date, greatest(v - 10.0, 0.0)::DOUBLE AS clipped, round_even(v / 7.0, 2)::DOUBLE AS two_digits
FROM demand JOIN units ON code = bu""")
def report_columns(spark: SparkSession, folder: str) -> DataFrame:
    """How reports write a series' name, its unit's name, bounds at zero, and numbers of two digits."""
    rows = _demand(spark, folder).join(_catalog(spark, folder).unit_names, "BU")
    return rows.select(series_label(F.col("Product_Group"), F.col("BU")).alias("series_key"), "BU_Name", "Date", clipped(F.col("Actuals") - 10.0).alias("clipped"), two_digits(F.col("Actuals") / 7.0).alias("two_digits"))
