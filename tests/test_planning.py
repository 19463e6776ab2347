"""Golden rows and properties of the planning operators."""

import math
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.config import CATALOG_COLUMNS, Settings
from tidemark.functions import columns as col
from tidemark.models import arima, smoothing, unit_root
from tidemark.operators import diagnostics, features, mapping, metrics, series
from tidemark.operators.catalog import parse_catalog
from tidemark.plans import selection
from tidemark.plans.forecast import fit_strategy
from tidemark.sources import readers

KEY = "Product_Group string, BU string, Date date"


def month(i, year=2020):
    return date(year + i // 12, i % 12 + 1, 1)


def one_series(spark, values, name="g", bu="EU", column="Actuals"):
    return spark.createDataFrame([(name, bu, month(i), v) for i, v in enumerate(values)], f"{KEY}, {column} double")


def cells(spark, values, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.select(f(F.col("v")).alias("x"), "i").orderBy("i").collect()]


class TestColumns:
    def test_codes(self, spark):
        assert cells(spark, [None, " item_ 12 ", "ITEM12", "PROD__7", "prod7", "_A"], col.normalize_code) == ["", "12", "12", "7", "7", "A"]

    def test_months(self, spark):
        assert cells(spark, ["45292", "2024-01-01", "junk", None, "2024-03", "45292.5"], col.parse_month) == [date(2024, 1, 1), date(2024, 1, 1), None, None, date(2024, 3, 1), date(2024, 1, 1)]

    def test_numbers(self, spark):
        assert cells(spark, [" $1,234.50 ", "", "None", "x", "nan"], col.currency_number) == [1234.5, None, None, None, None]
        assert cells(spark, ["1.5", "nan", "x", None], col.zero_number) == [1.5, 0.0, 0.0, 0.0]

    def test_lists(self, spark):
        assert cells(spark, [" A|B;C", "A;;B", "", None, "A\nB"], col.split_list) == [[" A", "B;C"], ["A", "B"], [], [], ["A", "B"]]
        assert cells(spark, [" A | B "], lambda c: col.split_list(c, trim=True)) == [["A", "B"]]

    def test_lags(self, spark):
        assert cells(spark, ["3", "default:2|ENT:4", "ENT:x|5", "2.9", "", "A:1|A:2"], col.lag_map) == [{"default": 3}, {"default": 2, "ENT": 4}, {"default": 5}, {"default": 2}, {}, {"A": 2}]

    def test_keys(self, spark):
        assert cells(spark, [" Ab ", "nan", None], lambda c: col.clean_key(c, lower=True)) == ["ab", "", ""]


def catalog_rows(spark, rows):
    return spark.createDataFrame(rows, "row_id long, " + ", ".join(f"{c} string" for c in CATALOG_COLUMNS) + ", sf_quantity_lag string")


def row(i, group, skus, codes="EU|AS", names="Europe", order=("1", "1", "1", "0", "1", "1", "12"), lag=None, mode="quantity"):
    return (i, group, skus, codes, names, mode, *order, lag)


@pytest.fixture(scope="module")
def catalog(spark):
    return parse_catalog(
        catalog_rows(
            spark,
            [
                row(1, "G1", "Prod_1|Prod_2", lag="default:2|EU:4"),
                row(2, "G2", "Prod_2|Prod_3", order=("1", "1", "2.9", "0", "0", "0", "12")),
                row(3, "G3", "", order=("1", "1", "1", "0", "1", "1", "12")),
                row(4, "G4", "Prod_9", order=("1", "1", "x", "0", "1", "1", "12")),
                row(5, "G1", "Prod_1|Prod_5", codes="EU|MI", names="Europa|Middle"),
            ],
        )
    )


class TestCatalog:
    def test_rows(self, catalog):
        got = {r.Product_Group: r for r in catalog.groups.collect()}
        assert set(got) == {"G1", "G2"} and got["G1"].skus == ["Prod_1", "Prod_5"] and got["G2"].order.q == 2
        assert {r.group_key: r.reason.split(":")[0] for r in catalog.rejected.collect()} == {"G3": "blank columns", "G4": "invalid order value"}

    def test_lookups(self, catalog):
        assert {r.sku: r.Product_Group for r in catalog.first_skus.collect()} == {"Prod_1": "G1", "Prod_2": "G1", "Prod_3": "G2", "Prod_5": "G1"}
        assert {(r.Product_Group, r.BU) for r in catalog.units.collect()} == {("G1", "EU"), ("G1", "AS"), ("G1", "MI"), ("G2", "EU"), ("G2", "AS")}
        assert {r.BU: r.BU_Name for r in catalog.unit_names.collect()} == {"EU": "Europa", "AS": "AS", "MI": "Middle"}

    def test_units(self, spark, catalog):
        df = spark.createDataFrame([("eu",), ("europa",), ("ZZ",), (" ",), ("zz",), (None,)], "BU string")
        assert sorted(mapping.normalize_units(df, catalog).collect(), key=str) == sorted([("EU",), ("EU",), ("ZZ",), (None,), ("ZZ",), (None,)], key=str)

    def test_names(self, spark, catalog):
        reference = spark.createDataFrame([(1, "Blue Thing", "G1"), (2, "blue thing ", "G2"), (3, "Gone", "G9")], "row_id long, salesforce_product_name string, group_key string")
        names = spark.createDataFrame([("BLUE THING",), ("bluething",), ("g2",), ("Prod_3",), ("item 3",), ("Gone",), (None,)], "name string")
        got = {r.name: r.Product_Group for r in mapping.resolve_names(names, catalog, reference).collect()}
        assert got == {"BLUE THING": "G1", "bluething": "G1", "g2": "G2", "Prod_3": "G2", "item 3": "G2", "Gone": None}

    def test_mapping_keeps_the_total(self, spark, catalog):
        facts = spark.createDataFrame([(" PROD_1 ", 1.0), ("prod_3", 2.0), ("other", 4.0)], "Product string, v double")
        assert mapping.map_products(facts, catalog.skus).agg(F.sum("v")).first()[0] == 3.0
        kept = mapping.map_products(facts, catalog.skus, keep_unmapped=True)
        assert kept.agg(F.sum("v")).first()[0] == 7.0 and mapping.unmapped_count(kept).first()[0] == 1


class TestSeries:
    def test_bad_months(self, spark):
        df = series.clean_actuals(spark.createDataFrame([("a", "junk", "1"), ("a", "45292", "2"), ("a", None, "3")], "Product string, Month string, Actuals string"))
        with pytest.raises(ValueError, match="junk"):
            series.require_months(df)
        assert series.require_months(df.filter("Month <> 'junk'")).count() == 1

    def test_off_grid(self, spark):
        df = spark.createDataFrame([("a", "2024-01-15", 1.0), ("a", "2024-01-01", 2.0)], "Product string, Month string, Actuals double")
        assert [r.Date.day for r in series.clean_actuals(df).collect()] == [1, 1]
        assert series.clean_actuals(df, off_grid="drop").count() == 1

    @pytest.mark.parametrize(("values", "kept"), [([5.0, 0.0, 3.0, 0.0, 0.0], 3), ([0.0, 0.0, 0.0], 3), ([4.0, None, 0.0], 2)])
    def test_trim(self, spark, values, kept):
        assert series.trim_trailing_zeros(one_series(spark, values)).count() == kept

    def test_grid_has_no_gaps(self, spark):
        gaps = one_series(spark, map(float, range(20))).filter("month(Date) not in (3, 4)")
        rows = series.month_grid(gaps, end=date(2022, 1, 1)).orderBy("Date").collect()
        assert [r.Date for r in rows] == [month(i) for i in range(25)] and sum(r.Actuals for r in rows) == gaps.agg(F.sum("Actuals")).first()[0]
        with pytest.raises(Exception, match="spans more than"):
            series.month_grid(gaps, max_months=5).collect()

    @pytest.mark.parametrize(("n", "cuts"), [(25, []), (26, [24, 25]), (40, list(range(34, 40)))])
    def test_folds(self, spark, n, cuts):
        lengths = spark.createDataFrame([("g", "", n)], "Product_Group string, BU string, n int")
        assert sorted(r.cut for r in series.fold_cuts(lengths, Settings()).collect()) == cuts

    def test_split(self, spark):
        rows = series.train_test_split(one_series(spark, [1.0] * 10)).orderBy("Date").collect()
        assert [r.part for r in rows] == ["train"] * 4 + ["test"] * 6


class TestFeatures:
    def test_backlog(self, spark):
        rows = features.backlog_features(one_series(spark, [10.0, 20.0, 30.0, 40.0], column="Backlog"), date(2020, 2, 1), 6).orderBy("Date").collect()
        assert [r.Backlog_Lag1 for r in rows] == [0, 10, 20, 30, 40, 0, 0, 0]
        assert [r.Backlog_Lag3 for r in rows] == [0, 0, 0, 10, 20, 30, 40, 0]
        assert [round(r.Backlog_MA3, 2) for r in rows] == [10, 15, 20, 30, 23.33, 13.33, 0, 0]

    def test_extrapolation(self, spark):
        rows = features.extrapolate(one_series(spark, [10.0] * 4 + [20.0] * 2, column="x"), 12).orderBy("step").collect()
        assert rows[0].x == pytest.approx(15.0) and rows[1].x == pytest.approx(15.25) and rows[0].Date == date(2020, 7, 1)
        tail = [10.0] * 4 + [20.0] * 2
        for _ in range(12):
            tail.append(float(np.dot(tail[-6:], features.TAIL_WEIGHTS)))
        assert [r.x for r in rows] == pytest.approx(tail[6:])
        assert features.extrapolate(one_series(spark, [1.0] * 5, column="x"), 3).count() == 0

    def test_constant_lag_is_lag(self, spark):
        grid = one_series(spark, [float(i * i) for i in range(12)], column="Quantity")
        lags = spark.createDataFrame([("g", {"Quantity": {"default": 3}})], "Product_Group string, lags map<string,map<string,int>>")
        got = [r.Quantity for r in features.apply_lags(grid, lags, ["Quantity"]).orderBy("Date").collect()]
        assert got == [0.0] * 3 + [float(i * i) for i in range(9)]

    def test_renames(self, spark):
        df = spark.createDataFrame([("2024-01-01", "a", "EU", 1.0, "w")], "CloseDate string, Product string, Business_Unit string, Weighted_Pipeline_Amount double, other string")
        assert features.rename_pipeline(df).columns == ["Timestamp", "SF_Product_Name", "BU", "Revenue", "other"]
        with pytest.raises(ValueError, match="Timestamp"):
            features.rename_pipeline(df.drop("CloseDate"))
        assert features.rename_backlog(spark.createDataFrame([("a", "2024-01-01", 1.0)], "SKU string, DATE string, backlog double")).columns == ["Product", "Month", "Backlog", "BU"]

    def test_store_and_slice(self, spark):
        store = features.feature_store(one_series(spark, [1.0, 2.0], column="x"), one_series(spark, [0.0, 5.0, 6.0], column="Backlog"))
        assert [(r.sf_x, r.backlog_Backlog) for r in store.orderBy("Date").collect()] == [(1, 0), (2, 5), (0, 6)]
        spans = spark.createDataFrame([("g", "EU", month(1), month(4)), ("h", "EU", month(1), month(4))], "Product_Group string, BU string, first_month date, last_month date")
        assert [r.backlog_Backlog for r in features.slice_store(store, spans).orderBy("Date").collect()] == [5, 6, 0, 0]

    def test_future_wins(self, spark):
        both = features.prefer_future(one_series(spark, [1.0, 2.0]), one_series(spark, [9.0]))
        assert [r.Actuals for r in both.orderBy("Date").collect()] == [9.0, 2.0]


class TestMetrics:
    def test_golden(self, spark):
        df = spark.createDataFrame([("g", "", a, f) for a, f in ((10.0, 12.0), (0.0, 1.0), (20.0, 16.0), (None, 1.0), (1.0, None))], "Product_Group string, BU string, actual double, forecast double")
        r = metrics.holdout_metrics(df).first()
        assert [round(v, 4) for v in (r.bias_percent, r.mae_percent, r.rmse, r.mape, r.cov)] == [-3.3333, 23.3333, round(math.sqrt(7), 4), 20.0, 81.6497]
        zero = metrics.holdout_metrics(df.filter("actual = 0")).first()
        assert zero.bias_percent is None and zero.mae_percent is None and zero.mape is None and zero.rmse == 1.0

    @pytest.mark.parametrize(("values", "volatile"), [([-1.0, -2.0], True), ([5.0], False), ([1.0, 1.0, 1.0], False), ([1.0, 9.0], True)])
    def test_volatility(self, spark, values, volatile):
        assert metrics.volatility_class(one_series(spark, values)).first().is_volatile is volatile

    def test_strategy(self, spark):
        rows = [(11, True), (12, True), (35, True), (36, True), (36, False)]
        df = spark.createDataFrame([("g", n, v) for n, v in rows], "Product_Group string, n int, v boolean")
        got = [r.strategy for r in metrics.choose_strategy(df, Settings(), F.col("v")).collect()]
        assert got == ["SARIMA", "ARIMA", "ARIMA", "SARIMA", "ARIMA"]
        ets = metrics.choose_strategy(spark.createDataFrame([("g", 24, False)], "Product_Group string, n int, v boolean"), Settings(arima_min=30, ets_enabled=True, arima_enabled=False), F.col("v"))
        assert ets.first().strategy == "ETS_THETA"

    def test_decomposition_adds_up(self, spark):
        y = [50 + i + 10 * math.sin(i * math.pi / 6) for i in range(48)]
        rows = metrics.seasonal_parts(one_series(spark, y)).filter("trend is not null").collect()
        assert len(rows) == 36 and all(r.trend + r.seasonal + r.resid == pytest.approx(r.Actuals) for r in rows)
        assert metrics.seasonal_strength(one_series(spark, [*y[:40], 60.0, *y[41:]])).first().is_seasonal
        assert metrics.seasonal_strength(one_series(spark, y[:23])).first().strength is None

    def test_best_lag(self, spark):
        df = spark.createDataFrame([("f", 0, 2.0), ("f", 2, 1.0), ("f", 1, 1.0), ("f", 3, None)], "feature string, lag int, mae double")
        assert tuple(metrics.best_lags(df, ("feature",)).first()) == ("f", 1, 1.0, 3)


class TestDiagnostics:
    def data(self, spark, x, y):
        return spark.createDataFrame([("g", "EU", month(i), a, b) for i, (a, b) in enumerate(zip(x, y, strict=True))], f"{KEY}, x double, y double")

    def test_perfect_collinearity(self, spark):
        df = self.data(spark, [float(i) for i in range(12)], [2.0 * i for i in range(12)])
        assert all(math.isinf(r.vif) for r in diagnostics.vif_report(df, ["x", "y"], 8).collect())
        assert diagnostics.pairwise_correlations(df, ["x", "y"], 8).first().pearson_correlation == pytest.approx(1.0)

    def test_short_and_constant(self, spark):
        df = self.data(spark, [float(i) for i in range(7)], [1.0] * 7)
        assert diagnostics.vif_report(df, ["x", "y"], 8).count() == 0
        notes = {r.variable: r.notes for r in diagnostics.stationarity_report(df, ["x", "y"], 8).collect()}
        assert set(notes.values()) == {"fewer than 8 values"}
        got = {r.variable: r.is_constant for r in diagnostics.stationarity_report(df, ["y"], 5).collect()}
        assert got == {"y": True}
        assert diagnostics.complete_correlations(df, ["x", "y"], ("Product_Group", "BU")).first()[2] is None

    def test_backlog_matrix(self, spark):
        rng = np.random.default_rng(1)
        rows = [("p", "EU", month(i), str(100 + 10 * v), str(v)) for i, v in enumerate(rng.standard_normal(30))]
        logs = features.log_features(spark.createDataFrame(rows, "Product string, BU string, Date date, raw_data string, Backlog string"))
        actuals = spark.createDataFrame([("p", "EU", month(i), float(i)) for i in range(30)], "Product string, BU string, Date date, Actuals double")
        got = {r.feature: r for r in diagnostics.backlog_diagnostics(logs, actuals).collect()}
        assert set(got) == set(diagnostics.BACKLOG_COLUMNS) and got["raw_data"].adf_stationary_flag and got["raw_data"].vif_flag_high


class TestModels:
    def test_recovery(self):
        rng = np.random.default_rng(2)
        e = rng.standard_normal(800)
        y = np.zeros(800)
        for t in range(1, 800):
            y[t] = 0.6 * y[t - 1] + e[t] + 0.4 * e[t - 1]
        got = arima.fit(y + 5, (1, 0, 1))
        assert got.converged and got.ar[1] == pytest.approx(-0.6, abs=0.1) and got.ma[1] == pytest.approx(0.4, abs=0.1) and got.sigma2 == pytest.approx(1, abs=0.15)

    def test_random_walk_with_drift(self):
        y = np.cumsum(np.random.default_rng(3).standard_normal(80)) + np.arange(80)
        mean, low, high = arima.fit(y, (0, 1, 0)).forecast(5, 0.8)
        assert mean == pytest.approx(y[-1] + np.arange(1, 6) * np.diff(y).mean(), rel=1e-6)
        assert (np.diff(high - low) > 0).all()

    def test_seasonal_naive_identity(self):
        y = np.random.default_rng(4).standard_normal(60)
        mean = arima.fit(y, (0, 0, 0), (0, 1, 0, 12)).forecast(12, 0.8)[0]
        assert mean - y[-12:] == pytest.approx(np.full(12, (y[12:] - y[:-12]).mean()))

    def test_regression_and_gaps(self):
        rng = np.random.default_rng(5)
        x = rng.standard_normal((120, 2))
        y = 10 + x @ [3.0, -2.0] + 0.1 * rng.standard_normal(120)
        y[50] = np.nan
        got = arima.fit(y, (1, 0, 0), x=x)
        assert got.n_missing == 1 and got.beta == pytest.approx([3, -2], abs=0.2)

    @pytest.mark.parametrize("seed", [22, 52])
    def test_iterations_are_those_of_the_setting(self, seed):
        y = np.random.default_rng(seed).normal(size=60).cumsum() + 10
        assert arima.fit(y, (2, 0, 1), stationary=True, max_iterations=Settings().max_iterations).converged
        assert not arima.fit(y, (2, 0, 1), stationary=True, max_iterations=40).converged

    def test_too_short(self):
        with pytest.raises(ValueError, match="too short"):
            arima.fit(np.arange(10.0), (1, 1, 1), (1, 1, 1, 12))

    def test_unit_root_points(self):
        assert [round(unit_root.mackinnon_p(v), 2) for v in (-3.43, -2.86, -2.57)] == [0.01, 0.05, 0.1]
        e = np.random.default_rng(6).standard_normal(200)
        assert unit_root.adf_test(e).p_value < 0.01 < 0.1 < unit_root.adf_test(np.cumsum(e)).p_value
        assert unit_root.kpss_test(e)[1] == 0.1 and unit_root.kpss_test(np.cumsum(e))[1] < 0.1

    def test_blend(self):
        y = 100 + np.arange(24.0)
        blend = smoothing.fit_blend(y, (0.5, 0.5), 12)
        mean, low, high = blend.forecast(6, 0.8)
        assert (low <= mean).all() and (mean <= high).all() and mean[0] == pytest.approx(124, abs=2)
        with pytest.raises(ValueError, match="neither"):
            smoothing.fit_blend(np.array([1.0, 2.0]), (0.5, 0.5), 12)

    def test_fallback_order(self):
        y = np.random.default_rng(7).standard_normal(20) + 50
        got = fit_strategy(y, None, None, "SARIMA", (1, 1, 1, 1, 1, 1, 12), (1, 1, 1), 3, Settings())
        assert got[1] == "Fallback ARIMA(1,1,1)" and got[2] == "N/A"


class TestSelection:
    def test_candidate_counts(self):
        table = selection.candidate_table()
        count = lambda volatile, n: sum(r[0] == volatile and n >= r[7] for r in table)
        assert (count(False, 60), count(False, 48), count(False, 24), count(True, 60)) == (102, 66, 28, 68)

    def test_small_search(self, spark):
        rng = np.random.default_rng(8)
        y = [100 + 20 * math.sin(i * math.pi / 6) + rng.standard_normal() for i in range(40)]
        df = one_series(spark, y, "long").union(one_series(spark, [5.0, 6.0] * 7, "short"))
        got = {r.group: r for r in selection.order_selection(df, Settings()).collect()}
        assert got["long"].status == "sarima_selected" and got["long"].mean_mae_h1 < 15 and got["long"].series_key == "long__EU"
        assert got["short"].status == "fallback" and got["short"].fallback_model == "Theta" and "short_history" in got["short"].warnings
        assert tuple(selection.order_selection(df.limit(0), Settings()).columns) == selection.SELECTION


class TestReaders:
    def test_catalog_file(self, spark, tmp_path):
        head = ",".join(readers.CATALOG_HEADERS)
        (tmp_path / "c.csv").write_text(f'﻿{head}\nG1,"A\nB",EU,Europe,quantity,1,1,1,0,1,1,12\n', encoding="utf-8")
        r = parse_catalog(readers.read_catalog(spark, str(tmp_path / "c.csv"))).groups.first()
        assert r.skus == ["A", "B"] and (r.order.d, r.order.seas_p) == (1, 0)
        (tmp_path / "bad.csv").write_text("group_key\nG1\n")
        with pytest.raises(ValueError, match="misses columns"):
            readers.read_catalog(spark, str(tmp_path / "bad.csv"))

    def test_report_round_trip(self, spark, tmp_path):
        df = one_series(spark, [3.0, 1.0])
        for _ in range(2):
            readers.write_report(df, f"{tmp_path}/out", ("Date",))
        assert readers.read_table(spark, f"{tmp_path}/out").count() == 2
        assert readers.read_reference(spark, None).count() == 0
