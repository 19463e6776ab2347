"""Bucketed stores of series, and the seasonal naive model folded over series, on hand-made rows."""

import math
import os
import uuid
from datetime import date
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.config import Settings
from tidemark.operators import naive_drift, series_store
from tidemark.plans.forecast import REPORT, phase_report

KEY = ("Product_Group", "BU")
ROW = "Product_Group string, BU string, Date date, "


def month(i):
    return date(2000 + i // 12, i % 12 + 1, 1)


def files(folder):
    return {d: sorted(f for f in os.listdir(f"{folder}/{d}") if f.endswith(".parquet")) for d in os.listdir(folder) if "=" in d}


class TestSeriesStore:
    @pytest.fixture
    def stores(self, spark, tmp_path):
        names = [f"{kind}_{uuid.uuid4().hex}" for kind in ("actuals", "features")]
        rows = [(f"g{g}", "EU", month(i), float(100 * g + i)) for g in range(9) for i in range(5)]
        for name, column, some in zip(names, ("Actuals", "Revenue"), (rows, rows[::2]), strict=True):
            series_store.open_store(spark, name, [column], f"{tmp_path}/{name}", 4)
            series_store.replace_months(spark.createDataFrame(some, ROW + f"{column} double"), name, 4)
        return names, rows

    def test_stores_meet_without_an_exchange(self, spark, stores):
        names, rows = stores
        met = series_store.meet(*(spark.table(n) for n in names))
        plan = met._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and plan.count("Bucketed: true") == 2
        got = {(r.Product_Group, r.Date): (r.Actuals, r.Revenue) for r in met.collect()}
        assert got == {(g, d): (v, v if k % 2 == 0 else 0.0) for k, (g, _, d, v) in enumerate(rows)}

    def test_series_are_whole_in_a_bucket(self, spark, stores):
        plan = spark.table(stores[0][0]).groupBy(*KEY).agg(F.sum("Actuals"))._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan

    def test_a_month_again_changes_only_its_partition(self, spark, stores, tmp_path):
        names, rows = stores
        before, mode = files(tmp_path / names[0]), spark.conf.get("spark.sql.sources.partitionOverwriteMode")
        again = [(g, b, d, -v) for g, b, d, v in rows if d == month(2)][:4] + [("new", None, month(2), None), ("lost", "EU", None, 1.0)]
        for _ in range(2):  # the same again leaves the same
            series_store.replace_months(spark.createDataFrame(again, ROW + "Actuals double"), names[0], 4)
        after = files(tmp_path / names[0])
        assert before.keys() == after.keys() and {d for d in before if before[d] != after[d]} == {f"Date={month(2)}"}
        table = spark.table(names[0])
        assert sorted((r.Product_Group, r.Actuals) for r in table.filter(F.col("Date") == F.lit(month(2))).collect()) == [("g0", -2.0), ("g1", -102.0), ("g2", -202.0), ("g3", -302.0), ("new", None)]
        assert table.count() == len(rows) - 9 + 5
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode

    def test_found_again(self, spark, stores, tmp_path):
        names, rows = stores
        want = spark.table(names[0]).collect()
        spark.sql(f"DROP TABLE {names[0]}")  # as a new session, which knows no tables
        assert sorted(series_store.open_store(spark, names[0], ["Actuals"], f"{tmp_path}/{names[0]}", 4).collect()) == sorted(want)

    def test_no_rows_and_clashing_names(self, spark, stores, tmp_path):
        names, rows = stores
        series_store.replace_months(spark.createDataFrame([], ROW + "Actuals double"), names[0], 4)
        assert spark.table(names[0]).count() == len(rows)
        with pytest.raises(ValueError, match="bu"):
            series_store.open_store(spark, "clash", ["bu"], str(tmp_path / "clash"))


def plain_forecast(y, steps, confidence, max_age):
    """The model by hand."""
    n, at = len(y), {}
    for t, v in enumerate(y):
        if v is not None:
            at[t % 12] = t
    changes = [y[t] - y[t - 12] for t in range(12, n) if y[t] is not None and y[t - 12] is not None]
    if len(at) < 12 or len(changes) < 2 or n - min(at.values()) > max_age:
        return None
    z, drift, spread = NormalDist().inv_cdf(0.5 + confidence / 2), np.mean(changes), np.std(changes, ddof=1)
    out = []
    for t in range(n, n + steps):
        k = (t - at[t % 12]) // 12
        mean = y[at[t % 12]] + k * drift
        out.append((mean, mean - z * spread * math.sqrt(k), mean + z * spread * math.sqrt(k)))
    return out


class TestNaiveDrift:
    SETTINGS = Settings(current_month=date(2009, 12, 1))

    def series(self):
        rng = np.random.default_rng(5)
        out = {"long": rng.integers(0, 50, 60), "year": rng.integers(1, 9, 13), "two": rng.integers(1, 9, 21), "three": rng.integers(1, 9, 30), "short": rng.integers(1, 9, 8)}
        out = {k: [float(x) + 1 for x in v] for k, v in out.items()}
        out["large"] = [1e12 + i for i in range(40)]
        out["still"] = [7.0] * 36
        out["falling"] = [300.0 - 5 * i for i in range(59)]
        out["gaps"] = [None if i % 5 == 2 else float(i % 12 + i) for i in range(70)]
        # July has no value after the third year: the holdout's fit is fresh enough, the refit's is not.
        out["stale"] = [None if i % 12 == 6 and i > 30 else float(10 + i % 12) for i in range(59)]
        return out

    def fitted(self, spark, max_age=24):
        rows = [(g, "EU", month(i), v) for g, y in self.series().items() for i, v in enumerate(y) if v is not None]
        return naive_drift.naive_phases(spark.createDataFrame(rows, ROW + "Actuals double"), self.SETTINGS, max_age)

    def test_phases_as_by_hand(self, spark):
        fitted, short = self.fitted(spark)
        got = {}
        for r in sorted(fitted.collect(), key=lambda r: r.step):
            got.setdefault((r.Product_Group, r.phase), []).append((r.step, r.actual, r.forecast, r.lower, r.upper))
        want = {}
        for g, y in self.series().items():
            for phase, held in (("holdout", 6), ("full", 0)):
                if len(y) >= 12 and (fit := plain_forecast(y[: len(y) - held], held + 12, 0.8, 24)):
                    want[g, phase] = [(h + 1 - held, y[len(y) - held + h] if h < held else None, *f) for h, f in enumerate(fit)]
        assert got.keys() == want.keys()
        for key, rows in want.items():
            for a, b in zip(got[key], rows, strict=True):
                assert a[:2] == b[:2] and a[2:] == pytest.approx(b[2:], rel=1e-9, abs=1e-6), key
        assert ("stale", "holdout") in got and ("stale", "full") not in got
        assert [(r.Product_Group, r.n) for r in short.collect()] == [("short", 8)]

    def test_report(self, spark):
        fitted, _ = self.fitted(spark)
        report, pairs = phase_report(fitted, spark.createDataFrame([("EU", "Europe")], "BU string, BU_Name string"), self.SETTINGS)
        assert tuple(report.columns) == REPORT
        rows = {}
        for r in sorted(report.collect(), key=lambda r: r.Date):
            rows.setdefault(r.Product_Group, []).append(r)
        assert all(len(r) == 12 and all(0 <= x.Lower_CI <= x.Forecast <= x.Upper_CI for x in r) for r in rows.values())
        # The holdout's forecast stands in for the refit, in the months after the history.
        assert rows["stale"][0].Date == "2004-12" and {r.BU_Name for r in rows["stale"]} == {"Europe"}
        assert {r.Forecast for r in rows["still"]} == {7.0} and rows["still"][0]["MAE%"] == 0
        assert rows["falling"][-1].Forecast == 0.0  # not below zero
        assert pairs.filter("Product_Group = 'year'").count() == 0

    def test_no_rows(self, spark):
        none = spark.createDataFrame([], ROW + "Actuals double")
        fitted, short = naive_drift.naive_phases(none, self.SETTINGS)
        assert fitted.count() == short.count() == 0

    def test_fold_of_gaps_and_nulls(self, spark):
        df = spark.createDataFrame([(1, [None] * 30), (2, []), (3, None), (4, [1.0] + [None] * 23 + [5.0])], "i int, y array<double>")
        got = {r.i: r for r in df.select("i", naive_drift.folded(F.col("y")).alias("s")).select("i", "s", naive_drift.usable(F.col("s"), 24).alias("ok"), naive_drift.drift_of(F.col("s")).alias("d")).collect()}
        assert got[1].s.t == 30 and got[1].s.n == 0 and got[1].ok is False and got[1].d is None
        assert got[2].s.t == 0 and got[3].s is None
        assert got[4].s.season[0].value == 5.0 and got[4].s.n == 0  # two years apart is no change of a season
