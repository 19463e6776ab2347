"""Matrices, tails, lags, counters and notes against NumPy, closed forms and hand-made rows."""

import math
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import matrices
from tidemark.functions.distributions import chi_squared_tail
from tidemark.operators import diagnostics, lag_moments, metrics, moment_store
from tidemark.operators.counters import Counters, rows_where
from tidemark.operators.notes import notes_in_order
from tidemark.sources import readers

KEY = ("Product_Group", "BU")


def month(i):
    return date(2000 + i // 12, i % 12 + 1, 1)


class TestMatrices:
    @pytest.mark.parametrize("k", [1, 2, 3, 6])
    def test_eigenvalues(self, spark, k):
        rng = np.random.default_rng(k)
        rows = []
        for i in range(20):
            a = rng.standard_normal((k, k)) * 10.0 ** rng.integers(-3, 4)
            rows.append((i, (a + a.T).ravel().tolist()))
        rows += [(20, np.eye(k).ravel().tolist()), (21, np.zeros((k, k)).ravel().tolist()), (22, np.ones((k, k)).ravel().tolist())]
        df = spark.createDataFrame(rows, "i int, m array<double>").select("m", matrices.eigenvalues(F.col("m"), k).alias("e"))
        for r in df.collect():
            want = np.linalg.eigvalsh(np.array(r.m).reshape(k, k))
            assert np.allclose(sorted(r.e), want, rtol=1e-9, atol=1e-9 * max(1e-300, np.abs(want).max()))

    def test_inflation_and_condition(self, spark):
        rng = np.random.default_rng(1)
        k, rows, want = 5, [], []
        for case in range(6):
            x = rng.standard_normal((80, k)) @ rng.standard_normal((k, k))
            infinite = set()
            if case == 1:
                x[:, 4], infinite = 2 * x[:, 1] + 3, {1, 4}
            if case == 2:
                x[:, 0], infinite = x[:, 2] - x[:, 3], {0, 2, 3}
            if case == 3:
                x[:, 1], x[:, 3], infinite = x[:, 0], -x[:, 2], {0, 1, 2, 3}
            r = np.corrcoef(x, rowvar=False)
            vif = []
            for j in range(k):
                others = np.column_stack([np.ones(80), np.delete(x, j, axis=1)])
                rest = x[:, j] - others @ np.linalg.lstsq(others, x[:, j], rcond=None)[0]
                vif.append(math.inf if j in infinite else x[:, j].var() / rest.var())
            rows.append((case, r.ravel().tolist()))
            want.append((vif, math.inf if infinite else np.linalg.cond((x - x.mean(0)) / x.std(0))))
        df = spark.createDataFrame([*rows, (6, None)], "i int, m array<double>").orderBy("i")
        got = df.select(matrices.inflation_factors(F.col("m"), k).alias("v"), matrices.condition_number(F.col("m"), k).alias("c")).collect()
        for r, (vif, condition) in zip(got, want, strict=False):
            assert r.v == pytest.approx(vif, rel=1e-7) and r.c == pytest.approx(condition, rel=1e-6)
        assert got[6].v is None and got[6].c is None

    def test_report_with_tied_constant_and_missing_columns(self, spark):
        rng = np.random.default_rng(2)
        rows = [("g", "b", month(i), float(v), float(2 * v), float(w), 7.0, None if i % 2 else float(u)) for i, (v, w, u) in enumerate(rng.standard_normal((40, 3)))]
        rows += [("g", "few", month(i), float(i), float(i * i), None, None, None) for i in range(2)]
        df = spark.createDataFrame(rows, "Product_Group string, BU string, Date date, a double, b double, c double, d double, e double")
        got = {(r.BU, r.variable): r for r in diagnostics.vif_report(df, ["a", "b", "c", "d", "e"], 2).collect()}
        assert set(got) == {("b", c) for c in "abce"} | {("few", c) for c in "ab"}
        assert got["b", "a"].vif == got["b", "b"].vif == math.inf and got["b", "e"].n_obs == 20 and got["b", "a"].n_obs == 40
        whole = np.array([r[3:] for r in rows[:40:2]], dtype=float)[:, [0, 2, 4]]
        assert [got["b", c].vif for c in "ce"] == pytest.approx(np.diag(np.linalg.inv(np.corrcoef(whole, rowvar=False)))[1:])
        assert all(got["b", c].condition_number == math.inf and not got["b", c].notes for c in "abce")
        assert all(got["few", c].vif is None and got["few", c].notes == diagnostics.TOO_FEW for c in "ab")


class TestTails:
    def test_chi_squared(self, spark):
        def tail(q, k):
            x = q / 2
            if k % 2 == 0:
                return math.exp(-x) * sum(x**j / math.factorial(j) for j in range(k // 2))
            return math.erfc(math.sqrt(x)) + math.exp(-x) * sum(x ** (j - 0.5) / math.gamma(j + 0.5) for j in range(1, (k - 1) // 2 + 1))

        cases = [(q, k) for k in (1, 2, 3, 5, 12, 23, 24, 61) for q in (1e-9, 0.1, 1.0, k - 0.5, float(k), k + 2.5, 3.0 * k, 200.0, 700.0)]
        df = spark.createDataFrame([*cases, (0.0, 3), (-1.0, 3), (None, 3), (1e9, 3)], "q double, k int")
        got = [r[0] for r in df.select(chi_squared_tail(F.col("q"), F.col("k"), range(1, 62))).collect()]
        assert got[: len(cases)] == pytest.approx([tail(*c) for c in cases], rel=1e-10, abs=1e-14)
        assert got[len(cases) :] == [1.0, 1.0, None, 0.0]

    def test_ljung_box_of_several_lags(self, spark):
        rng = np.random.default_rng(3)
        series = {"long": rng.standard_normal(40), "short": rng.standard_normal(4), "flat": np.zeros(9)}
        rows = [(g, "u", month(i), float(v)) for g, x in series.items() for i, v in enumerate(x)] + [("long", "u", month(99), None)]
        df = spark.createDataFrame(rows, "Product_Group string, BU string, Date date, resid double")
        lags = (1, 3, 7, 12)
        got = {(r.Product_Group, r.lag): r for r in metrics.ljung_box_lags(df, lags).collect()}
        for g, x in series.items():
            c = x - x.mean()
            for k in lags:
                if len(x) <= k or not c.any():
                    assert got[g, k].statistic is None and got[g, k].p_value is None
                    continue
                q = len(x) * (len(x) + 2) * sum((c[j:] @ c[: len(c) - j] / (c @ c)) ** 2 / (len(x) - j) for j in range(1, k + 1))
                assert got[g, k].statistic == pytest.approx(q)
        least = {r.Product_Group: r for r in metrics.ljung_box(df, lags).collect()}
        best = min((got["long", k].p_value, k) for k in lags)
        assert (least["long"].p_value, least["long"].statistic) == (best[0], got["long", best[1]].statistic)
        assert least["short"].p_value == min(got["short", k].p_value for k in (1, 3)) and least["flat"].p_value is None


def test_lag_errors(spark):
    rng = np.random.default_rng(4)
    y, x = rng.standard_normal(30).cumsum(), rng.standard_normal(30).cumsum()
    rows = [("g", "b", "f", month(i), None if i == 5 else float(y[i]), None if i == 9 else float(x[i])) for i in range(30)]
    rows += [("g", "b", "flat", month(i), float(y[i]), 1.0) for i in range(12)] + [("g", "b", "short", month(i), 1.0, 1.0) for i in range(6)]
    df = spark.createDataFrame(rows, "Product_Group string, BU string, feature string, Date date, Actuals double, value double")
    got = {(r.feature, r.lag): r for r in lag_moments.lag_errors(df, 6, 6).collect()}
    whole = [(a, b) for a, b in ((r[4], r[5]) for r in rows if r[2] == "f") if a is not None and b is not None]
    for lag in range(7):
        pairs = [(whole[i][0], whole[i - lag][1]) for i in range(lag, len(whole))]
        a, b = np.array(pairs[:-6]).T
        slope, intercept = np.polyfit(b, a, 1)
        error = np.mean([abs(t - intercept - slope * v) for t, v in pairs[-6:]])
        r = got["f", lag]
        assert (r.n_train, r.slope, r.intercept, r.mae) == (len(a), pytest.approx(slope), pytest.approx(intercept), pytest.approx(error))
    # A feature that does not vary gives the targets' mean; a lag without a training row is left out.
    assert got["flat", 2].slope == 0 and got["flat", 2].intercept == pytest.approx(y[2:6].mean())
    assert ("flat", 5) in got and ("flat", 6) not in got and not any(f == "short" for f, _ in got)


def test_counters(spark):
    counters = Counters()
    rows = spark.createDataFrame([(1, None), (2, "x"), (3, "y"), (3, "y")], "n int, t string").repartition(3)
    seen = counters.keep(rows, "a", read=F.count(F.lit(1)), blank=rows_where(F.col("t").isNull()), weight=rows_where(F.col("t").isNotNull(), "n"))
    assert seen.count() == 4
    # Nothing is left, and Spark may find that out before the rows are counted.
    none = counters.keep(rows.filter("n > 9").groupBy("t").count().join(seen.select("t"), "t", "left"), "b", read=F.count(F.lit(1)), blank=rows_where(F.col("t").isNull()))
    assert none.count() == 0
    assert counters.rows == [("a", "read", 4), ("a", "blank", 1), ("a", "weight", 8), ("b", "read", 0), ("b", "blank", 0)]
    assert counters.of("a", "blank") == 1 and counters.table(spark).count() == 5


def test_notes_in_order(spark):
    rows = [("a", 3, "late"), ("a", 1, "first"), ("a", 2, "late"), ("a", 9, "first"), ("a", 2, "also"), ("a", None, "no place"), ("a", 5, ""), ("b", 1, None), ("c", 7, "x"), ("c", 7, "x")]
    got = notes_in_order(spark.createDataFrame(rows, "k string, position int, note string").repartition(5), ("k",)).collect()
    assert {r.k: (r.n_notes, r.notes) for r in got} == {"a": (4, "first; also; late; no place"), "b": (0, ""), "c": (1, "x")}
    assert notes_in_order(spark.createDataFrame([], "k string, position int, note string"), ("k",)).count() == 0


def test_encoding_of_each_file(spark, tmp_path):
    text = "Product,Größe\ncafé,1\n\"naïve, quoted\",2\n"
    (tmp_path / "utf8.csv").write_bytes(b"\xef\xbb\xbf" + text.encode("utf-8"))
    (tmp_path / "latin1.csv").write_bytes(text.encode("latin-1"))
    (tmp_path / "ascii.csv").write_bytes(b"Product,Gr\xf6\xdfe\nplain,3\n")
    both = readers.read_table(spark, str(tmp_path), readers.AUTO)
    assert both.count() == 5 and sorted(r[0] for r in both.collect()) == sorted(["café", "naïve, quoted"] * 2 + ["plain"])
    for name in ("utf8", "latin1"):
        one = readers.read_table(spark, f"{tmp_path}/{name}.csv", readers.AUTO)
        assert one.columns == ["Product", "Größe"] and sorted(map(tuple, one.collect())) == [("café", "1"), ("naïve, quoted", "2")]
    assert {r.file.rsplit("/", 1)[1]: r.is_utf8 for r in readers.file_encodings(spark, str(tmp_path)).collect()} == {"utf8.csv": True, "latin1.csv": False, "ascii.csv": False}


def test_rows_set_aside(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Product,Timestamp,Revenue\nA,2021-01-01,1\nshort,2021-01-01\nlong,2021-01-01,1,2\nB,never,1\n\"C, D\",2021-02-01,3\n")
    (tmp_path / "b.csv").write_text("Product,Timestamp,Revenue\nE,,5\n,2021-01-01,6\n")
    checks = {"no date": lambda df: F.try_to_timestamp("Timestamp").isNull(), "no product": lambda df: F.col("Product").isNull()}
    good, rejected = readers.read_checked(spark, str(tmp_path), checks)
    assert good.columns == ["Product", "Timestamp", "Revenue"] and sorted(r.Product for r in good.collect()) == ["A", "C, D"]
    got = sorted((r.source_file.rsplit("/", 1)[1], r.reason, r.line) for r in rejected.collect())
    assert got == [
        ("a.csv", "no date", "B,never,1"), ("a.csv", readers.FIELDS, "long,2021-01-01,1,2"), ("a.csv", readers.FIELDS, "short,2021-01-01"),
        ("b.csv", "no date", "E,,5"), ("b.csv", "no product", ",2021-01-01,6"),
    ]
    # A column alone, and a count, see the same rows.
    assert good.select("Product").count() == 2 and rejected.count() == 5 and good.count() + rejected.count() == 7


class TestMomentStore:
    COLUMNS = ["a", "b", "c"]

    def facts(self, spark):
        """Several rows a month, with gaps, a column that never varies, one that is too short, and large values."""
        rng = np.random.default_rng(4)
        rows = []
        for g in ("g", "h", "still", "short", "gone"):
            for i in range(3 if g == "short" else 90):
                a, b, c = 1e9 + rng.standard_normal(3)
                a = 0.1 if g == "still" else a
                gaps = [rng.random() < 0.2 for _ in range(4)]
                values = [None if gap or (g == "gone" and k == 2) else float(v) for k, (gap, v) in enumerate(zip(gaps, (a, b, c, a + b), strict=True))]
                rows.append((g, "EU", date(2020 + i // 36, i // 3 % 12 + 1, i % 3 + 1), *values))
        return spark.createDataFrame(rows, "Product_Group string, BU string, Date date, a double, b double, c double, y double")

    def close(self, got, want, key):
        got, want = ({tuple(r[c] for c in key): r.asDict() for r in df.collect()} for df in (got, want))
        assert got.keys() == want.keys() and want
        for at, row in want.items():
            for name, value in row.items():
                flat = lambda v: [x for x in (v if isinstance(v, list) else [v])]
                for x, y in zip(flat(got[at][name]), flat(value), strict=True):
                    assert x == (pytest.approx(y, rel=1e-5, abs=1e-5) if isinstance(y, float) else y), (at, name)

    def test_months_merge_to_all_rows(self, spark, tmp_path):
        data, store = self.facts(spark), str(tmp_path / "store")
        every = [*self.COLUMNS, "y"]
        late = (F.dayofmonth("Date") == 2) & (F.month("Date") < 5)
        for batch, rows in (("1", F.year("Date") == 2020), ("2", F.year("Date") > 2020)):
            moment_store.add_facts(data.filter(rows & ~late), every, store, batch)
        for _ in range(2):  # a batch that runs again counts once
            moment_store.add_facts(data.filter(late), every, store, "3")
        kept = moment_store.read_store(spark, store)
        assert kept.agg(F.sum("n")).first()[0] == data.count()
        pairs = (*KEY, "variable_x", "variable_y")
        self.close(moment_store.merged_correlations(kept, self.COLUMNS, 12, "y"), diagnostics.pairwise_correlations(data, self.COLUMNS, 12, "y"), pairs)
        self.close(moment_store.merged_moments(kept, every, 12), diagnostics.complete_moments(data, every, 12, KEY), KEY)

    def test_no_rows(self, spark):
        none = moment_store.month_moments(self.facts(spark).limit(0), self.COLUMNS)
        assert moment_store.merged_moments(none, self.COLUMNS, 12).count() == moment_store.merged_correlations(none, self.COLUMNS, 12).count() == 0


@pytest.mark.parametrize("noise", [0.1, 0.03, 0.003])
def test_vif_sql_of_close_features(spark, noise):
    """Features that large tables bring near to each other are not tied; a series in which one follows from the others is left out."""
    import duckdb
    import pandas as pd

    from tidemark.config import FEATURES
    from tidemark.plans.analysis_queries import _swept_vif_sql

    rng, columns, frames = np.random.default_rng(5), list(FEATURES), []
    for g in ("a", "b", "still", "tied"):
        values = pd.DataFrame(rng.gamma(4, 1000, 80)[:, None] * (1 + noise * rng.standard_normal((80, 6))), columns=columns).assign(grp=g, bu="EU")
        values["Quantity"] = 0.5 if g == "still" else 2 * values["Revenue"] + values["New_Quotes"] if g == "tied" else values["Quantity"]
        frames.append(values)
    prepared = pd.concat(frames)
    with duckdb.connect() as c:
        c.register("prepared", prepared)
        want = {r[:3]: r[3:] for r in c.sql(_swept_vif_sql(columns, "round(vif, 3) AS vif")).fetchall()}
    data = spark.createDataFrame(prepared.rename(columns={"grp": "Product_Group", "bu": "BU"}))
    got = diagnostics.vif_report(data, columns, 12).filter("vif is not null and condition_number < double('infinity')")
    got = {(r.Product_Group, r.BU, r.variable): (round(r.vif, 3), r.n_obs) for r in got.collect()}
    assert got == want and len(got) == 17
