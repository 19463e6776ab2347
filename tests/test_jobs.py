"""Jobs from small files to reports."""

from datetime import date

import pytest

from tidemark.config import Settings
from tidemark.plans import jobs
from tidemark.sources import readers

SETTINGS = Settings(current_month=date(2024, 12, 1), use_pipeline=True, use_backlog=True)


@pytest.fixture(scope="module")
def inputs(tmp_path_factory):
    folder = tmp_path_factory.mktemp("files")
    months = [f"{y}-{m:02d}-01" for y in range(2021, 2025) for m in range(1, 13)]
    demand = [f"{p},{d},EU,{100 + 10 * k + 20 * (i % 12) + (7 * i) % 5}" for k, p in enumerate(("A1", "b2")) for i, d in enumerate(months)]
    demand += [f"C3,{d},EU,5" for d in months[:6]]
    (folder / "actuals.csv").write_text("Product,Month,BU,Actuals\n" + "\n".join(demand) + "\n")
    rows = ["G1,A1|B2,EU,Europe,quantity,1,1,1,0,1,1,12", "G2,C3,EU,Europe,default,1,1,1,0,1,1,12", "G3,,EU,Europe,default,1,1,1,0,1,1,12"]
    (folder / "catalog.csv").write_text(",".join(readers.CATALOG_HEADERS) + "\n" + "\n".join(rows) + "\n")
    sold = [f"{d},A1,EU,{10 * i},{i % 7 + 1},1,1,0,0" for i, d in enumerate(months)]
    (folder / "pipeline.csv").write_text("CloseDate,Product_Name,Business_Unit_Code,Revenue,Quantity,Open_Opportunities,New_Quotes,Revenue_new_orders,Quantity_new_orders\n" + "\n".join(sold) + "\n")
    (folder / "backlog.csv").write_text("SKU,Date,Business_Unit,Backlog\n" + "\n".join(f"ITEM_A1,{d},EU,{i % 5}" for i, d in enumerate(months)) + "\n")
    return jobs.Inputs(*(str(folder / f"{n}.csv") for n in ("actuals", "catalog", "pipeline")), None, str(folder / "backlog.csv"))


def test_forecast_job(spark, inputs, tmp_path):
    totals = jobs.forecast_job(spark, inputs, str(tmp_path), SETTINGS).first()
    assert (totals.models, totals.forecasts, totals.groups, totals.units) == (1, 12, 1, 1)
    report = readers.read_table(spark, f"{tmp_path}/forecast").collect()
    assert [r.Date for r in report] == [f"2025-{m:02d}" for m in range(1, 13)] and all(float(r.Lower_CI) <= float(r.Forecast) <= float(r.Upper_CI) for r in report)
    assert readers.read_table(spark, f"{tmp_path}/metrics").count() == 1
    assert [r.Product_Group for r in readers.read_table(spark, f"{tmp_path}/skipped").collect()] == ["G2"]
    assert [r.group_key for r in readers.read_table(spark, f"{tmp_path}/rejected").collect()] == ["G3"]
    counts = {(r.source, r.reason): int(r.rows) for r in readers.read_table(spark, f"{tmp_path}/counts").collect()}
    # C3 is in the catalog; G3, which is not, lists nothing.
    assert counts == {("actuals", "read"): 102, ("actuals", "no_date"): 0, ("actuals", "bad_date"): 0, ("actuals", "no_unit"): 0, ("actuals", "no_group"): 0} | {
        ("pipeline", r): n for r, n in {"read": 48, "no_date": 0, "no_group": 0, "no_unit": 0, "unit_not_listed": 0, "loaded": 48}.items()
    } | {("backlog", r): n for r, n in {"read": 48, "no_date": 0, "no_unit": 0, "no_group": 0}.items()}
    # A rerun overwrites.
    assert jobs.forecast_job(spark, inputs, str(tmp_path), SETTINGS, ["G1"]).first().forecasts == 12
    assert readers.read_table(spark, f"{tmp_path}/forecast").count() == 12


def test_unknown_groups_and_months(spark, inputs, tmp_path):
    with pytest.raises(ValueError, match="no such product groups: X, Y"):
        jobs.forecast_job(spark, inputs, str(tmp_path), SETTINGS, ["G1", "Y", "X"])
    (tmp_path / "bad.csv").write_text("Product,Month,BU,Actuals\nA1,someday,EU,1\n")
    with pytest.raises(ValueError, match="someday"):
        jobs.forecast_job(spark, jobs.Inputs(str(tmp_path / "bad.csv"), inputs.catalog), str(tmp_path), SETTINGS)


def test_counts_of_what_goes(spark, inputs, tmp_path):
    sold = ["2021-01-01,A1,EU,1", "never,A1,EU,1", ",A1,EU,1", "2021-01-01,NOPE,EU,1", "2021-01-01,NOPE,EU,2", "2021-01-01,A1,,1", "2021-01-01,A1,XX,1", "2021-01-01,A1,Europe,1"]
    sold += ["2021-01-01,A1,EU", "2021-01-01,A1,EU,1,1", "2021-01-01,Größe,EU,9"]
    (tmp_path / "pipeline.csv").write_bytes(("CloseDate,Product_Name,Business_Unit_Code,Revenue\n" + "\n".join(sold) + "\n").encode("latin-1"))
    owed = ["A1,2021-01-01,EU,1", "A1,,EU,1", "A1,2021-01-01,,1", "Q9,2021-01-01,EU,1", "Q9,2021-01-01,EU,1"]
    (tmp_path / "backlog.csv").write_text("SKU,Date,Business_Unit,Backlog\n" + "\n".join(owed) + "\n")
    few = jobs.Inputs(inputs.actuals, inputs.catalog, str(tmp_path / "pipeline.csv"), None, str(tmp_path / "backlog.csv"))
    jobs.forecast_job(spark, few, str(tmp_path / "out"), SETTINGS, ["G1"], kind="parquet")
    counts = {(r.source, r.reason): r.rows for r in spark.read.parquet(f"{tmp_path}/out/counts").collect()}
    assert counts["actuals", "no_group"] == 6  # those of G2, which is not asked for
    assert [counts["pipeline", r] for r in ("read", "no_date", "no_group", "no_unit", "unit_not_listed", "loaded")] == [9, 2, 3, 1, 1, 2]
    aside = sorted((r.reason, r.line) for r in spark.read.parquet(f"{tmp_path}/out/quarantine").collect())
    assert aside == [("no date", ",A1,EU,1"), ("no date", "never,A1,EU,1"), (readers.FIELDS, "2021-01-01,A1,EU"), (readers.FIELDS, "2021-01-01,A1,EU,1,1")]
    assert [counts["backlog", r] for r in ("read", "no_date", "no_unit", "no_group")] == [5, 1, 1, 2]


def test_baseline_job(spark, inputs, tmp_path):
    totals = jobs.baseline_job(spark, inputs, str(tmp_path), SETTINGS, kind="parquet").first()
    assert (totals.models, totals.forecasts) == (1, 12)
    read = lambda name: spark.read.parquet(f"{tmp_path}/{name}").collect()
    report = sorted(read("baseline"), key=lambda r: r.Date)
    assert [r.Date for r in report] == [f"2025-{m:02d}" for m in range(1, 13)] and {r.Model_Type for r in report} == {"SEASONAL_NAIVE"}
    assert all(0 <= r.Lower_CI <= r.Forecast <= r.Upper_CI for r in report)
    assert [(r.Product_Group, r.n, r.reason) for r in read("baseline_skipped")] == [("G2", 6, "insufficient data")]
    assert len(read("baseline_metrics")) == 1


def test_order_selection_and_lag_jobs(spark, inputs, tmp_path):
    orders = jobs.order_selection_job(spark, inputs, str(tmp_path), SETTINGS).collect()
    report = spark.read.parquet(f"{tmp_path}/order_selection").collect()
    assert {r.series_key for r in report} == {"G1__EU", "G2__EU"} and len(orders) == sum(r.status == "sarima_selected" for r in report)
    lags = jobs.lag_job(spark, inputs, str(tmp_path), SETTINGS)
    assert lags.count() == readers.read_table(spark, f"{tmp_path}/lags").count() > 0


def test_diagnostics_job(spark, inputs, tmp_path):
    unmapped = jobs.diagnostics_job(spark, inputs, str(tmp_path), kind="parquet").first()
    # Products match exactly here: the 48 rows of b2 are not those of the catalog's B2.
    assert (unmapped.missing_pipeline_mappings, unmapped.missing_actual_mappings) == (0, 48)
    read = lambda name: spark.read.parquet(f"{tmp_path}/{name}").collect()
    # Only pipeline facts named like a group, or as the reference tells, have a product group here.
    assert not read("correlations") and not read("collinearity")
    months = [f"{y}-{m:02d}-01" for y in range(2021, 2025) for m in range(1, 13)]
    sold = [f"{d},{name},EU,{10 * i},{i % 7 + 1},{3 * (i % 7) + i},1,0,0" for name in ("G1", "Sold", "Other") for i, d in enumerate(months)]
    (tmp_path / "pipeline.csv").write_text("CloseDate,Product_Name,Business_Unit_Code,Revenue,Quantity,Open_Opportunities,New_Quotes,Revenue_new_orders,Quantity_new_orders\n" + "\n".join(sold) + "\n")
    named = jobs.Inputs(inputs.actuals, inputs.catalog, str(tmp_path / "pipeline.csv"))
    jobs.diagnostics_job(spark, named, f"{tmp_path}/named", kind="parquet")
    read = lambda name: spark.read.parquet(f"{tmp_path}/named/{name}").collect()
    assert {(r.Product_Group, r.variable_x, r.variable_y) for r in read("correlations")} == {
        ("G1", x, y) for x, y in [("Revenue", "Quantity"), ("Revenue", "Open_Opportunities"), ("Revenue", "Actual_Quantity"), ("Quantity", "Open_Opportunities"), ("Quantity", "Actual_Quantity"), ("Open_Opportunities", "Actual_Quantity")]
    }
    # Open_Opportunities follows from the other two.
    assert {(r.variable, r.vif) for r in read("collinearity")} == {(c, float("inf")) for c in ("Revenue", "Quantity", "Open_Opportunities")}
    assert {r.variable for r in read("too_few")} == {"New_Quotes", "Revenue_new_orders", "Quantity_new_orders"}
    assert len(read("stationarity")) == 7 and sum(r.is_constant for r in read("stationarity")) == 3
    with pytest.raises(ValueError, match="pipeline"):
        jobs.diagnostics_job(spark, jobs.Inputs(inputs.actuals, inputs.catalog), str(tmp_path))
