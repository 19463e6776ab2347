"""Registered queries of analyses and of reading: lags, matrices, tails, counts, notes, encodings and rows set aside."""

from __future__ import annotations

import uuid
from dataclasses import replace
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FEATURES, KEY
from ..kept import kept, shared_folder
from ..operators import diagnostics, features, metrics, moment_store, series, series_store
from ..operators.counters import Counters
from ..operators.lag_moments import lag_errors
from ..operators.naive_drift import naive_phases
from ..operators.notes import notes_in_order
from ..sources import readers
from ..sources import star_schema as star
from .forecast import phase_report
from .registry import ORACLES, SETTINGS, _catalog, _demand, _dense, _pipe, _prepared, _rounded, _with_prepared, query

_LAG_FEATURES = ("Quantity", "New_Quotes")

_LAG_ERRORS = """pairs AS (
  SELECT q.grp, q.bu, q.d, q.v AS y, p.f.feature AS feature, p.f.x AS x FROM demand q
  JOIN (SELECT grp, bu, d, unnest([{'feature': 'Quantity', 'x': Quantity}, {'feature': 'New_Quotes', 'x': New_Quotes}]) AS f FROM pipe_grid) p
  ON p.grp = q.grp AND p.bu = q.bu AND p.d = q.d),
placed AS (SELECT *, row_number() OVER w AS rn, count(*) OVER (PARTITION BY grp, bu, feature) AS n FROM pairs WINDOW w AS (PARTITION BY grp, bu, feature ORDER BY d)),
met AS (
  SELECT a.grp, a.bu, a.feature, k AS lag, a.y, b.x, a.n - a.rn < 6 AS test FROM placed a, (SELECT unnest(range(0, 7)) AS k)
  JOIN placed b ON a.grp = b.grp AND a.bu = b.bu AND a.feature = b.feature AND b.rn = a.rn - k),
lines AS (
  SELECT grp, bu, feature, lag, n_train, slope, mean_y - slope * mean_x AS intercept FROM (
    SELECT grp, bu, feature, lag, count(*) AS n_train, CASE WHEN min(x) <> max(x) THEN regr_slope(y, x) ELSE 0 END AS slope, avg(y) AS mean_y, avg(x) AS mean_x
    FROM met WHERE NOT test GROUP BY ALL)),
lag_errors AS (
  SELECT l.*, e.mae FROM lines l JOIN (
    SELECT m.grp, m.bu, m.feature, m.lag, avg(abs(y - intercept - slope * x)) AS mae FROM met m JOIN lines l
    ON m.grp = l.grp AND m.bu = l.bu AND m.feature = l.feature AND m.lag = l.lag WHERE test GROUP BY ALL) e
  ON e.grp = l.grp AND e.bu = l.bu AND e.feature = l.feature AND e.lag = l.lag)"""


def _lag_errors(spark: SparkSession, folder: str) -> DataFrame:
    """Lines through demand and each pipeline feature of the months that have both, at lags 0 to 6."""
    read = _catalog(spark, folder)
    grid = series.month_grid(_pipe(spark, folder, read), end=SETTINGS.current_month)
    long = grid.select(*KEY, "Date", F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("value")) for c in _LAG_FEATURES])).alias("f"))
    pairs = _demand(spark, folder, read).join(long.select(*KEY, "Date", "f.feature", "f.value"), [*KEY, "Date"])
    return lag_errors(pairs, SETTINGS.max_lag, SETTINGS.holdout)


@query(f"SELECT * FROM (WITH {_LAG_ERRORS} SELECT grp AS Product_Group, bu AS BU, feature, lag, n_train, round(slope, 8) AS slope, round(intercept, 7) AS intercept, round(mae, 7) AS mae FROM lag_errors)")
def feature_lag_errors(spark: SparkSession, folder: str) -> DataFrame:
    out = _lag_errors(spark, folder)
    return out.select(*KEY, "feature", "lag", "n_train", F.round("slope", 8).alias("slope"), F.round("intercept", 7).alias("intercept"), F.round("mae", 7).alias("mae"))


@query(
    f"""SELECT * FROM (WITH {_LAG_ERRORS}
SELECT grp AS Product_Group, bu AS BU, feature, arg_min(lag, (round(mae, 7), lag)) AS best_lag, round(min(mae), 7) AS validation_mae, count(*) AS lags_evaluated
FROM lag_errors GROUP BY grp, bu, feature)"""
)
def feature_best_lags(spark: SparkSession, folder: str) -> DataFrame:
    """Errors that are equal but for rounding are ties."""
    return metrics.best_lags(_rounded(_lag_errors(spark, folder), 7), (*KEY, "feature"))


def _determinants(k: int, rows: list[int], name: str) -> tuple[list[str], str]:
    """(common table expressions, column) that expand a determinant of the entries c_i_j by its rows, one row a step."""
    steps, before = [], f"{name}_0"
    steps.append(f"{before} AS (SELECT *, 1.0::DOUBLE AS {name}_ FROM entries)")
    minors = {(): f"{name}_"}
    for depth, row in enumerate(rows, 1):
        here = {}
        for columns in combinations(rows, depth):
            parts = [f"{'+' if (depth - 1 - at) % 2 == 0 else '-'} c_{row}_{column} * {minors[columns[:at] + columns[at + 1 :]]}" for at, column in enumerate(columns)]
            here[columns] = (f"{name}_{'_'.join(map(str, columns))}", " ".join(parts))
        steps.append(f"{name}_{depth} AS (SELECT *, {', '.join(f'{e} AS {n}' for n, e in here.values())} FROM {before})")
        before, minors = f"{name}_{depth}", {c: n for c, (n, _) in here.items()}
    return steps, f"SELECT grp, bu, {minors[tuple(rows)]} AS det FROM {before}"


def _vif_sql(columns: list[str], reported: str) -> str:
    """Inflation factors as ratios of determinants of the correlations; columns that do not vary have a unit row."""
    k = len(columns)
    ok = [f"(count({c}) >= 12 AND min({c}) <> max({c}))" for c in columns]
    entry = lambda i, j: "1.0" if i == j else f"CASE WHEN {ok[i]} AND {ok[j]} THEN corr({columns[i]}, {columns[j]}) ELSE 0 END"
    entries = ", ".join(f"{entry(min(i, j), max(i, j))} AS c_{i}_{j}" for i in range(k) for j in range(k))
    flags = ", ".join(f"{ok[i]} AS ok_{i}" for i in range(k))
    steps, selects = [f"entries AS (SELECT grp, bu, count(*) AS n, {flags}, {entries} FROM prepared GROUP BY grp, bu)"], []
    for name, left in [("w", list(range(k))), *((f"d{j}", [i for i in range(k) if i != j]) for j in range(k))]:
        more, last = _determinants(k, left, name)
        steps += [*more, f"{name}_det AS ({last})"]
    for j, c in enumerate(columns):
        selects.append(f"SELECT e.grp AS Product_Group, e.bu AS BU, '{c}' AS variable, m.det / w.det AS vif, n AS n_obs FROM entries e JOIN w_det w USING (grp, bu) JOIN d{j}_det m USING (grp, bu) WHERE w.det > 1e-9 AND ok_{j} AND (" + " + ".join(f"ok_{i}::INT" for i in range(k)) + ") >= 2")
    return _with_prepared(f"SELECT * FROM (WITH {', '.join(steps)} SELECT Product_Group, BU, variable, {reported}, n_obs FROM ({' UNION ALL '.join(selects)}))")


def _swept(k: int) -> str:
    """Common table expressions that sweep the correlations r of entries as inflation_factors does: the largest pivot first, only pivots above 1e-10.

    swept has m, the inverse where done holds for all columns. spread has the ends of the eigenvalues, from squares of r and m.
    """
    at = lambda m, i, j: f"{m}[({i}) * {k} + {j} + 1]"
    times = lambda a, b: f"list_transform(range({k * k}), lambda e: list_sum(list_transform(range({k}), lambda x: {at(a, f'e // {k}', 'x')} * {at(b, 'x', f'e % {k}')})))"
    trace = lambda m: f"list_sum(list_transform(range({k}), lambda y: {at(m, 'y', 'y')}))"
    scaled = lambda m: f"list_transform({m}, lambda v: v / {trace(m)})"
    value = (
        f"CASE WHEN e // {k} = p AND e % {k} = p THEN 1 / d WHEN e // {k} = p THEN m[e + 1] / d WHEN e % {k} = p THEN -m[e + 1] / d"
        f" ELSE m[e + 1] - {at('m', f'e // {k}', 'p')} * {at('m', 'p', f'e % {k}')} / d END"
    )
    return f"""sweeps AS (
  SELECT grp, bu, n, ok, r, r AS m, list_transform(range({k}), lambda i: false) AS done, 0 AS step FROM entries
  UNION ALL SELECT grp, bu, n, ok, r, CASE WHEN d > 1e-10 THEN list_transform(range({k * k}), lambda e: {value}) ELSE m END,
    list_transform(range({k}), lambda i: done[i + 1] OR (d > 1e-10 AND i = p)), step + 1
  FROM (SELECT *, list_max(pivots) AS d, list_position(pivots, list_max(pivots)) - 1 AS p FROM (
    SELECT *, list_transform(range({k}), lambda i: CASE WHEN done[i + 1] THEN -1.0::DOUBLE ELSE {at('m', 'i', 'i')} END) AS pivots FROM sweeps WHERE step < {k}))),
swept AS (SELECT * FROM sweeps WHERE step = {k}),
squares AS (
  SELECT grp, bu, r, m, {scaled('r')} AS a, {scaled('m')} AS b, 0 AS step FROM swept WHERE list_bool_and(done)
  UNION ALL SELECT grp, bu, r, m, {scaled('aa')}, {scaled('bb')}, step + 1 FROM (SELECT *, {times('a', 'a')} AS aa, {times('b', 'b')} AS bb FROM squares WHERE step < 14)),
spread AS (
  SELECT grp, bu, {trace('ra')} / {trace('a')} AS most, {trace('b')} / {trace('mb')} AS least
  FROM (SELECT *, {times('r', 'a')} AS ra, {times('m', 'b')} AS mb FROM squares WHERE step = 14))"""


def _swept_vif_sql(columns: list[str], reported: str, prepared: str = "prepared") -> str:
    """Inflation factors of the series without tied columns, by the rule of diagnostics.inflation; columns that do not vary have a unit row."""
    k = len(columns)
    ok = [f"(count({c}) >= 12 AND min({c}) <> max({c}))" for c in columns]
    entry = lambda i, j: "1.0::DOUBLE" if i == j else f"CASE WHEN {ok[i]} AND {ok[j]} THEN corr({columns[i]}, {columns[j]}) ELSE 0 END"
    entries = ", ".join(entry(min(i, j), max(i, j)) for i in range(k) for j in range(k))
    names = ", ".join(f"'{c}'" for c in columns)
    return f"""SELECT * FROM (WITH RECURSIVE entries AS (SELECT grp, bu, count(*) AS n, [{", ".join(ok)}] AS ok, [{entries}] AS r FROM {prepared} GROUP BY grp, bu),
{_swept(k)}
SELECT Product_Group, BU, variable, {reported}, n_obs FROM (
  SELECT grp AS Product_Group, bu AS BU, [{names}][i + 1] AS variable, m[i * {k + 1} + 1] AS vif, n AS n_obs
  FROM swept JOIN spread USING (grp, bu), (SELECT unnest(range({k})) AS i) WHERE least > 1e-12 * most AND ok[i + 1] AND len(list_filter(ok, lambda x: x)) >= 2))"""


@query(_with_prepared(_swept_vif_sql(list(FEATURES), "round(vif, 3) AS vif")))
def vif_all_features(spark: SparkSession, folder: str) -> DataFrame:
    """All six features of series without tied ones: the sweep operator in Spark and in SQL."""
    out = diagnostics.vif_report(_prepared(spark, folder), list(FEATURES), 12).filter("vif is not null and condition_number < double('infinity')")
    return _rounded(out.select(*KEY, "variable", "vif", "n_obs"), 3)


def _stored(spark: SparkSession, folder: str, columns: list[str]) -> DataFrame:
    """A store filled by three batches: even months, then odd ones, in which a part of the groups comes late."""
    data = kept(_prepared(spark, folder).select(*KEY, "Date", *columns))
    even, late = F.month("Date") % 2 == 0, F.crc32(F.col("Product_Group").cast("binary")) % 2 == 1
    store = f"{shared_folder(spark)}/moments-{uuid.uuid4()}"
    for batch, rows in (("even", even), ("odd", ~even & ~late), ("late", ~even & late)):
        moment_store.add_facts(data.filter(rows), columns, store, batch, KEY)
    return moment_store.read_store(spark, store, KEY)


@query()
def stored_correlation(spark: SparkSession, folder: str) -> DataFrame:
    """Correlations merged from a store of monthly moments equal those of all rows."""
    columns = ["Revenue", "Quantity", "New_Quotes"]
    store = _stored(spark, folder, [*columns, "Actual_Quantity"])
    return _rounded(moment_store.merged_correlations(store, columns, 12, "Actual_Quantity", KEY))


ORACLES["stored_correlation"] = ORACLES["pairwise_correlation"]


@query(_with_prepared(_swept_vif_sql(list(FEATURES), "round(vif, 3) AS vif")))
def stored_vif(spark: SparkSession, folder: str) -> DataFrame:
    """Inflation factors of all six features from a store of monthly moments."""
    moments = moment_store.merged_moments(_stored(spark, folder, list(FEATURES)), list(FEATURES), 12, KEY)
    out = diagnostics.vif_of_moments(moments, list(FEATURES), KEY).filter("vif is not null and condition_number < double('infinity')")
    return _rounded(out.select(*KEY, "variable", "vif", "n_obs"), 3)


_TIED = ["Revenue", "Quantity", "New_Quotes"]


@query(
    "SELECT Product_Group, BU, variable, CASE WHEN variable = 'Quantity' THEN 'Infinity'::DOUBLE ELSE vif END AS vif, n_obs, 'Infinity'::DOUBLE AS condition_number FROM ("
    + _vif_sql(_TIED, "round(vif, 4) AS vif").replace("SELECT * FROM (WITH prepared", "SELECT * FROM (WITH prepared", 1)
    + ") UNION ALL SELECT Product_Group, BU, 'Quantity_Twice', 'Infinity'::DOUBLE, n_obs, 'Infinity'::DOUBLE FROM ("
    + _vif_sql(_TIED, "vif")
    + ") WHERE variable = 'Quantity'"
)
def vif_tied_features(spark: SparkSession, folder: str) -> DataFrame:
    """A feature and its double are infinite; the others are as without the double. Series whose quantity varies."""
    data = _prepared(spark, folder).withColumn("Quantity_Twice", 2 * F.col("Quantity"))
    out = diagnostics.vif_report(data, [*_TIED, "Quantity_Twice"], 12).filter("vif is not null")
    return _rounded(out.select(*KEY, "variable", "vif", "n_obs", "condition_number"), 4)


_CONDITION = """SELECT grp AS Product_Group, bu AS BU, round(sqrt((1 + abs(r13)) / (1 - abs(r13))), 4) AS of_two,
  round(sqrt((1 + 2 * sqrt(p) * cos(phi)) / (1 + 2 * sqrt(p) * cos(phi + 2 * pi() / 3))), 3) AS of_three FROM (
  SELECT *, acos(greatest(-1, least(1, r12 * r13 * r23 / power(p, 1.5)))) / 3 AS phi FROM (
    SELECT *, (r12 * r12 + r13 * r13 + r23 * r23) / 3 AS p FROM (
      SELECT grp, bu, corr(Revenue, Quantity) AS r12, corr(Revenue, New_Quotes) AS r13, corr(Quantity, New_Quotes) AS r23 FROM prepared GROUP BY grp, bu
      HAVING count(*) >= 12 AND min(Revenue) <> max(Revenue) AND min(Quantity) <> max(Quantity) AND min(New_Quotes) <> max(New_Quotes))))"""


@query(_with_prepared(_CONDITION))
def condition_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Of two and of three features, by Jacobi rotations in Spark against the closed forms."""
    data = kept(_prepared(spark, folder).select(*KEY, "Date", *_TIED))
    reports = [diagnostics.vif_report(data, columns, 12).filter("vif is not null") for columns in (["Revenue", "New_Quotes"], _TIED)]
    two, three = (r.groupBy(*KEY).agg(F.first("condition_number").alias(name), F.count("*").alias(f"_{name}")) for r, name in zip(reports, ("of_two", "of_three"), strict=True))
    both = two.join(three, list(KEY)).filter("_of_two = 2 and _of_three = 3")
    return both.select(*KEY, F.round("of_two", 4).alias("of_two"), F.round("of_three", 3).alias("of_three"))


_LJUNG = """centred AS (SELECT *, v - avg(v) OVER (PARTITION BY grp, bu) AS x FROM numbered),
products AS (
  SELECT a.grp, a.bu, a.n, k, sum(a.x * b.x) AS s FROM centred a, (SELECT unnest(range(1, 25)) AS k) JOIN centred b ON a.grp = b.grp AND a.bu = b.bu AND b.rn = a.rn - k GROUP BY ALL),
squares AS (SELECT grp, bu, sum(x * x) AS v FROM centred GROUP BY ALL),
sums AS (
  SELECT grp, bu, n, k AS lag, sum(power(s / nullif(v, 0), 2) / (n - k)) OVER (PARTITION BY grp, bu ORDER BY k) * n * (n + 2) AS q
  FROM products JOIN squares USING (grp, bu)),
tails AS (
  SELECT grp, bu, n, lag, q, q / 2 AS x, CASE WHEN lag % 2 = 0 THEN exp(-q / 2) * list_sum(list_transform(range(0, lag // 2), lambda j: power(q / 2, j) / gamma(j + 1)))
    ELSE CASE WHEN q > 80 THEN 0 ELSE 1 - 2 / sqrt(pi()) * list_sum(list_transform(range(0, 400), lambda m: exp(-q / 2 + 0.5 * ln(q / 2) + m * ln(q) - lgamma(2 * m + 2) + m * ln(2) + lgamma(m + 1)))) END
      + coalesce(exp(-q / 2) * list_sum(list_transform(range(1, (lag - 1) // 2 + 1), lambda j: power(q / 2, j - 0.5) / gamma(j + 0.5))), 0) END AS p
  FROM sums)"""


@query(f"SELECT * FROM (WITH {_LJUNG} SELECT grp AS Product_Group, bu AS BU, n, lag::INT AS lag, round(q, 5) AS statistic, round(p, 6) AS p_value FROM tails)")
def ljung_box_lags(spark: SparkSession, folder: str) -> DataFrame:
    """At lags 1 to 24, odd ones too."""
    out = metrics.ljung_box_lags(_dense(spark, folder), range(1, 25), "Actuals").filter("n > lag")
    return out.select(*KEY, "n", "lag", F.round("statistic", 5).alias("statistic"), F.round("p_value", 6).alias("p_value"))


@query(
    f"""SELECT * FROM (WITH {_LJUNG} SELECT grp AS Product_Group, bu AS BU, any_value(n) AS n, round(min(p), 6) AS p_value
FROM tails WHERE lag IN (1, 3, 6, 12, 23) GROUP BY grp, bu)"""
)
def ljung_box_least(spark: SparkSession, folder: str) -> DataFrame:
    """The least probability of several lags, which is what a report tells."""
    out = metrics.ljung_box(_dense(spark, folder), (1, 3, 6, 12, 23), "Actuals")
    return out.filter("p_value is not null").select(*KEY, "n", F.round("p_value", 6).alias("p_value"))


@query(
    """SELECT 'actuals' AS source, unnest(['read', 'no_date', 'bad_date', 'no_unit', 'no_group']) AS reason,
  unnest([count(*), count(*) FILTER (actuals % 10 = 3), count(*) FILTER (actuals % 10 = 3), count(*) FILTER (actuals % 10 <> 3 AND bu = 'MI'),
    count(*) FILTER (actuals % 10 <> 3 AND bu <> 'MI' AND part NOT IN (SELECT part FROM part_groups))])::BIGINT AS rows FROM v_actuals
UNION ALL SELECT 'pipeline', unnest(['read', 'no_date', 'no_group', 'no_unit', 'unit_not_listed', 'loaded']),
  unnest([count(*), count(*) FILTER (Quantity % 10 = 3), count(*) FILTER (Quantity % 10 <> 3 AND grp IS NULL), count(*) FILTER (Quantity % 10 = 7 AND grp IS NOT NULL),
    count(*) FILTER (Quantity % 10 NOT IN (3, 7) AND grp IS NOT NULL AND bu = 'AF'), count(*) FILTER (Quantity % 10 NOT IN (3, 7) AND grp IS NOT NULL AND bu <> 'AF')])::BIGINT FROM mapped
UNION ALL SELECT 'backlog', unnest(['read', 'no_date', 'no_unit', 'no_group']),
  unnest([count(*), count(*) FILTER (backlog % 10 = 3), count(*) FILTER (backlog % 10 = 7),
    count(*) FILTER (backlog % 10 NOT IN (3, 7) AND part NOT IN (SELECT part FROM part_groups))])::BIGINT FROM v_backlog"""
)
def run_counts(spark: SparkSession, folder: str) -> DataFrame:
    """What a run reads and drops, counted while it sums: some facts have no date, some no unit, one unit is not listed."""
    counters, catalog = Counters(), _catalog(spark, folder)
    digit = lambda c: F.col(c).cast("int") % 10
    sold = star.actuals(spark, folder)
    sold = sold.withColumns({"Month": F.when(digit("Actuals") == 3, "someday").otherwise(F.col("Month").cast("string")), "BU": F.when(F.col("BU") == "MI", " ").otherwise(F.col("BU"))})
    kept(series.monthly_demand(series.clean_actuals(sold), catalog.skus, keep_blank_bu=False, counters=counters))
    asked = star.pipeline(spark, folder)
    asked = asked.withColumns({"Timestamp": F.when(digit("Quantity") != 3, F.col("Timestamp").cast("date").cast("string")), "BU": F.when(digit("Quantity") != 7, F.col("BU"))})
    listed = replace(catalog, units=catalog.units.filter("BU <> 'AF'"))
    kept(features.pipeline_monthly(features.load_pipeline(asked, listed, star.reference(spark, folder), counters=counters)))
    owed = star.backlog(spark, folder)
    owed = owed.withColumns({"Month": F.when(digit("Backlog") != 3, F.col("Month").cast("string")).otherwise("-"), "BU": F.when(digit("Backlog") != 7, F.col("BU")).otherwise("")})
    kept(features.backlog_monthly(owed, catalog.skus, counters=counters))
    return counters.table(spark)


@query(
    """SELECT l_returnflag, l_linestatus, count(*)::INT AS n_notes, string_agg(note, '; ' ORDER BY first, note) AS notes FROM (
  SELECT l_returnflag, l_linestatus, note, min(position) AS first FROM (
    SELECT l_returnflag, l_linestatus, l_orderkey * 10 + l_linenumber AS position,
      CASE WHEN l_quantity % 7 = 0 THEN 'discount of ' || (l_orderkey % 11) WHEN l_quantity % 7 = 1 THEN 'line ' || l_linenumber END AS note FROM lineitem)
  WHERE note IS NOT NULL GROUP BY ALL) GROUP BY ALL"""
)
def notes_of_series(spark: SparkSession, folder: str) -> DataFrame:
    """Notes that repeat on most lines of a few series, each told once, in the order of its first line."""
    kind = F.col("l_quantity").cast("int") % 7
    note = F.when(kind == 0, F.concat(F.lit("discount of "), (F.col("l_orderkey") % 11).cast("string"))).when(kind == 1, F.concat(F.lit("line "), F.col("l_linenumber").cast("string")))
    lines = star.table(spark, folder, "lineitem").select("l_returnflag", "l_linestatus", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("position"), note.alias("note"))
    return notes_in_order(lines, ("l_returnflag", "l_linestatus"))


@query(
    """SELECT coalesce(reason, 'kept') AS reason, count(*) AS rows, sum(o_orderkey)::BIGINT AS keys FROM (
  SELECT o_orderkey, CASE WHEN o_orderkey % 20 IN (3, 4) THEN 'number of fields' WHEN o_orderkey % 20 = 5 THEN 'no date' END AS reason FROM orders) GROUP BY ALL"""
)
def quarantined_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Orders written as text, some lines short, some long, some without a date: what is kept, and what is set aside and why."""
    path = f"{shared_folder(spark)}/orders-{uuid.uuid4()}"
    at = F.col("o_orderkey") % 20
    fields = [F.col("o_orderkey").cast("string"), F.when(at == 5, "soon").otherwise(F.col("o_orderdate").cast("date").cast("string")), F.col("o_totalprice").cast("string")]
    line = F.when(at == 3, F.concat_ws(",", *fields[:2])).when(at == 4, F.concat_ws(",", *fields, F.lit("more"))).otherwise(F.concat_ws(",", *fields))
    lines = star.table(spark, folder, "orders").select(line.alias("value"), "o_orderkey")
    # Each file begins with a header, as exports in parts do.
    parts = lines.select("value", F.spark_partition_id().alias("part"), F.lit(1).alias("nr"))
    heads = parts.select("part").distinct().select(F.lit("key,day,price").alias("value"), "part", F.lit(0).alias("nr"))
    parts.unionByName(heads).repartition("part").sortWithinPartitions("part", "nr").select("value", "part").write.partitionBy("part").text(path)
    good, rejected = readers.read_checked(spark, f"{path}/*", {"no date": lambda df: F.try_to_timestamp("day").isNull()})
    sides = good.select(F.lit("kept").alias("reason"), F.col("key").cast("long").alias("key")), rejected.select("reason", F.split("line", ",")[0].cast("long").alias("key"))
    return sides[0].unionByName(sides[1]).groupBy("reason").agg(F.count("*").alias("rows"), F.sum("key").alias("keys"))


@query("SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'Größe ' WHEN 1 THEN 'café ' ELSE 'plain ' END || c_name AS c_name FROM customer")
def mixed_encodings(spark: SparkSession, folder: str) -> DataFrame:
    """Customers in files of two encodings in one folder, read without being told which is which."""
    path, at = f"{shared_folder(spark)}/customers-{uuid.uuid4()}", F.col("c_custkey") % 3
    named = star.table(spark, folder, "customer").select("c_custkey", F.concat(F.when(at == 0, "Größe ").when(at == 1, "café ").otherwise("plain "), "c_name").alias("c_name"))
    for rest, encoding in ((0, "UTF-8"), (1, "ISO-8859-1")):
        named.filter(F.col("c_custkey") % 2 == rest).write.mode("append").csv(path, header=True, encoding=encoding)
    return readers.read_table(spark, path, readers.AUTO).select(F.col("c_custkey").cast("long").alias("c_custkey"), "c_name")


_NAIVE = """cut AS (SELECT grp, bu, d, v FROM demand WHERE d <= DATE '2001-06-01'),
months AS (
  SELECT g.grp, g.bu, g.d, v, row_number() OVER w - 1 AS rn, count(*) OVER (PARTITION BY g.grp, g.bu) AS n, max(g.d) OVER (PARTITION BY g.grp, g.bu) AS last
  FROM (SELECT grp, bu, unnest(range(min(d), max(d) + INTERVAL 1 MONTH, INTERVAL 1 MONTH))::DATE AS d FROM cut GROUP BY grp, bu) g
  LEFT JOIN cut c ON g.grp = c.grp AND g.bu = c.bu AND g.d = c.d WINDOW w AS (PARTITION BY g.grp, g.bu ORDER BY g.d)),
trained AS (SELECT m.*, phase, n - held AS train FROM months m, (VALUES ('holdout', 6), ('full', 0)) p (phase, held) WHERE n >= 12 AND rn < n - held),
changes AS (
  SELECT a.grp, a.bu, a.phase, avg(a.v - b.v) AS drift, stddev_samp(a.v - b.v) AS deviation FROM trained a JOIN trained b
  ON a.grp = b.grp AND a.bu = b.bu AND a.phase = b.phase AND b.rn = a.rn - 12 WHERE a.v - b.v IS NOT NULL GROUP BY ALL HAVING count(*) >= 2),
places AS (SELECT grp, bu, phase, n, train, last, rn % 12 AS place, arg_max(v, rn) AS v, max(rn) AS seen FROM trained WHERE v IS NOT NULL GROUP BY ALL),
fits AS (
  SELECT grp, bu, phase FROM places JOIN changes USING (grp, bu, phase) GROUP BY ALL HAVING count(*) = 12 AND max(train - seen) <= 12),
fitted AS (
  SELECT grp, bu, phase, n, last, t, v + k * drift AS f, 1.2815515655446004 * deviation * sqrt(k) AS width FROM (
    SELECT p.*, drift, deviation, t, (t - seen) / 12 AS k FROM places p JOIN fits USING (grp, bu, phase) JOIN changes USING (grp, bu, phase), unnest(range(train, n + 12)) AS s (t)
    WHERE t % 12 = place)),
pairs AS (SELECT f.grp, f.bu, v AS a, f FROM fitted f JOIN months m ON m.grp = f.grp AND m.bu = f.bu AND m.rn = f.t WHERE phase = 'holdout' AND v IS NOT NULL),
measures AS (
  SELECT grp, bu, avg(f - a) / nullif(avg(a), 0) * 100 AS bias, sum(abs(f - a)) / nullif(sum(abs(a)), 0) * 100 AS mae, sqrt(avg((f - a) * (f - a))) AS rmse,
    avg(CASE WHEN a <> 0 THEN abs((f - a) / a) END) * 100 AS mape, stddev_pop(a) / nullif(abs(avg(a)), 0) * 100 AS cov FROM pairs GROUP BY ALL),
chosen AS (SELECT * FROM fitted f WHERE t >= n AND (phase = 'full' OR NOT EXISTS (FROM fits x WHERE x.grp = f.grp AND x.bu = f.bu AND x.phase = 'full')))"""


@query(
    f"""SELECT * FROM (WITH {_NAIVE} SELECT grp AS Product_Group, bu AS BU, coalesce(name, '') AS BU_Name, 'SEASONAL_NAIVE' AS Model_Type,
  'Seasonal naive with drift (12)' AS Model_Used, 'N/A' AS SARIMA_Params, 'None' AS Exogenous_Used, strftime(last + to_months((t - n + 1)::INT), '%Y-%m') AS Date,
  round_even(greatest(f, 0), 0) AS Forecast, round_even(greatest(f - width, 0), 0) AS Lower_CI, round_even(greatest(f + width, 0), 0) AS Upper_CI,
  round_even(mae, 2) AS "MAE%", round_even(bias, 2) AS "Bias%", round_even(rmse, 2) AS RMSE, round_even(mape, 2) AS MAPE, round_even(cov, 2) AS CoV
FROM chosen LEFT JOIN measures USING (grp, bu) LEFT JOIN units ON code = bu)"""
)
def naive_forecast_report(spark: SparkSession, folder: str) -> DataFrame:
    """All columns of the report, by a model that Spark folds over each series: holdout, refit, and the holdout's
    forecast for series of which a month of the last year is missing, so that they have no refit."""
    fitted, _ = naive_phases(_demand(spark, folder), SETTINGS, max_age=12)
    return phase_report(kept(fitted), _catalog(spark, folder).unit_names, SETTINGS)[0]


@query(
    f"""SELECT * FROM (WITH {_NAIVE}, short AS (SELECT grp, bu, any_value(n) AS n FROM months GROUP BY ALL)
SELECT grp AS Product_Group, bu AS BU, n, CASE WHEN n < 12 THEN 'insufficient data' WHEN full_ THEN 'full' WHEN held THEN 'holdout' ELSE 'no fit' END AS outcome FROM (
  SELECT s.*, EXISTS (FROM fits x WHERE x.grp = s.grp AND x.bu = s.bu AND phase = 'full') AS full_, EXISTS (FROM fits x WHERE x.grp = s.grp AND x.bu = s.bu AND phase = 'holdout') AS held
  FROM short s))"""
)
def naive_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    """What becomes of each series: too short, forecast by its refit, by its holdout's fit, or not at all."""
    cut = kept(series.prepared_series(_demand(spark, folder), SETTINGS))
    fitted, short = naive_phases(cut, SETTINGS, max_age=12)
    fits = fitted.groupBy(*KEY).agg(F.bool_or(F.col("phase") == "full").alias("_full"))
    rows = series.series_lengths(cut).join(short.select(*KEY, "reason"), list(KEY), "left").join(fits, list(KEY), "left")
    outcome = F.coalesce("reason", F.when(F.col("_full"), "full").when(~F.col("_full"), "holdout").otherwise("no fit"))
    return rows.select(*KEY, "n", outcome.alias("outcome"))


@query(ORACLES["actuals_with_features"].partition(star.SQL_VIEWS.strip())[2].strip())
def stores_that_meet(spark: SparkSession, folder: str) -> DataFrame:
    """Demand and pipeline features in bucketed stores: four months are written wrong at first, and then again."""
    name, late = uuid.uuid4().hex, (F.col("Date") >= "1999-11-01") & (F.col("Date") < "2000-03-01")
    pipe, demand, buckets = kept(_pipe(spark, folder).select(*KEY, "Date", "Revenue", "Quantity")), kept(_demand(spark, folder)), 4
    stores = []
    for kind, rows, values in (("actuals", demand, ["Actuals"]), ("features", pipe, ["Revenue", "Quantity"])):
        table = f"{kind}_{name}"
        stores.append(series_store.open_store(spark, table, values, f"{shared_folder(spark)}/{table}", buckets))
        wrong = rows.withColumns({v: F.when(late, -1.0).otherwise(F.col(v)) for v in values})
        series_store.replace_months(wrong, table, buckets)
        series_store.replace_months(rows.filter(late), table, buckets)
    return _rounded(series_store.meet(*(spark.table(f"{kind}_{name}") for kind in ("actuals", "features"))), 2)
