"""The four input tables, and their catalog, read from a TPC-H-like star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CURRENT_MONTH = "2001-06-01"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _region_of(rows: DataFrame, spark: SparkSession, folder: str, side: str, key: str) -> DataFrame:
    """rows with r_name of their supplier or customer; dimensions are small enough for Spark to broadcast, or it shuffles."""
    short = side[0]
    places = table(spark, folder, side).select(F.col(f"{short}_{key}").alias("_k"), F.col(f"{short}_nationkey").alias("n_nationkey"))
    nations = table(spark, folder, "nation").select("n_nationkey", F.col("n_regionkey").alias("r_regionkey"))
    return rows.join(places, "_k").join(nations, "n_nationkey").join(table(spark, folder, "region").select("r_regionkey", "r_name"), "r_regionkey").drop("_k", "n_nationkey", "r_regionkey")


def actuals(spark: SparkSession, folder: str) -> DataFrame:
    """(Product, Month, BU, Actuals); SKUs in three spellings."""
    lines = table(spark, folder, "lineitem").select(F.col("l_suppkey").alias("_k"), "l_partkey", "l_shipdate", "l_quantity")
    n = F.col("l_partkey").cast("string")
    spelt = F.when(F.col("l_partkey") % 3 == 0, F.concat(F.lit("prod_"), n)).when(F.col("l_partkey") % 3 == 1, F.concat(F.lit(" Prod_"), n, F.lit(" "))).otherwise(F.concat(F.lit("PROD_"), n))
    return _region_of(lines, spark, folder, "supplier", "suppkey").select(spelt.alias("Product"), F.trunc(F.col("l_shipdate").cast("date"), "MM").alias("Month"), F.substring("r_name", 1, 2).alias("BU"), F.col("l_quantity").alias("Actuals"))


def catalog(spark: SparkSession, folder: str) -> DataFrame:
    """A group per brand and one bundle that lists some parts again; one brand without an order, one without a period."""
    part = table(spark, folder, "part").select("p_partkey", "p_brand")
    sku = F.concat(F.lit("Prod_"), F.col("p_partkey").cast("string"))
    lists = part.groupBy(F.col("p_brand").alias("group_key")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", sku.alias("sku")))), lambda x: x["sku"]), "|").alias("sku_list"))
    bundle = part.filter("p_partkey % 50 = 0").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", sku.alias("sku")))), lambda x: x["sku"]), "|").alias("sku_list")).select(F.lit("Bundle").alias("group_key"), "sku_list")
    number = F.regexp_extract("group_key", r"#(\d+)", 1).try_cast("int")
    units = table(spark, folder, "region").agg(F.array_sort(F.collect_list(F.struct(F.substring("r_name", 1, 2).alias("code"), F.col("r_name").alias("name")))).alias("units"))
    out = lists.union(bundle).join(F.broadcast(units))  # one row
    digit = lambda v: F.when(number == 7, "").otherwise(v)
    order = {"sarima_p": "1", "sarima_d": "1", "sarima_q": "1", "seas_p": "0", "seas_d": "1", "seas_q": "1"}
    return out.select(
        F.coalesce(number.cast("long"), F.lit(1_000_000)).alias("row_id"), "group_key", "sku_list",
        F.array_join(F.transform("units", lambda x: x["code"]), "|").alias("business_unit_code"), F.array_join(F.transform("units", lambda x: x["name"]), "|").alias("business_unit_name"),
        F.when(number % 3 == 0, "quantity").when(number % 3 == 1, "dollars").otherwise("default").alias("salesforce_feature_mode"),
        *[digit(F.lit(v)).alias(c) for c, v in order.items()], digit(F.when(number == 9, "0").otherwise("12")).alias("sarima_s"),
        F.when(number % 4 == 0, "2").when(number % 4 == 1, "default:1|EU:3").when(number % 4 == 2, "x:y|3").otherwise("").alias("sf_quantity_lag"),
        F.when(number % 2 == 0, "default:2").otherwise("AS:1").alias("sf_revenue_lag"),
    )


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """(Timestamp, SF_Product_Name, BU, six features); names in five forms and some that no group has.

    Orders get their units, and parts their names, before lines meet them: lines move by order and by part only.
    """
    k, n = F.col("p_partkey"), F.col("p_partkey").cast("string")
    name = (
        F.when(k % 17 == 0, F.concat(F.lit("UNKNOWN-"), n)).when(k % 5 == 0, F.col("p_name")).when(k % 5 == 1, F.concat(F.lit("  "), F.upper("p_name"), F.lit(" ")))
        .when(k % 5 == 2, F.lower("p_brand")).when(k % 5 == 3, F.concat(F.lit("Prod_"), n)).otherwise(F.concat(F.lit("Prod_ "), n))
    )
    part = table(spark, folder, "part").select("p_partkey", name.alias("SF_Product_Name"))
    code = F.substring("r_name", 1, 2)
    unit = F.when(F.col("o_custkey") % 3 == 0, code).when(F.col("o_custkey") % 3 == 1, F.col("r_name")).otherwise(F.lower(code))
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("_k"), "o_custkey", "o_orderstatus", "o_orderdate")
    orders = _region_of(orders, spark, folder, "customer", "custkey").select("l_orderkey", "o_orderstatus", "o_orderdate", unit.alias("BU"))
    lines = table(spark, folder, "lineitem").select("l_orderkey", F.col("l_partkey").alias("p_partkey"), "l_quantity", "l_extendedprice")
    rows = lines.join(orders, "l_orderkey").join(part, "p_partkey")
    opened = F.col("o_orderstatus") == "O"
    return rows.select(
        F.col("o_orderdate").alias("Timestamp"), "SF_Product_Name", "BU", F.col("l_extendedprice").alias("Revenue"), F.col("l_quantity").alias("Quantity"),
        F.when(F.col("o_orderstatus") == "P", 1.0).otherwise(0.0).alias("Open_Opportunities"), F.lit(1.0).alias("New_Quotes"),
        F.when(opened, F.col("l_extendedprice")).otherwise(0.0).alias("Revenue_new_orders"), F.when(opened, F.col("l_quantity")).otherwise(0.0).alias("Quantity_new_orders"),
    )


def reference(spark: SparkSession, folder: str) -> DataFrame:
    """(row_id, salesforce_product_name, group_key): one row per part name and brand, ordered by both."""
    pairs = table(spark, folder, "part").select(F.col("p_name").alias("salesforce_product_name"), F.col("p_brand").alias("group_key")).distinct()
    return pairs.withColumn("row_id", F.struct("salesforce_product_name", "group_key"))


def backlog(spark: SparkSession, folder: str) -> DataFrame:
    """(Product, Month, BU, Backlog, raw_data) of open lines."""
    lines = table(spark, folder, "lineitem").filter("l_linestatus = 'O'").select(F.col("l_suppkey").alias("_k"), "l_partkey", "l_shipdate", "l_quantity", "l_extendedprice")
    rows = _region_of(lines, spark, folder, "supplier", "suppkey")
    return rows.select(F.concat(F.lit("ITEM_"), F.col("l_partkey").cast("string")).alias("Product"), F.trunc(F.col("l_shipdate").cast("date"), "MM").alias("Month"), F.substring("r_name", 1, 2).alias("BU"), F.col("l_quantity").alias("Backlog"), F.col("l_extendedprice").alias("raw_data"))


#: The same tables for DuckDB, as common table expressions. part_groups lists (grp, part) with fan-out; first_groups has
#: one group per part; named resolves pipeline names.
SQL_VIEWS = """
units AS (SELECT left(r_name, 2) AS code, r_name AS name FROM region),
brands AS (SELECT DISTINCT p_brand AS grp, CAST(regexp_extract(p_brand, '#([0-9]+)', 1) AS INT) AS number FROM part),
groups AS (
  SELECT grp, number, CASE number % 3 WHEN 0 THEN 'quantity' WHEN 1 THEN 'dollars' ELSE 'default' END AS mode, number <> 9 AS usable, 'brand' AS kind FROM brands WHERE number <> 7
  UNION ALL SELECT 'Bundle', NULL, 'default', true, 'bundle'),
part_groups AS (
  SELECT p_brand AS grp, p_partkey AS part FROM part WHERE p_brand <> 'Brand#7'
  UNION ALL SELECT 'Bundle', p_partkey FROM part WHERE p_partkey % 50 = 0),
first_groups AS (SELECT part, coalesce(max(grp) FILTER (grp <> 'Bundle'), max(grp)) AS grp FROM part_groups GROUP BY part),
v_actuals AS (
  SELECT l_partkey AS part, CASE l_partkey % 3 WHEN 0 THEN 'prod_' || l_partkey WHEN 1 THEN ' Prod_' || l_partkey || ' ' ELSE 'PROD_' || l_partkey END AS product,
         date_trunc('month', l_shipdate)::DATE AS d, left(r_name, 2) AS bu, l_quantity AS actuals
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
v_backlog AS (
  SELECT l_partkey AS part, date_trunc('month', l_shipdate)::DATE AS d, left(r_name, 2) AS bu, l_quantity AS backlog, l_extendedprice AS raw
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE l_linestatus = 'O'),
v_pipeline AS (
  SELECT p_partkey AS part, date_trunc('month', o_orderdate)::DATE AS d, o_orderdate AS at, left(r_name, 2) AS bu, o_custkey % 3 AS bu_form, r_name,
         CASE WHEN p_partkey % 17 = 0 THEN 'UNKNOWN-' || p_partkey WHEN p_partkey % 5 = 0 THEN p_name WHEN p_partkey % 5 = 1 THEN '  ' || upper(p_name) || ' '
              WHEN p_partkey % 5 = 2 THEN lower(p_brand) WHEN p_partkey % 5 = 3 THEN 'Prod_' || p_partkey ELSE 'Prod_ ' || p_partkey END AS name,
         p_partkey % 17 = 0 AS unknown, p_partkey % 5 AS form, p_name, p_brand, l_extendedprice AS Revenue, l_quantity AS Quantity,
         CASE WHEN o_orderstatus = 'P' THEN 1.0::DOUBLE ELSE 0 END AS Open_Opportunities, 1.0::DOUBLE AS New_Quotes,
         CASE WHEN o_orderstatus = 'O' THEN l_extendedprice ELSE 0 END AS Revenue_new_orders, CASE WHEN o_orderstatus = 'O' THEN l_quantity ELSE 0 END AS Quantity_new_orders
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
v_reference AS (SELECT DISTINCT p_name, p_brand FROM part),
first_reference AS (SELECT p_name, min(p_brand) AS grp FROM v_reference WHERE p_brand <> 'Brand#7' GROUP BY p_name),
mapped AS (
  SELECT v.*, CASE WHEN unknown THEN NULL WHEN form IN (0, 1) THEN r.grp WHEN form = 2 THEN nullif(v.p_brand, 'Brand#7') ELSE f.grp END AS grp
  FROM v_pipeline v LEFT JOIN first_reference r ON v.p_name = r.p_name LEFT JOIN first_groups f ON v.part = f.part),
demand AS (SELECT grp, bu, d, sum(actuals) AS v FROM v_actuals JOIN part_groups USING (part) GROUP BY ALL),
pipe AS (
  SELECT grp, bu, d, sum(Revenue) AS Revenue, sum(Quantity) AS Quantity, sum(Open_Opportunities) AS Open_Opportunities, sum(New_Quotes) AS New_Quotes,
         sum(Revenue_new_orders) AS Revenue_new_orders, sum(Quantity_new_orders) AS Quantity_new_orders
  FROM mapped WHERE grp IS NOT NULL GROUP BY ALL),
pipe_ends AS (SELECT grp, bu, min(d) AS a, greatest(max(d), DATE '2001-06-01') AS b FROM pipe GROUP BY ALL),
pipe_grid AS (
  SELECT g.grp, g.bu, g.d, coalesce(Revenue, 0) AS Revenue, coalesce(Quantity, 0) AS Quantity, coalesce(Open_Opportunities, 0) AS Open_Opportunities,
         coalesce(New_Quotes, 0) AS New_Quotes, coalesce(Revenue_new_orders, 0) AS Revenue_new_orders, coalesce(Quantity_new_orders, 0) AS Quantity_new_orders
  FROM (SELECT grp, bu, unnest(range(a, b + INTERVAL 1 MONTH, INTERVAL 1 MONTH))::DATE AS d FROM pipe_ends) g LEFT JOIN pipe p ON g.grp = p.grp AND g.bu = p.bu AND g.d = p.d),
backlog_month AS (SELECT grp, bu, d, sum(backlog) AS v FROM v_backlog JOIN part_groups USING (part) GROUP BY ALL),
backlog_grid AS (
  SELECT g.grp, g.bu, g.d, coalesce(p.v, 0) AS v
  FROM (SELECT grp, bu, unnest(range(a, DATE '2002-07-01', INTERVAL 1 MONTH))::DATE AS d FROM (SELECT grp, bu, min(d) AS a FROM backlog_month GROUP BY ALL) WHERE a <= DATE '2002-06-01') g
  LEFT JOIN backlog_month p ON g.grp = p.grp AND g.bu = p.bu AND g.d = p.d),
backlog_feat AS (
  SELECT grp, bu, d, v AS Backlog, coalesce(lag(v, 1) OVER w, 0) AS Backlog_Lag1, coalesce(lag(v, 3) OVER w, 0) AS Backlog_Lag3,
         avg(v) OVER (PARTITION BY grp, bu ORDER BY d ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS Backlog_MA3
  FROM backlog_grid WINDOW w AS (PARTITION BY grp, bu ORDER BY d)),
dense AS (
  SELECT g.grp, g.bu, g.d, coalesce(s.v, 0) AS v
  FROM (SELECT grp, bu, unnest(range(min(d), max(d) + INTERVAL 1 MONTH, INTERVAL 1 MONTH))::DATE AS d FROM demand GROUP BY grp, bu) g
  LEFT JOIN demand s ON g.grp = s.grp AND g.bu = s.bu AND g.d = s.d),
numbered AS (SELECT *, row_number() OVER (PARTITION BY grp, bu ORDER BY d) AS rn, count(*) OVER (PARTITION BY grp, bu) AS n FROM dense)
"""
