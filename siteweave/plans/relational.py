"""Queries over the order and event tables: unions, joins, pivots, windows and JSON, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteweave.operators import analytics
from siteweave.operators.lookups import range_lookup
from siteweave.schemas import conform
from siteweave.sources.filings import month_windows as windows
from siteweave.plans.catalogue import Catalogue
from siteweave.storage import table

catalogue = Catalogue()
query = catalogue.query
QUERIES, SQL = catalogue.queries, catalogue.sql


@query("""
SELECT 'customer' AS source, CAST(c_custkey AS VARCHAR) AS source_id, c_name AS name, c_mktsegment AS operator_raw, CAST(NULL AS DOUBLE) AS lat, false AS is_building FROM customer
UNION ALL SELECT 'supplier', CAST(s_suppkey AS VARCHAR), s_name, NULL, NULL, false FROM supplier
""")
def conform_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables in the common record shape, missing columns null."""
    a = table(spark, sf_dir, "customer").select(F.lit("customer").alias("source"), F.col("c_custkey").alias("source_id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("operator_raw"))
    b = table(spark, sf_dir, "supplier").select(F.lit("supplier").alias("source"), F.col("s_suppkey").alias("source_id"), F.col("s_name").alias("name"))
    return conform(a).unionByName(conform(b)).select("source", "source_id", "name", "operator_raw", "lat", "is_building")


@query("SELECT c_nationkey, count(*) AS n FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O') GROUP BY 1")
def semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with an open order."""
    opened = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "O").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf_dir, "customer").join(opened, "c_custkey", "left_semi").groupBy("c_nationkey").agg(F.count("*").alias("n"))


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')")
def anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers without an urgent order."""
    urgent = table(spark, sf_dir, "orders").where(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf_dir, "customer").join(urgent, "c_custkey", "left_anti").select("c_custkey", "c_name")


@query("SELECT o_custkey, count(*) AS lines, sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18, 4)))::DOUBLE AS revenue FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1")
def inner_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue per customer; lines are summed per order before the join's shuffle by customer."""
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("c"), F.sum((F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("decimal(18,4)")).alias("r"))
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(lines, "o_orderkey").groupBy("o_custkey").agg(F.sum("c").alias("lines"), F.sum("r").cast("double").alias("revenue"))


@query("SELECT s_suppkey, coalesce(n, 0) AS lines, round(coalesce(q, 0), 2) AS quantity FROM supplier LEFT JOIN (SELECT l_suppkey, count(*) AS n, sum(l_quantity) AS q FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) ON l_suppkey = s_suppkey")
def left_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers with their returned lines, zero where there are none."""
    lines = table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.count("*").alias("n"), F.sum("l_quantity").alias("q"))
    return table(spark, sf_dir, "supplier").select("s_suppkey").join(lines, "s_suppkey", "left").select("s_suppkey", F.coalesce("n", F.lit(0)).alias("lines"), F.round(F.coalesce("q", F.lit(0.0)), 2).alias("quantity"))


@query("SELECT p_partkey, name AS size_class FROM part LEFT JOIN (VALUES (1, 10, 'small'), (11, 30, 'middle'), (31, 45, 'large')) AS r(low, high, name) ON p_size BETWEEN low AND high")
def range_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of a size range, null in the gaps."""
    ranges = spark.createDataFrame([(1, 10, "small"), (11, 30, "middle"), (31, 45, "large")], "low int, high int, name string")
    return range_lookup(table(spark, sf_dir, "part").select("p_partkey", "p_size"), F.col("p_size"), ranges, "low", "high", "name", "size_class").select("p_partkey", "size_class")


@query("""
SELECT l_returnflag, round(coalesce(sum(l_quantity) FILTER (l_linestatus = 'F'), 0), 2) AS "F", round(coalesce(sum(l_quantity) FILTER (l_linestatus = 'O'), 0), 2) AS "O" FROM lineitem GROUP BY 1
""")
def pivot_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantities by flag and status, zero where there are none."""
    wide = table(spark, sf_dir, "lineitem").groupBy("l_returnflag").pivot("l_linestatus", ["F", "O"]).agg(F.round(F.sum("l_quantity"), 2))
    return wide.na.fill(0.0, ["F", "O"])


@query("SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.25), 4) AS p25, round(quantile_cont(l_extendedprice, 0.5), 4) AS median, round(quantile_cont(l_extendedprice, 0.75), 4) AS p75 FROM lineitem GROUP BY 1")
def price_quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact quartiles by linear interpolation."""
    q = F.percentile("l_extendedprice", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(q.alias("q")).select("l_returnflag", F.round(F.col("q")[0], 4).alias("p25"), F.round(F.col("q")[1], 4).alias("median"), F.round(F.col("q")[2], 4).alias("p75"))


@query("SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2")
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by a field of their JSON text."""
    rows = table(spark, sf_dir, "events").withColumn("k", F.from_json("props", "k BIGINT")["k"])
    return rows.groupBy("k", "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("SELECT o_orderkey, o_custkey || '-' || (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1) AS unique_id FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 1) UNION ALL SELECT max(o_orderkey), CAST(o_custkey AS VARCHAR) FROM orders GROUP BY o_custkey HAVING count(*) = 1")
def numbered_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suffixes from 0 for keys that occur several times."""
    return analytics.numbered_ids(table(spark, sf_dir, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"]).select("o_orderkey", "unique_id")


@query("SELECT user_id, event_type, arg_min(event_id, struct_pack(t := ts, e := event_id)) AS event_id, min(ts) AS ts FROM events GROUP BY 1, 2")
def keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first event of each user and type."""
    return analytics.keep_first(table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "ts"), ["user_id", "event_type"], ["ts", "event_id"])


@query("""
WITH w AS (SELECT unnest(generate_series(DATE '1995-03-01', DATE '1996-02-15', INTERVAL 1 MONTH)) AS s), x AS (SELECT CAST(s AS DATE) AS window_start, least(last_day(CAST(s AS DATE)), DATE '1996-02-15') AS window_end FROM w)
SELECT CAST(window_start AS VARCHAR) AS window_start, CAST(window_end AS VARCHAR) AS window_end, count(o_orderkey) AS orders FROM x LEFT JOIN orders ON CAST(o_orderdate AS DATE) BETWEEN window_start AND window_end GROUP BY 1, 2
""")
def month_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar months clipped to the end, with the orders in each; orders are counted per day first."""
    days = table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("d")).agg(F.count("*").alias("n"))
    months = windows(spark, "1995-03-01", "1996-02-15")
    return months.join(days, F.col("d").between(F.col("window_start"), F.col("window_end")), "left").groupBy(F.col("window_start").cast("string").alias("window_start"), F.col("window_end").cast("string").alias("window_end")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orders"))


@query("SELECT l_suppkey, round(sum(l_extendedprice), 2) AS total FROM lineitem GROUP BY 1 ORDER BY sum(l_extendedprice) DESC, l_suppkey LIMIT 16")
def topk_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2: the sixteen suppliers with most turnover."""
    by = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.sum("l_extendedprice").alias("t"))
    return by.orderBy(F.desc("t"), "l_suppkey").limit(16).select("l_suppkey", F.round("t", 2).alias("total"))


@query("SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour, event_type, count(*) AS rows FROM events GROUP BY 1, 2")
def window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streaming aggregate run as a batch: tumbling windows of an hour."""
    from siteweave.streaming.feed import deliveries_by_window

    out = deliveries_by_window(table(spark, sf_dir, "events"), "ts", ["event_type"], "1 hour")
    return out.select(F.col("window.start").alias("hour"), "event_type", "rows")


@query("""
SELECT n_name, o_orderpriority, count(*) AS orders, sum(CAST(o_totalprice AS DECIMAL(18, 2)))::DOUBLE AS total FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 2
""")
def nation_priorities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by nation and priority; orders are pre-aggregated per customer before they meet the dimensions."""
    per = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey"), "o_orderpriority").agg(F.count("*").alias("c"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("s"))
    who = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return per.join(who, "c_custkey").groupBy("n_name", "o_orderpriority").agg(F.sum("c").alias("orders"), F.sum("s").cast("double").alias("total"))
