"""Report merge, date windows, set operations and report documents.

The running report counts finished and open orders per day and priority; the delta counts pending orders of
the last years, with dates in another pattern and columns in another order.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegauge.operators import merge as M
from tidegauge.plans.queries import query, table
from tidegauge.schemas import MergeConfig, StorageConfig
from tidegauge.session import ensure_checkpoint_dir
from tidegauge.sources.reports import write_report

PATTERN = "dd-MM-yyyy"
_REPORT_SQL = """
  report AS (SELECT strftime(o_orderdate, '%d-%m-%Y') AS "Date", o_orderpriority AS priority, CAST(count(*) AS VARCHAR) AS orders
    FROM orders WHERE o_orderstatus <> 'P' GROUP BY ALL),
  delta AS (SELECT strftime(o_orderdate, '%d-%m-%Y') AS "Date", o_orderpriority AS priority, CAST(count(*) AS VARCHAR) AS orders
    FROM orders WHERE o_orderstatus = 'P' AND o_orderdate >= DATE '1999-06-01' GROUP BY ALL)
"""
_UPSERT_SQL = """
  merged AS (SELECT DISTINCT * FROM report WHERE "Date" NOT IN (SELECT "Date" FROM delta) UNION ALL SELECT * FROM delta)
"""
_DAY = "strptime(\"Date\", '%d-%m-%Y')"


def _counts(spark, sf_dir, condition, pattern, columns):
    orders = table(spark, sf_dir, "orders").where(condition)
    return (
        orders.groupBy(F.date_format("o_orderdate", pattern).alias("Date"), F.col("o_orderpriority").alias("priority"))
        .agg(F.count(F.lit(1)).cast("string").alias("orders"))
        .select(*columns)
    )


def _report(spark, sf_dir):
    return _counts(spark, sf_dir, F.col("o_orderstatus") != "P", PATTERN, ["Date", "priority", "orders"])


def _delta(spark, sf_dir):
    """Delta as it arrives: ISO dates, another column order, an extra column, every row twice."""
    pending = (F.col("o_orderstatus") == "P") & (F.col("o_orderdate") >= F.lit("1999-06-01").cast("timestamp"))
    rows = _counts(spark, sf_dir, pending, "yyyy-MM-dd", ["orders", "priority", "Date"]).withColumn("extra", F.lit("x"))
    return rows.unionByName(rows)


def _merged(spark, sf_dir, **config):
    spec = MergeConfig(**{"rollup": 1, "rollup_col": "Date||%d-%m-%Y", "dims": ("Date", "priority"), **config})
    name, pattern = M.rollup_spec(spec)
    delta = M.normalise_delta(_delta(spark, sf_dir), name, pattern)
    return M.merge_report(_report(spark, sf_dir), delta, spec)


@query("merge_delta_normalise", f"""WITH {_REPORT_SQL} SELECT "Date", priority, orders, 'x' AS extra FROM delta""")
def merge_delta_normalise(spark, sf_dir):
    return M.normalise_delta(_delta(spark, sf_dir), "Date", PATTERN)


@query("merge_upsert", f"WITH {_REPORT_SQL}, {_UPSERT_SQL} SELECT * FROM merged")
def merge_upsert(spark, sf_dir):
    return _merged(spark, sf_dir)


@query("merge_upsert_dims", f"""WITH {_REPORT_SQL}
  SELECT DISTINCT * FROM report r WHERE NOT EXISTS (SELECT 1 FROM delta d WHERE d."Date" = r."Date" AND d.priority = r.priority)
  UNION ALL SELECT * FROM delta""")
def merge_upsert_dims(spark, sf_dir):
    return _merged(spark, sf_dir, rollup_col=None, rollup_format=PATTERN)


@query("merge_replaced_rows", f"""WITH {_REPORT_SQL} SELECT DISTINCT r.* FROM report r SEMI JOIN delta d USING ("Date")""")
def merge_replaced_rows(spark, sf_dir):
    delta = M.normalise_delta(_delta(spark, sf_dir), "Date", PATTERN)
    return M.replaced_rows(_report(spark, sf_dir), delta, ["Date"])


@query("merge_except", f"""WITH {_REPORT_SQL}, p AS (SELECT priority, orders FROM report)
  SELECT * FROM p EXCEPT SELECT priority, orders FROM delta""")
def merge_except(spark, sf_dir):
    report = _report(spark, sf_dir).select("priority", "orders")
    delta = _delta(spark, sf_dir).select("priority", "orders")
    return M.kept_rows(report, delta, ["priority", "orders"])


@query("merge_replace", f"""WITH {_REPORT_SQL} SELECT "Date", priority, orders, 'x' AS extra FROM delta""")
def merge_replace(spark, sf_dir):
    return _merged(spark, sf_dir, rollup=0)


def _window(name, age, count, start):
    @query(name, f"""WITH {_REPORT_SQL}, {_UPSERT_SQL}, m AS (SELECT max({_DAY}) AS latest FROM merged)
      SELECT merged.* FROM merged, m WHERE {_DAY} >= {start}""")
    def run(spark, sf_dir):
        return _merged(spark, sf_dir, rollup_age=age, rollup_range=count)


_window(
    "merge_rollup_academic_year", "ACADEMIC_YEAR", 2,
    "make_date(year(latest) - CASE WHEN month(latest) <= 5 THEN 1 ELSE 0 END - 1, 6, 1)",
)
_window("merge_rollup_year", "GEN_YEAR", 2, "make_date(year(latest) - 1, 1, 1)")
_window("merge_rollup_month", "MONTH", 14, "date_trunc('month', latest) - INTERVAL 13 MONTH")
_window("merge_rollup_week", "WEEK", 6, "date_trunc('week', latest) - INTERVAL 35 DAY")
_window("merge_rollup_day", "DAY", 45, "latest - INTERVAL 44 DAY")
_window("merge_rollup_all", "NONE", 1, "DATE '1970-01-01'")


@query("merge_undated", f"""WITH {_REPORT_SQL}, r AS (
    SELECT CASE WHEN CAST(orders AS INT) > 1 AND priority = '5-LOW' THEN 'no date' WHEN priority = '2-HIGH' THEN NULL ELSE "Date" END AS "Date",
      priority, orders FROM report),
  merged AS (SELECT DISTINCT * FROM r WHERE "Date" IS NULL OR "Date" NOT IN (SELECT "Date" FROM delta) UNION ALL SELECT * FROM delta),
  m AS (SELECT max(try_strptime("Date", '%d-%m-%Y')) AS latest FROM merged)
  SELECT merged.* FROM merged, m WHERE try_strptime("Date", '%d-%m-%Y') IS NULL OR try_strptime("Date", '%d-%m-%Y') >= latest - INTERVAL 399 DAY""")
def merge_undated(spark, sf_dir):
    """Rows without a readable date stay in the report whatever the window."""
    date = F.when((F.col("orders").cast("int") > 1) & (F.col("priority") == "5-LOW"), "no date").when(
        F.col("priority") != "2-HIGH", F.col("Date")
    )
    spec = MergeConfig(1, ("Date", "priority"), "DAY", 400, "Date||%d-%m-%Y")
    delta = M.normalise_delta(_delta(spark, sf_dir), "Date", PATTERN)
    return M.merge_report(_report(spark, sf_dir).withColumn("Date", date), delta, spec)


@query("distinct_dims", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def distinct_dims(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderpriority").distinct()


@query("report_json", f"""WITH {_REPORT_SQL}
  SELECT "Date", priority, CASE WHEN TRY_CAST(orders AS INT) > 1 THEN orders || '.50' ELSE '0' END AS orders FROM report""")
def report_json(spark, sf_dir):
    """Documents of the report, unfolded again: every row once, null numbers as 0, plain decimals kept."""
    report = _report(spark, sf_dir).withColumn(
        "orders", F.when(F.col("orders").cast("int") > 1, F.concat("orders", F.lit(".50")))
    )
    documents = M.report_documents(report, ["priority", "orders", "Date"], ["orders"], rows_per_document=1000)
    return documents.select(F.explode("data").alias("row")).select(
        F.col("row")["Date"].alias("Date"), F.col("row")["priority"].alias("priority"), F.col("row")["orders"].alias("orders")
    )


@query("report_documents", f"""WITH {_REPORT_SQL}, r AS (
    SELECT *, row_number() OVER (ORDER BY "Date", priority, orders) - 1 AS number FROM report)
  SELECT count(*) AS n, 'priority,orders,Date' AS keys, md5(string_agg(priority || ',' || orders || ',' || "Date", ';' ORDER BY number)) AS digest
  FROM r GROUP BY number // 1000""")
def report_documents(spark, sf_dir):
    """The documents themselves: their sizes, keys and table rows in order."""
    documents = M.report_documents(_report(spark, sf_dir), ["priority", "orders", "Date"], rows_per_document=1000)
    rows = F.transform("tableData", lambda cells: F.array_join(cells, ","))
    return documents.select(
        F.size("tableData").cast("bigint").alias("n"), F.array_join("keys", ",").alias("keys"),
        F.md5(F.array_join(rows, ";").cast("binary")).alias("digest"),
    )


@query("report_plain_numbers", """
  SELECT p_partkey, CAST(p_size * 100 + p_partkey % 100 AS VARCHAR) AS shifted, CAST(p_size AS VARCHAR) || '.'
    || lpad(CAST(p_partkey % 100 AS VARCHAR), 2, '0') AS kept FROM part""")
def report_plain_numbers(spark, sf_dir):
    kept = F.concat(
        F.col("p_size").cast("string"), F.lit("."), F.lpad((F.col("p_partkey") % 100).cast("string"), 2, "0")
    )
    return table(spark, sf_dir, "part").select(
        "p_partkey", M.plain_number(F.concat(kept, F.lit("E2"))).alias("shifted"), M.plain_number(kept).alias("kept")
    )


@query("report_files_by_dims", """
  SELECT o_orderstatus || '/' || o_orderpriority AS file, count(*) AS rows, sum(o_orderkey) AS keys FROM orders GROUP BY 1""")
def report_files_by_dims(spark, sf_dir):
    """Orders written as one CSV per status and priority, then read back file by file."""
    home = f"{ensure_checkpoint_dir(spark)}/report-files"
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority")
    paths = write_report(
        orders, StorageConfig("local", None, home), "csv", "orders", {"header": "true"},
        dims=["o_orderstatus", "o_orderpriority"], column_order=["o_orderdate", "o_orderkey"],
    )
    rows = spark.read.option("header", True).csv(paths)
    file = F.regexp_extract(F.col("_metadata.file_path"), r"/orders/(.+?)\.csv", 1)
    return rows.groupBy(F.url_decode(file).alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("o_orderkey").cast("bigint")).alias("keys")
    )
