"""Filter language, sorting and scans."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegauge.functions.values import to_json_text
from tidegauge.operators import filters as O
from tidegauge.operators import workflow
from tidegauge.plans.queries import k_of, query, table, telemetry
from tidegauge.schemas import Filter, Sort
from tidegauge.sources.readers import parse_lines

# Events with gaps: kind is null for every fifth k and empty for every seventh.
_GAPPY_SQL = """
  SELECT event_id, user_id, k, value, CASE WHEN k % 5 = 0 THEN NULL WHEN k % 7 = 0 THEN '' ELSE event_type END AS kind
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)
"""


def _gappy(spark, sf_dir):
    k = k_of()
    kind = F.when(k % 5 == 0, None).when(k % 7 == 0, "").otherwise(F.col("event_type"))
    return table(spark, sf_dir, "events").select("event_id", "user_id", k.alias("k"), "value", kind.alias("kind"))


def _on_gappy(name, operator, value, condition):
    @query(name, f"SELECT event_id, kind, k FROM ({_GAPPY_SQL}) WHERE {condition}")
    def run(spark, sf_dir):
        return O.filter_events(_gappy(spark, sf_dir), Filter("kind", operator, value)).select("event_id", "kind", "k")


_on_gappy("flt_eq", "EQ", "click", "kind = 'click'")
_on_gappy("flt_eq_none", "EQ", None, "false")
_on_gappy("flt_ne", "NE", "click", "kind IS NOT NULL AND kind <> 'click'")
_on_gappy("flt_ne_none", "NE", None, "kind IS NOT NULL")
_on_gappy("flt_in", "IN", ["click", "view"], "kind IN ('click', 'view')")
_on_gappy("flt_nin", "NIN", ["click", "view"], "kind IS NULL OR kind NOT IN ('click', 'view')")
_on_gappy("flt_nin_no_list", "NIN", "click", "false")
_on_gappy("flt_isnull", "ISNULL", None, "kind IS NULL")
_on_gappy("flt_isnotnull", "ISNOTNULL", None, "kind IS NOT NULL")
_on_gappy("flt_isempty", "ISEMPTY", None, "kind IS NULL OR kind = ''")
_on_gappy("flt_isnotempty", "ISNOTEMPTY", None, "kind IS NOT NULL AND kind <> ''")


@query("flt_range_num", "SELECT event_id, value FROM events WHERE value BETWEEN 10 AND 50")
def flt_range_num(spark, sf_dir):
    df = table(spark, sf_dir, "events")
    return O.filter_events(df, Filter("value", "RANGE", {"start": 10, "end": 50})).select("event_id", "value")


@query(
    "flt_range_date",
    "SELECT o_orderkey FROM orders WHERE o_orderdate > DATE '1996-01-01' AND o_orderdate < DATE '1997-01-01'",
)
def flt_range_date(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return O.filter_events(
        df, Filter("o_orderdate", "RANGE", {"start": "1996-01-01", "end": "1997-01-01"})
    ).select("o_orderkey")


@query("flt_range_text", "SELECT o_orderkey FROM orders WHERE false")
def flt_range_text(spark, sf_dir):
    df = table(spark, sf_dir, "orders")
    return O.filter_events(df, Filter("o_orderpriority", "RANGE", {"start": "1", "end": "3"})).select("o_orderkey")


@query("flt_lt", "SELECT event_id, value FROM events WHERE value < 5.5")
def flt_lt(spark, sf_dir):
    return O.filter_events(table(spark, sf_dir, "events"), Filter("value", "LT", 5.5)).select("event_id", "value")


@query("flt_lt_date", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_shipdate < DATE '1995-06-01'")
def flt_lt_date(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return O.filter_events(df, Filter("l_shipdate", "LT", "1995-06-01")).select("l_orderkey", "l_linenumber")


@query(
    "flt_conj",
    f"SELECT event_id FROM ({_GAPPY_SQL}) WHERE (kind IS NULL OR kind NOT IN ('error')) AND value BETWEEN 5 AND 100 AND k < 60",
)
def flt_conj(spark, sf_dir):
    specs = [
        Filter("kind", "NIN", ["error"]),
        Filter("value", "RANGE", {"start": 5, "end": 100}),
        Filter("k", "LT", 60),
    ]
    return O.filter_events(_gappy(spark, sf_dir), specs).select("event_id")


@query(
    "flt_nested_json",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events"
    " WHERE json_extract_string(props, '$.k') IN ('3', '7', '11')",
)
def flt_nested_json(spark, sf_dir):
    df = table(spark, sf_dir, "events").withColumn("edata", F.from_json("props", "k int"))
    return O.filter_events(df, Filter("edata.k", "IN", [3, 7, 11])).select("event_id", F.col("edata.k").alias("k"))


@query(
    "flt_array_in",
    "SELECT p_partkey FROM part WHERE list_contains(string_split(p_name, ' '), 'red')"
    " AND list_contains(string_split(p_name, ' '), 'ring')",
)
def flt_array_in(spark, sf_dir):
    df = table(spark, sf_dir, "part").withColumn("words", F.split("p_name", " "))
    return O.filter_events(df, Filter("words", "IN", ["red", "ring"])).select("p_partkey")


@query(
    "flt_array_nin",
    "SELECT p_partkey FROM part WHERE NOT (list_contains(string_split(p_name, ' '), 'red')"
    " AND list_contains(string_split(p_name, ' '), 'ring'))",
)
def flt_array_nin(spark, sf_dir):
    df = table(spark, sf_dir, "part").withColumn("words", F.split("p_name", " "))
    return O.filter_events(df, Filter("words", "NIN", ["red", "ring"])).select("p_partkey")


@query(
    "flt_array_elements",
    "SELECT p_partkey, array_to_string(list_filter(string_split(p_name, ' '), lambda w: w <> 'red'), ' ') AS words FROM part",
)
def flt_array_elements(spark, sf_dir):
    df = table(spark, sf_dir, "part").withColumn("words", F.split("p_name", " "))
    kept = O.filter_array(F.col("words"), df.schema["words"].dataType.elementType, "NE", "red")
    return df.select("p_partkey", F.array_join(kept, " ").alias("words"))


@query(
    "flt_aliases",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events"
    " WHERE event_type = 'view' AND user_id IS NOT NULL AND CAST(json_extract_string(props, '$.k') AS INT) < 20"
    " AND epoch_us(ts) // 1000000 BETWEEN 1704067200 AND 1705276800",
)
def flt_aliases(spark, sf_dir):
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    df = table(spark, sf_dir, "events").select(
        "event_id", F.col("event_type").alias("eid"), F.col("user_id").alias("uid"), text.alias("ts"),
        text.alias("@timestamp"),
        F.struct(F.struct(k_of().alias("qid")).alias("eks")).alias("edata"),
    )
    span = {"start": 1704067200000, "end": 1705276800000}
    specs = [
        Filter("eventId", "EQ", "view"), Filter("userId", "ISNOTNULL"), Filter("itemId", "LT", 20),
        Filter("ts", "RANGE", span), Filter("eventts", "RANGE", span), Filter("ts", "ISNOTNULL"),
    ]
    return O.filter_events(df, specs).select("event_id", F.col("edata.eks.qid").alias("k"))


@query(
    "flt_matches",
    f"SELECT event_id, CASE WHEN kind = 'click' AND k < 50 THEN 1 ELSE 0 END AS matched FROM ({_GAPPY_SQL})",
)
def flt_matches(spark, sf_dir):
    df = O.matches(_gappy(spark, sf_dir), [Filter("kind", "EQ", "click"), Filter("k", "LT", 50)])
    return df.select("event_id", F.col("matches").cast("int").alias("matched"))


@query("flt_function", "SELECT event_id FROM events WHERE value * 2 > 100")
def flt_function(spark, sf_dir):
    df = table(spark, sf_dir, "events")
    return O.filter_with(df, 100, lambda rows, value: rows["value"] * 2 > value).select("event_id")


@query("sort_as_string", "SELECT o_orderkey, o_orderpriority FROM orders ORDER BY CAST(o_orderkey AS VARCHAR)")
def sort_as_string(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return O.sort_events(df, Sort("o_orderkey"))


@query(
    "filter_and_sort",
    "SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'error') ORDER BY event_type DESC",
)
def filter_and_sort(spark, sf_dir):
    df = table(spark, sf_dir, "events").select("event_id", "event_type")
    return O.filter_and_sort(df, [Filter("event_type", "IN", ["click", "error"])], Sort("event_type", "desc"))


@query(
    "scan_json_lines",
    "SELECT event_id, event_type AS eid, value FROM events WHERE CAST(json_extract_string(props, '$.k') AS INT) % 9 <> 0",
)
def scan_json_lines(spark, sf_dir):
    """Events written as JSON lines and scanned again; every ninth line is broken and dropped."""
    df = table(spark, sf_dir, "events").withColumn("eid", F.col("event_type"))
    line = to_json_text(F.struct("event_id", "eid", "value", "props"))
    lines = df.select(F.when(k_of() % 9 == 0, F.concat(F.lit("{broken"), line)).otherwise(line).alias("value"))
    return parse_lines(lines, "event_id bigint, eid string, value double")


@query(
    "scan_row_counts",
    "SELECT count(*) AS lines, count(CASE WHEN event_type <> 'error' THEN 1 END) AS kept FROM events",
)
def scan_row_counts(spark, sf_dir):
    df = table(spark, sf_dir, "events")
    return df.agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(O.predicate(df, Filter("event_type", "NE", "error"))).alias("kept"),
    )


@query(
    "unwrap_envelopes",
    "SELECT eid, count(*) AS n, sum(k) AS k FROM (SELECT CASE event_type WHEN 'signup' THEN 'START' WHEN 'purchase' THEN 'END'"
    " WHEN 'click' THEN 'INTERACT' WHEN 'view' THEN 'IMPRESSION' END AS eid,"
    " CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events WHERE event_type <> 'error') GROUP BY eid",
)
def unwrap_envelopes(spark, sf_dir):
    """Events in three kinds of envelope; errors become server LOG events and are left out."""
    df = telemetry(spark, sf_dir)
    event = F.struct(
        F.when(F.col("eid") == "ASSESS", "LOG").otherwise(F.col("eid")).alias("eid"),
        F.col("ets"), F.col("mid"), F.struct(F.col("k").cast("double").alias("duration")).alias("edata"),
    )
    line = (
        F.when(F.col("k") % 3 == 0, to_json_text(F.struct(event.alias("event"))))
        .when(F.col("k") % 3 == 1, to_json_text(F.struct(event.alias("events"))))
        .otherwise(to_json_text(event))
    )
    events = workflow.client_events(workflow.read_events(df.select(line.alias("value"))))
    return events.groupBy("eid").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("edata.duration").cast("bigint")).alias("k")
    )
