"""Scans, column shaping, joins, aggregates, profiles and sorts."""

from __future__ import annotations

from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import operators as op
from ..functions import day_of_week, hour_of_day, weekday
from ..operators import prepare_pair
from ..sources import read_csv, register, run_sql, store_buckets, write_csv
from .registry import Inputs, query, rounded, wall_clock

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
LINE_NUMBERS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
LINE_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

# The tables hold no nulls, so the null queries read a view with some.
GAPS = "(SELECT event_id, nullif(event_type, 'error') AS event_type, "
GAPS += "CASE WHEN event_type <> 'error' THEN value END AS value FROM events)"

GAPS_TEXT = "(SELECT user_id, nullif(event_type, 'error') AS event_type FROM events)"


def events_with_gaps(t: Inputs) -> DataFrame:
    return t("events").select(
        "event_id",
        F.nullif("event_type", F.lit("error")).alias("event_type"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("value"),
    )


# --- sources and sinks -------------------------------------------------------


@query("csv_typed_scan", "SELECT * FROM customer")
def csv_typed_scan(t):
    path = t.scratch("customer-csv")
    customer = t("customer")
    write_csv(customer, path)
    return read_csv(t.spark, path, customer.schema)


@query("csv_headerless_scan", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def csv_headerless_scan(t):
    """Header lines arrive as rows with nulls, which dropping incomplete rows removes."""
    path = t.scratch("orders-csv")
    orders = t("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    write_csv(orders, path)
    return op.drop_incomplete_rows(read_csv(t.spark, path, orders.schema, header=False))


@query(
    "csv_headerless_gaps",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice
       FROM (SELECT *, nullif(o_orderstatus, 'P') AS status FROM orders) WHERE status IS NOT NULL""",
)
def csv_headerless_gaps(t):
    """Rows with an empty field go with the header lines."""
    path = t.scratch("orders-csv")
    orders = t("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    orders = orders.withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("P")))
    write_csv(orders, path)
    return op.drop_incomplete_rows(read_csv(t.spark, path, orders.schema, header=False))


@query(
    "csv_malformed_lines",
    """SELECT c_custkey, c_name, CASE WHEN c_custkey % 4 <> 3 THEN c_nationkey END AS c_nationkey,
              CASE WHEN c_custkey % 4 <> 1 THEN c_mktsegment END AS c_mktsegment, c_custkey % 4 <> 0 AS malformed
       FROM customer""",
)
def csv_malformed_lines(t):
    """Lines that are whole, lack a field, have one too many, or hold a text for a number."""
    path = t.scratch("customer-lines")
    customer = t("customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    kind = F.col("c_custkey") % 4
    nation = F.when(kind == 3, F.lit("none")).otherwise(F.col("c_nationkey").cast("string"))
    fields = F.concat_ws(",", F.col("c_custkey").cast("string"), "c_name", nation)
    line = F.when(kind == 1, fields).otherwise(F.concat_ws(",", fields, "c_mktsegment", F.when(kind == 2, F.lit("more"))))
    customer.select(line.alias("line")).write.text(path)
    rows = read_csv(t.spark, path, customer.schema, header=False, malformed="malformed")
    return rows.withColumn("malformed", F.col("malformed").isNotNull())


@query(
    "csv_inferred_scan",
    """SELECT p_partkey, p_name, p_brand, p_type, CAST(p_size AS BIGINT) AS p_size,
              p_retailprice
       FROM part""",
)
def csv_inferred_scan(t):
    """Inference picks int or bigint by the values, so whole numbers are made bigint."""
    path = t.scratch("part-csv")
    write_csv(t("part"), path)
    inferred = read_csv(t.spark, path)
    return inferred.withColumns(
        {c: F.col(c).cast("bigint") for c in ("p_partkey", "p_size")}
    )


# --- projections, filters, column shaping ------------------------------------


@query("projection", "SELECT p_name, p_brand, p_size FROM part")
def projection(t):
    return op.project(t("part"), ["p_name", "p_brand", "p_size"])


RATIO_SQL = "SELECT p_partkey, p_retailprice / nullif(p_size, 0) AS density FROM part"


@query("ratio_column", RATIO_SQL)
def ratio_column(t):
    rated = op.with_ratio(t("part"), "p_retailprice", "p_size", "density")
    return rated.select("p_partkey", "density")


@query("ratio_column_sql", RATIO_SQL)
def ratio_column_sql(t):
    return run_sql(
        t.spark,
        "SELECT p_partkey, try_divide(p_retailprice, p_size) AS density FROM {waymark_part}",
        waymark_part=t("part"),
    )


@query(
    "renamed_columns",
    """SELECT s_suppkey AS supplier_id, s_name AS supplier_name, s_nationkey, s_acctbal
       FROM supplier""",
)
def renamed_columns(t):
    names = {"s_suppkey": "supplier_id", "s_name": "supplier_name", "absent": "unused"}
    return op.rename_columns(t("supplier"), names)


@query("renamed_by_position", "SELECT n_nationkey AS id, n_name AS name, n_regionkey AS region FROM nation")
def renamed_by_position(t):
    return op.rename_all(t("nation"), ["id", "name", "region"])


@query("dropped_columns", "SELECT event_id, user_id, event_type, value FROM events")
def dropped_columns(t):
    return op.drop_columns(t("events"), ["ts", "props"])


@query(
    "drop_incomplete",
    f"SELECT * FROM {GAPS} WHERE event_type IS NOT NULL AND value IS NOT NULL",
)
def drop_incomplete(t):
    return op.drop_incomplete_rows(events_with_gaps(t), ["event_type", "value"])


@query(
    "fill_and_cast",
    f"""SELECT event_id, event_type, CAST(trunc(coalesce(value, 0)) AS INTEGER) AS value
        FROM {GAPS}""",
)
def fill_and_cast(t):
    return op.fill_and_cast(events_with_gaps(t), {"value": 0}, {"value": "int"})


@query("filter_high", "SELECT event_id, ts, user_id, value FROM events WHERE value > 50")
def filter_high(t):
    high = op.keep_where(t("events"), "value > 50")
    return op.project(high, ["event_id", "ts", "user_id", "value"])


@query("filter_null", f"SELECT event_id FROM {GAPS} WHERE event_type IS NULL")
def filter_null(t):
    return op.keep_null(events_with_gaps(t), "event_type").select("event_id")


@query("numeric_projection", f"SELECT {', '.join(LINE_NUMBERS + LINE_MEASURES)} FROM lineitem")
def numeric_projection(t):
    lineitem = t("lineitem")
    return lineitem.select(*op.numeric_columns(lineitem))


AVERAGES_LONG_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS attribute, round(avg({c}), 4) AS average_value FROM lineitem"
    for c in MEASURES
)


@query("averages_long", AVERAGES_LONG_SQL)
def averages_long(t):
    return rounded(op.averages_long(t("lineitem"), MEASURES), 4, "average_value")


@query("table_shape", "SELECT count(*) AS num_rows, CAST(11 AS INTEGER) AS num_cols FROM lineitem")
def table_shape(t):
    return op.table_shape(t("lineitem"))


@query(
    "extend_rows",
    """SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation, c_acctbal AS balance,
              c_mktsegment AS segment FROM customer
       UNION ALL SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL FROM supplier""",
)
def extend_rows(t):
    customer = op.rename_all(t("customer"), ["id", "name", "nation", "balance", "segment"])
    supplier = op.rename_all(t("supplier"), ["id", "name", "nation", "balance"])
    return op.extend_rows(customer, supplier)


@query(
    "split_field",
    "SELECT c_custkey, string_split(c_name, '#')[2] AS number FROM customer",
)
def split_field(t):
    return op.with_split_field(t("customer"), "c_name", "#", 1, "number").select(
        "c_custkey", "number"
    )


@query(
    "parsed_timestamp",
    """SELECT event_id, ts AS parsed, CAST(hour(ts) AS INTEGER) AS pickup_hour,
              CAST(dayofweek(ts) + 1 AS INTEGER) AS pickup_dayofweek,
              CAST(isodow(ts) - 1 AS INTEGER) AS pickup_weekday
       FROM events""",
)
def parsed_timestamp(t):
    text = t("events").select("event_id", F.col("ts").cast("string").alias("ts"))
    parsed = op.with_parsed_timestamp(text, "ts", "parsed").select(
        "event_id",
        "parsed",
        hour_of_day("parsed").alias("pickup_hour"),
        day_of_week("parsed").alias("pickup_dayofweek"),
        weekday("parsed").alias("pickup_weekday"),
    )
    return wall_clock(parsed, "parsed")


# --- full outer join ---------------------------------------------------------

PAIR_SQL = """
    SELECT l.l_linestatus AS line_status, r.o_orderstatus AS order_status,
           l.l_extendedprice AS line_price, r.o_totalprice AS order_price
    FROM lineitem l FULL OUTER JOIN orders r ON l.l_orderkey = r.o_custkey"""


def pair_sides(t: Inputs) -> tuple[DataFrame, DataFrame]:
    """Two tables with the same column names whose keys repeat and partly differ."""
    names = ["id", "name", "amount"]
    lines = t("lineitem").select("l_orderkey", "l_linestatus", "l_extendedprice")
    orders = t("orders").select("o_custkey", "o_orderstatus", "o_totalprice")
    return op.rename_all(lines, names), op.rename_all(orders, names)


@query("full_outer_pair", PAIR_SQL)
def full_outer_pair(t):
    lines, orders = pair_sides(t)
    return op.full_outer_pair(
        lines,
        orders,
        "id",
        {"name": "line_status", "amount": "line_price"},
        {"name": "order_status", "amount": "order_price"},
    )


PAIR_BUCKETS = 16


@query("full_outer_stored_pair", PAIR_SQL)
def full_outer_stored_pair(t):
    """Both tables stored in buckets of the key, as for joins that are run often."""
    lines, orders = (store_buckets(side, "id", PAIR_BUCKETS) for side in pair_sides(t))
    return op.full_outer_stored(
        lines,
        orders,
        "id",
        {"name": "line_status", "amount": "line_price"},
        {"name": "order_status", "amount": "order_price"},
    )


# Small enough that most keys are hot, so that small tables run the sliced join too.
HOT_ROWS_PER_SLICE = 4


@query(
    "full_outer_hot_pair",
    """SELECT l.o_orderstatus AS order_status, r.event_type AS event_type,
              l.o_totalprice AS order_price, r.value AS event_value
       FROM orders l FULL OUTER JOIN events r ON l.o_custkey = r.user_id""",
)
def full_outer_hot_pair(t):
    names = ["id", "name", "amount"]
    orders = op.rename_all(t("orders").select("o_custkey", "o_orderstatus", "o_totalprice"), names)
    events = op.rename_all(t("events").select("user_id", "event_type", "value"), names)
    return op.full_outer_pair(
        orders,
        events,
        "id",
        {"name": "order_status", "amount": "order_price"},
        {"name": "event_type", "amount": "event_value"},
        rows_per_slice=HOT_ROWS_PER_SLICE,
    )


@query("full_outer_pair_sql", PAIR_SQL)
def full_outer_pair_sql(t):
    lines, orders = pair_sides(t)
    pair = prepare_pair(lines, orders, "id")
    return run_sql(
        t.spark,
        f"""SELECT l.name AS line_status, r.name AS order_status,
                   l.amount AS line_price, r.amount AS order_price
            FROM {{waymark_lines}} l FULL OUTER JOIN {{waymark_orders}} r ON {pair.on}
            WHERE {pair.keep}""",
        waymark_lines=pair.left,
        waymark_orders=pair.right,
    )


# --- aggregates --------------------------------------------------------------

SUMMARY_NAMES = ["total_size", "average_price", "min_size", "max_size", "part_count"]
SUMMARY_SQL = """
    SELECT CAST(sum(p_size) AS BIGINT) AS total_size,
           round(avg(p_retailprice), 4) AS average_price,
           min(p_size) AS min_size, max(p_size) AS max_size,
           count(p_partkey) AS part_count
    FROM part"""


@query("table_summary", SUMMARY_SQL)
def table_summary(t):
    summary = op.table_summary(t("part"), "p_size", "p_retailprice", "p_partkey", SUMMARY_NAMES)
    return rounded(summary, 4, "average_price")


@query("table_summary_sql", SUMMARY_SQL)
def table_summary_sql(t):
    return run_sql(
        t.spark,
        """SELECT sum(p_size) AS total_size, round(avg(p_retailprice), 4) AS average_price,
                  min(p_size) AS min_size, max(p_size) AS max_size,
                  count(p_partkey) AS part_count
           FROM {waymark_part}""",
        waymark_part=t("part"),
    )


def _stats_sql(stat: str) -> str:
    return f"SELECT {', '.join(f'{stat}({c}) AS {stat}_{c}' for c in MEASURES)} FROM lineitem"


AVERAGES_SQL = "SELECT {} FROM lineitem".format(
    ", ".join(f"round(avg({c}), 4) AS avg_{c}" for c in MEASURES)
)


@query("column_averages", AVERAGES_SQL)
def column_averages(t):
    averages = op.column_stats(t("lineitem"), MEASURES, "avg")
    return rounded(averages, 4, *averages.columns)


@query("column_averages_sql", AVERAGES_SQL)
def column_averages_sql(t):
    columns = ", ".join(f"round(avg({c}), 4) AS avg_{c}" for c in MEASURES)
    return run_sql(
        t.spark, f"SELECT {columns} FROM {{waymark_lines}}", waymark_lines=t("lineitem")
    )


@query("column_minima", _stats_sql("min"))
def column_minima(t):
    return op.column_stats(t("lineitem"), MEASURES, "min")


@query("column_maxima", _stats_sql("max"))
def column_maxima(t):
    return op.column_stats(t("lineitem"), MEASURES, "max")


@query("row_total", "SELECT count(*) AS row_count FROM events")
def row_total(t):
    return op.row_count(t("events"))


@query(
    "group_count_desc",
    """SELECT event_type, count(*) AS event_count FROM events
       GROUP BY event_type ORDER BY event_count DESC, event_type""",
)
def group_count_desc(t):
    return op.group_count(t("events"), "event_type", "event_count")


@query(
    "count_by_quantity",
    "SELECT l_quantity, count(*) AS row_count FROM lineitem GROUP BY l_quantity",
)
def count_by_quantity(t):
    return op.count_by(t("lineitem"), "l_quantity")


def average_sql(key: str, name: str, value: str = "value", alias: str = "avg_value") -> str:
    return f"SELECT {key} AS {name}, round(avg({value}), 6) AS {alias} FROM events GROUP BY 1"


HOUR_SQL = average_sql("CAST(hour(ts) AS INTEGER)", "pickup_hour")
DOW_SQL = average_sql("CAST(dayofweek(ts) + 1 AS INTEGER)", "pickup_dayofweek")
WEEKDAY_SQL = average_sql("CAST(isodow(ts) - 1 AS INTEGER)", "pickup_weekday")
TYPE_SQL = average_sql("event_type", "event_type", "user_id", "avg_user")


def average_by(events: DataFrame, part, name: str) -> DataFrame:
    """Average value by a part of the timestamp; for the table and the stream."""
    return op.group_avg(events, part("ts").alias(name), "value", "avg_value")


@query("avg_by_hour", HOUR_SQL)
def avg_by_hour(t):
    return rounded(average_by(t("events"), hour_of_day, "pickup_hour"), 6, "avg_value")


@query("avg_by_dayofweek", DOW_SQL)
def avg_by_dayofweek(t):
    return rounded(average_by(t("events"), day_of_week, "pickup_dayofweek"), 6, "avg_value")


@query("avg_by_weekday", WEEKDAY_SQL)
def avg_by_weekday(t):
    return rounded(average_by(t("events"), weekday, "pickup_weekday"), 6, "avg_value")


@query("avg_by_type", TYPE_SQL)
def avg_by_type(t):
    return rounded(op.group_avg(t("events"), "event_type", "user_id", "avg_user"), 6, "avg_user")


HOURLY_SUM_SQL = """
    SELECT date_trunc('hour', ts) AS start_time,
           date_trunc('hour', ts) + INTERVAL 1 HOUR AS end_time,
           round(sum(value), 2) AS total_value
    FROM events GROUP BY 1, 2"""
TEN_MINUTE_SQL = """
    SELECT time_bucket(INTERVAL '10 minutes', ts) AS start_time,
           time_bucket(INTERVAL '10 minutes', ts) + INTERVAL '10 minutes' AS end_time,
           CAST(sum(user_id) AS BIGINT) AS total_users
    FROM events GROUP BY 1, 2"""


@query("hourly_sum", HOURLY_SUM_SQL)
def hourly_sum(t):
    events = t("events").withColumn("ts", F.col("ts").cast("timestamp"))
    summed = op.window_sum(events, "ts", "1 hour", "value", "total_value")
    return wall_clock(rounded(summed, 2, "total_value"), "start_time", "end_time")


@query("ten_minute_sum", TEN_MINUTE_SQL)
def ten_minute_sum(t):
    events = t("events").withColumn("ts", F.col("ts").cast("timestamp"))
    summed = op.window_sum(events, "ts", "10 minutes", "user_id", "total_users")
    return wall_clock(summed, "start_time", "end_time")


# --- profiles ----------------------------------------------------------------

NULL_PROFILE_SQL = " UNION ALL ".join(
    f'SELECT \'{c}\' AS "column", count(*) FILTER ({c} IS NULL) AS null_count FROM {GAPS}'
    for c in ("event_id", "event_type", "value")
)


@query("null_profile", NULL_PROFILE_SQL)
def null_profile(t):
    return op.null_profile(events_with_gaps(t))


def describe_sql(table: str, numbers: list[str], texts: list[str]) -> str:
    """One SELECT per column, numbers and texts in the result's column order."""
    shared = "'{c}' AS \"column\", count({c}) AS value_count, "
    shared += "round(avg(TRY_CAST({c} AS DOUBLE)), 3) AS mean, "
    shared += "round(stddev_samp(TRY_CAST({c} AS DOUBLE)), 3) AS stddev, "
    number = "CAST(min({c}) AS DOUBLE) AS min_number, CAST(max({c}) AS DOUBLE) AS max_number, "
    number += "CAST(NULL AS VARCHAR) AS min_text, CAST(NULL AS VARCHAR) AS max_text"
    text = "CAST(NULL AS DOUBLE) AS min_number, CAST(NULL AS DOUBLE) AS max_number, "
    text += "min({c}) AS min_text, max({c}) AS max_text"
    selects = [f"SELECT {(shared + number).format(c=c)} FROM {table}" for c in numbers]
    selects += [f"SELECT {(shared + text).format(c=c)} FROM {table}" for c in texts]
    return " UNION ALL ".join(selects)


DESCRIBE_SQL = describe_sql("events", ["event_id", "user_id", "value"], ["event_type", "props"])


@query("describe_long", DESCRIBE_SQL)
def describe_long(t):
    return rounded(op.describe_long(t("events")), 3, "mean", "stddev")


CORRELATION_SQL = "SELECT col_x, col_y, round(CASE WHEN NOT isnan(r) THEN r END, 6) AS corr FROM ("
CORRELATION_SQL += " UNION ALL ".join(
    f"SELECT '{x}' AS col_x, '{y}' AS col_y, corr({x}, {y}) AS r FROM lineitem"
    for x, y in product(LINE_NUMBERS + LINE_MEASURES, repeat=2)
)
CORRELATION_SQL += ")"


@query("correlation_matrix", CORRELATION_SQL)
def correlation_matrix(t):
    return rounded(op.correlation_matrix(t("lineitem")), 6, "corr")


@query(
    "describe_text",
    f"""SELECT summary, CAST(user_id AS VARCHAR) AS user_id, event_type FROM (
          SELECT 'count' AS summary, count(user_id) AS user_id, CAST(count(event_type) AS VARCHAR) AS event_type FROM {GAPS_TEXT}
          UNION ALL SELECT 'min', min(user_id), min(event_type) FROM {GAPS_TEXT}
          UNION ALL SELECT 'max', max(user_id), max(event_type) FROM {GAPS_TEXT})""",
)
def describe_text(t):
    """Spark's own layout. Its mean and deviation are texts of doubles, checked as numbers elsewhere."""
    gaps = t("events").select("user_id", F.nullif("event_type", F.lit("error")).alias("event_type"))
    return op.describe_text(gaps).where("summary IN ('count', 'min', 'max')")


@query(
    "histogram",
    """WITH edge AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
            found AS (SELECT least(CAST(floor((value - lo) / (hi - lo) * 10) AS INTEGER), 9) AS bin,
                             count(*) AS n
                      FROM events, edge GROUP BY 1)
       SELECT CAST(b.bin AS INTEGER) AS bin, round(lo + (hi - lo) / 10 * b.bin, 6) AS low,
              round(lo + (hi - lo) / 10 * (b.bin + 1), 6) AS high,
              coalesce(n, 0) AS row_count
       FROM range(10) b(bin) CROSS JOIN edge LEFT JOIN found ON found.bin = b.bin""",
)
def histogram(t):
    return rounded(op.histogram(t("events"), "value", 10), 6, "low", "high")


# --- sorts, top-k, samples ---------------------------------------------------

SORT_SQL = """
    SELECT p_name, p_retailprice, p_size FROM part ORDER BY p_retailprice DESC, p_partkey"""


@query("sorted_projection", SORT_SQL)
def sorted_projection(t):
    columns = ["p_name", "p_retailprice", "p_size"]
    return op.sorted_projection(t("part"), columns, "p_retailprice", ["p_partkey"])


@query("sorted_projection_sql", SORT_SQL)
def sorted_projection_sql(t):
    register(t("part"), "waymark_part")
    return t.spark.sql(
        """SELECT p_name, p_retailprice, p_size FROM waymark_part
           ORDER BY p_retailprice DESC NULLS LAST, p_partkey"""
    )


@query(
    "top_k_series",
    "SELECT p_name, p_size FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 20",
)
def top_k_series(t):
    return op.top_k_series(t("part"), "p_name", "p_size", "p_retailprice", 20, ["p_partkey"])


def ends_sql(direction: str) -> str:
    return f"""SELECT l_quantity, count(*) AS row_count FROM lineitem
               GROUP BY l_quantity ORDER BY l_quantity {direction} LIMIT 10"""


SHORTEST_SQL, LONGEST_SQL = ends_sql("ASC"), ends_sql("DESC")
EXTREMES_SQL = f"({SHORTEST_SQL}) UNION ALL ({LONGEST_SQL})"


@query("shortest_groups", SHORTEST_SQL)
def shortest_groups(t):
    return op.extreme_groups(t("lineitem"), "l_quantity", 10, "smallest")


@query("longest_groups", LONGEST_SQL)
def longest_groups(t):
    return op.extreme_groups(t("lineitem"), "l_quantity", 10, "largest")


@query("extremes_union", EXTREMES_SQL)
def extremes_union(t):
    return op.extremes_union(t("lineitem"), "l_quantity", 10)
