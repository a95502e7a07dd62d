"""Registered queries: sources and sinks, projections and repairs, row filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from stopline import schema
from stopline.bindings.common import (
    CASES_SQL, CODED_SQL, EVENTS_SQL, STOPS_RAW, ZERO_TAX_SQL, cases, coded_events, coded_lineitem,
    query, stops_raw, table, zero_tax,
)
from stopline.functions import calendar, text
from stopline.models.evaluate import confusion_counts, confusion_metrics, metrics_long
from stopline.operators import cleaning, quality, stats
from stopline.session import discard_at_exit, new_path, small_table
from stopline.sources import tables

# ---- sources and sinks ----

ORDERS_CSV = ("x int, o_orderkey long, o_custkey long, o_orderstatus string, "
              "o_totalprice double, o_orderdate string, o_orderpriority string")


def _orders_csv(spark, sf, null_value="NA"):
    """orders written as the index-carrying CSV an export makes, and its path."""
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("int").alias("x"), "o_orderkey", "o_custkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"), "o_totalprice",
        F.col("o_orderdate").cast("string").alias("o_orderdate"), "o_orderpriority")
    path = new_path(spark, "orders-csv")
    tables.write_table(orders, path, null_value=null_value)
    discard_at_exit(spark, path)
    return path


@query("""SELECT cast(o_orderkey AS int) AS x, o_orderkey, o_custkey,
  nullif(o_orderstatus, 'P') AS o_orderstatus, o_totalprice,
  cast(o_orderdate AS string) AS o_orderdate, o_orderpriority FROM orders""")
def src_csv(spark, sf):
    return tables.read_table(spark, _orders_csv(spark, sf), ORDERS_CSV)


@query("""SELECT o_orderstatus, cast(count(*) AS bigint) AS n,
  round(sum(o_totalprice), 2) AS total FROM
  (SELECT nullif(o_orderstatus, 'P') AS o_orderstatus, o_totalprice FROM orders) o GROUP BY 1""")
def sink_csv(spark, sf):
    back = tables.read_table(spark, _orders_csv(spark, sf, ""), ORDERS_CSV, null_value="")
    return back.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("""SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS o_orderstatus, o_totalprice,
  cast(o_orderdate AS string) AS o_orderdate, o_orderpriority FROM orders""")
def drop_index(spark, sf):
    return tables.drop_index(tables.read_table(spark, _orders_csv(spark, sf), ORDERS_CSV))


RULE_COUNTS_SQL = f"""SELECT
  count(*) FILTER (WHERE l_quantity > 25 AND outcome = 'Citation') AS tp,
  count(*) FILTER (WHERE l_quantity > 25 AND outcome <> 'Citation') AS fp,
  count(*) FILTER (WHERE l_quantity <= 25 AND outcome = 'Citation') AS fn,
  count(*) FILTER (WHERE l_quantity <= 25 AND outcome <> 'Citation') AS tn
  FROM {CODED_SQL} l WHERE outcome IN ('Citation', 'Warning')"""
RULE_METRICS_SQL = f"""SELECT tp, fp, fn, tn,
  round((tp + tn) / n, 6) AS accuracy,
  round(greatest(tp + fn, fp + tn) / n, 6) AS no_information_rate,
  round(((tp + tn) / n - chance) / (1 - chance), 6) AS kappa,
  round(tp / (tp + fn), 6) AS sensitivity, round(tn / (tn + fp), 6) AS specificity,
  round(tp / (tp + fp), 6) AS pos_pred_value, round(tn / (tn + fn), 6) AS neg_pred_value,
  round((tp + fn) / n, 6) AS prevalence, round(tp / n, 6) AS detection_rate,
  round((tp + fp) / n, 6) AS detection_prevalence,
  round((tp / (tp + fn) + tn / (tn + fp)) / 2, 6) AS balanced_accuracy
  FROM (SELECT *, ((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn)) / (n * n) AS chance
    FROM (SELECT *, cast(tp + fp + fn + tn AS double) AS n FROM ({RULE_COUNTS_SQL}) a) b) c"""


def rule_predictions(spark, sf):
    """A fixed rule as predictor: more than 25 pieces means Citation."""
    rows = cleaning.filter_response(coded_lineitem(spark, sf), "outcome")
    return rows.withColumn(
        "predicted", F.when(F.col("l_quantity") > 25, "Citation").otherwise("Warning"))


@query(f"""SELECT 'rule' AS run, 'confusion' AS section, metric, cast(value AS double) AS value
  FROM (UNPIVOT (SELECT COLUMNS(*)::double FROM ({RULE_METRICS_SQL}) m)
        ON COLUMNS(*) INTO NAME metric VALUE value) u""")
def sink_report(spark, sf):
    counts = confusion_counts(rule_predictions(spark, sf), "predicted", "outcome", "Citation")
    path = new_path(spark, "report")
    tables.write_report(metrics_long(confusion_metrics(counts), run="rule"), path)
    discard_at_exit(spark, path)
    return spark.read.parquet(path)


RATE_FACTORS = ["l_linestatus", "l_linenumber", "l_tax", "o_orderpriority", "o_orderstatus"]


def _rates_sql(frame, factors, response="outcome"):
    """One grouping per factor, stacked: the plain form of the single-pass operator."""
    return " UNION ALL ".join(
        f"""SELECT '{f}' AS factor, cast({f} AS string) AS level, 'Citation' AS {response},
        count(*) FILTER (WHERE {response} = 'Citation') AS n,
        round(count(*) FILTER (WHERE {response} = 'Citation') / cast(count(*) AS double), 6) AS rate
        FROM {frame} t GROUP BY {f} HAVING count(*) FILTER (WHERE {response} = 'Citation') > 0"""
        for f in factors)


@query(_rates_sql(CASES_SQL, RATE_FACTORS))
def sink_factor_tables(spark, sf):
    path = new_path(spark, "factor-tables")
    tables.factor_rate_tables(cases(spark, sf), RATE_FACTORS, "outcome", "Citation", path)
    discard_at_exit(spark, path)
    back = (spark.read.option("header", True).option("nullValue", "NA")
            .schema("level string, outcome string, n long, rate double, factor string").csv(path))
    return back.select("factor", "level", "outcome", "n", "rate")


# The sketch is exact for so few values; beyond, its estimate has no SQL and is NULL here.
_FEW = 500


@query(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", '{t}' AS type, count(*) AS n, count(*) - count({c}) AS n_null,
    CASE WHEN count(DISTINCT {c}) < {_FEW} THEN count(DISTINCT {c}) END AS n_distinct FROM {ZERO_TAX_SQL} t"""
    for c, t in [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
                 ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
                 ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"),
                 ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz")]))
def profile_schema(spark, sf):
    few = F.when(F.col("n_distinct") < _FEW, F.col("n_distinct"))
    return stats.profile(zero_tax(spark, sf)).withColumn("n_distinct", few)


# ---- projections, casts, repairs ----

@query(f"""SELECT row_key, seq_id, try_cast(year AS int) AS year,
  try_cast(model AS int) AS model, cast(x AS string) AS x FROM ({STOPS_RAW}) s""")
def cast_types(spark, sf):
    raw = stops_raw(spark, sf).select("row_key", "seq_id", "year", "model", "x")
    return cleaning.cast_types(raw, {"seq_id": "string", "year": "int", "model": "int",
                                     "x": "string"})


@query("""SELECT event_id, date_trunc('second', ts) AS full_time, date_trunc('minute', ts) AS minute_time,
  cast(ts AS date) AS day, cast(NULL AS timestamp) AS bad_time FROM events""")
def parse_ts(spark, sf):
    e = table(spark, sf, "events")
    parts = e.select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("a"),
        F.date_format("ts", "MM/dd/yyyy HH:mm").alias("b"),
        F.date_format("ts", "MM/dd/yyyy").alias("c"), "event_type")
    return parts.select(
        "event_id",
        calendar.parse_timestamp(F.col("a")).alias("full_time"),
        calendar.parse_timestamp(F.col("b"), "MM/dd/yyyy HH:mm").alias("minute_time"),
        calendar.parse_date(F.col("c")).alias("day"),
        calendar.parse_timestamp(F.col("event_type")).alias("bad_time"))


@query("SELECT event_id, date_trunc('second', ts) AS date_time FROM events")
def unite_datetime(spark, sf):
    raw = stops_raw(spark, sf).select(F.col("row_key").alias("event_id"), "date_of_stop",
                                      "time_of_stop")
    return cleaning.unite_datetime(raw, "date_of_stop", "time_of_stop", "date_time")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def drop_columns(spark, sf):
    return cleaning.drop_columns(
        table(spark, sf, "orders"),
        ["o_orderstatus", "o_orderdate", "o_orderpriority", "not_there"])


@query("SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderstatus AS state,"
       " o_orderpriority AS asset_type FROM orders")
def rename_columns(spark, sf):
    return cleaning.rename_columns(
        table(spark, sf, "orders"), {"o_orderstatus": "state", "o_orderpriority": "asset_type"})


@query("SELECT o_orderdate, o_orderkey, o_orderpriority, o_totalprice, o_custkey, o_orderstatus"
       " FROM orders")
def reorder_columns(spark, sf):
    return cleaning.reorder_columns(
        table(spark, sf, "orders"),
        ["o_orderdate", "o_orderkey", "o_orderpriority", "o_totalprice", "o_custkey",
         "o_orderstatus"])


@query(f"""SELECT l_orderkey, l_linenumber, coalesce(l_tax, 0) AS l_tax,
  coalesce(l_discount, 0) AS l_discount FROM {ZERO_TAX_SQL} l""")
def fill_all_zero(spark, sf):
    rows = zero_tax(spark, sf).select("l_orderkey", "l_linenumber", "l_tax", "l_discount")
    return rows.fillna(0)


@query(f"""SELECT row_key, coalesce(search_conducted, 'No') AS search_conducted,
  coalesce(article, 'Safety Violation') AS article,
  coalesce(search_outcome = 'Arrest', false) AS arrest FROM ({STOPS_RAW}) s""")
def fill_defaults(spark, sf):
    raw = stops_raw(spark, sf).select(
        "row_key", "search_conducted", "article",
        (F.col("search_outcome") == "Arrest").alias("arrest"))
    return cleaning.fill(raw, {"search_conducted": "No", "article": "Safety Violation",
                               "arrest": False})


@query("""SELECT l_orderkey, l_linenumber, nullif(l_tax, 0) AS l_tax,
  nullif(l_discount, 0) AS l_discount FROM lineitem""")
def sentinel_to_null(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_tax", "l_discount")
    return cleaning.null_if(rows, ["l_tax", "l_discount"])


@query("""SELECT l_orderkey, l_linenumber, l_quantity,
  CASE WHEN l_quantity > 40 AND l_tax = 0 THEN NULL ELSE l_tax END AS l_tax FROM lineitem""")
def cond_sentinel_to_null(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax")
    return cleaning.null_if(rows, ["l_tax"], when=F.col("l_quantity") > 40)


@query(f"""SELECT row_key, search_outcome,
  coalesce(search_outcome = 'Arrest', false) AS arrest FROM ({STOPS_RAW}) s""")
def derive_arrest(spark, sf):
    raw = stops_raw(spark, sf).select("row_key", "search_outcome")
    return cleaning.derive_equals(raw, "search_outcome", "Arrest", "arrest")


_PED = "contains(description, 'PEDESTRIAN') AND state2 = 'XX'"


@query(f"""SELECT row_key, description, state2 AS state,
  CASE WHEN {_PED} THEN '29 - Unknown' ELSE vehicle_type END AS vehicle_type,
  CASE WHEN {_PED} THEN NULL ELSE try_cast(year AS int) END AS year,
  CASE WHEN {_PED} THEN 'None' ELSE make END AS make,
  CASE WHEN {_PED} THEN 'None' ELSE model END AS model,
  CASE WHEN {_PED} THEN 'N/A' ELSE color END AS color
  FROM (SELECT *, CASE WHEN contains(description, 'PEDESTRIAN FAILURE')
    OR contains(description, 'PEDESTRIAN CROSS') OR contains(description, 'PEDESTRIAN UNSAFELY')
    THEN 'XX' ELSE state END AS state2 FROM ({STOPS_RAW}) s) t""")
def pedestrian_overwrite(spark, sf):
    raw = stops_raw(spark, sf).select("row_key", "description", "state", "vehicle_type", "year",
                                      "make", "model", "color")
    return cleaning.pedestrian_overwrite(cleaning.cast_types(raw, {"year": "int"}))


@query("""SELECT l_returnflag, row_number() OVER (ORDER BY l_returnflag DESC) - 1 AS code,
  n FROM (SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1) t""")
def normalise_factor(spark, sf):
    """Level codes refitted on the filtered frame hold no unused level."""
    from stopline.models.encode import fit_indexer

    rows = table(spark, sf, "lineitem").select("l_returnflag").where("l_returnflag != 'N'")
    coded = fit_indexer(rows, ["l_returnflag"]).transform(rows)
    return coded.groupBy("l_returnflag", F.col("l_returnflag_ix").cast("long").alias("code")).agg(
        F.count(F.lit(1)).alias("n"))


_FLAGS = [*schema.STOP_FLAGS, "contributed_to_accident"]


@query("WITH s AS (" + STOPS_RAW + ")" + " UNION ALL ".join(
    f""" SELECT '{c}' AS flag, cast(sum(n) - max(n) AS bigint) AS minority,
    sum(n) - max(n) >= 100 AS kept
    FROM (SELECT count(*) AS n FROM s WHERE {c} IS NOT NULL GROUP BY {c}) g""" for c in _FLAGS))
def drop_low_variance(spark, sf):
    raw = stops_raw(spark, sf).select("row_key", *_FLAGS)
    counts = cleaning.minority_counts(raw, _FLAGS)
    kept = cleaning.drop_low_variance(raw, _FLAGS, 100).columns
    return small_table(spark, [(c, counts[c], c in kept) for c in _FLAGS],
                       "flag string, minority long, kept boolean")


@query(f"""SELECT l_orderkey, l_linenumber, outcome,
  CASE WHEN outcome = 'Citation' THEN 1.0e0 ELSE 0.0e0 END AS label FROM {CODED_SQL} l""")
def binary_label(spark, sf):
    rows = coded_lineitem(spark, sf).select("l_orderkey", "l_linenumber", "outcome")
    return rows.withColumn("label", text.binary_label(F.col("outcome")))


@query("""SELECT c_mktsegment, count(*) AS n FROM customer
  WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') GROUP BY 1""")
def literal_vector_append(spark, sf):
    wanted = schema.extend_values(["BUILDING"], ["MACHINERY"], ["HOUSEHOLD"])
    return stats.count_by(
        cleaning.filter_in_list(table(spark, sf, "customer"), "c_mktsegment", wanted),
        "c_mktsegment")


# ---- row filters ----

@query("""SELECT o_orderkey, o_orderdate FROM orders
  WHERE o_orderdate > timestamp '1996-12-31 00:00:00' AND o_orderdate < timestamp '2000-01-01 00:00:00'""")
def filter_date_window(spark, sf):
    import datetime as dt

    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return cleaning.filter_between(rows, "o_orderdate", dt.datetime(1996, 12, 31),
                                   dt.datetime(2000, 1, 1))


@query(f"""SELECT row_key, violation_type, fatal, personal_injury, model, driver_city
  FROM ({STOPS_RAW}) s WHERE violation_type IS NOT NULL AND fatal IS NOT NULL
  AND personal_injury IS NOT NULL AND model IS NOT NULL AND driver_city IS NOT NULL""")
def require_columns(spark, sf):
    raw = stops_raw(spark, sf).select("row_key", "violation_type", "fatal", "personal_injury",
                                      "model", "driver_city")
    first = cleaning.require_columns(raw, ["violation_type", "fatal", "personal_injury"])
    return cleaning.require_columns(first, ["model", "driver_city"])


@query(f"""SELECT l_orderkey, l_linenumber, l_tax, l_discount FROM {ZERO_TAX_SQL} l
  WHERE l_tax IS NOT NULL AND l_discount IS NOT NULL""")
def complete_cases(spark, sf):
    rows = zero_tax(spark, sf).select("l_orderkey", "l_linenumber", "l_tax", "l_discount")
    return cleaning.complete_cases(rows)


@query(f"""SELECT row_key, nullif(latitude, 0) AS latitude FROM ({STOPS_RAW}) s
  WHERE NOT (latitude > 39.33e0) AND NOT (latitude < 38.90e0 AND latitude > 0)""")
def filter_lat_range(spark, sf):
    return cleaning.filter_lat_range(stops_raw(spark, sf).select("row_key", "latitude"), "latitude")


@query(f"""SELECT row_key, nullif(longitude, 0) AS longitude FROM ({STOPS_RAW}) s
  WHERE NOT (longitude < -77.52e0) AND NOT (longitude > -76.88e0 AND longitude > 0)""")
def filter_lon_range(spark, sf):
    return cleaning.filter_lon_range(
        stops_raw(spark, sf).select("row_key", "longitude"), "longitude")


@query(f"""SELECT row_key, nullif(longitude, 0) AS longitude FROM ({STOPS_RAW}) s
  WHERE NOT (longitude < -77.52e0) AND NOT (longitude > -77.0e0 AND longitude <> 0)""")
def filter_lon_range_strict(spark, sf):
    return cleaning.filter_lon_range(
        stops_raw(spark, sf).select("row_key", "longitude"), "longitude", high=-77.0,
        as_written=False)


_CODES = ", ".join(f"'{c}'" for c in schema.STATE_CODES)


@query(f"""SELECT row_key, state, driver_state, dl_state FROM ({STOPS_RAW}) s
  WHERE state IN ({_CODES}) AND driver_state IN ({_CODES}) AND dl_state IN ({_CODES})""")
def filter_in_list(spark, sf):
    rows = stops_raw(spark, sf).select("row_key", "state", "driver_state", "dl_state")
    for c in ("state", "driver_state", "dl_state"):
        rows = cleaning.filter_in_list(rows, c, schema.STATE_CODES)
    return rows


@query(f"""SELECT row_key, state, dl_state FROM ({STOPS_RAW}) s
  WHERE NOT (state = 'MB' AND dl_state = 'MD') AND NOT (state = 'NB' AND dl_state = 'NJ')
  AND NOT (state = 'NB' AND dl_state = 'NY') AND NOT (state = 'PA' AND dl_state = 'NJ')""")
def filter_contradictions(spark, sf):
    rows = stops_raw(spark, sf).select("row_key", "state", "dl_state")
    return cleaning.filter_contradictions(rows, "state", "dl_state")


_NEEDING = "('02 - Automobile', '03 - Station Wagon', '05 - Light Duty Truck')"


@query(f"""SELECT row_key, year, vehicle_type FROM
  (SELECT row_key, try_cast(year AS int) AS year, vehicle_type FROM ({STOPS_RAW}) s) t
  WHERE NOT (year = 0 AND vehicle_type IN {_NEEDING})""")
def filter_year_by_type(spark, sf):
    rows = cleaning.cast_types(
        stops_raw(spark, sf).select("row_key", "year", "vehicle_type"), {"year": "int"})
    return cleaning.filter_year_by_type(rows, "year", "vehicle_type")


@query(f"""SELECT row_key, nullif(year, 0) AS year FROM
  (SELECT row_key, try_cast(year AS int) AS year FROM ({STOPS_RAW}) s) t
  WHERE NOT (coalesce(year, 0) < 1925 AND coalesce(year, 0) > 0) AND NOT coalesce(year, 0) > 2020""")
def filter_year_range(spark, sf):
    rows = cleaning.cast_types(stops_raw(spark, sf).select("row_key", "year"), {"year": "int"})
    return cleaning.filter_year_range(rows, "year")


@query(f"""SELECT l_orderkey, l_linenumber, outcome FROM {CODED_SQL} l
  WHERE outcome IN ('Warning', 'Citation')""")
def filter_response(spark, sf):
    rows = coded_lineitem(spark, sf).select("l_orderkey", "l_linenumber", "outcome")
    return cleaning.filter_response(rows, "outcome")


@query("""SELECT p_partkey, p_name, p_brand FROM part WHERE p_type NOT IN ('ECONOMY')
  AND p_name IN (SELECT p_name FROM part WHERE p_type NOT IN ('ECONOMY')
                 GROUP BY 1 HAVING count(*) >= 20)""")
def filter_low_density(spark, sf):
    parts = cleaning.filter_not_in(table(spark, sf, "part"), {"p_type": ["ECONOMY"]})
    rows = cleaning.drop_rare_levels(parts, "p_name", 20)
    return rows.select("p_partkey", "p_name", "p_brand")


@query(f"""SELECT event_id, event_type, value, outcome FROM {EVENTS_SQL} e
  WHERE event_type IN ('purchase', 'view') AND value <> 0 AND outcome = 'Citation'""")
def filter_equals(spark, sf):
    rows = coded_events(spark, sf).select("event_id", "event_type", "value", "outcome")
    kept = cleaning.filter_response(rows, "event_type", ["purchase", "view"])
    return kept.where((F.col("value") != 0) & (F.col("outcome") == "Citation"))
