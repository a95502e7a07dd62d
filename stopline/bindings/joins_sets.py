"""Registered queries: joins, duplicates, complements, row numbers, unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from stopline.bindings.common import CODED_SQL, coded_lineitem, query, table
from stopline.bindings.prepare import RULE_COUNTS_SQL, rule_predictions
from stopline.models.evaluate import confusion_counts
from stopline.operators import joins, selection, stats

_HOURLY = """(SELECT date_trunc('hour', ts) AS ts, round(avg(value), 6) AS mean_value,
  'here' AS address FROM events GROUP BY 1)"""


def _hourly(spark, sf):
    return table(spark, sf, "events").groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts")).agg(
        F.round(F.avg("value"), 6).alias("mean_value"), F.lit("here").alias("address"))


@query(f"""SELECT event_id, user_id, h.ts, mean_value FROM events e JOIN {_HOURLY} h
  ON date_trunc('hour', e.ts + INTERVAL 30 MINUTE) = h.ts""")
def join_nearest_hour(spark, sf):
    left = table(spark, sf, "events").select("event_id", "user_id", "ts")
    return joins.join_nearest_hour(left, _hourly(spark, sf), "ts")


@query(f"""SELECT event_id, ts, mean_value, address FROM
  (SELECT event_id, date_trunc('hour', ts) AS ts FROM events) e JOIN {_HOURLY} h USING (ts)""")
def join_natural(spark, sf):
    left = table(spark, sf, "events").select(
        "event_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"))
    return joins.join_common(left, _hourly(spark, sf))


@query("""SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
  WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""")
def join_semi_lookup(spark, sf):
    orders = table(spark, sf, "orders").where("o_orderstatus = 'F'").select(
        F.col("o_orderkey").alias("l_orderkey"))
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return joins.semi_lookup(lines, orders, "l_orderkey")


# The hash order of the split, and how many rows its training part has.
_SPLIT = """(SELECT *, row_number() OVER (ORDER BY (o_orderkey * 2654435761) % 4294967296) AS place,
  count(*) OVER () AS n FROM orders)"""


@query(f"""SELECT o_orderkey, o_custkey, o_totalprice FROM {_SPLIT} s
  WHERE place > floor(0.7 * n)""")
def join_anti_complement(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    train, _ = selection.split_exact(orders, "o_orderkey", 0.7)
    return joins.anti_complement(orders, train, "o_orderkey")


_PAIR_COLS = ["p_brand", "p_type", "p_size"]


@query("""WITH p AS (SELECT DISTINCT p_brand, p_type, p_size FROM part)
  SELECT a.p_brand AS brand_i, a.p_type AS type_i, a.p_size AS size_i,
    b.p_brand AS brand_j, b.p_type AS type_j, b.p_size AS size_j FROM p a JOIN p b
  ON (a.p_brand, a.p_type, a.p_size) < (b.p_brand, b.p_type, b.p_size)
  WHERE cast(a.p_brand <> b.p_brand AS int) + cast(a.p_type <> b.p_type AS int)
    + cast(a.p_size <> b.p_size AS int) = 1""")
def join_pairs(spark, sf):
    """Pairs of profiles one column apart, found by equi-joins."""
    from stopline.models.cluster import distinct_profiles

    profiles = distinct_profiles(table(spark, sf, "part"), _PAIR_COLS)
    pairs = joins.profile_neighbours(profiles, _PAIR_COLS)

    def side(i, names):
        return profiles.select(F.col("id").alias(i), *[
            F.col(c).alias(n) for c, n in zip(_PAIR_COLS, names)])

    return (
        pairs.join(side("i", ["brand_i", "type_i", "size_i"]), "i")
        .join(side("j", ["brand_j", "type_j", "size_j"]), "j").drop("i", "j", "differs"))


@query("SELECT l_orderkey, l_linenumber, count(*) OVER (PARTITION BY l_orderkey) > 1"
       " AS multi_infr FROM lineitem")
def repeat_key_flag(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return joins.repeat_flag(lines, "l_orderkey")


@query("SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_orderkey) AS row_id FROM orders")
def dense_row_id(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return selection.dense_row_id(orders, ["o_orderkey"], unique=True)


@query("""SELECT l_quantity, count(*) AS n, min(row_id) AS first, max(row_id) AS last FROM (
  SELECT l_quantity, row_number() OVER (ORDER BY l_quantity) AS row_id FROM lineitem) r GROUP BY 1""")
def dense_row_id_ties(spark, sf):
    """Numbers of rows in 50 runs of equal order values: each run's are one gapless stretch."""
    rows = selection.dense_row_id(table(spark, sf, "lineitem").select("l_quantity", "l_orderkey"), ["l_quantity"])
    return rows.groupBy("l_quantity").agg(
        F.count_distinct("row_id").alias("n"), F.min("row_id").alias("first"), F.max("row_id").alias("last"))


_CLASS_SQL = " UNION ALL ".join(
    f"""SELECT p_brand, p_type, p_size, '{c}' AS differs, count(*) OVER w - 1 AS links,
    min((p_brand, p_type, p_size)) OVER w AS lead
    FROM p WINDOW w AS (PARTITION BY {', '.join(o for o in _PAIR_COLS if o != c)})""" for c in _PAIR_COLS)


@query(f"""WITH p AS (SELECT DISTINCT p_brand, p_type, p_size FROM part)
  SELECT p_brand, p_type, p_size, differs, links, lead[1] AS lead_brand, lead[2] AS lead_type, lead[3] AS lead_size
  FROM ({_CLASS_SQL}) x WHERE links > 0""")
def join_classes(spark, sf):
    """The same links as classes: members, the number of their links, and the first member."""
    from stopline.models.cluster import distinct_profiles

    profiles = distinct_profiles(table(spark, sf, "part"), _PAIR_COLS)
    lead = profiles.select(F.col("id").alias("class"), *[
        F.col(c).alias(f"lead_{c[2:]}") for c in _PAIR_COLS])
    found = joins.neighbour_classes(profiles, _PAIR_COLS)
    return found.join(profiles, "id").join(lead, "class").select(
        *_PAIR_COLS, "differs", "links", "lead_brand", "lead_type", "lead_size")


@query("SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def duplicate_keys(spark, sf):
    return joins.duplicate_keys(table(spark, sf, "lineitem"), "l_orderkey")


@query("SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def distinct_rows(spark, sf):
    return stats.distinct_rows(
        table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus", "l_linenumber"])


@query(f"SELECT o_orderkey, o_orderpriority FROM {_SPLIT} s WHERE place > floor(0.6 * n)")
def except_sample(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return selection.split_exact(orders, "o_orderkey", 0.6)[1]


@query(f"SELECT o_orderkey, place <= floor(0.8 * n) AS train FROM {_SPLIT} s")
def split_exact(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey")
    train, test = selection.split_exact(orders, "o_orderkey", 0.8)
    return train.withColumn("train", F.lit(True)).unionByName(
        test.withColumn("train", F.lit(False)))


@query(f"""SELECT 'over 25' AS run, tp, fp, fn, tn FROM ({RULE_COUNTS_SQL}) a UNION ALL
  SELECT 'late line', count(*) FILTER (WHERE l_linenumber > 3 AND outcome = 'Citation'),
  count(*) FILTER (WHERE l_linenumber > 3 AND outcome <> 'Citation'),
  count(*) FILTER (WHERE l_linenumber <= 3 AND outcome = 'Citation'),
  count(*) FILTER (WHERE l_linenumber <= 3 AND outcome <> 'Citation')
  FROM {CODED_SQL} l WHERE outcome IN ('Citation', 'Warning')""")
def union_reports(spark, sf):
    rows = coded_lineitem(spark, sf).where("outcome in ('Citation', 'Warning')")
    late = rows.withColumn(
        "predicted", F.when(F.col("l_linenumber") > 3, "Citation").otherwise("Warning"))
    runs = {"over 25": rule_predictions(spark, sf), "late line": late}
    return stats.union_reports(*[
        confusion_counts(r, "predicted", "outcome", "Citation").select(
            F.lit(name).alias("run"), "tp", "fp", "fn", "tn")
        for name, r in runs.items()])
