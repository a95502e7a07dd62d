"""Forms that hold at any size: CSV with line breaks in many tasks, row numbers of ties, sparse designs, classes, cubes."""

import csv
import io
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stopline.models import encode
from stopline.operators import joins, selection, stats
from stopline.sources import tables

DDL = "id int, note string, v double"


def written(folder, rows, end="\n"):
    out = io.StringIO(newline="")
    writer = csv.writer(out, lineterminator=end)
    writer.writerow(["id", "note", "v"])
    writer.writerows(rows)
    (folder / "t.csv").write_bytes(out.getvalue().encode())
    return str(folder / "t.csv"), len(out.getvalue().encode())


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("block", [64, 257, 1000, 1 << 20])
def test_line_breaks_in_quotes_across_blocks(spark, tmp_path, block, end):
    rng = random.Random(block)
    rows = [(i, "".join(rng.choice(['a', 'é', ',', '"', '""', "\n", "\n\n", ' "x\ny" ', "z" * 9])
                        for _ in range(rng.choice([1, 3, 12, 60 if i % 17 == 0 else 2]))) + ".", i / 4) for i in range(150)]
    path, size = written(tmp_path, rows, end)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        lines = spark.read.text(path)
        assert lines.rdd.getNumPartitions() >= min(size // block, 8)
        got = tables.read_table(spark, path, DDL, multi_line=True)
        assert sorted(tuple(r) for r in got.collect()) == rows
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_header_and_bad_values_of_multi_line_files(spark, tmp_path):
    path, _ = written(tmp_path, [(1, "a\nb", "NA"), (2, "", 0.5)])
    assert [tuple(r) for r in tables.read_table(spark, path, DDL, multi_line=True).orderBy("id").collect()][0] == (1, "a\nb", None)
    with pytest.raises(ValueError):
        tables.read_table(spark, path, "id int, v string, note double", multi_line=True)
    bad, _ = written(tmp_path, [(1, "a", "x")])
    with pytest.raises(Exception, match="(?i)malformed|x"):
        tables.read_table(spark, bad, DDL, multi_line=True).collect()


def test_a_million_equal_values_are_numbered_in_even_tasks(spark):
    df = spark.range(1_000_000, numPartitions=4).select(F.lit(7).alias("v"))
    rows = selection.dense_row_id(df, ["v"], partitions=8)
    sizes = [r["n"] for r in rows.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 8 and max(sizes) < 1.5 * 125_000
    assert rows.agg(F.min("row_id"), F.max("row_id"), F.count_distinct("row_id")).first() == (1, 1_000_000, 1_000_000)


def test_a_factor_of_a_hundred_thousand_levels(spark):
    df = spark.range(200_000).select(F.col("id"), (F.col("id") % 100_000).alias("f"), (F.col("id") % 3).alias("g"),
                                     F.when(F.col("id") % 2 == 0, F.col("id")).alias("x"))
    slots = encode.level_slots(df, ["f", "g"], 1)
    assert slots.agg(F.count("*"), F.min("slot"), F.max("slot"), F.count_distinct("slot")).first() == (
        100_001, 1, 100_001, 100_001)
    rows = encode.design_triplets(df, "id", ["f", "g"], ["x"], slots)
    per = {r["id"]: r["n"] for r in rows.where("id < 4").groupBy("id").agg(F.count("*").alias("n")).collect()}
    assert per == {1: 2, 2: 3, 3: 1}  # row 0 has the first levels and a zero; 3 the first of g and no number
    assert rows.where("slot > 0").count() == 200_000 - 2 + 2 * 200_000 // 3
    assert rows.columns == ["id", "slot", "value"]
    again = slots.where("factor = 'g'").orderBy("slot").collect()
    assert [(r["level"], r["slot"]) for r in again] == [("1", 100_000), ("2", 100_001)]


def test_classes_hold_every_pair_one_column_apart(spark):
    rng = random.Random(3)
    rows = sorted({(rng.randint(0, 3), rng.randint(0, 3), rng.choice([None, "a", "b"])) for _ in range(30)}, key=repr)
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, a int, b int, c string")
    found = joins.neighbour_classes(df, ["a", "b", "c"]).collect()
    groups = {}
    for r in found:
        groups.setdefault((r["differs"], r["class"]), []).append(r)
    pairs = set()
    for members in groups.values():
        ids = sorted(m["id"] for m in members)
        assert members[0]["class"] == ids[0] and all(m["links"] == len(ids) - 1 for m in members)
        pairs |= {(i, j) for i in ids for j in ids if i < j}
    assert len(found) <= 3 * len(rows)
    assert pairs == {(i, j) for i in range(len(rows)) for j in range(i + 1, len(rows))
                     if sum(x != y for x, y in zip(rows[i], rows[j])) == 1}


def test_one_scan_gives_every_level_list(spark):
    rng = random.Random(7)
    rows = [(rng.choice(["x", "y", None]), rng.choice("pqr"), rng.random() < 0.3, rng.random() < 0.6) for _ in range(400)]
    df = spark.createDataFrame(rows, "a string, b string, f boolean, g boolean")
    cube = stats.level_cube(df, ["a", "b"], {"f": F.col("f"), "g": F.col("g")}, ["a"], "b", ["a"], [("b", "a")])
    assert cube._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
    got = {(r["flag"], r["level"]): r["n"] for r in stats.cube_topk(
        stats.cube_flags(cube.where("column = 'a'"), ["f", "g"]), 1, ["flag"]).collect()}
    for i, flag in ((2, "f"), (3, "g")):
        counts = Counter(r[0] for r in rows if r[i] and r[0])
        best = min(counts, key=lambda x: (-counts[x], x))
        assert got[flag, best] == counts[best]
    assert {r["level"]: r["n"] for r in stats.cube_levels(cube, "a").collect()} == Counter(r[0] for r in rows)
    by = {(r["by"], r["level"], r["rank"]): r["n"] for r in stats.cube_topk(cube.where("column = 'a'"), 2, ["by"]).collect()}
    pairs = Counter((r[1], r[0]) for r in rows if r[0])
    assert {(b, a): n for (b, a, _), n in by.items()} == pairs
    nested = {(r["outer"], r["level"]): r["n"] for r in stats.cube_topk(cube.where("column = 'b>a'"), 9, ["outer"]).collect()}
    assert nested == pairs
