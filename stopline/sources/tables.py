"""Reading and writing tables, per-factor rate files, reports and fitted models."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopline.operators.stats import rate_by_all
from stopline.session import BROADCAST_BYTES, data_bytes, store


def read_table(spark: SparkSession, path: str, schema: T.StructType | str, null_value: str = "NA",
               header: bool = True, multi_line: bool = False, bad_rows: str = "FAILFAST") -> DataFrame:
    """CSV with a declared schema, so no pass over the data is spent on guessing types.

    Quotes inside quoted text are doubled. The header must name the schema's columns
    in order. A value that does not fit its column is an error (`bad_rows`, or
    `PERMISSIVE` for null). `multi_line` reads quoted line breaks, in many tasks (`read_multi_line`).
    """
    if multi_line:
        return read_multi_line(spark, path, schema, null_value, header, bad_rows)
    return (spark.read.schema(schema).option("header", header).option("enforceSchema", not header)
            .option("quote", '"').option("escape", '"')
            .option("mode", bad_rows).option("nullValue", null_value).csv(path))


def whole_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, first, record): the records of CSV files with quoted line breaks; `first` marks a file's first.

    Files are read line by line in blocks, as text is. A line ends a record if the quotes before its
    end are even in number; for that each block needs to know whether the blocks before it
    hold an odd number. Quotes are counted per block in one pass, added up over the blocks of each file, and
    in a second pass every task puts the records of its blocks together. Only the two
    pieces of a record that a block's end cuts travel, and are joined by the block they began in.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    order = Window.partitionBy("file").orderBy("block")
    blocks = store(lines.groupBy("file", "block").agg(F.sum(quotes).alias("n")).withColumn(
        "open", F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2 == 1), "blocks")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a block's lines come one after the other; `held` is the record that is still open
        at, held, begun, inside, first = None, [], True, False, True

        def row(whole, last):
            return at[0], at[1], first, begun, last, "\n".join(whole)
        for batch in batches:
            out = []
            for file, block, value, was_open in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if (file, block) != at:
                    if held:
                        out.append(row(held, False))
                    # in an open block the record began in an earlier one
                    at, held, begun, inside, first = (file, block), [], not was_open, was_open, block == 0
                held.append(value)
                inside ^= value.count('"') % 2 == 1
                if not inside:
                    out.append(row(held, True))
                    held, begun, first = [], True, False
            yield _pieces(out)
        yield _pieces([row(held, False)] if held else [])

    # joined by broadcast alone, since a shuffle would mix the lines up
    opened = blocks.where("open").select(F.xxhash64("file").alias("f"), F.col("block").alias("b"), "open")
    if data_bytes(opened) > BROADCAST_BYTES:
        raise ValueError(f"too many blocks of {path} begin inside quotes: read fewer files at once, or larger blocks")
    same = (F.xxhash64("file") == F.col("f")) & (F.col("block") == F.col("b"))
    joined = lines.join(F.broadcast(opened), same, "left").select(
        "file", "block", "value", F.coalesce("open", F.lit(False)).alias("open"))
    cut = store(joined.mapInArrow(pieces, PIECES), "pieces")
    whole = cut.where("begun and ended").select("file", "first", "record")
    # a record cut by blocks: its start, whole blocks inside it, and its end follow each other
    parts = cut.where("not (begun and ended)")
    started = Window.partitionBy("file").orderBy("block", F.col("begun").cast("int"))
    parts = parts.withColumn("of", F.sum(F.col("begun").cast("int")).over(started))
    stitched = parts.groupBy("file", "of").agg(
        F.max("first").alias("first"), F.array_join(F.transform(
            F.array_sort(F.collect_list(F.struct("block", F.col("begun").cast("int").alias("b"), "record"))),
            lambda x: x["record"]), "\n").alias("record")).drop("of")
    return whole.unionByName(stitched)


PIECES = "file string, block long, first boolean, begun boolean, ended boolean, record string"


def _pieces(rows: list) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_(), pa.string()]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
        ["file", "block", "first", "begun", "ended", "record"])


def read_multi_line(spark: SparkSession, path: str, schema: T.StructType | str, null_value: str = "NA",
                    header: bool = True, bad_rows: str = "FAILFAST") -> DataFrame:
    """CSV with quoted line breaks, read by as many tasks as the file has blocks."""
    fields = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    records = whole_records(spark, path).withColumn("record", F.rtrim(F.col("record"), F.lit("\r"))).where("record <> ''")
    options = {"quote": '"', "escape": '"', "mode": bad_rows, "nullValue": null_value}
    if header:
        names = T.StructType([T.StructField(f.name, T.StringType()) for f in fields])
        heads = records.where("first").select(F.from_csv(
            "record", F.lit(names.simpleString()[7:-1].replace(":", " ")), {**options, "mode": "PERMISSIVE"}).alias("h"))
        wrong = heads.where(F.to_json("h") != F.lit(json.dumps({f.name: f.name for f in fields}, separators=(",", ":"))))
        if wrong.head(1):
            raise ValueError(f"the header of {path} does not name the columns {fields.names} in order")
        records = records.where("not first")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return records.select(F.from_csv("record", ddl, options).alias("r")).select("r.*")


def write_table(df: DataFrame, path: str, header: bool = True, null_value: str = "NA") -> None:
    """CSV with header, quotes doubled. Fails where the path exists, so no input is ever overwritten."""
    (df.write.option("header", header).option("quote", '"').option("escape", '"')
     .option("nullValue", null_value).csv(path))


def drop_index(df: DataFrame, name: str = "x") -> DataFrame:
    """Drop the row-number column an earlier export may have added."""
    return df.drop(name)


def factor_rate_tables(df: DataFrame, factors: Sequence[str], response: str, positive: str,
                       path: str) -> None:
    """One rate table per factor, one folder each, from a single scan."""
    rates = rate_by_all(df, factors, response, positive)
    rates.write.partitionBy("factor").option("header", True).option("nullValue", "NA").csv(path)


def write_report(report: DataFrame, path: str) -> None:
    """Append a long (run, section, metric, value) table."""
    report.write.mode("append").parquet(path)


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)
