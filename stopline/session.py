"""Session helpers: the shared work folder, lineage cuts and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A lookup side is broadcast only when it has been measured at or below this.
BROADCAST_BYTES = 32 << 20


def work_dir(spark: SparkSession) -> str:
    """Folder all executors share, as the session names it in spark.checkpoint.dir.

    A local session (tests) gets a temporary folder when none is named; a
    cluster session without one is refused, since its executors share no disk.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if named is None and current is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="stopline-")
    if current is None:
        sc.setCheckpointDir(named)
    return named or current


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared work folder."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise `df` in the shared work folder, so a lost executor replays nothing."""
    work_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def store(df: DataFrame, name: str) -> DataFrame:
    """Write `df` under the shared work folder and read it back; removed when the driver's JVM ends."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    discard_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, name: str) -> DataFrame:
    """A table of fewer parts than cores, stored in a part a core: its rows' work would else be that of few tasks."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else store(df.repartition(cores), name)


@contextmanager
def compiled_methods(spark: SparkSession) -> Iterator[None]:
    """Within it, stages of wide rows run in methods short enough for the JIT compiler; the session's setting comes back."""
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, RECOMMENDED_SETTINGS[name])
    try:
        yield
    finally:
        spark.conf.set(name, before)


def discard_at_exit(spark: SparkSession, path: str) -> None:
    """Have a written path removed when the driver's JVM ends."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a path this session wrote under the shared work folder and no longer reads."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def data_bytes(df: DataFrame) -> int:
    """Bytes of the values of `df`, from one aggregate; nested values count as their JSON text."""
    size = F.lit(16 + 8 * len(df.columns)).cast("long")  # a row, and a word for each fixed-width value
    for f in df.schema.fields:
        col = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(col), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(col))), F.lit(0))
    return df.agg(F.sum(size)).first()[0] or 0


def broadcast_if_small(df: DataFrame, most: int | None = None) -> DataFrame:
    """Hint a broadcast only after measuring; larger sides are joined without a hint."""
    return F.broadcast(df) if data_bytes(df) <= (BROADCAST_BYTES if most is None else most) else df


def small_table(spark: SparkSession, rows: list, ddl: str) -> DataFrame:
    """A few driver rows as a local relation: no job and no Python worker to read them."""
    kinds = {"string": pa.string(), "double": pa.float64(), "bigint": pa.int64(),
             "int": pa.int32(), "boolean": pa.bool_()}
    fields = T.StructType.fromDDL(ddl).fields
    columns = list(zip(*rows)) or [()] * len(fields)
    table = pa.table(
        [pa.array(c, kinds[f.dataType.simpleString()]) for c, f in zip(columns, fields)],
        names=[f.name for f in fields])
    return spark.createDataFrame(table)


# Wide rows make Spark generate methods too long for the JIT compiler, which
# then run interpreted. With this limit Spark splits such stages up instead.
RECOMMENDED_SETTINGS = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Splits hot keys also where the split costs one more shuffle later on.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}
