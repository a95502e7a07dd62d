"""Resharding by minimum-cost flow: move the fewest bytes from old shards to new capacities.

Rows of equal text form a group; groups are gathered in blocks by a hash of the
text, so a block's copies stay together and a block is what moves. The old
shards' sizes and the new capacities are a transport problem: staying costs
nothing, moving costs one per byte. Successive shortest paths solve it on the
graph of shards, and blocks fill the flows, large ones first.

The driver sees one row per block and part, `BLOCKS * PARTS` at most whatever
the rows; texts are never shuffled. Places inside a shard are gapless: the
counted parts give offsets, and rows are numbered inside their part. A group of
copies spreads over the parts of its block, so no task numbers more than a part.

Defined results. A null text has no bytes; size is bytes plus 1. Repeated rows
have places of their own. An empty table gives no rows. Ties: blocks by size,
then number; places by doc_id, then CRC.
"""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopline.llm.common import store

BLOCKS = 6144
PARTS = 16
SHARDS = 8
OLD_SHARDS = 6


def cheapest_flow(supplies: list[int], capacities: list[int]) -> dict[tuple[int, int], int]:
    """Bytes from old shard i to new shard j at the least number of bytes moved (i != j).

    Successive shortest paths with potentials on source, old, new, sink.
    """
    n, m = len(supplies), len(capacities)
    source, sink = n + m, n + m + 1
    graph: list[list[list[int]]] = [[] for _ in range(n + m + 2)]

    def edge(a, b, cap, cost):
        graph[a].append([b, cap, cost, len(graph[b])])
        graph[b].append([a, 0, -cost, len(graph[a]) - 1])

    for i, s in enumerate(supplies):
        edge(source, i, s, 0)
        for j in range(m):
            edge(i, n + j, s, 0 if i == j else 1)
    for j, c in enumerate(capacities):
        edge(n + j, sink, c, 0)
    potential, left = [0] * len(graph), sum(supplies)
    while left:
        cost, came, queue = [None] * len(graph), {}, [(0, source)]
        cost[source] = 0
        while queue:
            d, a = heapq.heappop(queue)
            if d > cost[a]:
                continue
            for k, (b, cap, price, _) in enumerate(graph[a]):
                new = d + price + potential[a] - potential[b]
                if cap and (cost[b] is None or new < cost[b]):
                    cost[b], came[b] = new, (a, k)
                    heapq.heappush(queue, (new, b))
        if cost[sink] is None:
            raise ValueError("the capacities are smaller than the shards")
        potential = [p + (c or 0) for p, c in zip(potential, cost)]
        step, at = left, sink
        while at != source:
            a, k = came[at]
            step, at = min(step, graph[a][k][1]), a
        at = sink
        while at != source:
            a, k = came[at]
            graph[a][k][1] -= step
            graph[at][graph[a][k][3]][1] += step
            at = a
        left -= step
    return {(i, e[0] - n): supplies[i] - e[1] for i in range(n) for e in graph[i]
            if n <= e[0] < n + m and supplies[i] - e[1] > 0}


def place_blocks(blocks: dict[tuple[int, int], int], n_old: int, n_new: int) -> dict[tuple[int, int], int]:
    """New shard of every block (old shard, block), from their bytes."""
    supplies = [0] * n_old
    for (old, _), size in blocks.items():
        supplies[old] += size
    total = sum(supplies)
    capacities = [total * (j + 1) // n_new - total * j // n_new for j in range(n_new)]
    need = cheapest_flow(supplies, capacities)
    place, load = {}, [0] * n_new
    for key in sorted(blocks, key=lambda b: (-blocks[b], b)):
        _, stays, j = max((left, j == key[0], -j) for (i, j), left in need.items() if i == key[0])
        j = -j
        need[key[0], j] -= blocks[key]
        place[key] = j
        load[j] += blocks[key]
    # what the block sizes left uneven: small blocks go from the fullest to the emptiest shard
    of = [sorted((blocks[b], b) for b in place if place[b] == j) for j in range(n_new)]
    for _ in range(64 * n_new):
        full, empty = load.index(max(load)), load.index(min(load))
        gap = load[full] - load[empty]
        fits = [x for x in of[full] if 0 < x[0] < gap]
        if not fits:
            break
        size, b = min(fits, key=lambda x: (abs(2 * x[0] - gap), x))
        of[full].remove((size, b))
        of[empty].append((size, b))
        load[full] -= size
        load[empty] += size
        place[b] = empty
    return place


def resharded(docs: DataFrame, old_shard, n_old: int, n_new: int = SHARDS, text: str = "text",
              doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, size, text_crc32, old, shard, slot) of every row.

    `old_shard` is a column expression giving 0 .. n_old - 1, the same for equal texts
    if groups are to stay together.
    """
    per_old = max(1, BLOCKS // n_old)
    x = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), (F.octet_length(x) + F.lit(1)).cast("long").alias("size"),
        F.crc32(x.cast("binary")).alias("text_crc32"), old_shard.cast("int").alias("old"),
        F.pmod(F.xxhash64(F.lit("block"), x), F.lit(per_old)).cast("int").alias("block"),
        F.pmod(F.xxhash64(F.lit("part"), F.col(doc_id)), F.lit(PARTS)).cast("int").alias("part"))
    rows = store(rows, "sizes")
    counts = rows.groupBy("old", "block", "part").agg(
        F.sum("size").alias("size"), F.count("*").alias("n")).collect()  # BLOCKS * PARTS rows
    sizes: dict[tuple[int, int], int] = {}
    for old, block, _, size, _ in counts:
        sizes[old, block] = sizes.get((old, block), 0) + size
    place = place_blocks(sizes, n_old, n_new)
    table, filled = [], [0] * n_new
    for old, block, part, _, n in sorted(counts):
        shard = place[old, block]
        table.append((old, block, part, shard, filled[shard]))
        filled[shard] += n
    columns = list(zip(*table)) or [()] * 5
    types = [pa.int32()] * 4 + [pa.int64()]
    offsets = docs.sparkSession.createDataFrame(pa.table(
        [pa.array(c, t) for c, t in zip(columns, types)], names=["old", "block", "part", "shard", "offset"]))
    from pyspark.sql import Window

    place_in_part = Window.partitionBy("old", "block", "part").orderBy("doc_id", "text_crc32", "size")
    return (rows.join(F.broadcast(offsets), ["old", "block", "part"])
            .withColumn("slot", F.col("offset") + F.row_number().over(place_in_part) - 1)
            .select("doc_id", "size", "text_crc32", "old", "shard", F.col("slot").cast("long").alias("slot")))


def text_layout(n_old: int = OLD_SHARDS, text: str = "text"):
    """An old layout by text hash, for tables that carry no shard."""
    return F.pmod(F.xxhash64(F.lit("old"), F.coalesce(F.col(text), F.lit(""))), F.lit(n_old))


def shard_rows(docs: DataFrame) -> DataFrame:
    """All documents in shards 0 to 7 under the law `bytes`."""
    done = resharded(docs.select("doc_id", "text"), text_layout(), OLD_SHARDS)
    return done.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"))


def rewrite(spark: SparkSession, layout: str, out: str, n_new: int, text: str = "text",
            doc_id: str = "doc_id") -> dict[str, int]:
    """Rewrite a dataset in folders `shard=K` with `n_new` even shards at `out`.

    Only rows of shards that lose or win rows are read and written; untouched
    shards stay where they are and are named in the result with -1.
    """
    docs = spark.read.parquet(layout)
    if "shard" not in docs.columns:
        raise ValueError("the layout has no folders shard=K")
    n_old = 1 + (docs.agg(F.max("shard")).first()[0] or 0)
    moved = store(resharded(docs, F.col("shard"), n_old, n_new, text, doc_id), "moves")
    touched = {r[0] for r in moved.where("old != shard").select("old").distinct().collect()}
    touched |= {r[0] for r in moved.where("old != shard").select("shard").distinct().collect()}
    keys = [F.col(doc_id).alias("k1"), F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("k2")]
    goes = moved.select(F.col("doc_id").alias("k1"), F.col("text_crc32").alias("k2"), F.col("old").alias("k3"),
                        F.col("shard").alias("to")).distinct()
    rows = docs.where(F.col("shard").isin(sorted(touched))).withColumns({"k1": keys[0], "k2": keys[1]})
    rows = rows.join(goes, rows["k1"].eqNullSafe(goes["k1"]) & (rows["k2"] == goes["k2"])
                     & (rows["shard"] == goes["k3"])).drop("k1", "k2", "k3", "shard")
    rows.withColumnRenamed("to", "shard").write.partitionBy("shard").mode("overwrite").parquet(out)
    written = dict(spark.read.parquet(out).groupBy("shard").count().collect()) if touched else {}
    return {f"shard={k}": written.get(k, -1 if k not in touched else 0) for k in range(n_new)}
