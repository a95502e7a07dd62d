"""Forests grown, stored and scored in Spark, whatever their number of rows and nodes.

Rows travel as blocks of level and bin codes. While a node holds more than `GROUP_ROWS` rows, one pass over the
blocks counts the codes of all such nodes and trees. A smaller node's rows then meet in one task, which grows the rest of
its tree there. Nodes stay in a stored table, packed per grown part; no forest reaches the driver. For votes, a
tree meets the rows it is to judge in groups of (tree, part of the rows).

Samples are those of `bagging.copies`. Splits go by gini gain, over `mtry` columns that a hash of (seed, tree, node)
draws; levels are ordered by their number of positive rows in the node. Pairs of leaves of one class are merged. A node has the
number 2i + 1 or 2i + 2 under node i, the root 0.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stopline.models.bagging import CUTS, draw, with_partner
from stopline.models.lasso import added_up
from stopline.operators.selection import exact_quantiles, extents
from stopline.session import discard_at_exit, new_path, small_table, store

BINS = 32                 # of a number
BLOCK_ROWS = 1 << 14
GROUP_ROWS = 1 << 20      # of a node whose subtree one task grows
PART_ROWS = 1 << 21       # that meet a tree in one task; each tree, which grows with the rows, is sent to all parts
ROWS_AT_ONCE = 1 << 26    # rows x trees in one shuffle
CELLS = 1 << 23           # numbers of one counting pass
LEAST_GAIN = 1e-12
BOTH = float(1 << 26)     # two sums in one: of less than 2 ** 26 copies each

PACKET = "tree int, top bigint, n int, ids binary, feature binary, mask binary, gain binary, weight binary, ones binary, rows binary"


@dataclass(frozen=True)
class Bins:
    """Per column: None for a factor, whose levels are codes, or the ascending cuts of a number."""
    cuts: list
    size: int

    @property
    def factor(self) -> np.ndarray:
        return np.array([c is None for c in self.cuts])

    @property
    def kind(self):
        return np.uint8 if self.size <= 256 else np.uint16

    def codes(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(x.shape, self.kind)
        for j, cuts in enumerate(self.cuts):
            out[:, j] = x[:, j] if cuts is None else np.searchsorted(cuts, x[:, j], "left")
        return out


def bins_of(df: DataFrame, features: str = "features") -> Bins:
    """Factors as the column's metadata names them; a number is cut between its values, or at quantiles if they are many."""
    attrs = df.schema[features].metadata["ml_attr"]["attrs"]
    levels = {a["idx"]: len(a.get("vals", "01")) for kind in ("nominal", "binary") for a in attrs.get(kind, [])}
    width = sum(len(a) for a in attrs.values())
    numbers = [j for j in range(width) if j not in levels]
    cuts: list = [None] * width
    if not numbers:
        return Bins(cuts, max([BINS, *levels.values()]))
    x = df.select(vector_to_array(features).alias("x")).select(*[F.get("x", F.lit(j)).alias(f"x{j}") for j in numbers])
    long = x.select(F.inline(F.array(*[F.struct(F.lit(j).alias("j"), F.col(f"x{j}").alias("v")) for j in numbers])))
    first = Window.partitionBy("j").orderBy("v")  # keeps BINS + 1 values a column before the shuffle
    least = long.distinct().withColumn("k", F.row_number().over(first)).where(F.col("k") <= BINS + 1)
    values: dict = {j: [] for j in numbers}
    for r in least.select("j", "v").collect():
        values[r["j"]].append(r["v"])
    many = [j for j in numbers if len(values[j]) > BINS]
    spans = extents(x, [f"x{j}" for j in many]) if many else {}
    found = exact_quantiles(long.where(F.col("j").isin(many)), "v", [k / BINS for k in range(1, BINS)],
                            {j: spans[f"x{j}"] for j in many}, "j") if many else {}
    for j in numbers:
        few = sorted(values[j])
        cuts[j] = np.unique(found[j]) if j in found else np.array([(a + b) / 2 for a, b in zip(few, few[1:])])
    return Bins(cuts, max([BINS, *levels.values()]))


# ---- blocks of rows ----

def blocks(df: DataFrame, key: str, bins: Bins, count: int, held: bool, partner: bool = False, label: str = "label",
           carry: str | None = None) -> DataFrame:
    """Rows as stored blocks: keys, labels, codes, a partner's codes, and the copies of each row in `count` samples.

    `held` rows are in no sample. `carry` is a text column that goes along.
    """
    spark, width = df.sparkSession, len(bins.cuts)
    names = F.col(carry).cast("string") if carry else F.lit(None).cast("string")
    rows = df.select(key, F.col(label).cast("double").alias("_y"), names.alias("_name"), "features")
    parts = max(spark.sparkContext.defaultParallelism, -(-rows.count() // (8 * BLOCK_ROWS)))
    if partner:
        rows = with_partner(rows, key)
    draws = F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda t: draw(key, t))
    rows = rows.repartition(parts).select(
        key, "_y", "_name", vector_to_array("features").alias("_x"),
        vector_to_array("partner" if partner else "features").alias("_z"),
        (F.lit(None).cast("array<bigint>") if held else draws).alias("_draws"))
    limits = np.array(CUTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, waiting, held_back = TaskContext.get().partitionId(), [], 0
        made = 0

        def block(parts):
            nonlocal made
            made += 1
            keys, names = (pa.concat_arrays([p[i] for p in parts]) for i in (0, 1))
            one = [b"".join(x) for x in zip(*[(p[2], p[3], p[4]) for p in parts])]
            drawn = b"" if held else np.concatenate([p[5] for p in parts], 1).tobytes()
            lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (keys, names)]
            return pa.RecordBatch.from_arrays(
                [pa.array([(at << 32 | made) * 2 + held], pa.int64()), pa.array([held]), pa.array([len(keys)], pa.int32()),
                 *lists, *[pa.array([x], pa.binary()) for x in (*one, drawn)]],
                ["block", "held", "n", "keys", "names", "label", "codes", "other", "copies"])

        for batch in batches:
            if not batch.num_rows:
                continue
            n = batch.num_rows
            x, z = (bins.codes(batch.column(i).flatten().to_numpy().reshape(n, width)) for i in (3, 4))
            drawn = None if held else np.searchsorted(
                limits, batch.column(5).flatten().to_numpy().reshape(n, count), "right").astype(np.uint8).T
            waiting.append((batch.column(0), batch.column(2), (batch.column(1).to_numpy() == 1).astype(np.uint8).tobytes(),
                            x.tobytes(), z.tobytes() if partner else b"", drawn))
            held_back += n
            if held_back >= BLOCK_ROWS:
                yield block(waiting)
                waiting, held_back = [], 0
        if waiting:
            yield block(waiting)

    return store(rows.mapInArrow(
        run, f"block bigint, held boolean, n int, keys array<{dict(df.dtypes)[key]}>, names array<string>, label binary, "
             "codes binary, other binary, copies binary"), "blocks")


# ---- splits ----

def candidates(seed: int, tree, ids: np.ndarray, width: int, mtry: int) -> np.ndarray:
    """(nodes, mtry) columns to try, drawn by a hash."""
    def mixed(x):
        for shift, odd in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(odd)
        return x ^ (x >> np.uint64(31))
    with np.errstate(over="ignore"):
        start = mixed(np.asarray(tree, np.uint64) + np.uint64(seed * 1_000_003 + 1)) + ids.astype(np.uint64)
        h = mixed(mixed(start)[:, None] + np.arange(1, width + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    mtry = min(mtry, width)
    return np.sort(np.argpartition(h, mtry - 1, axis=1)[:, :mtry], axis=1)


class Best:
    """The best split of each node, from the counts of one candidate column after the other."""

    def __init__(self, nodes: int, size: int):
        self.size = size
        self.gain = np.full(nodes, -np.inf)
        self.feature = np.full(nodes, -1, np.int16)
        self.mask = np.zeros((nodes, size), bool)  # codes that go left

    def offer(self, feature: np.ndarray, factor: np.ndarray, weight: np.ndarray, ones: np.ndarray) -> None:
        """`weight`, `ones`: flat (nodes x codes) sums of the rows and of the positive rows; `feature` by node."""
        cell = np.flatnonzero(weight)
        node, code = np.divmod(cell, self.size)
        w, y = weight[cell], ones[cell]
        first = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
        most = np.repeat(np.add.reduceat(y, first) + 1.0, np.diff(np.append(first, len(node))))
        ordered = np.argsort(2.0 * node + np.where(factor[feature[node]], y / most, code / self.size), kind="stable")
        code, w, y = code[ordered], w[ordered], y[ordered]
        last = np.append(first[1:], len(node)) - 1
        place = np.repeat(np.arange(len(first)), last - first + 1)
        cw, cy = np.cumsum(w), np.cumsum(y)
        tw, ty = np.add.reduceat(w, first), np.add.reduceat(y, first)
        lw, ly = cw - (cw[first] - w[first])[place], cy - (cy[first] - y[first])[place]
        rw, ry = tw[place] - lw, ty[place] - ly
        with np.errstate(divide="ignore", invalid="ignore"):
            pure = (ly ** 2 + (lw - ly) ** 2) / lw + (ry ** 2 + (rw - ry) ** 2) / rw
            gain = pure / tw[place] - ((ty ** 2 + (tw - ty) ** 2) / tw ** 2)[place]
        gain[last] = -np.inf
        most = np.maximum.reduceat(gain, first)
        who = node[first]
        better = most > self.gain[who]
        hit = np.flatnonzero((gain == most[place]) & better[place])
        hit = hit[np.append(True, place[hit][1:] != place[hit][:-1])] if len(hit) else hit
        new = who[place[hit]]
        self.gain[new], self.feature[new] = gain[hit], feature[new]
        end = np.full(len(first), -1)
        end[place[hit]] = hit
        left = np.arange(len(node)) <= end[place]
        self.mask[new] = False
        self.mask[node[left], code[left]] = True
        number = ~factor[feature[new]]
        self.mask[new[number]] = np.arange(self.size) <= code[hit[number]][:, None]


# ---- growing ----

def apart(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the copies and of the positive copies, from those of copies * (1 + BOTH * class), which are exact."""
    ones = np.floor(sums / BOTH)
    return sums - ones * BOTH, ones


def grow(codes: np.ndarray, y: np.ndarray, w: np.ndarray, tree: int, top: int, mtry: int, max_depth: int, factor: np.ndarray,
         size: int, seed: int) -> dict[str, np.ndarray]:
    """All nodes below and with node `top` (numbered from 1 at the root), grown level by level on these rows."""
    both, flat = w * (1.0 + BOTH * y), codes.ravel()
    rows, at, ids = np.arange(len(y)) * codes.shape[1], np.zeros(len(y), np.int64), np.array([top], np.int64)  # rows: place of the first code
    levels = []
    while len(ids):
        m = len(ids)
        weight, ones = apart(np.bincount(at, both, m))
        node = {"ids": ids, "feature": np.full(m, -1, np.int16), "mask": np.zeros((m, size), bool), "gain": np.full(m, -1.0),
                "weight": weight, "ones": ones, "rows": np.bincount(at, minlength=m).astype(np.int64)}
        levels.append(node)
        able = (ones > 0) & (ones < weight) & (int(ids[0]).bit_length() <= max_depth)
        if not able.all():
            go = np.flatnonzero(able.take(at))
            rows, both, at = rows.take(go), both.take(go), (np.cumsum(able) - 1).take(at.take(go))
        able = np.flatnonzero(able)
        if not len(able):
            break
        tried, best = candidates(seed, tree, ids[able], codes.shape[1], mtry), Best(len(able), size)
        first = at * size
        for k in range(tried.shape[1]):
            column = np.ascontiguousarray(tried[:, k])
            cell = first + flat.take(rows + column.take(at))
            best.offer(column, factor, *apart(np.bincount(cell, both, len(able) * size)))
        split = best.gain > LEAST_GAIN
        done = able[split]
        node["feature"][done], node["mask"][done], node["gain"][done] = best.feature[split], best.mask[split], best.gain[split]
        if not split.all():
            go = np.flatnonzero(split.take(at))
            rows, both, at = rows.take(go), both.take(go), at.take(go)
        left = best.mask.ravel().take(at * size + flat.take(rows + best.feature.take(at)))
        at = (2 * (np.cumsum(split) - 1)).take(at) + ~left
        ids = (2 * ids[done][:, None] + np.array([0, 1])).ravel()
    return merge_leaves({k: np.concatenate([x[k] for x in levels]) for k in levels[0]})


def merge_leaves(nodes: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Two leaves of one class below a node make it a leaf, from the bottom up; `nodes` ascend by number."""
    ids, feature, vote = nodes["ids"], nodes["feature"], 2 * nodes["ones"] > nodes["weight"]
    keep = np.ones(len(ids), bool)
    depth = np.frexp(ids.astype(float))[1]
    for d in range(depth.max(initial=0), depth.min(initial=1) - 1, -1):
        inner = np.flatnonzero((depth == d) & (feature >= 0))
        left, right = np.searchsorted(ids, 2 * ids[inner]), np.searchsorted(ids, 2 * ids[inner] + 1)
        same = (feature[left] < 0) & (feature[right] < 0) & (vote[left] == vote[right])
        keep[left[same]] = keep[right[same]] = False
        feature[inner[same]], nodes["gain"][inner[same]], nodes["mask"][inner[same]] = -1, -1.0, False
    return {k: v[keep] for k, v in nodes.items()}


def packed(tree: int, top: int, nodes: dict[str, np.ndarray]) -> list:
    """A row of the stored table."""
    return [tree, top, len(nodes["ids"]), *[nodes[k].tobytes() for k in ("ids", "feature")],
            np.packbits(nodes["mask"], axis=1).tobytes(), *[nodes[k].tobytes() for k in ("gain", "weight", "ones", "rows")]]


def packet_table(rows: Sequence[list]) -> pa.Table:
    kinds = [pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 7]
    columns = list(zip(*rows)) or [()] * 10
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=[x.split()[0] for x in PACKET.split(", ")])


def unpacked(table: pa.Table, size: int, columns: Sequence[str]) -> dict[str, np.ndarray]:
    """The nodes of some packets, in ascending number."""
    kinds = {"ids": np.int64, "feature": np.int16, "mask": np.uint8, "rows": np.int64}
    out = {c: np.frombuffer(b"".join(table[c].to_pylist()), kinds.get(c, np.float64)) for c in columns}
    if "mask" in out:
        wide = -(-size // 8)
        out["mask"] = np.unpackbits(out["mask"].reshape(-1, wide), axis=1, count=size).astype(bool)
    ordered = np.argsort(out["ids"], kind="stable")
    return {c: v[ordered] for c, v in out.items()}


class Tops:
    """The upper nodes of all trees, which hold too many rows for one task."""

    def __init__(self, count: int, size: int):
        self.tree, self.ids = np.arange(count), np.ones(count, np.int64)
        self.feature, self.mask = np.full(count, -1, np.int16), np.zeros((count, size), bool)
        self.gain, self.left = np.full(count, -1.0), np.full(count, -1)
        self.sums = np.zeros((count, 3))           # weight, ones, rows
        self.whole = np.zeros(count, bool)          # grown by one task

    def split(self, at: np.ndarray, best: Best, sums: np.ndarray) -> np.ndarray:
        """Split these nodes; the places of their children, left and right in turn. `sums`: theirs, in the same order."""
        self.feature[at], self.mask[at], self.gain[at] = best.feature, best.mask, best.gain
        new = len(self.ids) + np.arange(2 * len(at))
        self.left[at] = new[::2]
        self.tree = np.append(self.tree, np.repeat(self.tree[at], 2))
        self.ids = np.append(self.ids, (2 * self.ids[at][:, None] + np.array([0, 1])).ravel())
        for name, blank in (("feature", np.int16(-1)), ("gain", -1.0), ("left", -1), ("whole", False)):
            old = getattr(self, name)
            setattr(self, name, np.append(old, np.full(len(new), blank, old.dtype)))
        self.mask = np.vstack([self.mask, np.zeros((len(new), self.mask.shape[1]), bool)])
        self.sums = np.vstack([self.sums, sums])
        return new

    def walk(self, tree: int, codes: np.ndarray) -> np.ndarray:
        if self.feature[tree] < 0:
            return np.full(len(codes), tree)
        return walk(np.full(len(codes), tree), codes, self.feature, self.mask, np.stack([self.left, self.left + 1], 1))


def walk(node: np.ndarray, codes: np.ndarray, feature: np.ndarray, mask: np.ndarray, child: np.ndarray,
         asked: np.ndarray | None = None, row: np.ndarray | None = None, other: tuple | None = None) -> np.ndarray:
    """The leaf each line reaches from its inner node `node`; `child`: left and right of each node.

    asked: (lines, columns), gets the first node that asked a line for a column. row: a line's row of `codes`, if not
    its own. other: a column of each line, and the code the line has there instead of the row's.
    """
    size, width, inner, child = mask.shape[1], codes.shape[1], feature >= 0, child.ravel()
    flat, mask = codes.ravel(), mask.ravel()
    out, going, here = np.empty(len(node), np.int64), np.arange(len(node)), node
    at = (going if row is None else row) * width
    if other:
        column, instead = other
    while len(going):
        asks = feature.take(here)
        code = flat.take(at + asks)
        if other:
            code = np.where(asks == column, instead, code)
        if asked is not None:
            cell = at + asks
            new = np.flatnonzero(asked.ravel().take(cell) < 0)
            asked.ravel()[cell.take(new)] = here.take(new)
        here = child.take(2 * here + ~mask.take(here * size + code))
        on = inner.take(here)
        if not on.all():
            done, on = np.flatnonzero(~on), np.flatnonzero(on)
            out[going.take(done)] = here.take(done)
            going, here, at = going.take(on), here.take(on), at.take(on)
            if other:
                column, instead = column.take(on), instead.take(on)
    return out


def _read(row: dict, kind, width: int):
    n = row["n"]
    return (np.frombuffer(row["label"], np.uint8), np.frombuffer(row["codes"], kind).reshape(n, width),
            np.frombuffer(row["copies"], np.uint8).reshape(-1, n))


def upper_nodes(train: DataFrame, bins: Bins, count: int, mtry: int, max_depth: int, seed: int, rows: int,
                group_rows: int) -> Tops:
    """Split the nodes of more than `group_rows` rows, a level of all trees at a time."""
    spark, size, width, kind, factor = train.sparkSession, bins.size, len(bins.cuts), bins.kind, bins.factor
    tops = Tops(count, size)
    if rows <= group_rows:
        tops.whole[:] = True
        return tops
    columns = train.select("n", "label", "codes", "copies")
    level = np.arange(count)
    while len(level):
        tried = candidates(seed, tops.tree[level], tops.ids[level], width, mtry)
        each, following = tried.shape[1] * size * 3, []
        step = max(1, CELLS // each)
        for a in range(0, len(level), step):
            at, cand = level[a:a + step], tried[a:a + step]
            slot = np.full(len(tops.ids), -1)
            slot[at] = np.arange(len(at))
            shared = spark.sparkContext.broadcast((tops, slot, cand))

            def compute(batches):
                tops, slot, cand = shared.value
                total, columns = np.zeros((cand.shape[1], 3, len(cand) * size)), np.ascontiguousarray(cand.T)
                some = np.unique(tops.tree[slot >= 0])
                for batch in batches:
                    for row in batch.to_pylist():
                        y, codes, copies = _read(row, kind, width)
                        for t in some:
                            mine = np.flatnonzero(copies[t])
                            x = codes[mine]
                            s = slot.take(tops.walk(t, x))
                            here = np.flatnonzero(s >= 0)
                            if not len(here):
                                continue
                            mine, s, at = mine.take(here), s.take(here), here * width
                            lo, m = s.min(), (s.max() - s.min() + 1) * size
                            both, first = copies[t].take(mine) * (1.0 + BOTH * y.take(mine)), (s - lo) * size
                            for k in range(cand.shape[1]):
                                cell = first + x.ravel().take(at + columns[k].take(s))
                                for i, v in enumerate((*apart(np.bincount(cell, both, m)), np.bincount(cell, minlength=m))):
                                    total[k, i, lo * size:lo * size + m] += v
                return total.ravel()

            total = added_up(columns, compute, len(at) * each).reshape(tried.shape[1], 3, -1)
            shared.unpersist()
            sums = total[0].reshape(3, len(at), size).sum(-1).T
            tops.sums[at] = sums
            small = sums[:, 2] <= group_rows
            tops.whole[at[small]] = True
            pick = np.flatnonzero(~small & (sums[:, 1] > 0) & (sums[:, 1] < sums[:, 0])
                                  & (np.frexp(tops.ids[at].astype(float))[1] <= max_depth))
            if not len(pick):
                continue
            best = Best(len(at), size)
            for k in range(tried.shape[1]):
                best.offer(cand[:, k], factor, total[k, 0], total[k, 1])
            pick = pick[best.gain[pick] > LEAST_GAIN]
            best.gain, best.feature, best.mask = best.gain[pick], best.feature[pick], best.mask[pick]
            used = (cand[pick] == best.feature[:, None]).argmax(1)
            counts = total.reshape(tried.shape[1], 3, len(at), size)[used, :, pick]
            left = (counts * best.mask[:, None, :]).sum(-1)
            child = np.stack([left, sums[pick] - left], 1).reshape(-1, 3)
            new = tops.split(at[pick], best, child)
            tops.whole[new[child[:, 2] <= group_rows]] = True
            following.append(new[child[:, 2] > group_rows])
        level = np.concatenate(following) if following else np.array([], int)
    return tops


def fit(train: DataFrame, bins: Bins, count: int, mtry: int, max_depth: int, seed: int = 7,
        group_rows: int | None = None) -> DataFrame:
    """The stored nodes of `count` trees, packed; `train` are blocks."""
    group_rows = GROUP_ROWS if group_rows is None else group_rows
    spark, size, width, kind, factor = train.sparkSession, bins.size, len(bins.cuts), bins.kind, bins.factor
    rows = train.agg(F.sum("n")).first()[0] or 0
    if not rows:
        raise ValueError("a forest needs rows")
    tops = upper_nodes(train, bins, count, mtry, max_depth, seed, rows, group_rows)
    shared = spark.sparkContext.broadcast(tops)
    columns = train.select("n", "label", "codes", "copies")
    path = new_path(spark, "grown")

    def some(first: int, end: int) -> DataFrame:
        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tops = shared.value
            for batch in batches:
                for row in batch.to_pylist():
                    y, codes, copies = _read(row, kind, width)
                    for t in range(first, end):
                        mine = np.flatnonzero(copies[t])
                        x, node = codes[mine], tops.walk(t, codes[mine])
                        ordered = np.argsort(node, kind="stable")
                        cuts = np.flatnonzero(np.diff(node[ordered])) + 1
                        out = [(t, int(tops.ids[node[g[0]]]), x[g].tobytes(), y[mine[g]].tobytes(), copies[t][mine[g]].tobytes())
                               for g in np.split(ordered, cuts) if len(g) and tops.whole[node[g[0]]]]
                        if out:
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(c, k) for c, k in zip(zip(*out), (pa.int32(), pa.int64(), *[pa.binary()] * 3))],
                                ["tree", "top", "codes", "label", "copies"])

        def grown(part: pa.Table) -> pa.Table:
            codes, y, w = (np.frombuffer(b"".join(part[c].to_pylist()), k)
                           for c, k in (("codes", kind), ("label", np.uint8), ("copies", np.uint8)))
            tree, top = part["tree"][0].as_py(), part["top"][0].as_py()
            return packet_table([packed(tree, top, grow(
                codes.reshape(-1, width), y, w, tree, top, mtry, max_depth, factor, size, seed))])

        sent = columns.mapInArrow(send, "tree int, top bigint, codes binary, label binary, copies binary")
        return sent.groupBy("tree", "top").applyInArrow(grown, PACKET)

    each = max(1, ROWS_AT_ONCE // rows)
    for first in range(0, count, each):
        some(first, min(first + each, count)).write.mode("append").parquet(path)
    discard_at_exit(spark, path)
    shared.unpersist()
    found = spark.read.schema(PACKET).parquet(path)
    if not (tops.feature >= 0).any() and tops.whole.all():
        return found
    return _with_tops(found, tops, size)


def _with_tops(found: DataFrame, tops: Tops, size: int) -> DataFrame:
    """Add the upper nodes, after merging leaves across the border."""
    spark = found.sparkSession
    single = {(r["tree"], r["top"]) for r in found.where("n = 1").select("tree", "top").collect()}
    gone, tables = [], []
    for t in np.unique(tops.tree):
        mine = np.flatnonzero((tops.tree == t) & (~tops.whole | np.array([(t, i) in single for i in tops.ids])))
        deep = np.flatnonzero((tops.tree == t) & tops.whole)
        mine = np.union1d(mine, deep)
        mine = mine[np.argsort(tops.ids[mine])]
        inner = tops.whole[mine] & ~np.array([(t, i) in single for i in tops.ids[mine]])
        nodes = {"ids": tops.ids[mine], "feature": np.where(inner, np.int16(0), tops.feature[mine]), "mask": tops.mask[mine],
                 "gain": tops.gain[mine], "weight": tops.sums[mine, 0], "ones": tops.sums[mine, 1],
                 "rows": tops.sums[mine, 2].astype(np.int64), "border": tops.whole[mine]}
        kept = _merge_upper(nodes, inner)
        gone += [(int(t), int(i)) for i in tops.ids[mine][tops.whole[mine]] if i not in set(kept["ids"][kept["border"]].tolist())]
        upper = {k: v[~kept["border"]] for k, v in kept.items()}
        if len(upper["ids"]):
            tables.append(packed(int(t), 0, upper))
    if gone:
        found = found.join(F.broadcast(small_table(spark, gone, "tree int, top bigint")), ["tree", "top"], "left_anti")
    return store(found.unionByName(spark.createDataFrame(packet_table(tables)).select(*found.columns)), "grown")


def _merge_upper(nodes: dict[str, np.ndarray], inner: np.ndarray) -> dict[str, np.ndarray]:
    """`merge_leaves` where some nodes have their children elsewhere, and so are no leaves."""
    elsewhere = nodes["ids"][inner]
    work = {**nodes, "feature": np.where(inner, np.int16(-1), nodes["feature"])}
    ids, keep = work["ids"], np.ones(len(inner), bool)
    vote, leaf = 2 * work["ones"] > work["weight"], (work["feature"] < 0) & ~np.isin(ids, elsewhere)
    for i in range(len(ids) - 1, -1, -1):
        if work["feature"][i] >= 0:
            a, b = np.searchsorted(ids, [2 * ids[i], 2 * ids[i] + 1])
            if leaf[a] and leaf[b] and vote[a] == vote[b]:
                keep[[a, b]] = False
                work["feature"][i], work["gain"][i], work["mask"][i], leaf[i] = -1, -1.0, False, True
    return {k: v[keep] for k, v in work.items()}


def load(spark: SparkSession, path: str) -> DataFrame:
    """The nodes of a saved forest."""
    return spark.read.schema(PACKET).parquet(path)


# ---- votes ----

def votes(nodes: DataFrame, rows: DataFrame, key: str, bins: Bins, count: int, sizes: Sequence[int],
          importance: bool = False) -> DataFrame:
    """(block, place, held, key, label, name, seen, positive, score, lost): one row per row of the blocks, stored.

    A row of the sample is judged by the trees that have not seen it, a held row by all. For each number of trees in
    `sizes`: how many judged the row, how many of them said 1, and the mean share of the positive class in their
    leaves. `lost` is as in `bagging.out_of_bag`.
    """
    spark, size, width, kind = rows.sparkSession, bins.size, len(bins.cuts), bins.kind
    total = rows.agg(F.sum("n")).first()[0] or 0
    parts, each = max(1, -(-total // PART_ROWS)), max(1, ROWS_AT_ONCE // max(total, 1))
    sizes = list(sizes)
    path = new_path(spark, "judged")

    def some(first: int, end: int) -> DataFrame:
        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    n, block = row["n"], row["block"]
                    label, codes, copies = _read(row, kind, width)
                    other = np.frombuffer(row["other"], kind).reshape(-1, width)
                    for t in range(first, end):
                        at = np.arange(n) if row["held"] else np.flatnonzero(copies[t] == 0)
                        if not len(at):
                            continue
                        swapped = other[at].tobytes() if importance and not row["held"] else b""
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([t], pa.int32()), pa.array([block * 2654435761 % 2 ** 32 % parts], pa.int32()),
                             pa.array([block], pa.int64()),
                             *[pa.array([x], pa.binary()) for x in (at.astype(np.int32).tobytes(), label[at].tobytes(),
                                                                     codes[at].tobytes(), swapped)]],
                            ["tree", "part", "block", "at", "label", "codes", "other"])

        def judge(mine: pa.Table, forest: pa.Table) -> pa.Table:
            tree = unpacked(forest, size, ["ids", "feature", "mask", "weight", "ones"])
            ids, feature, mask = tree["ids"], tree["feature"], tree["mask"]
            left, right = np.searchsorted(ids, 2 * ids), np.searchsorted(ids, 2 * ids + 1)
            share = tree["ones"] / tree["weight"]
            child, inner = np.stack([left, right], 1), len(ids) > 0 and feature[0] >= 0

            out = []
            for block, at, label, codes, other in zip(*[mine[c].to_pylist() for c in ("block", "at", "label", "codes", "other")]):
                x = np.frombuffer(codes, kind).reshape(-1, width)
                asked = np.full(x.shape, -1, np.int64) if other else None
                end = walk(np.zeros(len(x), np.int64), x, feature, mask, child, asked) if inner else np.zeros(len(x), int)
                said = share[end] if len(ids) else np.zeros(len(x))
                lost = b""
                if other:
                    z, y = np.frombuffer(other, kind).reshape(-1, width), np.frombuffer(label, np.uint8)
                    right_now = (said > 0.5) == y
                    less = np.zeros((len(x), width), np.int8)
                    # the others end where they did; these part from their way where the column is first asked
                    row, column = np.nonzero((asked >= 0) & (x != z))
                    if len(row):
                        moved = walk(asked[row, column], x, feature, mask, child, None, row, (column, z[row, column]))
                        less[row, column] = right_now[row].astype(np.int8) - ((share[moved] > 0.5) == y[row])
                    lost = less.tobytes()
                out.append((block, mine["tree"][0].as_py(), at, said.tobytes(), lost))
            kinds = (pa.int64(), pa.int32(), *[pa.binary()] * 3)
            columns = list(zip(*out)) or [()] * 5
            return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["block", "tree", "at", "said", "lost"])

        sent = rows.select("block", "held", "n", "label", "codes", "other", "copies").mapInArrow(
            send, "tree int, part int, block bigint, at binary, label binary, codes binary, other binary")
        forest = nodes.where((F.col("tree") >= first) & (F.col("tree") < end)).select(
            "tree", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), "ids", "feature", "mask", "weight", "ones")
        return sent.groupBy("tree", "part").cogroup(forest.groupBy("tree", "part")).applyInArrow(
            judge, "block bigint, tree int, at binary, said binary, lost binary")

    for first in range(0, count, each):
        some(first, min(first + each, count)).write.mode("append").parquet(path)
    discard_at_exit(spark, path)
    judged = spark.read.parquet(path)

    def tally(block: pa.Table, found: pa.Table) -> pa.Table:
        n, k = block["n"][0].as_py(), len(sizes)
        seen, ones = np.zeros((n, k), np.int32), np.zeros((n, k), np.int32)
        score, lost = np.zeros((n, k)), np.zeros((n, width), np.int32)
        found = found.sort_by("tree")
        for tree, at, said, less in zip(*[found[c].to_pylist() for c in ("tree", "at", "said", "lost")]):
            at, said = np.frombuffer(at, np.int32), np.frombuffer(said)
            for i, most in enumerate(sizes):
                if tree < most:
                    seen[at, i] += 1
                    ones[at, i] += said > 0.5
                    score[at, i] += said
            if less:
                lost[at] += np.frombuffer(less, np.int8).reshape(-1, width)
        score /= np.maximum(seen, 1)
        held = block["held"][0].as_py()

        def lists(x, item):
            return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * x.shape[1], pa.int32()), pa.array(x.ravel(), item))
        none = pa.nulls(n, pa.list_(pa.int32()))
        flat = [c.combine_chunks().flatten() if isinstance(c, pa.ChunkedArray) else c.flatten()
                for c in (block["keys"], block["names"])]
        return pa.table([
            pa.array(np.full(n, block["block"][0].as_py())), pa.array(np.arange(n), pa.int32()), pa.array(np.full(n, held)),
            flat[0], pa.array(np.frombuffer(block["label"][0].as_py(), np.uint8).astype(float)), flat[1],
            lists(seen, pa.int32()), lists(ones, pa.int32()), lists(score, pa.float64()),
            lists(lost, pa.int32()) if importance and not held else none],
            names=["block", "place", "held", key, "label", "name", "seen", "positive", "score", "lost"])

    item = dict(rows.dtypes)["keys"].removeprefix("array<").removesuffix(">")
    return store(rows.select("block", "n", "held", "keys", "names", "label").groupBy("block").cogroup(
        judged.groupBy("block")).applyInArrow(
            tally, f"block bigint, place int, held boolean, `{key}` {item}, label double, name string, seen array<int>, "
                   "positive array<int>, score array<double>, lost array<int>"), "votes")


def predicted(judged: DataFrame, at: int, name: str) -> DataFrame:
    """The held rows with the probability of the positive class and the 0/1 prediction of the forest at place `at`."""
    share = F.get("score", F.lit(at))
    return judged.where("held").drop("held", "lost").withColumnRenamed("name", name).withColumns(
        {"probability": share, "prediction": (share > 0.5).cast("double")})


# ---- node tables ----

def tree_nodes(packets: DataFrame, bins: Bins, names: Sequence[str], trees: int | None = None) -> DataFrame:
    """The first `trees` trees in the form of `trees.tree_nodes`, and each node's weight in the sample as `copies`."""
    size, cuts = bins.size, bins.cuts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                part = pa.Table.from_batches([batch.slice(i, 1)])
                x = unpacked(part, size, ["ids", "feature", "mask", "gain", "weight", "ones", "rows"])
                for a in range(0, len(x["ids"]), 50_000):
                    ids, feature, mask, gain, weight, ones, rows = (v[a:a + 50_000] for v in x.values())
                    leaf = feature < 0
                    code = [[] if f < 0 else np.flatnonzero(m).astype(float).tolist() if cuts[f] is None
                            else [float(cuts[f][m.sum() - 1])] for f, m in zip(feature.tolist(), mask)]
                    node = ids - 1
                    yield pa.RecordBatch.from_arrays([
                        pa.array(feature.astype(np.int32), mask=leaf),
                        pa.array(np.full(len(ids), part["tree"][0].as_py(), np.int32)), pa.array(node.astype(np.int32)),
                        pa.array((2 * node + 1).astype(np.int32), mask=leaf), pa.array((2 * node + 2).astype(np.int32), mask=leaf),
                        pa.array(code, pa.list_(pa.float64())), pa.array(gain), pa.array(rows),
                        pa.array((2 * ones > weight).astype(float)), pa.array(weight)],
                        ["feature", "tree", "node", "left", "right", "split_code", "gain", "weight", "prediction", "copies"])

    some = packets if trees is None else packets.where(F.col("tree") < trees)
    flat = some.mapInArrow(run, "feature int, tree int, node int, left int, right int, split_code array<double>, gain double, "
                                "weight bigint, prediction double, copies double")
    lookup = small_table(packets.sparkSession, list(enumerate(names)), "feature int, variable string")
    return flat.join(F.broadcast(lookup), "feature", "left")


def impurity_importance(spark: SparkSession, nodes: DataFrame, names: Sequence[str]) -> DataFrame:
    """(variable, importance): each tree's impurity decreases scaled to sum 1, their mean scaled to sum 1."""
    per_tree = nodes.where("variable is not null").groupBy("tree", "variable").agg(F.sum(F.col("gain") * F.col("copies")).alias("s"))
    total = per_tree.groupBy("tree").agg(F.sum("s").alias("whole"))
    shares = per_tree.join(total, "tree").groupBy("variable").agg(F.sum(F.col("s") / F.col("whole")).alias("s"))
    found = {r["variable"]: r["s"] for r in shares.collect()}  # a row per column
    whole = sum(found.values()) or 1.0
    return small_table(spark, [(n, float(found.get(n, 0.0) / whole)) for n in names], "variable string, importance double")
