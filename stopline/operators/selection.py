"""Exact order statistics, quantile buckets, row numbers and samples without a global sort.

A window without partition keys, or an exact percentile, would bring all rows
to one task. Here a rank is found by counting rows in a few thousand equal
value ranges, then again inside the one range that holds the rank, until that
range is a single value. Every pass is a scan of one column with map-side
counting, and only the range counts reach the driver, about `RANGES` a pass
whatever the number of ranks.

NaN counts as missing. Infinities are values: a pass sets them apart before the
finite ones are divided. Passes are bounded by the number format: each divides
the spread of what is left by the number of ranges.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopline.session import cut_lineage, small_table

RANGES = 16_384  # value ranges per pass, and the most values listed one by one, for all spans together
LEAST_RANGES = 64  # of one span


@dataclass(frozen=True)
class OrderStatistic:
    value: float | int
    below: int   # rows with a smaller value
    equal: int   # rows with this value


@dataclass(frozen=True)
class _Span:
    """Values lo..hi of one group that still hold unresolved ranks."""
    group: object
    lo: float | int
    hi: float | int
    below: int
    size: int
    ranks: tuple


def _is_whole(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType,
                      (T.LongType, T.IntegerType, T.ShortType, T.ByteType))


def known(df: DataFrame, col: str) -> Column:
    """The column with NaN as NULL."""
    fraction = isinstance(df.schema[col].dataType, (T.DoubleType, T.FloatType))
    return F.nanvl(col, F.lit(None).cast(df.schema[col].dataType)) if fraction else F.col(col)


def extents(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple]:
    """(min, max, count) of the values of each column, NULL and NaN left out, in one pass."""
    parts = [f(known(df, c)).alias(f"_{i}_{j}") for i, c in enumerate(cols)
             for j, f in enumerate((F.min, F.max, F.count))]
    seen = list(df.agg(*parts).first())
    return {c: tuple(seen[3 * i:3 * i + 3]) for i, c in enumerate(cols)}


def order_statistics(df: DataFrame, col: str, ranks: Mapping[object, Sequence[int]] | Sequence[int],
                     by: str | None = None, span: Mapping | tuple | None = None) -> dict:
    """The values at 1-based ascending `ranks` of a numeric column, NULL and NaN left out.

    With `by`, `ranks` maps group values to ranks inside that group, and all groups
    are searched in the same passes; the result is keyed (group, rank). Without
    it the result is keyed by rank. `span` may pass a known (min, max, count),
    with `by` one per group.
    """
    wanted = {None: ranks} if by is None else dict(ranks)
    wanted = {g: sorted(set(r)) for g, r in wanted.items() if r}
    if not wanted:
        return {}
    x, whole = F.col(col), _is_whole(df, col)
    data = df.select(x.cast("long" if whole else "double").alias(col),
                     *([] if by is None else [by])).where(x.isNotNull())
    if not whole:
        data = data.where(~F.isnan(x))
    if by is None:
        spans = {None: span or extents(data, [col])[col]}
    else:
        data = data.where(F.col(by).isin(list(wanted)))
        spans = span or {
            r[0]: tuple(r)[1:] for r in
            data.groupBy(by).agg(F.min(col), F.max(col), F.count(col)).collect()}
    found: dict = {}
    todo = []
    for g, held in wanted.items():
        lo, hi, n = spans[g]
        if not 1 <= held[0] <= held[-1] <= n:
            raise ValueError(f"ranks must lie in 1..{n}")
        todo.append(_Span(g, lo, hi, 0, n, tuple(held)))

    while True:
        for s in todo:
            if s.lo == s.hi:
                found.update({(s.group, r): OrderStatistic(s.lo, s.below, s.size)
                              for r in s.ranks})
        todo = [s for s in todo if s.lo != s.hi]
        if not todo:
            break
        todo = _narrow(data, col, by, whole, todo)
    return found if by is not None else {r: stat for (_, r), stat in found.items()}


def _narrow(data: DataFrame, col: str, by: str | None, whole: bool, spans: list) -> list:
    """One counting pass: replace each span by the ranges in it that hold its ranks."""
    x = F.col(col)
    slots, cells, singles = [], [], []
    ranges = max(LEAST_RANGES, RANGES // len(spans))
    for k, s in enumerate(spans):
        inside = x.between(F.lit(s.lo), F.lit(s.hi))
        if by is not None:
            inside = (F.col(by) == F.lit(s.group)) & inside
        slots.append((inside, F.lit(k)))
        if s.size <= ranges:
            # Few rows are left: count each value by itself.
            singles.append((inside, x))
        elif whole:
            step = -(-(s.hi - s.lo + 1) // ranges)
            far = f"`{col}`" if s.hi - s.lo < 1 << 63 else f"cast(`{col}` as decimal(20,0))"
            cells.append((inside, F.expr(f"({far} - ({s.lo}L)) div {step}L")))
        elif math.isinf(s.lo) or math.isinf(s.hi):
            cells.append((inside, F.when(x == -math.inf, 0).when(x == math.inf, 2).otherwise(1).cast("long")))
        else:
            # Halves where the difference would leave the number format.
            part = 1.0 if math.isfinite(s.hi - s.lo) else 0.5
            at = (x * part - F.lit(s.lo * part)) / F.lit(s.hi * part - s.lo * part)
            cells.append((inside, F.least(F.floor(at * ranges).cast("long"), F.lit(ranges - 1))))

    def case(arms: list, kind) -> Column:
        out = F.when(F.lit(False), F.lit(None).cast(kind))
        for cond, value in arms:
            out = out.when(cond, value)
        return out

    counts = (
        data.select(x, case(slots, "int").alias("_slot"), case(cells, "long").alias("_cell"),
                    case(singles, data.schema[col].dataType).alias("_single"))
        .where(F.col("_slot").isNotNull())
        .groupBy("_slot", "_cell", "_single")
        .agg(F.count(col).alias("n"), F.min(col).alias("lo"), F.max(col).alias("hi"))
        .collect()
    )
    by_slot: dict[int, list] = {}
    for row in counts:
        by_slot.setdefault(row["_slot"], []).append(row)
    narrowed = []
    for k, s in enumerate(spans):
        left, below = list(s.ranks), s.below
        for row in sorted(by_slot[k], key=lambda r: r["lo"]):
            here = [r for r in left if r <= below + row["n"]]
            if here:
                narrowed.append(_Span(s.group, row["lo"], row["hi"], below, row["n"], tuple(here)))
                left = left[len(here):]
            below += row["n"]
            if not left:
                break
    return narrowed


def rank_cuts(df: DataFrame, col: str, key: str, ranks: Sequence[int],
              span: tuple | None = None) -> list[Column]:
    """For each rank r, a predicate true exactly for the first r rows by (col, key).

    Both are numeric. A cut inside a run of equal values is settled by the key,
    looking at such runs only; the key must be unique there.
    """
    inner = [r for r in ranks if r > 0]
    stats = order_statistics(df, col, inner, span=span)
    runs: dict = {}
    for r in inner:
        s = stats[r]
        if r < s.below + s.equal:
            runs.setdefault(s.value, []).append(r - s.below)
    keys = order_statistics(df, key, runs, by=col) if runs else {}
    x, k = F.col(col), F.col(key)
    cuts = []
    for r in ranks:
        if r <= 0:
            cuts.append(F.lit(False))
            continue
        s = stats[r]
        tie = keys.get((s.value, r - s.below))
        if tie is None:
            cuts.append(x <= F.lit(s.value))
            continue
        if tie.below + tie.equal != r - s.below:
            raise ValueError(f"{key!r} repeats where a cut falls, at {col}={s.value!r}; "
                             "pass a key that is unique per row")
        cuts.append((x < F.lit(s.value)) | ((x == F.lit(s.value)) & (k <= F.lit(tie.value))))
    return cuts


def bucket_ends(n: int, k: int, legacy: bool = False) -> list[int]:
    """Last row number of buckets 1..k-1 when n rows go into k buckets.

    The default puts the larger buckets first, as SQL does; `legacy` uses
    floor(k(row-1)/n)+1.
    """
    if legacy:
        return [-(-b * n // k) for b in range(1, k)]
    size, extra = divmod(n, k)
    return [b * size + min(b, extra) for b in range(1, k)]


def with_ntile(df: DataFrame, col: str, key: str, k: int, out: str = "bin",
               legacy: bool = False, span: tuple | None = None) -> DataFrame:
    """Bucket 1..k by rank of `col`, ties in order of the unique `key`; NULL and NaN get NULL.

    Adds one expression over k-1 literal cuts; the rows are neither moved nor sorted.
    """
    span = span or extents(df, [col])[col]
    if span[2] == 0:
        return df.withColumn(out, F.lit(None).cast("int"))
    cuts = rank_cuts(df, col, key, bucket_ends(span[2], k, legacy), span)

    def bucket(low: int, high: int) -> Column:
        # The cuts are nested, so a row finds its bucket by halving.
        if low == high:
            return F.lit(low)
        mid = (low + high) // 2
        return F.when(cuts[mid - 1], bucket(low, mid)).otherwise(bucket(mid + 1, high))

    return df.withColumn(out, F.when(known(df, col).isNotNull(), bucket(1, k)))


def key_hash(key: Column) -> Column:
    """(key * 2654435761) mod 2^32, spelled so that no product leaves 64 bits."""
    two32, odd = 1 << 32, 2654435761
    low = F.pmod(key.cast("long"), F.lit(two32))
    upper = F.shiftright(low, 16) * odd % 65536
    return (upper * 65536 + low.bitwiseAND(F.lit(65535)) * odd) % two32


def split_exact(df: DataFrame, key: str, fraction: float) -> tuple[DataFrame, DataFrame]:
    """(train, test): exactly floor(fraction * n) rows in train, the rest in test.

    Rows are taken in order of a hash of the unique integer key. One threshold
    is found by counting, so both parts are plain filters of the input: no
    sort, no join, and no row can be in both.
    """
    hashed = df.select(key_hash(F.col(key)).alias("_h"), F.col(key).cast("long").alias("_k"))
    span = extents(hashed, ["_h"])["_h"]
    size = math.floor(fraction * span[2] + 1e-9)
    cut = rank_cuts(hashed, "_h", "_k", [size], span)[0]
    marked = df.withColumns({"_h": key_hash(F.col(key)), "_k": F.col(key).cast("long")})
    return marked.where(cut).drop("_h", "_k"), marked.where(~cut).drop("_h", "_k")


def dense_row_id(df: DataFrame, order: Sequence[str], out: str = "row_id",
                 partitions: int | None = None, unique: bool = False) -> DataFrame:
    """Row numbers 1..n in `order`, by one range shuffle; equal order values are numbered in any order.

    Unless `order` is `unique`, the input is first written with a hash of each
    row's place, and ranges are cut by order value and hash: a run of equal values, or of equal rows,
    however long, falls into as many ranges as its share of the rows. Sorted ranges are written to the shared folder, so that range membership
    is fixed; each row's place inside its range is the low part of Spark's row
    id, and the rows before a range come from the counts per range.
    """
    if not unique:
        df = cut_lineage(df.withColumn("_salt", F.xxhash64(F.monotonically_increasing_id())))
        order = [*order, "_salt"]
    ranged = df.repartitionByRange(*([partitions] if partitions else []), *order)
    ranged = ranged.sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()).drop("_salt")
    fixed = cut_lineage(ranged)
    part = F.shiftright("_id", 33)
    sizes = fixed.groupBy(part.alias("p")).count().orderBy("p").collect()
    if not sizes:
        return fixed.withColumnRenamed("_id", out)
    starts, total = [], 0
    for row in sizes:
        starts.append((row["p"], total))
        total += row["count"]
    # One row per range, so the broadcast is as small as the partition count.
    before = small_table(df.sparkSession, starts, "_p long, _before long")
    place = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    joined = fixed.join(F.broadcast(before), part == F.col("_p"))
    return joined.withColumn(out, F.col("_before") + place + 1).drop("_id", "_p", "_before")


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float],
                    span: Mapping | tuple | None = None, by: str | None = None):
    """Quantiles with linear interpolation between neighbouring ranks.

    A list in the order of `probs`; with `by`, a dict of such lists per group,
    found in common passes. `span` is as for `order_statistics`, and needed with `by`.
    """
    spans = dict(span) if by is not None else {None: span or extents(df, [col])[col]}
    places = {g: [(n - 1) * p + 1 for p in probs] for g, (_, _, n) in spans.items() if n}

    def neighbours(g, h: float) -> tuple[int, int]:
        return math.floor(h), min(math.floor(h) + 1, spans[g][2])

    ranks = {g: sorted({r for h in hs for r in neighbours(g, h)}) for g, hs in places.items()}
    if by is None:
        found = order_statistics(df, col, ranks.get(None, []), span=spans[None])
        at = {(None, r): s.value for r, s in found.items()}
    else:
        at = {k: s.value for k, s in order_statistics(df, col, ranks, by, spans).items()}
    out: dict = {}
    for g in spans:
        out[g] = [None] * len(probs)
        for i, h in enumerate(places.get(g, [])):
            a, b = (at[g, r] for r in neighbours(g, h))
            part = h - math.floor(h)
            if a == b or part == 0:
                out[g][i] = a
            else:
                out[g][i] = a + part * (b - a) if math.isfinite(b - a) else (1 - part) * a + part * b
    return out if by is not None else out[None]
