"""Order-dependent numbering and running aggregates that never put one key (or the whole table) into one task.

``row_number``/``lead``/running sums over ``partition by key`` and ``dense_rank`` over an unpartitioned window make
Spark gather each key -- or everything -- into a single task. Here the total order ``(keys, order)`` is cut into
*slices* at bounds taken from a small sample of it (the ``SAMPLES`` rows per slice with the smallest hashes of their
sort columns, so the same rows every time, found in one pass). Each row finds its slice by comparing itself with the
bounds: nothing is exchanged or written for that, and the slices are the same whenever the plan is evaluated. Rows are
then numbered or summed by a window over (slice, keys), the only exchange. Keys that reach over a bound are few (at most
one per bound); what their other slices hold is summed up in at most two rows per bound and broadcast.

This is the only path, whatever the size of the input.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

SLICE = "_slice"
#: Sampled rows per slice; slices come out within about a third of the mean.
SAMPLES = 32
#: Bounds that are compared as a tree of expressions.
TREE = 255


def _n_slices(df: DataFrame, n: int | None) -> int:
    return n or max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)


def _asc(order: Sequence[str]) -> list[Column]:
    return [F.col(c).asc() for c in order]


def slice_bounds(df: DataFrame, cols: Sequence[str], n: int | None = None) -> list[tuple]:
    """At most ``n - 1`` ascending tuples of ``cols`` that cut ``df`` into slices of similar size.

    Sampled rows are sorted where the sample is gathered (``n * SAMPLES`` rows); only the bounds reach the driver."""
    n = _n_slices(df, n)
    row = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(cols)])
    picked = df.select(row.alias("r"), F.xxhash64(*cols).alias("h")).orderBy("h").limit(n * SAMPLES)
    sample = picked.agg(F.sort_array(F.collect_list("r")).alias("s"), F.count(F.lit(1)).alias("m"))
    at = F.filter(F.transform(F.sequence(F.lit(1), F.lit(max(n - 1, 1))), lambda i: F.expr("m") * i / n), lambda x: x >= 1)
    bounds = sample.select(F.transform(at, lambda x: F.get("s", F.floor(x).cast("int"))).alias("b")).first()["b"]
    return list(dict.fromkeys(tuple(b) for b in bounds)) if n > 1 else []


def _literals(df: DataFrame, cols: Sequence[str], rows: Sequence[tuple]) -> list[Column]:
    types = [f.dataType.simpleString() for f in df.select(*cols).schema]
    return [F.struct(*[F.lit(v).cast(t).alias(f"c{i}") for i, (v, t) in enumerate(zip(r, types))]) for r in rows]


def slice_of(df: DataFrame, cols: Sequence[str], bounds: Sequence[tuple], tree: int = TREE) -> Column:
    """The number of bounds that are not above the row, found by halving: a tree of comparisons, which Spark compiles,
    for up to ``tree`` bounds, a search in a literal array beyond that."""
    if not bounds:
        return F.lit(0)
    literal = _literals(df, cols, bounds)
    row = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(cols)])

    def branch(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(literal[middle] <= row, branch(middle + 1, high)).otherwise(branch(low, middle))

    if len(bounds) <= tree:
        return branch(0, len(bounds))
    bound = F.array(*literal)

    def halve(low: Column, step: Column) -> Column:
        return F.when((low + step <= len(bounds)) & (F.get(bound, low + step - 1) <= row), low + step).otherwise(low)

    steps = [1 << k for k in range(len(bounds).bit_length() - 1, -1, -1)]
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), halve)


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """``left``'s keys equal ``right``'s copies ``_e_<key>``; null equals null."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"_e_{k}"]) for k in keys], F.lit(True))


def _at_bounds(sliced: DataFrame, keys: Sequence[str], bounds: Sequence[tuple]) -> DataFrame:
    """The rows of ``sliced`` whose key stands at their slice's lower or upper bound, hence may lie in several slices."""
    if not keys:
        return sliced
    if not bounds:
        return sliced.where("false")
    edges = F.array(*_literals(sliced, keys, [b[: len(keys)] for b in bounds]))
    row = F.struct(*[F.col(k).alias(f"c{i}") for i, k in enumerate(keys)])
    # a slice without such a bound compares with null, which no row's struct is
    return sliced.where(row.eqNullSafe(F.get(edges, F.col(SLICE) - 1)) | row.eqNullSafe(F.get(edges, F.col(SLICE))))


def _with_summary(local: DataFrame, summary: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``summary`` (at most two rows per bound) attached by slice and key."""
    renamed = summary.select(F.col(SLICE).alias("_e_slice"), *[F.col(k).alias(f"_e_{k}") for k in keys], value)
    on = (local[SLICE] == renamed["_e_slice"]) & _same(local, renamed, keys)
    return local.join(F.broadcast(renamed), on, "left").drop("_e_slice", *[f"_e_{k}" for k in keys])


def row_number_within(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    out: str = "row_number",
    n: int | None = None,
    descending: bool = False,
    at_most: int | None = None,
) -> DataFrame:
    """``row_number() over (partition by keys order by order)`` (ascending, NULLs first; ``descending``: the other way
    round); ``order`` must be total within a key. Without keys the whole table is numbered. ``at_most`` keeps the rows
    numbered up to it; most others go before the borders are looked at."""
    keys, order = list(keys), list(order)
    cols = [*keys, *order]
    bounds = slice_bounds(df, cols, n)
    sliced = df.withColumn(SLICE, slice_of(df, cols, bounds))
    by = [F.col(c).desc() if descending else F.col(c).asc() for c in order]
    local = sliced.withColumn("_local", F.row_number().over(Window.partitionBy(SLICE, *keys).orderBy(*by)))
    if at_most is not None:
        local = local.where(F.col("_local") <= at_most)
    counts = _at_bounds(sliced, keys, bounds).groupBy(SLICE, *keys).agg(F.count(F.lit(1)).alias("_n"))
    before = F.col(SLICE).desc() if descending else F.col(SLICE).asc()
    earlier = Window.partitionBy(*keys).orderBy(before).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.sum("_n").over(earlier)).where(F.col("_off").isNotNull())
    joined = _with_summary(local, offsets, keys, "_off")
    numbered = joined.withColumn(out, (F.col("_local") + F.coalesce("_off", F.lit(0))).cast("long")).drop("_local", "_off", SLICE)
    return numbered if at_most is None else numbered.where(F.col(out) <= at_most)


#: Running aggregates: what a slice's rows give, and how a carry from earlier slices joins in.
_RUNNING = {
    "sum": (F.sum, lambda carry, here: F.when(carry.isNull(), here).when(here.isNull(), carry).otherwise(carry + here)),
    "count": (F.count, lambda carry, here: F.coalesce(carry, F.lit(0)) + here),
    "min": (F.min, F.least),
    "max": (F.max, F.greatest),
    "last": (lambda c: F.last(c, ignorenulls=True), lambda carry, here: F.coalesce(here, carry)),
}


def running_within(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], aggregates: Mapping[str, tuple[str, str]], n: int | None = None
) -> DataFrame:
    """Running aggregates over ``rows between unbounded preceding and current row`` of ``partition by keys order by
    order`` (ascending, NULLs first); without keys, of the whole table.

    ``aggregates`` maps a new column to ``(function, column)`` with function sum, count, min, max or last (the last value
    that is not NULL). ``order`` must be total within a key. Sums join slices associatively, so sums of doubles may
    differ from a sequential sum in the last digits; sum integers or decimals where that matters.
    """
    unknown = sorted({f for f, _ in aggregates.values()} - set(_RUNNING))
    if unknown:
        raise ValueError(f"unknown running aggregate {unknown}; there are {sorted(_RUNNING)}")
    keys, order = list(keys), list(order)
    cols = [*keys, *order]
    bounds = slice_bounds(df, cols, n)
    sliced = df.withColumn(SLICE, slice_of(df, cols, bounds))
    upto = Window.partitionBy(SLICE, *keys).orderBy(*_asc(order)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = sliced.withColumns({f"_l_{out}": _RUNNING[f][0](F.col(c)).over(upto) for out, (f, c) in aggregates.items()})

    def total(f: str, c: str) -> Column:
        if f != "last":
            return _RUNNING[f][0](F.col(c))
        return F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.struct(*order)))

    totals = _at_bounds(sliced, keys, bounds).groupBy(SLICE, *keys).agg(*[total(f, c).alias(f"_t_{o}") for o, (f, c) in aggregates.items()])
    earlier = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    merge = {"count": F.sum}  # counts of slices add up
    carry = F.struct(*[merge.get(f, _RUNNING[f][0])(F.col(f"_t_{o}")).over(earlier).alias(o) for o, (f, _) in aggregates.items()])
    carries = totals.withColumn("_carry", carry).select(SLICE, *keys, "_carry")
    joined = _with_summary(local, carries, keys, "_carry")
    done = {out: _RUNNING[f][1](F.col("_carry").getField(out), F.col(f"_l_{out}")) for out, (f, _) in aggregates.items()}
    return joined.withColumns(done).drop(SLICE, "_carry", *[f"_l_{out}" for out in aggregates])


def lead_within(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str, n: int | None = None
) -> DataFrame:
    """``lead(value, 1) over (partition by keys order by order)`` (ascending, NULLs first); ``order`` must be
    total within a key."""
    keys, order = list(keys), list(order)
    cols = [*keys, *order]
    bounds = slice_bounds(df, cols, n)
    sliced = df.withColumn(SLICE, slice_of(df, cols, bounds))
    boxed = F.struct(F.col(value).alias("v"))  # tells a NULL value from no successor
    local = sliced.withColumn("_next", F.lead(boxed).over(Window.partitionBy(SLICE, *keys).orderBy(*_asc(order))))
    firsts = _at_bounds(sliced, keys, bounds).groupBy(SLICE, *keys).agg(F.min_by(boxed, F.struct(*order)).alias("_first"))
    later = Window.partitionBy(*keys).orderBy(SLICE)
    following = firsts.withColumn("_succ", F.lead("_first").over(later)).where(F.col("_succ").isNotNull())
    joined = _with_summary(local, following, keys, "_succ")
    return joined.withColumn(out, F.coalesce("_next", "_succ").getField("v")).drop("_next", "_succ", SLICE)


def ranked_values(
    df: DataFrame, order_col: str, descending: bool = True, out: str = "rank", max_out: str = "_max", n: int | None = None
) -> DataFrame:
    """The distinct values of ``order_col`` (as ``_v``) with their dense rank ``out`` and the highest rank.

    The values (pre-aggregated, so a value shared by many rows is one row) are written once and numbered by
    ``row_number_within``; NULL is the first value ascending and the last descending.
    """
    values = cut_lineage(df.select(F.col(order_col).alias("_v")).distinct())
    top = values.count()
    numbered = row_number_within(values, [], ["_v"], "_rn", n)
    rank = F.lit(top + 1) - F.col("_rn") if descending else F.col("_rn")
    return numbered.select("_v", rank.cast("int").alias(out), F.lit(top).cast("int").alias(max_out))


def attach_ranks(df: DataFrame, order_col: str, ranked: DataFrame) -> DataFrame:
    """Join ranked values (from ``ranked_values``) back to the rows; NULL-safe on the value. A value shared by
    many rows is a skewed join key, which adaptive execution splits."""
    return df.join(ranked, F.col(order_col).eqNullSafe(ranked["_v"]), "inner").drop("_v")


def dense_rank_global(
    df: DataFrame, order_col: str, descending: bool = True, out: str = "rank", max_out: str | None = None, n: int | None = None
) -> DataFrame:
    """``dense_rank() over (order by order_col [desc])`` over the whole table (see ``ranked_values``).
    ``max_out`` adds the highest rank."""
    result = attach_ranks(df, order_col, ranked_values(df, order_col, descending, out, max_out or "_max", n))
    return result if max_out else result.drop("_max")
