"""Table corrections as pure functions ``DataFrame x DataFrame -> DataFrame`` (the caller writes the result).

Plain Parquet tables have no UPDATE/MERGE, so each statement shape of the warehouse becomes a join plan:
full upsert, partial-field merge, UPDATE ... FROM, closing of open validity intervals and a per-group cap.
Keys must be unique on the source side: by default a duplicate fails the job from inside the plan (no extra
action), or a given order picks one row per key with a map-side-combined ``max_by`` aggregate (skew-safe).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordered import lead_within, row_number_within


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], latest: bool = True) -> DataFrame:
    """Keep one row per key: the greatest (``latest``) or smallest by ``order``; a partial aggregate."""
    others = [c for c in df.columns if c not in keys]
    pick = F.max_by if latest else F.min_by
    agg = df.groupBy(*keys).agg(pick(F.struct(*others), F.struct(*order)).alias("_row"))
    return agg.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in others])


def unique_or_fail(df: DataFrame, keys: Sequence[str], what: str = "source", allow_null_keys: bool = True) -> DataFrame:
    """``df``, failing the job for a key held by more than one row (or for a NULL key unless ``allow_null_keys``).

    The check is part of the plan, not a separate action: rows are counted by a window on the partitioning that the
    following join needs anyway, and checked by a filter, which no column pruning removes.
    """
    keys = list(keys)
    count = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    check = F.when(F.col("_n") > 1, F.raise_error(F.lit(f"{what} has more than one row for a key of {keys}")))
    if not allow_null_keys:
        null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        check = check.when(null_key, F.raise_error(F.lit(f"{what} has a NULL key in {keys}")))
    return df.withColumn("_n", count).where(F.coalesce(check.cast("boolean"), F.lit(True))).drop("_n")


def _resolve_duplicates(source: DataFrame, keys, on_duplicate: str, order, allow_null_keys: bool = True) -> DataFrame:
    if on_duplicate == "error":
        return unique_or_fail(source, keys, allow_null_keys=allow_null_keys)
    if on_duplicate == "first":
        if not order:
            raise ValueError("on_duplicate='first' needs an order")
        return one_per_key(source, keys, order)
    raise ValueError(f"unknown on_duplicate {on_duplicate!r}")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    on_duplicate: str = "error",
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Full-row upsert: source rows replace target rows with the same key, new keys are inserted.

    One full outer join on the keys (each side read once); a source row wins as a whole, so columns the source
    lacks become NULL on replaced rows. A duplicate or NULL source key fails the job
    (``on_duplicate='error'``); ``'first'`` keeps the latest row per key by ``order``."""
    keys = list(keys)
    src = _resolve_duplicates(source, keys, on_duplicate, order, allow_null_keys=False)
    return _merge(target, src, keys, [c for c in source.columns if c not in keys], whole_row=True)


def merge_partial(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    fields: Sequence[str],
    on_duplicate: str = "error",
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Existing key: overwrite only ``fields`` (a NULL in the source overwrites); other target fields survive.
    Missing key: insert the whole source row. Target rows without a source row are unchanged."""
    keys = list(keys)
    src = _resolve_duplicates(source, keys, on_duplicate, order)
    return _merge(target, src, keys, list(fields), whole_row=False)


def _merge(target: DataFrame, src: DataFrame, keys: list[str], fields: list[str], whole_row: bool) -> DataFrame:
    t_cols = [c for c in target.columns if c not in keys]
    s_cols = [c for c in src.columns if c not in keys]
    t = target.select(*keys, *[F.col(c).alias(f"_t_{c}") for c in t_cols], F.lit(True).alias("_in_t"))
    s = src.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in s_cols], F.lit(True).alias("_in_s"))
    j = t.join(s, keys, "full_outer")
    in_s = F.coalesce(F.col("_in_s"), F.lit(False))
    out = [F.col(k) for k in keys]
    for c in t_cols + [c for c in s_cols if c not in t_cols]:
        tc = F.col(f"_t_{c}") if c in t_cols else F.lit(None)
        sc = F.col(f"_s_{c}") if c in s_cols else F.lit(None)
        if whole_row or c in fields:
            out.append(F.when(in_s, sc).otherwise(tc).alias(c))
        else:
            out.append(F.when(F.col("_in_t"), tc).otherwise(sc).alias(c))
    return j.select(*out)


def update_from(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[tuple[str, str]] | Sequence[str],
    set_exprs: Mapping[str, Callable[[Callable[[str], Column]], Column] | str],
    where: Callable[[Callable[[str], Column], Callable[[str], Column]], Column] | None = None,
    on_duplicate: str = "error",
    order: Sequence[str] | None = None,
    matched_col: str | None = None,
) -> DataFrame:
    """``UPDATE target SET c = expr(source) FROM source WHERE target.k = source.k [AND where]``.

    ``on`` lists equal column pairs ``(target_col, source_col)`` (or names present in both). ``set_exprs`` maps a
    target column to a source column name or to ``lambda s: <Column over s('col')>``. ``where(t, s)`` adds
    conditions over target ``t('col')`` and source ``s('col')`` columns. Unmatched rows are unchanged; a
    matched NULL overwrites (no ``coalesce``). The row count of ``target`` never changes.

    Adaptive execution broadcasts a source that turns out small at run time; nothing is broadcast on a caller's word.
    """
    pairs = [(p, p) if isinstance(p, str) else tuple(p) for p in on]
    skeys = [sk for _, sk in pairs]
    source = _resolve_duplicates(source, skeys, on_duplicate, order)
    src = source.select(
        *[F.col(c).alias(f"_src_{c}") for c in source.columns], F.lit(True).alias("_matched")
    )

    def s(c: str) -> Column:
        return F.col(f"_src_{c}")

    def t(c: str) -> Column:
        return F.col(c)

    cond = reduce(lambda a, b: a & b, [target[tk] == src[f"_src_{sk}"] for tk, sk in pairs])
    joined = target.join(src, cond, "left")
    hit = F.coalesce(F.col("_matched"), F.lit(False))
    if where is not None:
        hit = hit & F.coalesce(where(t, s), F.lit(False))
    out = []
    for c in target.columns:
        if c in set_exprs:
            e = set_exprs[c]
            new = s(e) if isinstance(e, str) else e(s)
            out.append(F.when(hit, new).otherwise(F.col(c)).cast(target.schema[c].dataType).alias(c))
        else:
            out.append(F.col(c))
    if matched_col:
        out.append(hit.alias(matched_col))
    return joined.select(*out)


def close_open_intervals(
    df: DataFrame,
    key: str | Sequence[str],
    start: str,
    end: str,
    tiebreak: str | Sequence[str],
    changed_col: str | None = None,
) -> DataFrame:
    """For keys with more than one open row (``end`` NULL), give each open row that has a successor
    ``end = next start - 1 day``. The successor is taken over *all* rows of the key, closed ones included,
    ordered by ``start`` then ``tiebreak``. Rows of other keys are returned unchanged.

    Open rows are counted per key with a map-side-combined aggregate (joined back on the key), and the
    successor comes from ``lead_within`` over all rows in one pass, which stays balanced when one key holds a
    large share of the rows.
    """
    keys = [key] if isinstance(key, str) else list(key)
    ties = [tiebreak] if isinstance(tiebreak, str) else list(tiebreak)
    multi = (
        df.where(F.col(end).isNull())
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_open"))
        .where(F.col("_open") > 1)
        .select(*keys, F.lit(True).alias("_multi"))
    )
    nxt = lead_within(df, keys, [start] + ties, start, "_next_start").join(multi, keys, "left")
    new_end = F.when(
        F.col("_multi") & F.col(end).isNull() & F.col("_next_start").isNotNull(),
        F.date_sub(F.to_date(F.col("_next_start")), 1),
    ).cast(df.schema[end].dataType)
    out = nxt.withColumn("_new_end", new_end)
    result = [F.coalesce(F.col("_new_end"), F.col(end)).alias(end) if c == end else F.col(c) for c in df.columns]
    if changed_col:
        result.append(F.col("_new_end").isNotNull().alias(changed_col))
    return out.select(*result)


def limit_per_group(df: DataFrame, keys: Sequence[str], n: int, order: Sequence[str], descending: bool = False) -> DataFrame:
    """At most ``n`` rows per key: the first ``n`` by ``order`` (total within a key), or the last when ``descending``
    (NULLs first ascending, last descending).

    Rows are numbered by ``row_number_within``, so neither a hot key nor a large ``n`` fills one task.
    """
    return row_number_within(df, keys, order, out="_rn", descending=descending, at_most=n).drop("_rn")
