"""Global ranking and top-percent selection."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .ordered import attach_ranks, ranked_values


def top_percent(
    df: DataFrame,
    order_col: str,
    pct: float,
    rank_col: str = "rank",
    max_col: str = "max_rank",
    descending: bool = True,
) -> DataFrame:
    """Rows whose dense rank by ``order_col`` is strictly below ``max_rank * pct``.

    Ranks are over distinct values, so with few distinct values a small ``pct`` can select nothing; that is the
    rule, not an accident. Both the rank and the highest rank are returned. No step gathers the rows (or the
    values) into one task: see ``ordered.ranked_values``. ``df`` is usually an aggregate; it is computed once and
    written, as the values and the selected rows are both taken from it.
    """
    df = cut_lineage(df)
    ranked = ranked_values(df, order_col, descending=descending, out=rank_col, max_out=max_col)
    # exact decimal product: 1170 * 0.10 must be 117, not 117.00000000000001
    limit = F.col(max_col).cast("decimal(20,0)") * F.lit(Decimal(str(pct)))
    # select among the distinct values first, so the join back carries only the selected ones (a small side
    # that adaptive execution can broadcast at run time)
    return attach_ranks(df, order_col, ranked.where(F.col(rank_col) < limit))
