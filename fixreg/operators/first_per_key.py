"""First row per key after a sort (G3; the sort itself, G13, is the window order).

Expressed as ``row_number() over (partition by keys order by …) = 1``.
Catalyst rewrites this into ``WindowGroupLimit``: a *partial* limit sorts and
keeps the top row of every key inside each input partition before the
shuffle, and a final limit after it.  A hot key therefore ships at most one
row per map task, never its whole group, to a single reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def sort_exprs(order: Sequence[str]) -> list[Column]:
    """``"x"`` → x ascending, ``"-x"`` → x descending; nulls always last
    (pandas' ``sort_values`` default)."""
    out = []
    for o in order:
        if o.startswith("-"):
            out.append(F.col(o[1:]).desc_nulls_last())
        else:
            out.append(F.col(o).asc_nulls_last())
    return out


def first_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    complete_order: bool = True,
    rank_col: str = "__rn",
) -> DataFrame:
    """Keep the first row of every ``keys`` group under ``order``.

    With ``complete_order`` every other orderable column is appended
    ascending, so ties are broken the same way on every run and every retry
    of a lost task (ledger L10).
    """
    order = list(order)
    if complete_order:
        named = set(keys) | {o.lstrip("-") for o in order}
        order += [f.name for f in df.schema.fields
                  if f.name not in named and isinstance(f.dataType, T.AtomicType)]
    w = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(*sort_exprs(order))
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) == 1).drop(rank_col)
