"""Wide → long.

``DataFrame.unpivot`` plans as an ``Expand`` inside the scan's stage: no
shuffle, one output row per (input row, value column).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unpivot_non_null(
    df: DataFrame,
    ids: Sequence[str],
    values: Sequence[str],
    *,
    variable_col: str = "variable",
    value_col: str = "value",
    value_type: str | None = None,
) -> DataFrame:
    """Melt ``values`` into (``variable_col``, ``value_col``) rows and drop
    missing values.  All value columns are cast to one type first."""
    if value_type is None:
        types = {df.schema[v].dataType.simpleString() for v in values}
        value_type = types.pop() if len(types) == 1 else "double"
    cast = df.select(*ids, *[F.col(v).cast(value_type).alias(v) for v in values])
    long = cast.unpivot(list(ids), list(values), variable_col, value_col)
    return long.filter(F.col(value_col).isNotNull())
