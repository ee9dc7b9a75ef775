"""Checked lookup joins and membership operators.

pandas' ``merge`` matches null keys to null keys, so the default comparison
is null-safe (``<=>``, ledger L7).  Checks run inside the join's own pass
whenever possible:

* *duplicate match* (J1): the right side is grouped by its key — the same
  hash partitioning the sort-merge join needs, so the grouping adds no
  exchange — carrying the group size; a left row that finds a key with two
  or more rows raises.  Duplicate right keys that match nothing pass, as in
  pandas where only the row count is compared.
* *completeness* (J3): a lazy ``raise_error`` filter on the joined column.
* *uniqueness of a lookup* (J2) is eager but runs on the small side only.

Broadcast is not forced: Spark's size estimate (``autoBroadcastJoinThreshold``)
and AQE's run-time statistics decide, so a lookup that grows past the limit
falls back to a shuffled join instead of exhausting executor memory.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fixreg.functions.exprs import fail_if

Keys = str | Sequence[str | tuple[str, str]]


class CheckFailed(ValueError):
    """A data check of the pipeline did not hold."""


def _pairs(on: Keys) -> list[tuple[str, str]]:
    items = [on] if isinstance(on, str) else list(on)
    return [(k, k) if isinstance(k, str) else (k[0], k[1]) for k in items]


def _key_cond(pairs: list[tuple[str, str]], rename: dict[str, str], null_safe: bool | Sequence[str]) -> Column:
    """Equality on every key pair; ``null_safe`` is a bool for all keys or
    the left key names compared null-safe (``<=>``)."""
    cond = None
    for lk, rk in pairs:
        safe = (lk in null_safe) if not isinstance(null_safe, bool) else null_safe
        c = F.col(lk).eqNullSafe(F.col(rename[rk])) if safe else F.col(lk) == F.col(rename[rk])
        cond = c if cond is None else cond & c
    return cond


def joined_name(left: DataFrame, column: str, suffix: str) -> str:
    """Name a right-side column gets in the output of :func:`lookup_join`."""
    return column + suffix if column in left.columns else column


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: Keys,
    *,
    how: str = "left",
    suffix: str = "_right",
    null_safe: bool | Sequence[str] = True,
    on_duplicate: str = "fail",
    keep_right_keys: bool = False,
    broadcast: bool | None = None,
    unique_right: bool = False,
    name: str = "lookup join",
) -> DataFrame:
    """Left join of a lookup with the reference's checks.

    Output: every left column in order, then the right non-key columns;
    a right column whose name exists on the left gets ``suffix``.  With
    ``keep_right_keys`` right key columns named differently from their left
    key are kept too (pandas ``left_on``/``right_on`` behaviour).

    ``on_duplicate``: ``fail`` (a left row matching two right rows raises,
    J1) or ``ignore`` (plain join — use when the right side is unique by
    construction, e.g. the output of ``first_per_key`` on the same keys).
    ``broadcast=True`` only for a side whose size is bounded by the caller.
    ``unique_right`` additionally requires every right key to be unique and
    non-null, matched or not (J2); it is checked on the grouped right side
    inside the same job, not by a separate pass.
    """
    if on_duplicate not in ("fail", "ignore"):
        raise ValueError("on_duplicate must be fail or ignore")
    pairs = _pairs(on)
    rkeys = [r for _, r in pairs]
    missing = [k for k, _ in pairs if k not in left.columns] + [k for k in rkeys if k not in right.columns]
    if missing:
        raise CheckFailed(f"{name}: key columns not found: {missing}")
    payload = [c for c in right.columns if c not in rkeys]
    tmp = {c: f"__lj{i}" for i, c in enumerate(right.columns)}
    r = right.select(*[F.col(c).alias(tmp[c]) for c in right.columns])
    if on_duplicate == "fail" or unique_right:
        r = r.groupBy(*[tmp[k] for k in rkeys]).agg(
            F.count(F.lit(1)).alias("__lj_n"), *[F.first(tmp[c]).alias(tmp[c]) for c in payload]
        )
    if unique_right:
        bad_key = F.col("__lj_n") > 1
        for k in rkeys:
            bad_key = bad_key | F.col(tmp[k]).isNull()
        r = r.filter(fail_if(bad_key, f"{name}: lookup key {rkeys} is not unique or has nulls"))
    if broadcast:
        r = F.broadcast(r)
    joined = left.join(r, _key_cond(pairs, tmp, null_safe), how)
    if on_duplicate == "fail" and not unique_right:
        keys = ", ".join(lk for lk, _ in pairs)
        joined = joined.filter(fail_if(F.col("__lj_n") > 1, f"{name}: a key ({keys}) matches more than one row"))
    out = [F.col(c) for c in left.columns]
    added = ([(rk, joined_name(left, rk, suffix)) for lk, rk in pairs if lk != rk] if keep_right_keys else [])
    added += [(c, joined_name(left, c, suffix)) for c in payload]
    taken = [n for _, n in added if n in left.columns]
    if taken:
        raise CheckFailed(f"{name}: output columns {taken} already exist; rename or drop them first")
    out += [F.col(tmp[c]).alias(n) for c, n in added]
    return joined.select(*out)


def assert_unique(df: DataFrame, keys: Sequence[str], name: str = "lookup") -> DataFrame:
    """Eager check that ``keys`` identify rows; null keys count as a violation
    (J2: ``len == nunique`` fails on nulls too).  Meant for lookups."""
    keys = list(keys)
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    bad = (
        df.groupBy(*keys).count()
        .filter((F.col("count") > 1) | any_null)
        .limit(1)
        .count()
    )
    if bad:
        raise CheckFailed(f"{name}: key {keys} is not unique or has nulls")
    return df


def require_not_null(df: DataFrame, column: str, name: str = "check") -> DataFrame:
    """Lazy check that every row has ``column``."""
    return df.filter(fail_if(F.col(column).isNull(), f"{name}: {column} is missing on some rows"))


def require_columns(df: DataFrame, columns: Sequence[str], name: str = "input") -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise CheckFailed(f"{name}: required columns missing: {missing}")
    return df


def member_flag(left: DataFrame, right: DataFrame, on: Keys, flag_col: str, *, null_safe: bool = True) -> DataFrame:
    """Add a 0/1 column: does the left key occur in ``right`` (J8, ``isin``)?

    The right keys are de-duplicated first (G4, partial aggregation before the
    shuffle), so a key repeated a billion times ships once per map task.
    """
    pairs = _pairs(on)
    rkeys = [r for _, r in pairs]
    tmp = {c: f"__mf{i}" for i, c in enumerate(rkeys)}
    r = right.select(*[F.col(c).alias(tmp[c]) for c in rkeys]).distinct().withColumn("__mf_hit", F.lit(1))
    joined = left.join(r, _key_cond(pairs, tmp, null_safe), "left")
    return joined.select(
        *[F.col(c) for c in left.columns],
        F.when(F.col("__mf_hit").isNotNull(), F.lit(1)).otherwise(F.lit(0)).alias(flag_col),
    )


def anti_join(left: DataFrame, right: DataFrame, on: Keys, *, null_safe: bool = True) -> DataFrame:
    """Left rows whose key does not occur in ``right`` (J9, ``~isin``).

    The right keys are de-duplicated first, as in ``member_flag``."""
    pairs = _pairs(on)
    rkeys = [r for _, r in pairs]
    tmp = {c: f"__aj{i}" for i, c in enumerate(rkeys)}
    r = right.select(*[F.col(c).alias(tmp[c]) for c in rkeys]).distinct()
    return left.join(r, _key_cond(pairs, tmp, null_safe), "left_anti")


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_col: str = "n_rows") -> DataFrame:
    """Keys that occur more than once, with their row count (J2/G5 report)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col)).filter(F.col(count_col) > 1)
