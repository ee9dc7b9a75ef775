"""Pseudonymisation.

Two modes for the person id:

* ``hash`` (default): ``sha2(salt ‖ id, 256)`` computed in place — no
  crosswalk, no shuffle, consistent across tables and runs for one salt.
* ``permute``: a bijection of the id set onto itself, as the register's own
  tool produces (ledger L11).  The i-th id in id order gets the i-th id in
  salted-hash order.  Both orders need an exact global rank, computed without
  a single-partition window: sort once (range partitioning), write the sorted
  ids with their place in the partition to the shared checkpoint folder, count
  rows per partition, and add each row's partition offset (a table with one
  row per partition, broadcast).

The salt is a secret argument; it is never written with the output.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fixreg.functions.exprs import fail_if, zero_pad
from fixreg.operators.joins import CheckFailed, lookup_join, require_columns
from fixreg.session import ScratchSpace, session_space

PERSON_ID = "PersoonsgebondenNummer"
# Columns holding direct identifiers, blanked on export.
SENSITIVE_COLUMNS = ("Onderwijsnummer", "Burgerservicenummer")
PSEUDO_WIDTH = 7


def _check_salt(salt: str) -> None:
    if not salt:
        raise ValueError("a non-empty secret salt is required")


def salted_hash(c: str | Column, salt: str) -> Column:
    _check_salt(salt)
    col = F.col(c) if isinstance(c, str) else c
    return F.sha2(F.concat(F.lit(salt), col.cast("string")), 256)


def global_rank(df: DataFrame, order: Sequence[str], rank_col: str = "rank", *, scratch: ScratchSpace | None = None) -> DataFrame:
    """Exact 1-based rank of every row under ``order`` (a total order).

    Equivalent to ``row_number() over (order by …)`` without funnelling all
    rows through one task.  The sorted rows are a table of ``scratch`` (the
    session's space by default).
    """
    scratch = scratch or session_space(df.sparkSession)
    pid = F.spark_partition_id()
    idx = F.monotonically_increasing_id() - F.shiftleft(pid.cast("bigint"), 33)
    # A row's place in its partition is stored with it: the order is total, so
    # a partition computed again after a loss has the same rows and places.
    local = scratch.write(df.orderBy(*[F.col(o).asc_nulls_last() for o in order]).select("*", pid.alias("__pid"), idx.alias("__idx")), "ranking")
    counts = local.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    # One row per partition: a cumulative sum over a table of that size is cheap.
    offsets = counts.select(
        "__pid",
        (F.sum("__n").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1))).alias("__off"),
    ).fillna(0, subset=["__off"])
    ranked = local.join(F.broadcast(offsets), "__pid")
    return ranked.select(*df.columns, (F.col("__off") + F.col("__idx") + 1).alias(rank_col))


def crosswalk(
    ids: DataFrame,
    id_col: str = PERSON_ID,
    *,
    salt: str,
    pseudo_col: str | None = None,
    width: int = PSEUDO_WIDTH,
    scratch: ScratchSpace | None = None,
) -> DataFrame:
    """Permutation crosswalk ``(id, pseudo)`` over the distinct ids.

    Fails on a null id (L15) and when padding would make two pseudo ids
    equal.  Pseudo ids are zero-padded to ``width`` without truncating
    longer ids.

    The crosswalk is a table of ``scratch`` and names every person: close the
    space once the pseudonymised tables are written (``convert_register``
    does).  Without one it belongs to the session's space.  The rankings
    behind it are removed here, whether the crosswalk succeeds or not.
    """
    _check_salt(salt)
    require_columns(ids, [id_col], "crosswalk")
    pseudo_col = pseudo_col or id_col + "_new"
    distinct = (
        ids.select(F.col(id_col).cast("string").alias("__id"))
        .filter(fail_if(F.col("__id").isNull(), f"crosswalk: {id_col} has null values"))
        .distinct()
    )
    spark = ids.sparkSession
    scratch = scratch or session_space(spark)
    with ScratchSpace(spark, "crosswalk-ranking") as work:  # raw ids beside their salted hashes
        by_id = global_rank(distinct, ["__id"], "__r", scratch=work)
        # The second ranking reads the ids from the first one's table, so
        # the source tables are scanned and de-duplicated once.
        ids_once = by_id.select("__id")
        # Padding may map a short id onto another id ("12345" → "0012345"); the
        # pseudo ids would then not be unique.  Only ids shorter than ``width``
        # can collide, so only they are checked (none in 12-digit registers).
        short = ids_once.filter(F.length("__id") < width).select(zero_pad("__id", width).alias("__id"))
        if short.join(ids_once, "__id", "left_semi").limit(1).count():
            raise CheckFailed(f"crosswalk: zero-padding to {width} makes two {id_col} values equal")
        by_hash = global_rank(ids_once.withColumn("__h", salted_hash("__id", salt)), ["__h", "__id"], "__r", scratch=work)
        return scratch.write(by_id.join(by_hash.select("__r", F.col("__id").alias("__p")), "__r").select(
            F.col("__id").alias(id_col), zero_pad("__p", width).alias(pseudo_col)
        ), "crosswalk")


def replace_id(df: DataFrame, xwalk: DataFrame, id_col: str = PERSON_ID, pseudo_col: str | None = None) -> DataFrame:
    """Replace the id by its pseudo id; ids outside the crosswalk become null.

    Column order is kept.  The crosswalk is unique per id by construction.
    """
    pseudo_col = pseudo_col or id_col + "_new"
    x = xwalk.select(F.col(id_col).alias("__xid"), F.col(pseudo_col).alias("__xnew"))
    joined = df.join(x, F.col(id_col).cast("string") == F.col("__xid"), "left")
    return joined.select(*[F.col("__xnew").alias(id_col) if c == id_col else F.col(c) for c in df.columns])


def hash_id(df: DataFrame, id_col: str = PERSON_ID, *, salt: str) -> DataFrame:
    """Replace the id by its salted hash in place (P2, ``hash`` mode)."""
    return df.withColumn(id_col, F.when(F.col(id_col).isNotNull(), salted_hash(id_col, salt)))


def blank_columns(df: DataFrame, columns: Sequence[str] = SENSITIVE_COLUMNS) -> DataFrame:
    """Set the sensitive columns that exist to null, keeping their type."""
    types = {f.name: f.dataType for f in df.schema.fields}
    present = [c for c in columns if c in types]
    if not present:
        return df
    return df.withColumns({c: F.lit(None).cast(types[c]) for c in present})


def pseudonymise(
    tables: Mapping[str, DataFrame],
    *,
    salt: str,
    mode: str = "hash",
    id_col: str = PERSON_ID,
    crosswalk_from: Sequence[str] | None = None,
    blank: Sequence[str] = SENSITIVE_COLUMNS,
    scratch: ScratchSpace | None = None,
) -> dict[str, DataFrame]:
    """One consistent id replacement over several tables, PII blanked.

    The crosswalk covers the union of the ids of ``crosswalk_from`` (default:
    every table, so exam rows of people without an enrolment keep a pseudo
    id — ledger L14).  It runs for any set of tables, also exam subjects
    alone (L12).  Tables without the id column are only blanked.  In
    ``permute`` mode the results read the crosswalk, a table of ``scratch``.
    """
    if mode not in ("hash", "permute"):
        raise ValueError("mode must be hash or permute")
    with_id = {n: t for n, t in tables.items() if id_col in t.columns}
    if not with_id:
        raise CheckFailed(f"no table has {id_col}")
    out: dict[str, DataFrame] = {}
    if mode == "hash":
        for n, t in tables.items():
            out[n] = blank_columns(hash_id(t, id_col, salt=salt) if n in with_id else t, blank)
        return out
    sources = [with_id[n] for n in (crosswalk_from or list(with_id)) if n in with_id]
    ids = sources[0].select(F.col(id_col).cast("string").alias(id_col))
    for s in sources[1:]:
        ids = ids.unionByName(s.select(F.col(id_col).cast("string").alias(id_col)))
    xw = crosswalk(ids, id_col, salt=salt, scratch=scratch)
    for n, t in tables.items():
        out[n] = blank_columns(replace_id(t, xw, id_col) if n in with_id else t, blank)
    return out


def add_local_id(df: DataFrame, local_ids: DataFrame, left_on: str, right_on: str) -> DataFrame:
    """Attach an institution's own id by left join; fails if rows would multiply (P5).

    Independent of pseudonymisation, always a left join (ledger L13)."""
    return lookup_join(df, local_ids, [(left_on, right_on)], keep_right_keys=True, suffix="_local",
                       name="local id")
