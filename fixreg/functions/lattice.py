"""Common types of a column over deliveries, and the union of tables under them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Chains of types, each the next one's special case; whatever else differs meets as text.
CHAINS = (
    (T.NullType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DoubleType, T.StringType),
    (T.FloatType, T.DoubleType, T.StringType),
    (T.NullType, T.DateType, T.TimestampType, T.StringType),
    (T.NullType, T.BooleanType, T.StringType),
)


@dataclass(frozen=True)
class TypeConflict:
    """A column whose type differs between deliveries, and the type that holds all its values."""

    column: str
    chosen: str
    types: Mapping[str, str]  # by delivery


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that holds the values of both; text if no other does."""
    if a == b:
        return a
    for chain in CHAINS:
        if type(a) in chain and type(b) in chain:
            return chain[max(chain.index(type(a)), chain.index(type(b)))]()
    if isinstance(a, T.NullType) or isinstance(b, T.NullType):
        return b if isinstance(a, T.NullType) else a
    if isinstance(a, T.FloatType) and isinstance(b, T.IntegralType) or isinstance(b, T.FloatType) and isinstance(a, T.IntegralType):
        return T.DoubleType()
    for t in (a, b):
        if not isinstance(t, T.AtomicType):
            raise ValueError(f"no common type of {a.simpleString()} and {b.simpleString()}")
    return T.StringType()


def type_conflicts(deliveries: Mapping[str, T.StructType]) -> list[TypeConflict]:
    """Columns that have several types, in the order of their first appearance."""
    kinds: dict[str, dict[str, T.DataType]] = {}
    for name, schema in deliveries.items():
        for f in schema.fields:
            kinds.setdefault(f.name, {})[name] = f.dataType
    return [TypeConflict(c, reduce(common_type, by.values()).simpleString(), {n: t.simpleString() for n, t in by.items()})
            for c, by in kinds.items() if len(set(by.values())) > 1]


def union_deliveries(deliveries: Mapping[str, DataFrame]) -> tuple[DataFrame, list[TypeConflict]]:
    """All rows of the deliveries by column name, each column in the common
    type of its deliveries; a column that a delivery lacks is null in its
    rows.  No value is lost to a changed type, and the changes are reported."""
    kinds: dict[str, T.DataType] = {}
    for df in deliveries.values():
        for f in df.schema.fields:
            kinds[f.name] = common_type(kinds[f.name], f.dataType) if f.name in kinds else f.dataType
    cast = [df.select(*[F.col(f"`{f.name}`").cast(kinds[f.name]).alias(f.name) for f in df.schema.fields]) for df in deliveries.values()]
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), cast)
    return out.select(*[f"`{c}`" for c in kinds]), type_conflicts({n: df.schema for n, df in deliveries.items()})
