"""Delimited lookup files (S9): ``;``-separated, header, every column text.

Reading everything as text keeps codes such as ``04586`` intact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _all_strings(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def read_delimited(spark: SparkSession, path: str, columns: list[str], *, sep: str = ";",
                   encoding: str = "UTF-8") -> DataFrame:
    """Read a delimited file with a header line; ``columns`` fixes names and
    order (no schema inference pass)."""
    return (
        spark.read.option("header", True).option("sep", sep).option("encoding", encoding)
        .option("enforceSchema", False).schema(_all_strings(columns)).csv(path)
    )


def parse_delimited(lines: DataFrame, line_col: str, columns: list[str], *, sep: str = ";",
                    header_first: str | None = None) -> DataFrame:
    """Parse a column of delimited text lines (``from_csv``), all strings.

    ``header_first``: drop lines whose first field equals this header name.
    """
    schema = ", ".join(f"`{c}` STRING" for c in columns)
    parsed = lines.select(F.from_csv(F.col(line_col), schema, {"sep": sep}).alias("__r")).select("__r.*")
    if header_first is not None:
        parsed = parsed.filter(F.col(columns[0]).isNull() | (F.col(columns[0]) != header_first))
    return parsed
