"""fixreg — fixed-width administrative registers as Spark DataFrames.

Subpackages: ``sources`` (layouts, fixed-width and delimited scans),
``functions`` (converters, recodes, flags), ``operators`` (first per key,
checked lookup joins, unpivot, pseudonymisation), ``plans`` (enrichment,
cohorts, exam grades, coverage report), ``sinks`` and ``streaming``.
"""

__version__ = "0.1.0"
