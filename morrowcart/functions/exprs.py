"""Expressions shared by the operators. All are built-in (JVM-side).

Most come as SQL text for ``selectExpr`` / ``F.expr``: the feature tables
have hundreds of columns, and one string per column keeps plan building
to one call per column.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_ratio_sql(num: str, den: str) -> str:
    """num / den with x/0 and 0/0 mapped to 0.0 (inf and NaN become 0)."""
    return f"coalesce(try_divide({num}, {den}), 0.0D)"


def div_or_null(num: Column, den: Column) -> Column:
    """num / den, NULL when the denominator is 0 (metrics that are undefined)."""
    return F.try_divide(num.cast("double"), den.cast("double"))
