"""K3: print the first rows of a result; ordered first when it must be stable."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def preview(df: DataFrame, n: int = 20, order_by: Sequence[str] = (), truncate: bool = True) -> None:
    """``show`` of the first ``n`` rows; with ``order_by`` Spark plans a
    top-n (``TakeOrderedAndProject``), never a full sort."""
    (df.orderBy(*order_by) if order_by else df).show(n, truncate=truncate)
