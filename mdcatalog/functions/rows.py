"""Row-heavy work: evaluate costly expressions once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluate_once(df: DataFrame, *columns: str | Column) -> DataFrame:
    """``select`` whose results are computed once per row, however often they are used later.

    The optimizer merges neighbouring projections and pushes filters through them, which copies
    a long expression into every place that uses it. A generator of one row is a border it
    does not move expressions across; it runs inside the same stage, without a shuffle.
    """
    return df.select(F.inline(F.array(F.struct(*columns))))

