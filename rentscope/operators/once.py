"""Costly columns that later filters must not compute again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame) -> DataFrame:
    """The same rows, with a border no filter is moved across.

    A filter on a computed column is otherwise pushed below the computation, which
    copies its expression into every condition: cheap for arithmetic, dear for regular
    expressions over long texts. Column pruning stops here too, so use it where all
    columns are wanted.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))
