"""Turning arrays into rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def one_row_each(df: DataFrame, columns: Sequence[str | Column], array: Column, name: str) -> DataFrame:
    """One row per non-null element of `array`, beside `columns`.

    The outer form is used on purpose. For a plain explode the optimizer adds a
    filter on the array's size and pushes it through the projections below,
    which would evaluate the whole text expression behind the array once more.
    """
    return df.select(*columns, F.explode_outer(array).alias(name)).filter(F.col(name).isNotNull())
