"""Comparison of two similarity tables (the reference's check run).

A full outer join on ``(term1, term2)`` visits every cell of either side; a
cell missing on one side counts as 0, the value of an absent cell of a sparse
matrix. The reference's check only visits the cells of its recomputed side;
``how='right'`` reproduces that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: tolerance of the reference's check.
TOLERANCE = 1e-7


def similarity_cell_diff(
    left: DataFrame, right: DataFrame, tol: float = TOLERANCE, how: str = "full"
) -> DataFrame:
    """``(term1, term2, left, right, differs)`` for every compared cell."""
    a = left.select("term1", "term2", F.col("similarity").alias("left"))
    b = right.select("term1", "term2", F.col("similarity").alias("right"))
    cells = a.join(b, ["term1", "term2"], how)
    diff = F.abs(F.coalesce(F.col("left"), F.lit(0.0)) - F.coalesce(F.col("right"), F.lit(0.0)))
    return cells.select("term1", "term2", "left", "right", (diff > F.lit(tol)).alias("differs"))


def similarity_diff(
    left: DataFrame, right: DataFrame, tol: float = TOLERANCE, how: str = "full"
) -> DataFrame:
    """Verdict per term: ``(term1, cells, differing, passed)``."""
    cells = similarity_cell_diff(left, right, tol, how)
    return cells.groupBy("term1").agg(
        F.count(F.lit(1)).alias("cells"),
        F.count(F.when(F.col("differs"), F.lit(1))).alias("differing"),
    ).select("term1", "cells", "differing", (F.col("differing") == 0).alias("passed"))
