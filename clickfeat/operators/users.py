"""User cohorts by file position.

Of n users, position i (0-based) is level 0 while i <= int(0.05 n), level 1
while i <= int(0.3 n), level 2 while i <= int(0.6 n), else level 3 (so level 0
holds int(0.05 n) + 1 users).  Positions come from the distributed index, n
from a scalar aggregate; no global sort in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickfeat.operators.indexing import with_global_index

# Cumulative cohort bounds as shares of the user count.
LEVEL_BOUNDS = [0.05, 0.3, 0.6]


def cohort_level(i, n) -> F.Column:
    b0, b1, b2 = (F.floor(n * F.lit(b)) for b in LEVEL_BOUNDS)
    return F.when(i <= b0, 0).when(i <= b1, 1).when(i <= b2, 2).otherwise(3)


def user_cohorts(users: DataFrame, order_col: str = "pos") -> DataFrame:
    idx = with_global_index(users, [order_col], "_i")
    n = users.agg(F.count(F.lit(1))).scalar()
    return idx.withColumn("level", cohort_level(F.col("_i"), n).cast("int")).drop("_i")
