"""Group-local list operations expressed as windows.

``top_n`` is a ``row_number() <= n`` filter, which Spark plans as a
``WindowGroupLimit``: a partial limit runs before the shuffle, so a key that
holds a third of all rows is cut to ``n`` rows per map task before it moves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .columns import r9


def top_n(df: DataFrame, keys, order: list[Column], n: int, rank_col: str = "rank") -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn(rank_col, F.row_number().over(w))
            .where(F.col(rank_col) <= n)
            .withColumn(rank_col, F.col(rank_col).cast("long")))


def normalize(df: DataFrame, key: str, item: str, weight: str, out: str = "weight") -> DataFrame:
    """Min-max scale a (short) list to [0.1, 1] per ``key``.

    n = 1 -> 1.0; n = 2 -> 1.0 and 0.1 even on a tie (higher weight, then
    smaller item, first); n > 2 -> 0.1 + 0.9 (w - min) / (max - min), and all
    1.0 when max = min. Works on ``round(w, 9)`` so that equal weights stay
    equal whatever order the sums were added in.
    """
    w9 = r9(weight)
    part = Window.partitionBy(key)
    ordered = Window.partitionBy(key).orderBy(w9.desc(), F.col(item).asc())
    n = F.count(F.lit(1)).over(part)
    mx = F.max(w9).over(part)
    mn = F.min(w9).over(part)
    rn = F.row_number().over(ordered)
    scaled = F.lit(0.1) + F.lit(0.9) * (w9 - mn) / (mx - mn)
    value = (F.when(n == 1, F.lit(1.0))
             .when(n == 2, F.when(rn == 1, F.lit(1.0)).otherwise(F.lit(0.1)))
             .when(mx == mn, F.lit(1.0))
             .otherwise(scaled))
    return df.withColumn(out, value)
