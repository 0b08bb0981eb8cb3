"""Long series over many tasks: slices of a bounded number of rows, each with the rows before it (a halo).

A window over (key, order) needs a whole series in one task. Cut into slices,
a series that holds a third of all rows is the work of many tasks, and a row
still sees the rows before it: those that a window of ``reach`` earlier rows
needs are copied into the slice.

1. Rows are counted by key and month (partial aggregates; the counts are
   bounded by keys times months, not by rows).
2. Running totals of the counts put each month into a slice, and say which
   later slices reach back into it.
3. Each row joins its month and is copied to its slice and to those.

Months are never cut, so a slice has at most ``slice_rows`` rows and one
month's, and as much halo as ``reach`` rows and one month's.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SLICE, OWN = "__slice", "__own"


def sliced(df: DataFrame, keys: Sequence[str], date_col: str, slice_rows: int, reach: int) -> DataFrame:
    """``df`` with each row in its slice (``__own`` true) and in the slices whose first rows reach back to it.

    Add ``__slice`` to a window's partition columns, order it by ``date_col`` first, and keep the rows
    where ``__own`` is true afterwards. Null keys and null dates are series and months of their own; null dates
    come first, as in an ascending order.
    """
    if slice_rows < 1 or reach < 0:
        raise ValueError("slice_rows must be positive and reach not negative")
    month = F.trunc(F.col(date_col), "month")
    key_names = [f"__key{i}" for i in range(len(keys))]
    counts = df.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, key_names)], month.alias("__month")).agg(F.count(F.lit(1)).alias("__rows"))
    series = Window.partitionBy(*key_names).orderBy("__month")
    after = F.sum("__rows").over(series)
    placed = counts.select(*key_names, "__month", (after - F.col("__rows")).alias("__before"), after.alias("__after"))
    placed = placed.withColumn(SLICE, F.floor(F.col("__before") / slice_rows))
    # Where each slice begins; a month lies in the halo of those that begin at most ``reach`` rows behind its end.
    starts = placed.groupBy(*key_names, SLICE).agg(F.min("__before").alias("__start"))
    reached = placed.join(
        starts.select(*[F.col(n).alias(f"{n}s") for n in key_names], F.col(SLICE).alias("__of"), "__start"),
        reduce(and_, [F.col(n).eqNullSafe(F.col(f"{n}s")) for n in key_names])
        & (F.col("__of") >= F.col(SLICE))
        & (F.col("__of") <= F.floor((F.col("__after") + reach) / slice_rows))
        & ((F.col("__of") == F.col(SLICE)) | (F.col("__start") < F.col("__after") + reach)),
    )
    to = reached.select(*key_names, "__month", F.col("__of").alias(SLICE), (F.col("__of") == F.col(SLICE)).alias(OWN))
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, key_names)])
    return df.join(to, same & month.eqNullSafe(F.col("__month"))).drop(*key_names, "__month")
