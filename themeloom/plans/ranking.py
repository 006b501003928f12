"""Places in an order over all rows, without gathering them in one task."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from themeloom.plans.session import materialise


def numbered(rows: DataFrame, *order: Column | str, name: str = "rank", key: str | None = None) -> DataFrame:
    """rows with their place from 1 in an order, as `name`; with `key`, rows of equal keys get the first place among them.

    Rows are dealt to ranges of the order and sorted inside each; each range's places begin after those of the ranges
    before it. Only the number of rows of each range comes to the driver. The order should have no ties, or they are broken
    as they come (once: the rows are written); a column that orders first may be the key.
    """
    held = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    held = materialise(held)
    part, inside = F.shiftright("_id", 33), F.col("_id").bitwiseAND((1 << 33) - 1)
    counts = {r["p"]: r["n"] for r in held.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()}
    parts = sorted(counts)
    starts = list(zip(parts, accumulate([0, *(counts[p] for p in parts)]), strict=False))
    starts = held.sparkSession.createDataFrame(starts, "_part bigint, _start bigint")  # a row for each range
    out = held.join(F.broadcast(starts), part == F.col("_part")).withColumn(name, (F.col("_start") + inside + 1).cast("bigint"))
    out = out.drop("_id", "_part", "_start")
    return out if key is None else out.withColumn(name, F.min(name).over(Window.partitionBy(key)))
