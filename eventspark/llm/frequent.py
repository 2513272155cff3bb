"""The most frequent keys of a table of counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """Rows of ``counts`` (column ``n``) above the lowest count level that leaves at most ``most`` of them.

    Levels are eighths of a doubling, so a histogram of a few hundred rows decides, without sorting the keys or sending
    any task's share of them to the driver.
    """
    level = F.floor(F.log2(F.col("n")) * 8)
    sizes = counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("keys")).collect()
    total, least = 0, None
    for r in sorted(sizes, key=lambda r: -r["level"]):
        total += r["keys"]
        if total > most:
            break
        least = r["level"]
    return counts.filter(F.lit(False) if least is None else level >= least)
