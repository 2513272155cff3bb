"""Top-N per window, ranked reports, the SQL form and its changelog.

``row_number() <= n`` over ``PARTITION BY window_end`` is planned by Catalyst as a ``WindowGroupLimit``: each map task
keeps only its local top-n per window before the shuffle, so the exchange carries at most n rows per (task, window)
whatever the number of items.  Ties are broken by item id ascending (the reference's order among equal counts is
arrival order, which is not reproducible).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.durations import to_seconds
from .windows import sliding_count

# Fixed values of the ranked report text (must equal the reference's output format).
REPORT_RULE = "=" * 61
REPORT_TIME_PREFIX = "time: "


def top_n_per_window(counts: DataFrame, *, n: int = 3, window_col="window_end", item_col="item_id",
                     count_col="cnt", rank_col="rank") -> DataFrame:
    w = Window.partitionBy(window_col).orderBy(F.col(count_col).desc(), F.col(item_col).asc())
    return counts.withColumn(rank_col, F.row_number().over(w).cast("bigint")).where(F.col(rank_col) <= n)


def hot_items(behaviors: DataFrame, *, n: int = 3, size="1 hour", slide="5 minutes", behavior="pv") -> DataFrame:
    """Hot items: sliding-window view counts per item, top ``n`` per window end.

    Output ``window_end, item_id, cnt, rank``.  Filter → pane counts → pane expansion → window sums →
    per-window group limit.
    """
    pv = behaviors.where(F.col("behavior") == behavior).select("item_id", "ts")
    counts = sliding_count(pv, key="item_id", ts="ts", size=size, slide=slide)
    top = top_n_per_window(counts, n=n)
    return top.select("window_end", "item_id", "cnt", "rank")


def java_timestamp_text(ts_col) -> F.Column:
    """``java.sql.Timestamp.toString`` of a timestamp: ``yyyy-MM-dd HH:mm:ss.f`` with trailing zeros trimmed,
    at least one fractional digit."""
    frac = F.regexp_replace(F.date_format(ts_col, "SSSSSS"), "0+$", "")
    return F.concat(F.date_format(ts_col, "yyyy-MM-dd HH:mm:ss"), F.lit("."),
                    F.when(frac == "", F.lit("0")).otherwise(frac))


def hot_items_report(top: DataFrame, *, window_col="window_end") -> DataFrame:
    """One text block per window: header rule, ``time: <window end>``, one line per rank, closing rule.

    The per-window group holds at most n rows (the top-n already applied), so ``collect_list`` is bounded.
    """
    line = F.format_string("No.%d :  itemID = %s count = %d", F.col("rank"), F.col("item_id").cast("string"),
                           F.col("cnt"))
    grouped = top.groupBy(window_col).agg(
        F.array_sort(F.collect_list(F.struct(F.col("rank").alias("r"), line.alias("l")))).alias("lines"))
    text = F.concat(F.lit(REPORT_RULE + "\n" + REPORT_TIME_PREFIX), java_timestamp_text(F.col(window_col)),
                    F.lit("\n"),
                    F.concat_ws("", F.transform("lines", lambda x: F.concat(x["l"], F.lit("\n")))),
                    F.lit(REPORT_RULE + "\n\n"))
    return grouped.select(window_col, text.alias("report"))


# Sliding-window counts are pre-aggregated per slide-long pane; only pane counts are expanded to the size/slide
# windows they belong to (a row is never copied into every window).
HOT_ITEMS_SQL = """
SELECT item_id, item_count, window_end, row_num
FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY window_end ORDER BY item_count DESC, item_id ASC) AS row_num
  FROM (
    SELECT item_id, SUM(pane_count) AS item_count, window_end
    FROM (
      SELECT item_id, pane_count,
             explode(sequence(pane.end, pane.start + INTERVAL '{size}', INTERVAL '{slide}')) AS window_end
      FROM (
        SELECT item_id, window(ts, '{slide}') AS pane, COUNT(item_id) AS pane_count
        FROM {view}
        GROUP BY window(ts, '{slide}'), item_id
      )
    )
    GROUP BY item_id, window_end
  )
)
WHERE row_num <= {n}
"""


def hot_items_sql(spark: SparkSession, view: str, *, n: int = 3, size="1 hour", slide="5 minutes") -> DataFrame:
    """The SQL spelling of the hot-items query over a registered view ``(item_id, ts)``."""
    if to_seconds(size) % to_seconds(slide):
        raise ValueError("size must be a multiple of slide")
    return spark.sql(HOT_ITEMS_SQL.format(view=view, n=int(n), size=size, slide=slide))


def changelog(prev: DataFrame, curr: DataFrame, *, flag_col="is_add") -> DataFrame:
    """Retract/add pairs turning result ``prev`` into ``curr`` (multiset difference both ways).

    Rows only in ``prev`` come out with ``is_add = false`` (retractions), rows only in ``curr`` with ``true``.  Each
    side is read once: equal rows cancel out in one aggregate.
    """
    cols = curr.columns
    signed = (prev.select(*cols, F.lit(-1).alias("_sign"))
              .unionByName(curr.select(*cols, F.lit(1).alias("_sign"))))
    net = signed.groupBy(*cols).agg(F.sum("_sign").alias("_net")).where("_net <> 0")
    copies = F.explode(F.array_repeat(F.col("_net") > 0, F.abs("_net").cast("int"))).alias(flag_col)
    return net.select(copies, *cols)


def hot_items_changelog(behaviors: DataFrame, since, *, n: int = 3, size="1 hour", slide="5 minutes",
                        behavior="pv") -> DataFrame:
    """:func:`changelog` from the hot items of the rows before ``since`` to the hot items of all rows.

    One scan and one pane aggregate count both versions; the windows' counts are then unpivoted, ranked per window
    and version (a group limit in each task), and compared, at most ``2 * n`` rows a window.
    """
    pv = behaviors.where(F.col("behavior") == behavior).select("item_id", "ts")
    both = sliding_count(pv, key="item_id", ts="ts", size=size, slide=slide, also=F.col("ts") < since)
    versions = both.select("window_end", "item_id", F.explode(F.array(
        F.struct(F.lit(False).alias("curr"), F.col("cnt_also").alias("cnt")),
        F.struct(F.lit(True).alias("curr"), F.col("cnt").alias("cnt")))).alias("v")).where("v.cnt > 0")
    versions = versions.select("window_end", "item_id", "v.*").withColumn("_group", F.struct("window_end", "curr"))
    top = top_n_per_window(versions, n=n, window_col="_group")
    net = (top.groupBy("window_end", "item_id", "cnt", "rank").agg(F.count(F.lit(1)).alias("versions"),
                                                                    F.max("curr").alias("is_add")))
    return net.where("versions = 1").select("is_add", "window_end", "item_id", "cnt", "rank")
