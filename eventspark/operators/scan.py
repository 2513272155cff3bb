"""Running (prefix) aggregates that stay balanced under skew.

``Window.partitionBy(key).orderBy(t)`` puts every row of a key into one task, and an un-keyed running value
(watermark = running max over *global* arrival order) would put the whole table into one task.  ``prefix_scan``
instead cuts the rows into range pieces over ``(key, order)`` so that even a key holding a third of all rows spans
many pieces of similar size, and stitches the pieces back together with a carry:

1. Range pieces: ``repartitionByRange`` over ``(key, *order)`` into ``spark.sql.shuffle.partitions`` pieces (two at
   least), at every size.  The rows are written once to the shared checkpoint folder together with their piece id
   ``_ps_pid`` (the partition's number, so ids follow the sort order); summary and scan both read that copy, and a task
   that is recomputed after an executor loss sees the same pieces.  The input is evaluated twice: by Spark's range
   sampling and by the write.
2. Per piece: first key, last key and the aggregate of the piece's tail (rows of its last key) — partial aggregates
   per ``(piece, key)`` combined map-side before a small shuffle, then one tiny row per piece.
3. Carry into piece p: the aggregate of all earlier rows with p's first key.  Because keys are sorted across
   pieces, those rows sit in the tails of the pieces just before p; a window over the summary rows finds them.  The
   carry table has one row per piece, as many as there are shuffle partitions, so it is broadcast.
4. Running value inside ``(piece, key)`` with an ordinary window, combined with the carry on the piece's first key.
   Every window group is at most one piece.

Supported aggregates: ``sum``, ``max``, ``min`` and ``last`` (last non-null value in order, the carrier of as-of
lookups).  ``sum`` treats NULL as 0; the others ignore NULL.  ``inclusive=False`` gives the value before the row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import reliable_checkpoint

_PID, _FIRST, _LAST = "_ps_pid", "_ps_first", "_ps_last"


def _partial(how: str, v: Column, order_struct: Column) -> Column:
    if how == "sum":
        return F.sum(v)
    if how == "max":
        return F.max(v)
    if how == "min":
        return F.min(v)
    if how == "last":
        return F.max_by(v, F.when(v.isNotNull(), order_struct))
    raise ValueError(how)


def _running(how: str, v: Column, w: Window) -> Column:
    if how == "sum":
        return F.sum(v).over(w)
    if how == "max":
        return F.max(v).over(w)
    if how == "min":
        return F.min(v).over(w)
    if how == "last":
        return F.last(v, ignorenulls=True).over(w)
    raise ValueError(how)


def _combine(how: str, run: Column, carry: Column) -> Column:
    if how == "sum":
        return F.coalesce(run, F.lit(0)) + F.coalesce(carry, F.lit(0))
    if how == "max":
        return F.greatest(run, carry)
    if how == "min":
        return F.least(run, carry)
    if how == "last":
        return F.coalesce(run, carry)
    raise ValueError(how)


def prefix_scan(df: DataFrame, *, order: Sequence[str], values: Sequence[tuple[str, Column, str]],
                key: str | None = None, inclusive: bool = True, num_partitions: int | None = None,
                keep_piece: bool = False, in_pieces: bool = False) -> DataFrame:
    """Add running aggregates to ``df``.

    ``values`` lists ``(out_col, value_expr, how)``.  ``order`` must make rows unique within a key (add a unique id as
    the last column), otherwise rows of equal order are visited in an arbitrary order.  ``in_pieces``: ``df`` comes out
    of a scan by the same key and order with ``keep_piece``; its pieces are used again, without another range shuffle.
    """
    order = list(order)
    keycols = [key] if key else []
    names = [c for c in df.columns if c not in (_PID, _FIRST, _LAST)]
    vals = [(out, f"_ps_v{i}", expr, how) for i, (out, expr, how) in enumerate(values)]
    prepared = df.select("*", *[expr.alias(tmp) for _, tmp, expr, _ in vals])

    pieces = max(2, num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    frame = (Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    if in_pieces:
        pieced = reliable_checkpoint(prepared.drop(_FIRST, _LAST))
    else:
        pieced = reliable_checkpoint(prepared.repartitionByRange(pieces, *keycols, *order)
                                     .withColumn(_PID, F.spark_partition_id()))
    order_struct = F.struct(*[F.col(c) for c in order])

    # 2. per-piece first/last key and tail aggregates (one row per non-empty piece)
    if key:
        # combined per (piece, key) map-side, so only partial rows are shuffled; then each piece keeps its first key and
        # its last key's aggregate
        per_key = pieced.groupBy(_PID, key).agg(*[_partial(how, F.col(tmp), order_struct).alias(tmp)
                                                   for _, tmp, _, how in vals])
        # keys ordered as the sort orders them, NULL first (plain min/max/max_by would skip a NULL key)
        k_ord = F.struct(F.col(key).isNotNull().alias("nn"), F.col(key).alias("k"))
        tail = F.max_by(F.struct(*[F.col(tmp) for _, tmp, _, _ in vals]), k_ord)
        summary = (per_key.groupBy(_PID)
                   .agg(F.min(k_ord)["k"].alias(_FIRST), F.max(k_ord)["k"].alias(_LAST), tail.alias("_ps_tail"))
                   .select(_PID, _FIRST, _LAST, *[F.col("_ps_tail")[tmp].alias(tmp) for _, tmp, _, _ in vals]))
    else:
        summary = (pieced.groupBy(_PID).agg(*[_partial(how, F.col(tmp), order_struct).alias(tmp)
                                              for _, tmp, _, how in vals])
                   .withColumn(_FIRST, F.lit(0)).withColumn(_LAST, F.lit(0)))

    # 3. carry into each piece (windows over the summary rows only, one per piece, brought together once)
    summary = summary.repartition(1)
    by_last = Window.partitionBy(_LAST).orderBy(_PID).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    by_pid = Window.orderBy(_PID)
    runs = summary.select(_PID, _FIRST, _LAST,
                          *[_running(how, F.col(tmp), by_last).alias(tmp) for _, tmp, _, how in vals])
    carry = runs.select(
        _PID,
        *[F.when(F.lag(_LAST).over(by_pid).eqNullSafe(F.col(_FIRST)), F.lag(tmp).over(by_pid)).alias(tmp + "_c")
          for _, tmp, _, _ in vals],
        F.col(_FIRST), F.col(_LAST))

    # 4. running value within (piece, key), combined with the piece's carry on its first key
    w = Window.partitionBy(_PID, *keycols).orderBy(*order).rowsBetween(*frame)
    joined = pieced.join(F.broadcast(carry), _PID, "left")
    first_key = F.col(key).eqNullSafe(F.col(_FIRST)) if key else F.lit(True)
    out_cols = []
    for out, tmp, _, how in vals:
        run = _running(how, F.col(tmp), w)
        other = F.coalesce(run, F.lit(0)) if how == "sum" else run
        out_cols.append(F.when(first_key, _combine(how, run, F.col(tmp + "_c"))).otherwise(other).alias(out))
    # keep_piece: also return the piece id and its first/last key (the frame stays hash-partitioned by piece, so a
    # caller can run more windows over (piece, key) without another shuffle)
    return joined.select(*names, *out_cols, *([_PID, _FIRST, _LAST] if keep_piece else []))


def running_count(df: DataFrame, *, key: str | None, order: Sequence[str], out: str = "running_cnt") -> DataFrame:
    """1-based position of each row within its key in ``order`` (skew-safe ``row_number``)."""
    return prefix_scan(df, key=key, order=order, values=[(out, F.lit(1).cast("bigint"), "sum")])


def with_neighbors(df: DataFrame, *, key: str, order: Sequence[str], offsets: Sequence[int],
                   cols: Sequence[str], rn_col: str = "rn") -> DataFrame:
    """Attach the columns of the rows ``offset`` positions later (negative: earlier) within the key.

    ``lead``/``lag`` without a single-key window, and without a further shuffle: the positions come from the skew-safe
    :func:`running_count`, whose output stays partitioned by range piece; ``lead``/``lag`` over ``(piece, key)`` find
    every neighbour inside the same piece.  A neighbour in another piece is at most ``max|offset|`` rows into that
    piece's first (or last) key, so those edge rows — at most ``max|offset|`` per piece, a proven bound — are
    broadcast and looked up by ``(key, position)``.  Neighbour columns are named ``{col}_{offset}`` (``_m`` for
    negative offsets).
    """
    numbered = prefix_scan(df, key=key, order=order, values=[(rn_col, F.lit(1).cast("bigint"), "sum")],
                           keep_piece=True)
    return neighbors_in_pieces(numbered, key=key, order=order, offsets=offsets, cols=cols, rn_col=rn_col,
                               keep=[*df.columns, rn_col])


def neighbors_in_pieces(numbered: DataFrame, *, key: str, order: Sequence[str], offsets: Sequence[int],
                        cols: Sequence[str], rn_col: str, keep: Sequence[str]) -> DataFrame:
    """The neighbour step of :func:`with_neighbors` for a frame that came out of :func:`prefix_scan` with
    ``keep_piece=True`` and holds ``rn_col``, the 1-based position of each row within its key."""
    run = Window.partitionBy(_PID, key)
    w = run.orderBy(*order)
    ahead = max([o for o in offsets if o > 0], default=0)
    behind = max([-o for o in offsets if o < 0], default=0)

    def tag(off: int) -> str:
        return f"{off}" if off >= 0 else f"m{-off}"

    inside = [(F.lead(c, off) if off > 0 else F.lag(c, -off)).over(w).alias(f"{c}_{tag(off)}")
              for off in offsets for c in cols]
    fw = F.row_number().over(w)
    staged = numbered.select("*", *inside, fw.alias("_nb_fw"))
    staged = staged.withColumn("_nb_bw", F.count(F.lit(1)).over(run) - F.col("_nb_fw") + 1)
    # one edge table for every offset (identical broadcast subtrees are reused by the planner)
    edge = staged.where((F.col(key).eqNullSafe(F.col(_FIRST)) & (F.col("_nb_fw") <= ahead))
                        | (F.col(key).eqNullSafe(F.col(_LAST)) & (F.col("_nb_bw") <= behind))).select(
        F.col(key).alias("_nb_k"), F.col(rn_col).alias("_nb_rn"), *[F.col(c).alias(f"_nb_{c}") for c in cols])
    out = staged
    for off in offsets:
        t = tag(off)
        joined = out.join(F.broadcast(edge), F.col(key).eqNullSafe(F.col("_nb_k"))
                          & ((F.col(rn_col) + F.lit(off)) == F.col("_nb_rn")), "left")
        # inside the piece the window found it; across pieces the edge row did (both are the same row when both hit)
        repl = {f"{c}_{t}": F.coalesce(F.col(f"{c}_{t}"), F.col(f"_nb_{c}")) for c in cols}
        out = joined.select(*[repl.get(c2, F.col(c2)).alias(c2) for c2 in out.columns])
    return out.select(*keep, *[f"{c}_{tag(off)}" for off in offsets for c in cols])
