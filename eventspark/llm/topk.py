"""Exact top-k inner products: tiles of queries against shards of candidates, partial lists merged per query.

Candidates are dealt by hash to shards of about ``shard_rows`` vectors; every query goes to every shard.  A task holds
one shard as a matrix and multiplies it with the queries, ``tile`` at a time, keeping only the ``k`` best of each
query.  The lists are merged as a tree: those of ``fan`` neighbouring shards into one list of ``k`` per query, those of
``fan`` such groups again, until one list is left; no step brings more than ``fan * k`` rows of a query together.

Scores are integers: components are ``floor(scale * x)``.  Products are taken in double precision where every sum is
below 2^53 and thus exact, else in 64-bit integers.

Nulls and odd inputs: vectors that are null or hold null or non-finite components take no part, neither do null ids;
vectors of another length than the query's neither; repeated rows (same id, same vector) count once; a query never
meets a row of its own id; ties go to the smaller id; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventspark.llm.vectors import matrices, usable

_LEAST = np.iinfo(np.int64).min


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer ``a @ b.T``."""
    if a.size and b.size and float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2.0 ** 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def best(scores: np.ndarray, query: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(query, id, score)`` of the ``k`` highest scores of each row, ties to the smaller id, own ids left out."""
    scores[query[:, None] == ids[None, :]] = _LEAST
    n = min(k, scores.shape[1])
    least = np.partition(scores, scores.shape[1] - n, axis=1)[:, scores.shape[1] - n]
    row, col = np.nonzero((scores >= least[:, None]) & (scores > _LEAST))
    order = np.lexsort((ids[col], -scores[row, col], row))
    row, col = row[order], col[order]
    first = np.searchsorted(row, np.arange(len(query)))
    keep = np.arange(len(row)) - first[row] < k
    row, col = row[keep], col[keep]
    return query[row], ids[col], scores[row, col]


def _search(k: int, tile: int):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, parts, ready = None, {}, {}
        for batch in it:
            number, is_query, ids = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            cuts = np.flatnonzero(np.diff(number) | np.diff(is_query.astype(np.int8))) + 1
            for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                if lo == hi:
                    continue
                if number[lo] != shard:
                    shard, parts, ready = number[lo], {}, {}
                for rows, m in matrices(batch.column(3).slice(lo, hi - lo)):
                    own, d = ids[lo + rows], m.shape[1]
                    if not is_query[lo]:
                        parts.setdefault(d, []).append((own, m))
                        continue
                    if d in parts:
                        ready[d] = tuple(np.concatenate(x) for x in zip(*parts.pop(d), strict=True))
                    if d not in ready:
                        continue
                    for at in range(0, len(own), tile):
                        q = own[at:at + tile]
                        found = best(products(m[at:at + tile], ready[d][1]), q, ready[d][0], k)
                        yield pa.RecordBatch.from_arrays([*[pa.array(x) for x in found],
                                                          pa.array(np.full(len(found[0]), shard))],
                                                         names=["query_id", "vec_id", "score", "part"])

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0, shard_rows: int = 16_384,
          tile: int = 256, fan: int = 32, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)`` of the ``k`` best rows of every row with ``is_query``."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                          F.col(vector_col).cast("array<double>").alias("v"), is_query.alias("is_query"))
    rows = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("v"))).select(
        "vec_id", F.coalesce("is_query", F.lit(False)).alias("is_query"),
        F.transform("v", lambda x: F.floor(x * scale)).alias("v")).dropDuplicates(["vec_id", "v"])
    spark = vectors.sparkSession
    shards = -(-vectors.count() // shard_rows) or 1
    parts = rows.select(F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).cast("long").alias("shard"),
                        F.lit(False).alias("is_query"), "vec_id", "v")
    queries = rows.filter("is_query").select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")))
                                             .alias("shard"), "is_query", "vec_id", "v")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = parts.union(queries).repartition(n, "shard").sortWithinPartitions("shard", "is_query", "vec_id")
    lists = dealt.mapInArrow(_search(k, tile), "query_id long, vec_id long, score long, part long")
    while True:
        shards = -(-shards // fan)
        lists = _merged(lists.withColumn("part", F.floor(F.col("part") / fan)), k)
        if shards == 1:
            return lists.select("query_id", "rank", "vec_id", "score")


def _merged(lists: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each query in each part."""
    rank = F.row_number().over(Window.partitionBy("query_id", "part").orderBy(F.desc("score"), "vec_id"))
    return lists.withColumn("rank", rank).filter(F.col("rank") <= k)


def top_k_sql(every: int, k: int = 5, scale: int = 256) -> str:
    """DuckDB SQL of the same lists over ``embeddings``, queries being ids divisible by ``every``."""
    return f"""WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)) AS v
        FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
        FROM v q JOIN v c ON q.vec_id % {every} = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {k}"""
