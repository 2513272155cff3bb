"""Packing token pieces into fixed windows by non-negative least squares over length patterns.

Every document is tokenised once and cut on its own into full windows and one rest, so each piece's identity (start,
length, checksum) is known before the layout.  The layout depends only on the histogram of piece lengths, ``window``
numbers, which is all the driver gets:

1. shallow patterns (one, two or three lengths that fill a window exactly) are enumerated;
2. non-negative least squares, by coordinate descent on their sparse columns, finds repeat counts whose total matches
   the histogram;
3. the counts are rounded down and held to what is there;
4. what is left is packed greedily, longest first into the fullest window that takes it, whole groups of equal windows
   at a time.

The plan's size depends on the window, not on the corpus.  Pieces are then numbered within their length by hash bucket
(bucket offsets come from the per-bucket counts, so no length is ranked in one task) and look their place up in the
plan, which goes to the tasks as arrays.

Nulls and odd inputs: null and empty texts are one piece that holds the end id only; rows that repeat a doc_id are
packed like any others; other columns are ignored.
"""

from __future__ import annotations

import base64
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventspark.session import reliable_checkpoint

_ENCODERS: dict = {}


def encoder(vocabulary: str, ranks: str, pattern: str):
    """``text -> ids`` of a byte-level BPE vocabulary, made once per worker process.

    ``ranks`` holds the vocabulary as ranks; its encoder is four times as fast, but its splitting pattern gives up on
    very long runs of white space.  Such a text goes through ``vocabulary``, which gives the same ids.  Both are files
    that come with an installed library, so every worker has them.
    """
    import tiktoken
    from tokenizers import Tokenizer

    if (vocabulary, ranks) not in _ENCODERS:
        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        fast = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        slow = Tokenizer.from_file(vocabulary)
        slow.encode_special_tokens = True

        def encode(text: str) -> np.ndarray:
            try:
                return fast.encode_to_numpy(text, disallowed_special=())
            except ValueError:
                return np.array(slow.encode(text, add_special_tokens=False).ids, np.uint32)

        _ENCODERS[vocabulary, ranks] = encode
    return _ENCODERS[vocabulary, ranks]


def _cut(vocabulary: str, ranks: str, pattern: str, window: int, end_id: int):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, ranks, pattern)
        for batch in it:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(encode(text.as_py() or ""), end_id).astype("<u4")
                rows += [(doc, at, len(x := ids[at:at + window]), zlib.crc32(x.tobytes()), len(ids))
                         for at in range(0, len(ids), window)]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                             names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return run


def patterns(hist: np.ndarray, grid: int = 64) -> list[tuple[int, ...]]:
    """Pairs of lengths that fill the window, and triples whose middle length lies on a grid; lengths that occur."""
    window = len(hist) - 1
    have = hist > 0
    out: list[tuple[int, ...]] = [(a, window - a) for a in range(1, window // 2 + 1) if have[a] and have[window - a]]
    for a in np.flatnonzero(have[:window]).tolist():
        for b in range(grid // 2, window - a, grid):
            c = window - a - b
            if c > 0 and have[b] and have[c]:
                out.append((a, b, c))
    return out


def nnls(columns: list[tuple[int, ...]], hist: np.ndarray, sweeps: int = 20) -> np.ndarray:
    """Non-negative repeat counts that bring the columns' total nearest to ``hist``, by coordinate descent."""
    rest, x = hist.astype(float).tolist(), [0.0] * len(columns)
    uses = [[(n, c.count(n)) for n in set(c)] for c in columns]
    norm = [sum(m * m for _, m in u) for u in uses]
    for _ in range(sweeps):
        for i, u in enumerate(uses):
            step = sum(m * rest[n] for n, m in u) / norm[i]
            if (step := max(step, -x[i])):
                x[i] += step
                for n, m in u:
                    rest[n] -= m * step
    return np.array(x)


def plan(hist: np.ndarray) -> list[tuple[list[tuple[int, int]], int]]:
    """``([(length, times), ...], number of windows)`` that together hold exactly ``hist`` (index: length)."""
    window = len(hist) - 1
    left, out = hist.astype(np.int64).copy(), []
    if left[window]:
        out.append(([(window, 1)], int(left[window])))
        left[window] = 0
    columns = patterns(left)
    x = nnls(columns, left)
    for i in np.argsort(-x, kind="stable"):
        uses = [(n, columns[i].count(n)) for n in sorted(set(columns[i]), reverse=True)]
        n = min(int(x[i] + 1e-9), *(int(left[k]) // m for k, m in uses))
        if n <= 0:
            continue
        for k, m in uses:
            left[k] -= n * m
        out.append((uses, n))
    space: list[list] = [[] for _ in range(window + 1)]  # by free space: groups [number of equal windows, their uses]
    for k in range(window - 1, 0, -1):
        todo = int(left[k])
        while todo:
            free = next((f for f in range(k, window) if space[f]), window)
            group = space[free].pop() if free < window else [todo, []]
            each = min(free // k, todo)
            take = min(group[0], todo // each)
            if group[0] > take and free < window:
                space[free].append([group[0] - take, group[1]])
            space[free - each * k].append([take, [*group[1], (k, each)]])
            todo -= take * each
    return out + [(uses, n) for groups in space for n, uses in groups]


def slots(layout: list[tuple[list[tuple[int, int]], int]]) -> dict[str, np.ndarray]:
    """For each length, consecutive ranges of piece numbers and where their pieces go."""
    rows, used, sequence = [], {}, 0
    for uses, n in layout:
        offset = 0
        for k, m in uses:
            first = used.get(k, 0)
            used[k] = first + n * m
            rows.append((k, first, n, sequence, offset))
            offset += k * m
        sequence += n
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("length", "first", "n", "sequence", "offset"), table.T, strict=True))


def _placed(table: dict[str, np.ndarray]):
    key = table["length"] << 48 | table["first"]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(key, length << 48 | rank, side="right") - 1
            inside = rank - table["first"][at]
            n = table["n"][at]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in names),
                 pa.array(table["sequence"][at] + inside % n), pa.array(table["offset"][at] + length * (inside // n))],
                names=[*names, "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, vocabulary: str, ranks: str, pattern: str, window: int = 2048, end_id: int = 1,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    pieces = reliable_checkpoint(texts.mapInArrow(
        _cut(vocabulary, ranks, pattern, window, end_id),
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"))
    hist = np.zeros(window + 1, np.int64)
    for r in pieces.groupBy("length").count().collect():  # at most `window` rows
        hist[r["length"]] = r["count"]
    table = slots(plan(hist))
    buckets = max(64, math.isqrt(int(hist.sum())))
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start"), F.lit(buckets)))
    counts = dealt.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    counts = reliable_checkpoint(counts.select("length", "bucket", before.alias("before")))
    own = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32"))
    ranked = dealt.withColumn("own", own).join(counts, ["length", "bucket"])
    ranked = ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                           (F.col("before") + F.col("own") - 1).cast("long").alias("rank"))
    return ranked.mapInArrow(_placed(table), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                                             "sequence_id long, offset long")
