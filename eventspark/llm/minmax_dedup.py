"""MinHash near-duplicates by min-max hashing.

Every permutation of the shingle hashes gives two signature values, its minimum and its maximum, so ``perms``
evaluations give ``2 * perms`` values.  Bands of ``rows`` consecutive values (all minima, then all maxima, so the two
ends of one permutation lie in different bands) are the bucket keys.

Steps, every one a shuffle of small rows:

1. One pass over the texts: distinct word shingles, digest of the whole set, band keys.
2. Documents with equal sets are one class, known by 64 bits of the set's digest (never by a doc_id); only one row of it
   goes on, so copies cost nothing further.
3. Every bucket proposes its smallest member against each of its others (linear in the bucket).  Proposed pairs are
   confirmed on the full sets, which are built once for the documents concerned.
4. Components of the confirmed links.  A bucket whose members still lie in different components then compares the
   full sets of those members, in pairs of blocks of ``block`` rows; a block pair returns only links that merge
   components, fewer than its rows.  Pairs inside one component need no comparison: they cannot change the result.

A pair of similarity s shares no band with probability ``(1 - s**rows) ** bands``: 2.4e-7 at 0.85 with 5 and 26.

Nulls and odd inputs: null and empty texts have an empty set and link with nothing; texts below five words are one
shingle; rows that repeat a doc_id keep one result row each, by their own text; in ``near_duplicates`` a null doc_id takes
no part and gets a null component, in ``deduplicated`` it is compared like any other; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventspark.llm import words
from eventspark.llm.components import connected_components
from eventspark.session import reliable_checkpoint

U = np.uint64


def permutations(n: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 63, n, dtype=U) * U(2) + U(1), rng.integers(0, 1 << 63, n, dtype=U)


def signatures(hashes: np.ndarray, counts: np.ndarray, perms: int) -> np.ndarray:
    """``len(counts) x 2 * perms`` values: minima, then maxima.  Rows without shingles are zero."""
    a, b = permutations(perms)
    out = np.zeros((len(counts), 2 * perms), U)
    full = np.flatnonzero(counts)
    if len(full):
        first = (np.cumsum(counts) - counts)[full]
        for i in range(perms):
            v = hashes * a[i] + b[i]
            out[full, i] = np.minimum.reduceat(v, first)
            out[full, perms + i] = np.maximum.reduceat(v, first)
    return out


def _digest(own: np.ndarray) -> int:
    """64 bits of a set's digest."""
    return int.from_bytes(hashlib.blake2b(own.tobytes(), digest_size=8).digest(), "little", signed=True)


def _band_keys(bands: int, rows: int, width: int):
    perms = -(-bands * rows // 2)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for row, to, h, counts in words.batches(batch.column(1)):
                sh, per = words.shingles(h, counts, width)
                sig = signatures(sh, per, perms)
                key = np.zeros((len(per), bands), U)
                with np.errstate(over="ignore"):
                    for j in range(bands):
                        k = np.full(len(per), j + 1, U)
                        for x in range(j * rows, (j + 1) * rows):
                            k = words.mix(k * U(0x9FB21C651E98DF25) + sig[:, x])
                        key[:, j] = k
                at = np.concatenate([[0], np.cumsum(per)])
                n, digest = np.zeros(len(per), np.int64), []
                for i in range(len(per)):
                    own = np.unique(sh[at[i]:at[i + 1]])
                    n[i] = len(own)
                    digest.append(_digest(own))
                ends = np.concatenate([[0], np.cumsum(np.where(per > 0, bands, 0))]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(words.signed(key[per > 0].ravel())))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, to - row), batch.column(2).slice(row, to - row), pa.array(n),
                     pa.array(digest, pa.int64()), lists], names=["doc_id", "row", "n_shingles", "rep", "bands"])

    return run


def _sets(width: int):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for row, to, h, counts in words.batches(batch.column(1)):
                sh, per = words.shingles(h, counts, width)
                at = np.concatenate([[0], np.cumsum(per)])
                own = [np.unique(sh[at[i]:at[i + 1]]) for i in range(len(per))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_digest(x) for x in own], pa.int64()),
                     pa.array([x.tobytes() for x in own], pa.large_binary()).cast(pa.binary())], names=["doc_id", "hashes"])

    return run


def _confirm(percent: int):
    """Rows ``(hub, salt, member, doc_id, hashes)``, a hub's own row first: links of at least ``percent``."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, own = None, []  # own: the hub's set
        for batch in it:
            h, s, m, d = (batch.column(i).to_pylist() for i in range(4))
            us, vs = [], []
            for i in range(batch.num_rows):
                x = np.frombuffer(batch.column(4)[i].as_buffer(), U)
                if not m[i]:
                    own = [*own, x.copy()] if hub == (h[i], s[i]) else [x.copy()]
                    hub = (h[i], s[i])
                    continue
                for y in own if hub == (h[i], s[i]) else ():
                    both = len(np.intersect1d(y, x, assume_unique=True))
                    if both and 100 * both >= percent * (len(y) + len(x) - both):
                        us.append(h[i])
                        vs.append(d[i])
                        break
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])

    return run


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int, per_task: int = 64) -> DataFrame:
    """The pairs ``(hub, rep)`` whose sets overlap enough, as ``(u, v)``.  A hub of many pairs is dealt out by salt."""
    size = reliable_checkpoint(pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / per_task).alias("salts")))
    salted = reliable_checkpoint(pairs.join(size, "hub").select(
        "hub", F.pmod(F.xxhash64("rep"), F.col("salts")).alias("salt"), "rep"))
    members = salted.join(sets, salted["rep"] == sets["doc_id"]).select(
        "hub", "salt", F.lit(1).alias("member"), "doc_id", "hashes")
    hubs = salted.select("hub", "salt").distinct()
    hubs = hubs.join(sets, hubs["hub"] == sets["doc_id"]).select(
        "hub", "salt", F.lit(0).alias("member"), "doc_id", "hashes")
    n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = members.union(hubs).repartition(n, "hub", "salt").sortWithinPartitions("hub", "salt", "member")
    return reliable_checkpoint(dealt.mapInArrow(_confirm(percent), "u long, v long"))


def _cross_block(percent: int):
    """One block pair of a bucket: links between its components, only those that merge two of them."""

    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        side = pdf["side"].to_numpy()
        comp, at = np.unique(pdf["component"].to_numpy(), return_inverse=True)
        root = np.arange(len(comp))  # of each component, the group it has been merged into
        sets = [np.frombuffer(x, U) for x in pdf["hashes"]]
        size = np.array([len(x) for x in sets])
        shingle, local = np.unique(np.concatenate(sets), return_inverse=True)
        start = np.cumsum(size) - size
        rep = pdf["rep"].to_numpy()
        right = np.flatnonzero(side == (0 if key[1] == key[2] else 1))
        if not len(right):
            return pd.DataFrame({"u": [], "v": []}, dtype="int64")
        r_ids = np.concatenate([local[start[j]:start[j] + size[j]] for j in right])
        r_start = np.cumsum(size[right]) - size[right]
        mark, links = np.zeros(len(shingle), dtype=np.int32), []
        for i in np.flatnonzero(side == 0):
            if (root[at[right]] == root[at[i]]).all():
                continue
            own = local[start[i]:start[i] + size[i]]
            mark[own] = 1
            both = np.add.reduceat(mark[r_ids], r_start)
            mark[own] = 0
            for j in right[100 * both >= percent * (size[i] + size[right] - both)]:
                a, b = root[at[i]], root[at[j]]
                if a != b:
                    root[root == max(a, b)] = min(a, b)
                    links.append((rep[i], rep[j]))
        return pd.DataFrame(links, columns=["u", "v"], dtype="int64")

    return run


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc_id, text, row)``; ``row`` is a hash of the two, the same in every pass."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.withColumn("row", F.xxhash64("doc_id", "text"))


def _classes(texts: DataFrame, seen: DataFrame, percent: int, block: int, width: int) -> DataFrame:
    """``(rep, least, component)`` of the classes of ``seen``: smallest ``(doc_id, row)``, a null doc_id last; component's rep."""
    least = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    classes = reliable_checkpoint(seen.filter("n_shingles > 0").groupBy("rep").agg(
        F.min(least).alias("least"), F.first("bands").alias("bands")))  # equal sets have equal bands
    bucket = classes.select("rep", F.explode("bands").alias("key"))
    size = bucket.groupBy("key").agg(F.min("rep").alias("hub"), F.max("rep").alias("top"),
                                     F.count(F.lit(1)).alias("n")).filter("top > hub").drop("top")
    size = reliable_checkpoint(size)
    shared = reliable_checkpoint(bucket.join(size, "key"))
    pairs = reliable_checkpoint(shared.filter("rep <> hub").select("hub", "rep").distinct())
    classes = classes.drop("bands")
    if pairs.isEmpty():
        return classes.withColumn("component", F.col("rep"))
    needed = classes.join(shared.select("rep").distinct(), "rep", "leftsemi").select("least.row")
    sets = texts.join(needed, "row", "leftsemi").select("doc_id", "text").mapInArrow(_sets(width), "doc_id long, hashes binary")
    sets = reliable_checkpoint(sets.dropDuplicates(["doc_id"]))
    links = _confirmed(pairs, sets, percent)
    first = reliable_checkpoint(connected_components(links))
    more = reliable_checkpoint(_cross_links(shared.filter("n > 2"), first, sets, percent, block))
    if not more.isEmpty():
        first = reliable_checkpoint(connected_components(links.union(more)))
    return reliable_checkpoint(classes.join(first, classes["rep"] == first["node"], "left").select(
        "rep", "least", F.coalesce("component", "rep").alias("component")))


def _seen(texts: DataFrame, bands: int, rows: int, width: int) -> DataFrame:
    return reliable_checkpoint(texts.mapInArrow(
        _band_keys(bands, rows, width), "doc_id long, row long, n_shingles long, rep long, bands array<long>"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85,
                    bands: int = 26, rows: int = 5, width: int = 5, block: int = 256) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row of ``docs``."""
    texts = _texts(docs, id_col, text_col)
    seen = _seen(texts, bands, rows, width)
    classes = _classes(texts, seen.filter("doc_id IS NOT NULL"), percent, block, width)
    smallest = classes.groupBy("component").agg(F.min("least.doc_id").alias("smallest"))
    classes = classes.join(smallest, "component").select("rep", "smallest")
    keyed = seen.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("rep")).alias("rep"))
    out = keyed.join(classes, "rep", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("smallest", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(component == F.col("doc_id"), F.lit(False)).alias("kept"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85,
                 bands: int = 26, rows: int = 5, width: int = 5, block: int = 256) -> DataFrame:
    """Exactly one row of ``docs`` per component, that of the smallest doc_id (null last), and all rows without words.

    Rows of equal doc_id and text differ in their other columns only; the one whose others come first as JSON stays.
    All columns are returned as they are, whatever their names and types.
    """
    texts = _texts(docs, id_col, text_col)
    classes = _classes(texts, _seen(texts, bands, rows, width), percent, block, width)
    stay = reliable_checkpoint(classes.groupBy("component").agg(F.min("least").alias("least")).select(F.col("least.row").alias("stays")))
    text = F.col(text_col).cast("string")
    some = F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    own = [F.col(f"`{c}`") for c in docs.columns]
    others = [F.col(f"`{c}`") for c in docs.columns if c not in (id_col, text_col)]
    one = docs.filter(some).select(F.struct(*own).alias("doc"), F.xxhash64(F.col(id_col).cast("long"), text).alias("row"),
                                   (F.to_json(F.struct(*others)) if others else F.lit("")).alias("first"))
    one = one.join(stay, F.col("row") == F.col("stays"), "leftsemi").groupBy("row").agg(F.min_by("doc", "first").alias("doc"))
    return docs.filter(~some).union(one.select(*[F.col(f"doc.`{c}`") for c in docs.columns]))


def _cross_links(shared: DataFrame, components: DataFrame, sets: DataFrame, percent: int, block: int) -> DataFrame:
    """Links ``(u, v)`` that join different components, from buckets whose members lie in several of them."""
    held = shared.select("key", "rep").join(components, F.col("rep") == F.col("node"), "left").select(
        "key", "rep", F.coalesce("component", "rep").alias("component"))
    held = reliable_checkpoint(held)
    mixed = reliable_checkpoint(held.groupBy("key").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("n"))
        .filter("lo < hi").select("key", F.ceil(F.col("n") / block).alias("blocks")))
    held = reliable_checkpoint(held.join(mixed, "key"))
    held = held.join(sets, held["rep"] == sets["doc_id"])
    own = F.pmod(F.xxhash64("rep"), F.col("blocks"))
    one = held.select("key", "rep", "component", "hashes", own.alias("own"),
                      F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    one = one.select("key", F.least("own", "other").alias("b1"), F.greatest("own", "other").alias("b2"),
                     F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"), "rep", "component", "hashes")
    return one.groupBy("key", "b1", "b2").applyInPandas(_cross_block(percent), "u long, v long")
