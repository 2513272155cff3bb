"""Reversible line deduplication: sharded cuckoo filters backed by exact reference-count tables.

A line's key is the line without blanks around it, A-Z lower-cased, known by 128 bits of a hash.  :class:`LineIndex`
keeps three tables in a shared folder:

* ``references``: which document holds which key, one row each, in parts; an insertion adds a part;
* ``counts``: how many documents hold a key, and the largest of their ids;
* ``filters``: per shard of the key space, a cuckoo filter of the keys that enough documents share.

Insertion adds the new references, merges their counts, and inserts into the filters the keys that reach ``min_docs``.
Deletion takes the documents' references out, counts anew the keys that they held, and deletes from the filters those
that fall below.  Both are exact, so inserting and deleting the same documents leads back to the same tables.  A shard
whose filter is full is built anew from ``counts``.

``deduplicated`` deals the documents' keys out to the filters (by shard, and by a salt of the document, so a key that a
third of all documents hold is spread over many tasks), checks what passes against ``counts``, and drops those lines.
Keys held by a thousandth of all references or more, a thousand at most, are broadcast for that; the others are joined.

Nulls and odd inputs: null and empty texts are one empty line and come back empty; a null id is one document, smaller
than all others; rows that share an id are one document; an id inserted again adds the lines not yet known of it;
deleting an unknown id changes nothing; repeated rows give equal results; other columns are kept, but for added names.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventspark.llm.cuckoo import CuckooFilter
from eventspark.session import reliable_checkpoint, remove_folder, scratch_folder

BLANK = " \t\n\x0b\x0c\r"
_PAIR = struct.Struct("<qq")


def line_key(line: str, min_chars: int) -> tuple[int, int] | None:
    """128 bits of the line's key; none for a key below ``min_chars`` code points."""
    core = line.strip(BLANK)
    if len(core) < min_chars:
        return None
    return _PAIR.unpack(xxhash.xxh3_128_digest(core.encode().lower()))  # bytes: lower-cases A-Z only


def _keys(min_chars: int):
    """``(text, doc_id, row)`` to one ``(k1, k2, doc_id, row)`` per key of the text."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            found, per = [], np.zeros(batch.num_rows, np.int64)
            for i, text in enumerate(batch.column(0)):
                own = {line_key(line, min_chars) for line in (text.as_py() or "").split("\n")} - {None}
                found += own
                per[i] = len(own)
            keys = np.array(found, np.int64).reshape(-1, 2)
            at = pa.array(np.repeat(np.arange(batch.num_rows), per))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[:, 0]), pa.array(keys[:, 1]), batch.column(1).take(at), batch.column(2).take(at)],
                names=["k1", "k2", "doc_id", "row"])

    return run


def _screen(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(shard, slots, k1, k2, doc_id, row)``, a shard's filter before its keys: the keys that the filter holds."""
    shard, known = None, None
    for batch in it:
        own = batch.column(0).to_numpy()
        is_filter = batch.column(1).is_valid().to_numpy(zero_copy_only=False)
        k1 = batch.column(2).fill_null(0).to_numpy()
        passed = np.zeros(batch.num_rows, bool)
        cuts = np.flatnonzero((own[1:] != own[:-1]) | is_filter[1:] | is_filter[:-1]) + 1
        for a, b in zip([0, *cuts], [*cuts, len(own)], strict=True):
            if b > a and is_filter[a]:
                shard, known = own[a], CuckooFilter.load(batch.column(1)[a].as_py())
            elif b > a and shard == own[a]:
                passed[a:b] = known.contains(k1[a:b])
        yield pa.RecordBatch.from_arrays(batch.columns[2:], names=["k1", "k2", "doc_id", "row"]).filter(pa.array(passed))


def _updated(key, changed: pd.DataFrame, old: pd.DataFrame) -> pd.DataFrame:
    """A shard's filter after ``changed`` keys came (``up``) and went; null slots if it is full."""
    up, k1 = changed["up"].to_numpy(bool), changed["k1"].to_numpy(np.int64)
    if len(old):
        known = CuckooFilter.load(old["slots"].iloc[0])
        known.delete(k1[~up])
        slots = known.dump() if known.insert(k1[up]) else None
    else:
        slots = CuckooFilter.of(k1[up]).dump()
    return pd.DataFrame({"shard": [key[0]], "slots": [slots]})


def _built(key, shared: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"shard": [key[0]], "slots": [CuckooFilter.of(shared["k1"].to_numpy(np.int64)).dump()]})


def _kept(min_chars: int):
    """``(doc, text, drops)`` to ``(doc, text, n_lines, n_dropped)``."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            texts, lines, dropped = [], [], []
            drops = batch.column(2)
            for i, text in enumerate(batch.column(1)):
                text = text.as_py() or ""
                own = text.split("\n")
                stay = own
                if drops[i].is_valid:
                    gone = {(d["k1"], d["k2"]) for d in drops[i].as_py()}
                    stay = [line for line in own if line_key(line, min_chars) not in gone]
                    text = "\n".join(stay)
                texts.append(text)
                lines.append(len(own))
                dropped.append(len(own) - len(stay))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())],
                names=["doc", "text", "n_lines", "n_dropped"])

    return run


class LineIndex:
    """The tables of one index in ``folder`` (a new one in the shared checkpoint folder by default).

    ``shards`` parts the key space when the index is made (default: as many as shuffle partitions); ``salts`` deals
    each shard's filter out to that many tasks.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None, min_docs: int = 3, min_chars: int = 20,
                 shards: int | None = None, salts: int = 16, id_col: str = "doc_id", text_col: str = "text"):
        self.spark, self.folder = spark, folder or scratch_folder(spark, "lines")
        self.min_docs, self.min_chars, self.salts = min_docs, min_chars, salts
        self.shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.id_col, self.text_col = id_col, text_col
        self.parts: list[str] = []
        self.counts_name = self.filters_name = ""
        self.version = 0

    @classmethod
    def open(cls, spark: SparkSession, folder: str, **options) -> LineIndex:
        """The index that an earlier session left in ``folder``; to be opened anew after another's insertion or deletion."""
        last = spark.read.json(f"{folder}/state-*").orderBy(F.col("version").desc()).first()
        out = cls(spark, folder, last["min_docs"], last["min_chars"], last["shards"], **options)
        out.parts, out.version = list(last["parts"]), last["version"]
        out.counts_name, out.filters_name = last["counts"], last["filters"]
        return out

    def _write(self, df: DataFrame, kind: str) -> str:
        name = f"{kind}-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.folder}/{name}")
        return name

    def _read(self, name: str, schema: str) -> DataFrame:
        if not name:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}")

    @property
    def references(self) -> DataFrame:
        schema = "k1 long, k2 long, doc_id long"
        if not self.parts:
            return self._read("", schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.folder}/{p}" for p in self.parts])

    @property
    def counts(self) -> DataFrame:
        return self._read(self.counts_name, "k1 long, k2 long, docs long, last long")

    @property
    def filters(self) -> DataFrame:
        return self._read(self.filters_name, "shard long, slots binary")

    def _documents(self, docs: DataFrame) -> DataFrame:
        return docs.select(F.col(self.text_col).cast("string").alias("text"), F.col(self.id_col).cast("long").alias("doc_id"),
                           F.xxhash64(F.col(self.id_col).cast("long"), F.col(self.text_col).cast("string")).alias("row"))

    def _postings(self, docs: DataFrame) -> DataFrame:
        return self._documents(docs).mapInArrow(_keys(self.min_chars), "k1 long, k2 long, doc_id long, row long")

    def insert(self, docs: DataFrame) -> None:
        """Adds the documents' lines."""
        new = self._postings(docs).select("k1", "k2", "doc_id").distinct()
        if self.parts:
            known = self.references.alias("k")
            same = (F.col("n.k1") == F.col("k.k1")) & (F.col("n.k2") == F.col("k.k2")) & F.col("n.doc_id").eqNullSafe(F.col("k.doc_id"))
            new = new.alias("n").join(known, same, "leftanti")
        part = self._write(new, "references")
        new = self._read(part, "k1 long, k2 long, doc_id long")
        self.parts.append(part)
        fresh = new.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("docs"), F.max("doc_id").alias("last"))
        if not self.counts_name:
            self._settle(fresh)
            return
        merged = self.counts.union(fresh).groupBy("k1", "k2").agg(F.sum("docs").alias("docs"), F.max("last").alias("last"))
        self._settle(merged)

    def delete(self, ids: DataFrame) -> None:
        """Takes all lines of the documents in ``ids`` (its column ``id_col``) out again."""
        if not self.parts:
            return
        ids = reliable_checkpoint(ids.select(F.col(self.id_col).cast("long").alias("id_")).distinct())
        same = F.col("doc_id").eqNullSafe(F.col("id_"))
        held = reliable_checkpoint(self.references.join(ids, same, "leftsemi").select("k1", "k2").distinct())
        part = self._write(self.references.join(ids, same, "leftanti"), "references")
        old, self.parts = self.parts, [part]
        again = self.references.join(held, ["k1", "k2"], "leftsemi").groupBy("k1", "k2").agg(
            F.count(F.lit(1)).alias("docs"), F.max("doc_id").alias("last"))
        self._settle(self.counts.join(held, ["k1", "k2"], "leftanti").union(again))
        for name in old:
            remove_folder(self.spark, f"{self.folder}/{name}")

    def _settle(self, counts: DataFrame) -> None:
        """Writes ``counts`` in place of the known ones and brings the filters up to them."""
        before, old = self.counts, [self.counts_name, self.filters_name]
        name = self._write(counts, "counts")
        shard = F.pmod(F.col("k2"), F.lit(self.shards)).alias("shard")
        enough = F.col("docs") >= self.min_docs
        shared = self._read(name, "k1 long, k2 long, docs long, last long").filter(enough).select("k1", "k2")
        if self.filters_name:
            was = before.filter(enough).select("k1", "k2")
            came = shared.join(was, ["k1", "k2"], "leftanti").select(shard, "k1", F.lit(True).alias("up"))
            went = was.join(shared, ["k1", "k2"], "leftanti").select(shard, "k1", F.lit(False).alias("up"))
            filters = reliable_checkpoint(came.union(went).groupBy("shard").cogroup(self.filters.groupBy("shard")).applyInPandas(
                _updated, "shard long, slots binary"))
            full = filters.filter("slots IS NULL").select("shard")
            anew = shared.select(shard, "k1").join(full, "shard", "leftsemi")
            filters = filters.filter("slots IS NOT NULL").union(
                anew.groupBy("shard").applyInPandas(_built, "shard long, slots binary"))
        else:
            filters = shared.select(shard, "k1").groupBy("shard").applyInPandas(_built, "shard long, slots binary")
        self.filters_name = self._write(filters, "filters")
        self.counts_name = name
        self.version += 1
        state = (self.version, self.parts, name, self.filters_name, self.min_docs, self.min_chars, self.shards)
        self.spark.createDataFrame([state], "version long, parts array<string>, counts string, filters string, "
                                            "min_docs int, min_chars int, shards int").write.json(
            f"{self.folder}/state-{self.version}")
        for gone in filter(None, old):
            remove_folder(self.spark, f"{self.folder}/{gone}")

    def _screened(self, postings: DataFrame) -> DataFrame:
        """The postings whose key a filter holds."""
        nothing = [F.lit(None).cast("long").alias(c) for c in ("k1", "k2", "doc_id", "row")]
        filters = self.filters.select("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(self.salts - 1).cast("long"))).alias("salt"),
                                      F.lit(0).alias("kind"), "slots", *nothing)
        keys = postings.select(F.pmod(F.col("k2"), F.lit(self.shards)).alias("shard"),
                               F.pmod(F.xxhash64("doc_id"), F.lit(self.salts)).alias("salt"), F.lit(1).alias("kind"),
                               F.lit(None).cast("binary").alias("slots"), "k1", "k2", "doc_id", "row")
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        dealt = filters.union(keys).repartition(n, "shard", "salt").sortWithinPartitions("shard", "salt", "kind")
        return dealt.select("shard", "slots", "k1", "k2", "doc_id", "row").mapInArrow(
            _screen, "k1 long, k2 long, doc_id long, row long")

    def deduplicated(self, docs: DataFrame) -> DataFrame:
        """``docs`` without the lines shared by ``min_docs`` documents of the index, which stay in the largest doc_id that
        holds them, and with ``n_lines`` (before) and ``n_dropped``."""
        hits = reliable_checkpoint(self._screened(self._postings(docs)))
        counts = self.counts
        total = counts.agg(F.sum("docs")).first()[0] or 0
        shared = counts.filter(F.col("docs") >= self.min_docs).select("k1", "k2", "docs", "last", F.lit(True).alias("is_shared"))
        often = F.col("docs") * 1000 >= total  # at most 1000 keys, as the counts add up to the total
        hot = F.broadcast(shared.filter(often).drop("docs"))
        first = hits.join(hot, ["k1", "k2"], "left")
        rest = first.filter("is_shared IS NULL").select("k1", "k2", "doc_id", "row")
        exact = first.filter("is_shared").select("k1", "k2", "doc_id", "row", "last").union(
            rest.join(shared.filter(~often), ["k1", "k2"]).select("k1", "k2", "doc_id", "row", "last"))
        gone = exact.filter(~F.col("doc_id").eqNullSafe(F.col("last"))).groupBy(
            F.col("doc_id").alias("of"), F.col("row").alias("in_row")).agg(F.collect_set(F.struct("k1", "k2")).alias("drops"))
        gone = reliable_checkpoint(gone)
        added = ("n_lines", "n_dropped")
        others = [f for f in docs.schema.fields if f.name != self.text_col and f.name not in added]
        doc = F.struct(*[F.col(f"`{f.name}`") for f in others]) if others else F.struct(F.lit(0).alias("none"))
        rows = docs.select(doc.alias("doc"), F.col(self.text_col).cast("string").alias("text"),
                           F.col(self.id_col).cast("long").alias("doc_id"),
                           F.xxhash64(F.col(self.id_col).cast("long"), F.col(self.text_col).cast("string")).alias("row"))
        rows = rows.join(gone, (F.col("row") == F.col("in_row")) & F.col("doc_id").eqNullSafe(F.col("of")), "left")
        rows = rows.select("doc", "text", "drops")
        schema = T.StructType([rows.schema["doc"], T.StructField("text", T.StringType()),
                               *[T.StructField(a, T.LongType()) for a in added]])
        out = rows.mapInArrow(_kept(self.min_chars), schema)
        names = [c for c in docs.columns if c not in added]
        return out.select(*[F.col("text").alias(c) if c == self.text_col else F.col(f"doc.`{c}`") for c in names], *added)


LINES_SQL = """WITH src AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
    lines AS (SELECT r, doc_id, unnest(string_split(text, chr(10))) AS line,
        generate_subscripts(string_split(text, chr(10)), 1) AS i FROM src),
    keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
    shared AS (SELECT key AS k, max(doc_id) AS last FROM keyed WHERE length(key) >= 20
        GROUP BY key HAVING count(DISTINCT coalesce(doc_id, -9223372036854775808)) >= 3),
    judged AS (SELECT r, doc_id, i, line, k IS NOT NULL AND doc_id IS DISTINCT FROM last AS gone
        FROM keyed LEFT JOIN shared ON key = k)
    SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
        sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
    FROM judged GROUP BY r, doc_id"""
