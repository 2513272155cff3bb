"""Hashed maximum-entropy language model with a class-factored softmax.

``log p(word | context) = log p(class | context) + log p(word | class, context)``, both softmaxes.

* Classes: each of the most frequent words is its own class, all other words fall into classes by their last two
  bytes, a text's end is one more.
* ``p(class | context)`` has four hashed features of the preceding words: the last word, the one before (a skip), both
  together, and the classes by ending of the last three.
* ``p(word | class, context)`` has one weight per word and hashed last word (``CONTEXTS`` of them), on the class's unigram
  shares ``(c + 1) / (N_class + V_class + 1)``, one unseen word per class among them.  The same smoothed step as below,
  taken from those shares, gives weights whose softmax is already normalised: with ``k`` the word's count in the context,
  ``K`` the class's and ``s`` = ``INSIDE``, a word has ``(k + s * share) / (K + s)``.  The counts by word and context are a
  Spark table that grows with the corpus.

Training is distributed: every round each task sums class counts per feature over its texts, the sums are added block by
block, and the driver applies one scaled gradient step (of the logarithmic form of iterative scaling, ``log observed /
expected`` over the number of features).  Every round covers every training text.  The first one sums the observed counts,
which hold for all rounds, and starts from the class frequencies, whose expectations need no softmax; the later ones sum
the softmax's expectations.  These weights are ``FEATURES * CLASSES`` numbers at any size of corpus.

Scoring works on sparse batches: four gathered weight rows per token.  Counts of the most frequent words, by context,
go to the tasks (``most * CONTEXTS`` numbers at most); all other words are looked up by a join on the word's hash.

Words are runs outside 0x20 and 0x09-0x0D after lower-casing A-Z, known by a 64-bit hash (two different words get the
same one with a chance of about ``V**2 / 2**65``).

Nulls and odd inputs: a null text is an empty one and consists of its end; a null id counts as held in; repeated rows
are learnt and scored as often as they occur; without training rows counts are zero and all classes alike; other
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventspark.llm import words
from eventspark.llm.frequent import most_frequent
from eventspark.session import reliable_checkpoint

U = np.uint64
FEATURES, ACTIVE = 1 << 14, 4
ENDINGS, OWN = 47, 32
CLASSES = 1 + ENDINGS + OWN
END = 0
BLOCK = 512
#: Features whose expectations one matrix product adds up, and the tokens it takes at most.
NEAR, PIECE = 16, 1024
#: Bytes of text cut into words at once; what that takes stays in the processor's cache.
CHUNK = 1 << 18
#: Ranges of word hashes that one part of the counting shuffle handles, one after another.
SPLIT = 16
#: Hashed last words of the softmax inside a class, and how many tokens the class's own shares weigh there.
CONTEXTS, INSIDE = 32, 1000.0
_END_HASH, _PAD = U(0x5851F42D4C957F2D), U(0x14057B7EF767814F)
#: The class by ending of each pair of last byte (times 256) and byte before it.
_BY_ENDING = (words.mix(np.arange(1 << 16, dtype=U)) % U(ENDINGS)).astype(np.int64) + 1


def tokens(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """``(first row, row after the last, hashes, classes by ending, tokens per row)``, each row closed by its end."""
    held: list = []

    def closed(row, to, h, e, counts):
        at = np.cumsum(counts)
        return row, to, np.insert(np.concatenate(h), at, _END_HASH), np.insert(np.concatenate(e), at, END), counts + 1

    for row, to, part, bounds in words.chunks(column, CHUNK):
        if held and held[0] != row:
            yield closed(*held)
            held = []
        starts, ends, counts = words.chunk_words(part, bounds)
        if not held:
            held = [row, to, [], [], np.zeros(to - row, np.int64)]
        held[2].append(words.hash_spans(part, starts, ends))
        last = words._LOWER[part[ends - 1]].astype(np.int64)
        before = np.where(ends - starts > 1, words._LOWER[part[np.maximum(ends - 2, 0)]], 0)
        held[3].append(_BY_ENDING[last * 256 + before])
        held[4] = held[4] + counts
    if held:
        yield closed(*held)


def contexts(h: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The hashed last word before each token."""
    one = np.empty_like(h)
    one[1:] = h[:-1]
    one[(np.cumsum(counts) - counts)] = _PAD
    return (words.mix(one + U(5)) & U(CONTEXTS - 1)).view(np.int64)


def features(h: np.ndarray, e: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``ACTIVE x tokens`` feature numbers from the tokens before each, none of them across a text's start."""
    first = np.cumsum(counts) - counts

    def back(x: np.ndarray, k: int, pad) -> np.ndarray:
        out = np.full_like(x, pad)
        out[k:] = x[:len(x) - k]
        for i in range(k):  # where a text ends before, this is the start of a later one
            out[(first + i)[first + i < len(x)]] = pad
        return out

    one, two = back(h, 1, _PAD), back(h, 2, _PAD)
    ends = (back(e, 1, 63) * 64 + back(e, 2, 63)) * 64 + back(e, 3, 63)
    raw = [one + U(1), two * U(3) + U(2), one * U(0x9E3779B97F4A7C15) + two * U(5) + U(3), ends.astype(U) * U(7) + U(4)]
    return np.stack([(words.mix(x) & U(FEATURES - 1)).view(np.int64) for x in raw])


_BITS = FEATURES.bit_length() - 1


def _codes(f: np.ndarray) -> np.ndarray:
    """The feature numbers of each token in one, the first feature's highest."""
    return ((f[0] << _BITS | f[1]) << _BITS | f[2]) << _BITS | f[3]


def _unpacked(codes: np.ndarray) -> np.ndarray:
    return np.stack([codes >> k * _BITS & FEATURES - 1 for k in (3, 2, 1, 0)])


@dataclass
class Model:
    """Weights, class bias, and what is known of the words."""
    weights: np.ndarray  # FEATURES x CLASSES, float32
    bias: np.ndarray  # CLASSES
    top: np.ndarray  # sorted hashes of frequent words
    top_count: np.ndarray
    own: np.ndarray  # sorted hashes of the words with a class of their own
    own_class: np.ndarray
    top_by: np.ndarray  # their counts by context, a row per word
    size: np.ndarray  # N_class + V_class + 1
    inside: np.ndarray  # CONTEXTS x CLASSES tokens
    n_tokens: int
    n_words: int

    def classes(self, h: np.ndarray, e: np.ndarray) -> np.ndarray:
        """Class numbers, from hashes and classes by ending."""
        if not len(self.own):
            return e
        at = np.minimum(np.searchsorted(self.own, h), len(self.own) - 1)
        return np.where(self.own[at] == h, self.own_class[at], e)

    def tables(self) -> tuple[np.ndarray, np.ndarray, bool]:
        """What the first feature (with the bias) and the others contribute per class, and whether as factors.

        Factors save the ``exp`` of each token.  No product of them can overflow below this bound of the logits' size;
        beyond it these are summands, whose largest sum is taken off."""
        factors = bool(ACTIVE * np.abs(self.weights).max(initial=0) + np.abs(self.bias).max(initial=0) < 80)
        first = self.weights + self.bias
        return (np.exp(first), np.exp(self.weights), True) if factors else (first, self.weights, False)

    def softmax(self, f: np.ndarray, tables: tuple[np.ndarray, np.ndarray, bool] | None = None,
                block: int = 1024) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        """``(tokens, exp(logits), their sums)`` in blocks that stay in the processor's cache; ``tables``: if at hand."""
        first, others, factors = tables or self.tables()
        z, more = np.empty((2, block, CLASSES), np.float32)
        ones = np.ones(CLASSES, np.float32)
        for at in range(0, f.shape[1], block):
            part = f[:, at:at + block]
            own, other = z[:part.shape[1]], more[:part.shape[1]]
            np.take(first, part[0], axis=0, out=own, mode="clip")
            for x in part[1:]:
                np.take(others, x, axis=0, out=other, mode="clip")
                if factors:
                    own *= other
                else:
                    own += other
            if not factors:
                own -= own.max(axis=1, keepdims=True)
                np.exp(own, out=own)
            yield slice(at, at + part.shape[1]), own, (own @ ones)[:, None]

    def chances(self, f: np.ndarray) -> np.ndarray:
        """``CLASSES x tokens``."""
        out = np.empty((CLASSES, f.shape[1]))
        for own, z, total in self.softmax(f):
            out[:, own] = (z / total).T
        return out

    def expect(self, codes: np.ndarray, due: np.ndarray, block: int = 1 << 16) -> None:
        """Adds the expected class counts of tokens with these packed features to ``due``, ``CLASSES x FEATURES``.

        Tokens of equal features have the same softmax, which is taken once.  In the order of their features' numbers
        tokens of ``NEAR`` neighbouring numbers follow each other; a product with the matrix that marks each one's number
        adds them up.
        """
        codes, times = np.unique(codes, return_counts=True)
        times = times.astype(np.float32)
        tables, sums = self.tables(), np.zeros((FEATURES, CLASSES))
        p = np.empty((min(block, len(codes)), CLASSES), np.float32)
        rows, marks, mark = np.empty((PIECE, CLASSES), np.float32), np.empty((PIECE, NEAR), np.float32), np.eye(NEAR, dtype=np.float32)
        for at in range(0, len(codes), block):
            f = _unpacked(codes[at:at + block])
            for own, z, total in self.softmax(f, tables):
                np.multiply(z, times[at:at + block][own, None] / total, out=p[own])
            x = f.astype(np.uint16).ravel()
            order = np.argsort(x, kind="stable")
            x, order = x[order], np.tile(np.arange(f.shape[1]), ACTIVE)[order]
            cuts, x = np.searchsorted(x, np.arange(0, FEATURES, NEAR, np.uint16)).tolist() + [len(x)], x & np.uint16(NEAR - 1)
            for i in range(FEATURES // NEAR):
                for a in range(cuts[i], cuts[i + 1], PIECE):
                    b = min(a + PIECE, cuts[i + 1])
                    sums[i * NEAR:i * NEAR + NEAR] += mark.take(x[a:b], 0, marks[:b - a], "clip").T @ p.take(
                        order[a:b], 0, rows[:b - a], "clip")
        due += sums.T

    def log_class(self, f: np.ndarray, c: np.ndarray, tables: tuple[np.ndarray, np.ndarray, bool] | None = None) -> np.ndarray:
        out = np.empty(len(c))
        tiny = np.finfo(np.float32).tiny
        for own, z, total in self.softmax(f, tables):
            mine = z[np.arange(len(z)), c[own]]
            out[own] = np.log(np.maximum(mine, tiny), dtype=np.float64) - np.log(total[:, 0], dtype=np.float64)
        return out


def held_out(id_col: str, parts: int = 7, part: int = 2) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % parts == part, F.lit(False))


def _reduced(h: np.ndarray, e: np.ndarray, b: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Equal ``(word, context)`` pairs added up, in order; ``n``: their counts, one each if not given.

    Without ``n`` words that differ only in the lowest bits may alternate, and then come with more than one count."""
    # the context in the lowest bits gives one quick sort instead of two stable ones
    order = np.argsort(h & ~U(CONTEXTS - 1) | b.astype(U)) if n is None else np.lexsort((b, h))
    h, e, b = h[order], e[order], b[order]
    first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (b[1:] != b[:-1])]))
    total = np.diff(np.append(first, len(h))) if n is None else np.add.reduceat(n[order], first)
    return h[first], e[first], b[first], total


def _counted(parts: int):
    """Counts of each batch's words by context, packed into one row per range of hashes (``SPLIT`` of them a part)."""
    ranges = parts * SPLIT

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            found = [(h, e, contexts(h, counts)) for _, _, h, e, counts in tokens(batch.column(0))]
            if not found:
                continue
            h, e, b, n = _reduced(*(np.concatenate(x) for x in zip(*found, strict=True)))
            at = (h >> U(40)) * U(ranges) >> U(24)  # hashes come in order, so their ranges do
            cuts = np.searchsorted(at, np.arange(ranges + 1).astype(U))
            have = np.flatnonzero(np.diff(cuts))
            packed = [[x[cuts[i]:cuts[i + 1]].tobytes() for i in have]
                      for x in (h, e.astype(np.uint8), b.astype(np.uint8), n.astype(np.int64))]
            yield pa.RecordBatch.from_arrays([pa.array(have), *[pa.array(x, pa.binary()) for x in packed]],
                                             names=["range", "words", "endings", "contexts", "counts"])

    return run


def _added_up(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one range after another: its words with their counts by context.  A task holds one range."""
    def words_of(held: list) -> pa.RecordBatch:
        h, e, b, n = _reduced(*(np.concatenate([np.frombuffer(r[i], t) for r in held])
                                for i, t in enumerate((U, np.uint8, np.uint8, np.int64))))
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        ends = pa.array(np.append(first, len(h)).astype(np.int32))
        return pa.RecordBatch.from_arrays(
            [pa.array(words.signed(h[first])), pa.array(np.minimum.reduceat(e, first).astype(np.int64)),
             pa.array(np.add.reduceat(n, first)), pa.MapArray.from_arrays(ends, pa.array(b.astype(np.int64)), pa.array(n))],
            names=["word", "ending", "n", "by"])

    last, held = None, []
    for batch in it:
        for i, at in enumerate(batch.column(0).to_pylist()):
            if at != last and held:
                yield words_of(held)
                held = []
            last = at
            held.append([batch.column(c)[i].as_py() for c in range(1, 5)])
    if held:
        yield words_of(held)


def _packed(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words with their counts by context as ``CONTEXTS`` numbers in one cell."""
    for batch in it:
        by = np.zeros((batch.num_rows, CONTEXTS), np.float32)
        lists = batch.column(3)
        for i, entry in enumerate(lists):
            for c, n in entry.as_py():
                by[i, c] = n
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([x.tobytes() for x in by], pa.binary())],
                                         names=["word", "ending", "n", "by"])


def _sums(model: Model, expected: bool, window: int = 1 << 20):
    """Observed or expected class counts per feature of a task's texts, in blocks of features.

    About ``window`` tokens are held at a time, so that the softmax of features that repeat there is taken once."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(0 if expected else FEATURES * CLASSES)
        due, held, classes = np.zeros((CLASSES, FEATURES) if expected else 0), [], []

        def add() -> None:
            codes = np.concatenate(held)
            if expected:
                model.expect(codes, due)
            else:
                c = np.concatenate(classes)
                for k in range(ACTIVE):
                    np.add(seen, np.bincount((codes >> k * _BITS & FEATURES - 1) * CLASSES + c, minlength=len(seen)), out=seen)
            held.clear()
            classes.clear()

        for batch in it:
            for _, _, h, e, counts in tokens(batch.column(0)):
                held.append(_codes(features(h, e, counts)))
                if not expected:
                    classes.append(model.classes(h, e))
                if sum(map(len, held)) >= window:
                    add()
        if held:
            add()
        total = (due.T if expected else seen.reshape(FEATURES, CLASSES)).astype(np.float32)
        for b in range(FEATURES // BLOCK):
            part = np.ascontiguousarray(total[b * BLOCK:(b + 1) * BLOCK])
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([b], pa.int64()), pa.array([part.tobytes()], pa.binary())],
                                                 names=["block", "sums"])

    return run


def _added(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the sums of each block; rows come sorted by block."""
    block, total = None, None
    for batch in it:
        for b, x in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            part = np.frombuffer(x.as_buffer(), np.float32).astype(np.float64)
            if b == block:
                total += part
            else:
                if block is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([total.tobytes()], pa.binary())],
                                                     names=["block", "sums"])
                block, total = b, part
    if block is not None:
        yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([total.tobytes()], pa.binary())],
                                         names=["block", "sums"])


def _gathered(texts: DataFrame, model: Model, expected: bool) -> np.ndarray:
    """``FEATURES x CLASSES`` sums over all texts, observed or expected."""
    n = FEATURES // BLOCK
    parts = texts.mapInArrow(_sums(model, expected), "block long, sums binary")
    rows = parts.repartition(n, "block").sortWithinPartitions("block").mapInArrow(_added, "block long, sums binary")
    out = np.zeros((FEATURES, CLASSES))
    for r in rows.toLocalIterator():  # FEATURES / BLOCK rows
        out[r["block"] * BLOCK:(r["block"] + 1) * BLOCK] = np.frombuffer(r["sums"]).reshape(BLOCK, CLASSES)
    return out


def train(docs: DataFrame, text_col: str, most: int = 1 << 16, rounds: int = 2,
          smooth: float = 100.0) -> tuple[Model, DataFrame]:
    """The model learnt from ``docs`` and the table ``(word, ending, n, by)`` of all its word counts, ``by`` context.

    ``most`` bounds the word counts that go to the tasks.  The first step and each of the ``rounds`` after it cover all
    texts.
    """
    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = texts.mapInArrow(_counted(parts), "range long, words binary, endings binary, contexts binary, counts binary")
    counts = reliable_checkpoint(counts.repartition(parts, "range").sortWithinPartitions("range").mapInArrow(
        _added_up, "word long, ending long, n long, by map<long,long>"))
    top = most_frequent(counts, most).mapInArrow(_packed, "word long, ending long, n long, by binary").collect()
    order = sorted(top, key=lambda r: (-r["n"], r["word"]))
    own = [r for r in order if r["ending"] != END][:OWN]
    size, inside = np.ones(CLASSES), np.zeros((CONTEXTS, CLASSES))
    for r in counts.groupBy("ending").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect():  # ENDINGS + 1
        size[r["ending"]] += r["n"] + r["v"]
    spread = counts.select("ending", F.explode("by").alias("context", "k"))
    for r in spread.groupBy("context", "ending").agg(F.sum("k").alias("k")).collect():  # CONTEXTS * (ENDINGS + 1)
        inside[r["context"], r["ending"]] = r["k"]
    n_tokens, n_words = (counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first())
    for i, r in enumerate(own):
        size[r["ending"]] -= r["n"] + 1
        size[1 + ENDINGS + i] += r["n"] + 1
        by = np.frombuffer(r["by"], np.float32)
        inside[:, r["ending"]] -= by
        inside[:, 1 + ENDINGS + i] = by
    by_hash = sorted((np.int64(r["word"]).view(U), r["n"], r["by"]) for r in top)
    own_hash = sorted((np.int64(r["word"]).view(U), 1 + ENDINGS + i) for i, r in enumerate(own))
    bias = np.log(np.maximum(size, 1) / np.maximum(size, 1).sum())
    model = Model(np.zeros((FEATURES, CLASSES), np.float32), bias.astype(np.float32),
                  np.array([h for h, _, _ in by_hash], U), np.array([n for _, n, _ in by_hash], np.int64),
                  np.array([h for h, _ in own_hash], U), np.array([c for _, c in own_hash], np.int64),
                  np.frombuffer(b"".join(by for _, _, by in by_hash), np.float32).reshape(-1, CONTEXTS),
                  size, inside, int(n_tokens), int(n_words))
    p = np.exp(bias)
    seen = _gathered(texts, model, False)
    for step in range(rounds + 1):
        due = _gathered(texts, model, True) if step else seen.sum(axis=1, keepdims=True) * p
        pace = (1 if step else 2) / ACTIVE
        model.weights += (pace * np.log((seen + smooth * p) / (due + smooth * p))).astype(np.float32)
    return model, counts


def _finder(top: np.ndarray, bits: int = 18):
    """``np.searchsorted(top, h)`` for well mixed hashes: starts at the first of equal leading bits."""
    starts = np.searchsorted(top, np.arange(1 << bits, dtype=U) << U(64 - bits))
    closed = np.append(top, ~U(0))

    def find(h: np.ndarray) -> np.ndarray:
        at = starts[h >> U(64 - bits)]
        more = np.flatnonzero(closed[at] < h)
        while len(more):
            at[more] += 1
            more = more[closed[at[more]] < h[more]]
        return at

    return find


def _scored(model: Model):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unseen = np.log10(INSIDE / model.size)  # a word without a count has this share, times INSIDE
        tables, find = model.tables(), _finder(model.top)
        for batch in it:
            for row, to, h, e, counts in tokens(batch.column(2)):
                c, b = model.classes(h, e), contexts(h, counts)
                value = model.log_class(features(h, e, counts), c, tables) / math.log(10) - np.log10(model.inside[b, c] + INSIDE)
                known, by = np.zeros(len(h), np.int64), np.zeros(len(h))
                if len(model.top):
                    at = np.minimum(find(h), len(model.top) - 1)
                    known = np.where(model.top[at] == h, model.top_count[at], 0)
                    by = model.top_by[at, b].astype(np.float64)
                rest, of = known == 0, np.repeat(np.arange(to - row), counts)
                value += np.where(rest, unseen[c], np.log10(by + INSIDE * (known + 1) / model.size[c]))
                first = np.cumsum(counts) - counts
                group = np.lexsort((b[rest], h[rest], of[rest]))
                w, o, k = h[rest][group], of[rest][group], b[rest][group]
                new = (w[1:] != w[:-1]) | (o[1:] != o[:-1]) | (k[1:] != k[:-1])
                start = np.flatnonzero(np.concatenate([[True], new])) if len(w) else np.zeros(0, int)
                times = np.diff(np.concatenate([start, [len(w)]]))
                ends = pa.array(np.searchsorted(o[start], np.arange(to - row + 1)).astype(np.int32))
                lists = [pa.array(words.signed(w[start])), pa.array(k[start].astype(np.int32)), pa.array(times.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, to - row), batch.column(1).slice(row, to - row), pa.array(counts),
                     pa.array(np.add.reduceat(value, first)),
                     pa.array(np.add.reduceat(np.where(rest, 0, np.log10(known + 1.0)), first)),
                     pa.array(np.add.reduceat((~rest).astype(np.int64), first)),
                     *[pa.ListArray.from_arrays(ends, x) for x in lists]],
                    names=["row", "doc_id", "n_tokens", "part", "counted", "known", "rare", "context", "times"])

    return run


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` of every document.

    Texts whose id has ``crc32 mod 7 = 2`` are scored but not learnt.  ``base_score`` is the add-one unigram score.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))
    model, counts = train(rows.filter(~held_out("doc_id")), "text")
    done = reliable_checkpoint(rows.mapInArrow(
        _scored(model), "row long, doc_id long, n_tokens long, part double, counted double, known long, "
                        "rare array<long>, context array<int>, times array<int>"))
    rare = done.select("row", F.explode(F.arrays_zip("rare", "context", "times")).alias("x")).select("row", "x.*")
    found = rare.join(counts, F.col("rare") == F.col("word"))
    # the rare word's share of its class in this context, over that of a word without a count
    size = F.element_at(F.array(*[F.lit(float(x)) for x in model.size[:ENDINGS + 1]]), (F.col("ending") + 1).cast("int"))
    by = F.coalesce(F.element_at("by", F.col("context").cast("long")), F.lit(0))
    gain = F.log10(by * size / F.lit(INSIDE) + F.col("n") + 1)
    found = reliable_checkpoint(found.groupBy(F.col("row").alias("row_")).agg(
        F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("more"), F.sum(F.col("times") * gain).alias("more_score"),
        F.sum("times").alias("more_known")))
    per = F.lit(math.log10(model.n_tokens + model.n_words + 1))
    counted = F.col("counted") + F.coalesce("more", F.lit(0.0))
    return done.drop("rare", "context", "times").join(found, F.col("row") == F.col("row_"), "left").select(
        "doc_id", held_out("doc_id").alias("held_out"), "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(model.n_tokens).cast("long").alias("train_tokens"),
        (counted - F.col("n_tokens") * per).alias("base_score"),
        (F.col("part") + F.coalesce("more_score", F.lit(0.0))).alias("score"))
