"""URL filter: rules first, then segmented host words judged by naive Bayes.

1. Rules ``(verdict, host, path)``: a rule fits its host and all subdomains if the url's path starts with the rule's;
   the longest fitting rule decides.
2. Host names are split into words by a unigram Viterbi search.  The unigram counts come from all pages' texts, with no
   bound on the words: the stretches of letters inside each distinct host are joined to the table of all counts, and every
   host is split by its own few words.  A stretch of unknown letters is charged by its length.
3. Multinomial naive Bayes over the host's words and the path's tokens, learnt from the pages that a rule decides,
   judges the pages that no rule fits.  Tokens are hashed into ``BUCKETS`` counters, summed per task before the shuffle;
   the driver gets at most that many rows.  Equal odds mean allow.

Nulls and odd inputs: a null url or one without ``://`` has an empty host and path, fits no rule and is judged by the
prior alone; null html has no words; repeated rows each get their verdict; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventspark.session import reliable_checkpoint

BUCKETS = 1 << 15
LONGEST = 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_RUN = re.compile(r"[a-z]+|[0-9]+")


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url column."""
    at = F.coalesce(F.locate("://", url), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits (the first listed of equally long ones), else null."""
    text = verdict = F
    for r in sorted(rules, key=lambda r: -len(r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        text, verdict = text.when(fits, F.lit(r.text)), verdict.when(fits, F.lit(r.verdict))
    if not rules:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return text, verdict


def unigrams(texts: DataFrame, column: str) -> DataFrame:
    """Counts ``(word, n)`` of all words (runs of a-z, 2 to 20 letters) of all texts."""
    words = texts.select(F.explode(F.split(F.translate(F.col(column), _UPPER, _LOWER), "[^a-z]+")).alias("word"))
    counts = words.filter(F.length("word").between(2, LONGEST)).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return reliable_checkpoint(counts)


class Segmenter:
    """Viterbi split of letter runs under a unigram model of ``total`` words (those of ``counts``, if not given)."""

    def __init__(self, counts: dict[str, int], total: int | None = None):
        total = (sum(counts.values()) if total is None else total) + 1
        self.cost = {w: -math.log(n / total) for w, n in counts.items()}
        self.unknown = math.log(total)

    def split(self, run: str) -> tuple[str, ...]:
        best, back = [0.0] + [math.inf] * len(run), [0] * (len(run) + 1)
        for end in range(1, len(run) + 1):
            for start in range(max(0, end - LONGEST), end):
                cost = self.cost.get(run[start:end])
                if cost is None:
                    cost = self.unknown + math.log(10) * (end - start)
                if best[start] + cost < best[end]:
                    best[end], back[end] = best[start] + cost, start
        out, at = [], len(run)
        while at:
            out.append(run[back[at]:at])
            at = back[at]
        return tuple(reversed(out))


def _stretches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(host, word)``: the distinct stretches of 2 to 20 letters of each host."""
    for batch in it:
        for host in batch.column(0).to_pylist():
            found = {run[i:j] for run in _RUN.findall(host) if run.isalpha()
                     for i in range(len(run)) for j in range(i + 2, min(i + LONGEST, len(run)) + 1)}
            yield pa.RecordBatch.from_arrays([pa.array([host] * len(found), pa.string()), pa.array(sorted(found), pa.string())],
                                             names=["host", "word"])


def _split(total: int):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            out = []
            for host, known in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                segmenter, words = Segmenter({x["word"]: x["n"] for x in known or ()}, total), []
                for r in _RUN.findall(host):
                    words += segmenter.split(r) if r.isalpha() else [f"#{len(r)}"]
                out.append(words)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.string()))], names=["host", "words"])

    return run


def host_words(hosts: DataFrame, counts: DataFrame) -> DataFrame:
    """``(host, words)`` of every distinct host; a run of digits counts by its length."""
    hosts = reliable_checkpoint(hosts.select("host").distinct())
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    known = hosts.mapInArrow(_stretches, "host string, word string").join(counts, "word")
    known = known.groupBy("host").agg(F.collect_list(F.struct("word", "n")).alias("known"))
    return reliable_checkpoint(hosts.join(known, "host", "left").select("host", "known")
                               .mapInArrow(_split(int(total)), "host string, words array<string>"))


def tokens(words: list[str], path: str) -> list[str]:
    """Words of the host's labels and tokens of the path; a run of digits counts by its length."""
    out = [f"h:{w}" for w in words]
    for run in _RUN.findall(path.lower()):
        out.append(f"p:{run}" if run.isalpha() else f"p:#{len(run)}")
    return out


def _buckets(words: list[str], path: str) -> list[int]:
    return [zlib.crc32(t.encode()) % BUCKETS for t in tokens(words, path)]


def _class_counts(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((2, BUCKETS + 1), np.int64)
    for batch in it:
        for words, path, verdict in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            row = total[int(verdict == "allow")]
            np.add.at(row, _buckets(words, path), 1)
            row[BUCKETS] += 1
    kind, bucket = np.nonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(bucket), pa.array(total[kind, bucket])],
                                     names=["kind", "bucket", "n"])


def _judged(weight: np.ndarray, prior: float):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            path, verdict, words = (batch.column(i).to_pylist() for i in (2, 4, 5))
            odds = [prior + float(weight[_buckets(w, p)].sum()) for w, p in zip(words, path, strict=True)]
            verdict = [v or ("allow" if o >= 0 else "block") for v, o in zip(verdict, odds, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(verdict, pa.string()), pa.array(odds)],
                                             names=["page_id", "host", "path", "rule", "verdict", "log_odds"])

    return run


def judge_urls(pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url", text_col: str = "html", train: Column | None = None) -> DataFrame:
    """``(page_id, host, path, rule, verdict, log_odds)`` of every page.

    ``train`` restricts the pages that the classifier learns from (all that a rule decides, if not given);
    ``log_odds`` is the classifier's view (positive: allow), given for all pages.
    """
    host, path = url_parts(F.col(url_col))
    parts = pages.select(F.col(id_col).cast("long").alias("page_id"), host.alias("host"), path.alias("path"),
                         (F.lit(True) if train is None else train).alias("learn"))
    text, verdict = rule_of(F.col("host"), F.col("path"), rules)
    parts = parts.withColumns({"rule": text, "verdict": verdict})
    parts = parts.join(host_words(parts, unigrams(pages, text_col)), "host")
    known = parts.filter("learn AND verdict IS NOT NULL").select("words", "path", "verdict")
    sums = known.mapInArrow(_class_counts, "kind long, bucket long, n long")
    table = np.zeros((2, BUCKETS + 1))
    for r in sums.groupBy("kind", "bucket").agg(F.sum("n").alias("n")).collect():  # at most 2 * (BUCKETS + 1) rows
        table[r["kind"], r["bucket"]] = r["n"]
    seen = (table[:, :BUCKETS].sum(axis=0) > 0).sum() + 1  # token kinds met, and one for all others
    tenth = 0.1  # of a count is added to each kind, so rare kinds of a small class still tell
    share = np.log(table[:, :BUCKETS] + tenth) - np.log(table[:, :BUCKETS].sum(axis=1, keepdims=True) + tenth * seen)
    prior = math.log(table[1, BUCKETS] + 1) - math.log(table[0, BUCKETS] + 1)
    return parts.select("page_id", "host", "path", "rule", "verdict", "words").mapInArrow(
        _judged(share[1] - share[0], prior),
        "page_id long, host string, path string, rule string, verdict string, log_odds double")
