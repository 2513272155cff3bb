"""Min-max near-duplicates against brute force over word-shingle sets."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from eventspark.llm import words
from eventspark.llm.components import connected_components
from eventspark.llm.minmax_dedup import near_duplicates, signatures

SF01 = "/root/testdata/sf0.01"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def plain_set(text, width=5):
    w = plain_words(text)
    return {tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def brute(rows, percent=85):
    sets = [(d, plain_set(t)) for d, t in rows]
    root = {d: d for d, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            both = len(x & y)
            if both and 100 * both >= percent * len(x | y):
                lo, hi = sorted((find(a), find(b)))
                root[hi] = lo
    return sorted((d, len(s), find(d), find(d) == d) for d, s in sets)


def result(df):
    return sorted(tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect())


@pytest.mark.parametrize("limit", [16, 64, 1 << 21])
def test_words_and_shingles_match_plain(limit):
    texts = ["The cat,\tthe CAT", None, "", "  \n\x0b ", "Éa éA x", "one", "a b c d e f a b c d e", "x" * 300 + " y", "q\x1cr\xa0s t"]
    names = {}
    for first, to, h, counts in words.batches(pa.array(texts), limit):
        at = 0
        for r in range(first, to):
            w = plain_words(texts[r])
            assert counts[r - first] == len(w)
            for x in w:
                assert names.setdefault(x, h[at]) == h[at]
                at += 1
        s, per = words.shingles(h, counts)
        at = np.concatenate([[0], np.cumsum(per)])
        for r in range(first, to):
            assert len(np.unique(s[at[r - first]:at[r - first + 1]])) == len(plain_set(texts[r]))
    assert len(set(names.values())) == len(names)


def test_signature_values_estimate_similarity():
    rng = np.random.default_rng(3)
    pool = words.mix(rng.integers(0, 1 << 63, 1500, dtype=np.uint64))
    a, b = pool[:1000], pool[200:1200]  # 800 of 1200 shared
    sig = signatures(np.concatenate([a, b]), np.array([1000, 1000]), 500)
    assert abs((sig[0, :500] == sig[1, :500]).mean() - 2 / 3) < 0.08
    assert abs((sig[0, 500:] == sig[1, 500:]).mean() - 2 / 3) < 0.08


def test_components(spark):
    links = [(9, 8), (8, 7), (7, 6), (6, 1), (20, 21), (21, 22), (22, 20), (5, 5), (None, 3)]
    got = connected_components(spark.createDataFrame(links, "u long, v long"))
    assert dict(got.collect()) == {1: 1, 6: 1, 7: 1, 8: 1, 9: 1, 20: 20, 21: 20, 22: 20}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_components_of_a_long_path(spark):
    ids = np.random.default_rng(2).permutation(100_000).tolist()
    links = spark.createDataFrame(list(zip(ids, ids[1:], strict=False)), "u long, v long")
    got = connected_components(links)
    assert got.count() == 100_000 and got.filter("component <> 0").count() == 0


def test_edges_and_chains(spark):
    rng = random.Random(1)
    vocab = [f"w{i}" for i in range(500)]
    base = [rng.choice(vocab) for _ in range(200)]
    rows, at = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "ONE  two"), (6, "one two three")], 10
    chain = list(base)
    for i in range(60):  # a chain whose ends differ, neighbours close
        chain = list(chain)
        chain[(3 * i) % 200] = f"z{i}"
        rows.append((at, " ".join(chain)))
        at += 1
    for _ in range(40):
        rows.append((at, " ".join(base).upper() if at % 2 else " ".join(base)))
        at += 1
    for _ in range(40):  # a shared passage in otherwise different texts
        rows.append((at, " ".join(base[:120] + [rng.choice(vocab) for _ in range(rng.randrange(10, 150))])))
        at += 1
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("digest", F.lit("clash"))
    assert result(near_duplicates(df, block=16)) == brute(rows)
    assert result(near_duplicates(df.limit(0))) == []
    some = spark.createDataFrame([(None, "a b"), (3, "a b"), (3, "a b")], "doc_id long, text string")
    assert [tuple(r)[1:] for r in near_duplicates(some).orderBy("doc_id").collect()] == [(1, None, False), (1, 3, True), (1, 3, True)]


def test_documents_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    assert result(near_duplicates(docs)) == brute([tuple(r) for r in docs.select("doc_id", "text").collect()])
