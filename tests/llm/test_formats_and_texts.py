"""Chat, personal data, urls, quality, mixing, packing, language model: oracles, brute force and odd inputs."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SF01, SF001
from eventspark.llm import chat, maxent_lm, queries, words
from eventspark.llm.maxent_lm import score_texts
from eventspark.llm.mixing import Target, mix_sources
from eventspark.llm.packing import encoder, nnls, pack, plan, slots
from eventspark.llm.personal_data import base_spans, find_spans, masked, personal_data
from eventspark.llm.quality_knn import quality_scores, term_counts, train
from eventspark.llm.url_filter import Rule, Segmenter, host_words, judge_urls, unigrams
from oracle_check import duck, frame_digest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_oracle(spark, name):
    got = frame_digest(queries.QUERIES[name](spark, SF01).toPandas())
    want = frame_digest(duck(SF01).execute(queries.ORACLE[name]).df())
    assert got[:3] == want[:3]


def test_chat_round_trip(spark):
    rng = random.Random(4)
    bits = ["### ", "</turn>", "\\", ":\n", "\n", "<", "#", "é", "a", "</turn>\n", "### assistant:\n", ""]
    rows, want = [], {}
    for c in range(120):
        turns = [(rng.choice(["user", "assistant", "system", "odd:\nrole", None]),
                  None if rng.random() < 0.1 else "".join(rng.choices(bits, k=rng.randrange(8)))) for _ in range(rng.randrange(1, 6))]
        rows += [(c, i, r, t, "x") for i, (r, t) in enumerate(turns)]
        want[c] = [(r or "", t or "") for r, t in turns]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    out = chat.read_back(chat.format_chat(chat.canonical_turns(chat.conversation_records(df))))
    for r in out.collect():
        turns = want[r["conv_id"]]
        assert [tuple(t) for t in r["read_turns"]] == turns
        assert r["loss_text"] == "".join(t for role, t in turns if role == "assistant")
        spans = [r["formatted"][s["start"]:s["end"]] for s in r["loss_spans"] if s]
        assert len(spans) == sum(role == "assistant" for role, _ in turns)
    assert chat.chat_digest(chat.format_chat(chat.canonical_turns(chat.conversation_records(df.limit(0))))).count() == 0


def test_chat_layouts(spark):
    rows = ['{"id": 1, "record": {"instruction": "i", "input": "x", "output": "o"}}',
            '{"id": 2, "record": {"question": "q", "answer": {"text": "a"}}}',
            '{"id": 3, "record": {"conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}]}}',
            '{"id": 4, "record": {"messages": [{"content": "only"}]}}', '{"id": 5, "record": {"question": "alone"}}',
            '{"id": 6, "record": null}']
    df = spark.read.json(spark.createDataFrame([(r,) for r in rows], "value string").select("value").rdd.map(lambda r: r[0]))
    got = {r["id"]: (r["layout"], r["turns"] and [tuple(t) for t in r["turns"]]) for r in chat.canonical_turns(df).collect()}
    assert got[1] == ("instruction", [("user", "i"), ("user", "x"), ("assistant", "o")])
    assert got[2] == ("question", [("user", "q"), ("assistant", "a")])
    assert got[3] == ("share", [("user", "h"), ("assistant", "g")])
    assert got[4] == ("messages", [("", "only")])
    assert got[5] == got[6] == (None, None)


def plain_base(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        if 14 <= len(d) <= 19 and sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(reversed(d))) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out)


def test_base_spans_match_plain_patterns():
    rng = random.Random(8)
    bits = ["a", "b_", "@", ".", "-", "1", "255", "256", "0", " ", "+1", "(", ")", "4111 1111 1111 1111", "x@y.z", "é", "12.3.4.5", "+"]
    for _ in range(6000):
        text = "".join(rng.choices(bits, k=rng.randrange(14)))
        assert base_spans(text) == plain_base(text), text
    for text in ("1" * 300_000, "a" * 300_000 + " @", "a@" * 100_000, "1." * 100_000, "+1(" * 100_000, "@" * 100_000):
        base_spans(text)  # linear, so quick


def test_disguises_map_back():
    for text, kind, part in [
            ("write to joe [at] mail (dot) example [dot] com now", "email", "joe [at] mail (dot) example [dot] com"),
            ("mail joe at mail dot example dot com please", "email", "joe at mail dot example dot com"),
            ("ask joe_b_at_mail_dot_example_dot_com or", "email", "joe_b_at_mail_dot_example_dot_com"),
            ("ask joe&#64;mail&period;com or", "email", "joe&#64;mail&period;com"),
            ("to=joe%40mail.com&x", "email", "joe%40mail.com"),
            ("host one zero dot one two dot zero dot five up", "ip", "one zero dot one two dot zero dot five"),
            ("see jоe@mаil.example.com ok", "email", "jоe@mаil.example.com"),
            ("ip １０.0.0.1 here", "ip", "１０.0.0.1"), ("ip 10 dot 0 dot 0 dot 1 here", "ip", "10 dot 0 dot 0 dot 1"),
            ("call plus one two one two five five five zero one two three now", "phone",
             "plus one two one two five five five zero one two three"),
            ("a j​oe@mail.example.com", "email", "j​oe@mail.example.com")]:
        found = [(k, text[s:e]) for k, s, e, base in find_spans(text) if not base]
        assert (kind, part) in found, (text, found)
    for clean in ("meet at the dot", "one two three men at sea", "the plus one", "we met at noon. dot com boom",
                  "see us at example.com", "a five-at-ten b", None, ""):
        assert find_spans(clean) == []
    for text in ("one dot " * 100_000, "nine nine nine dot " * 50_000, "a at b dot " * 50_000, "x-at-y-dot-" * 50_000):
        find_spans(text)  # linear, so quick
    assert masked("a x@y.zz b") == "a [EMAIL] b" and masked(None) is None


def test_mixed_disguises():
    for part in ("joe [at] mail dot com", "joe at mail [dot] com", "joe@mail dot com", "joe at mail&period;com", "joe&#64;mail dot com",
                 "joe at mail dot example [dot] com", "joe (at) mail dot example.com", "joe_b [at] mail_dot_com", "joe_at_mail [dot] com",
                 "joe at mail_dot_com", "joe@mail_dot_com", "joe_at_mail dot com"):
        text = f"write to {part}, or call"
        assert ("email", text.index(part), text.index(part) + len(part)) in [x[:3] for x in find_spans(text)], part
        assert part not in masked(text)
    for clean in ("see us at example.com", "we met at noon [dot] com", "look at this. dot com", "@ noon dot"):
        assert all(k != "email" or "noon" in clean for k, *_ in find_spans(clean)), clean
    for text in ("a@b dot " * 50_000, "a at b[dot]" * 50_000, "a@" * 100_000 + " dot x"):
        find_spans(text)  # linear, so quick


def test_spelled_digits_among_numerals():
    part = "plus four nine 30 one two 34 five six 78"
    for text in (f"call {part} now", f"call {part} now, \u0430"):
        assert [(k, text[s:e]) for k, s, e, _ in find_spans(text)] == [("phone", part)]
    find_spans("nine 5 " * 100_000)  # linear, so quick


def test_personal_data_rows(spark):
    texts = {1: "mail a.b@c.de and +1 (988) 555-2485", 2: None, 3: "", 4: "joe [at] mail [dot] com"}
    df = spark.createDataFrame([(k, t, "z") for k, t in texts.items()], "doc_id long, text string, spans string")
    for r in personal_data(df).collect():
        base = ",".join(f"{('email', 'ip', 'card', 'phone')[k]}:{s}:{e}" for s, k, e in plain_base(texts[r["doc_id"]] or ""))
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert (r["n_email"], r["n_phone"], r["n_added"]) == ((1, 1, 0) if r["doc_id"] == 1 else (0, 0, int(r["doc_id"] == 4)))
    assert personal_data(df.limit(0)).count() == 0


def test_urls(spark):
    seg = Segmenter({"red": 50, "shop": 40, "reds": 1, "hop": 2})
    assert seg.split("redshop") == ("red", "shop")
    urls = ["http://A.Org/x", "https://example.org/es/1?q", "http://www.example.org/en/12#t", "http://x.com/fr/", "http://x.com/de/9",
            "http://x.org", "nourl", None, "http://notexample.org/es/1", "http://shop.net/fr/1"]
    df = spark.createDataFrame([(i, u, "red shop", "q") for i, u in enumerate(urls)], "page_id long, url string, html string, host string")
    got = {r["page_id"]: tuple(r)[1:5] for r in judge_urls(df, queries.URL_RULES).collect()}
    assert got[0] == ("a.org", "/x", "org/", "allow")
    assert got[1] == ("example.org", "/es/1", "example.org/es/", "block")
    assert got[2] == ("www.example.org", "/en/12", "example.org/en/1", "block")
    assert got[3][2:] == ("com/fr/", "allow") and got[4][2:] == ("com/de/", "block")
    assert got[5][:3] == ("x.org", "", None) and got[6][:3] == got[7][:3] == ("", "", None)
    assert got[8][2:] == ("org/", "allow") and got[9][2] is None and got[9][3] in ("allow", "block")
    pages = spark.read.parquet(f"{SF01}/pages.parquet")
    learn = F.col("page_id") % 2 == 0
    rows = judge_urls(pages.withColumn("page_id", F.col("page_id")), (Rule("allow", "org", "/"), Rule("block", "net", "/")), train=learn)
    right = rows.filter("page_id % 2 = 1 AND rule IS NOT NULL").select((F.col("log_odds") >= 0) == (F.col("verdict") == "allow"))
    assert np.mean([r[0] for r in right.collect()]) > 0.9  # held out
    assert judge_urls(df.limit(0), queries.URL_RULES).count() == 0


def test_quality(spark):
    rows = queries.op9_quality_knn(spark, SF01).join(spark.read.parquet(f"{SF01}/labels.parquet"), "doc_id")
    right = [r["predicted"] == r["quality"] for r in rows.filter("held_out").collect()]
    assert len(right) > 50 and np.mean(right) > 0.95
    docs = spark.createDataFrame([(1, None, "z"), (2, "", "z"), (2, "", "z")], "doc_id long, text string, score string")
    none = spark.createDataFrame([(1, None), (9, 1)], "doc_id long, quality int")
    assert [r["score"] for r in quality_scores(docs, train(docs, none)).collect()] == [0.5] * 3
    assert quality_scores(docs.limit(0), train(docs.limit(0), none)).count() == 0


def test_vote_matches_brute_force(spark):
    """Every document's neighbours by one cosine at a time, and their weighted labels added up one by one."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{SF001}/labels.parquet"))
    got = {r["doc_id"]: r["score"] for r in quality_scores(docs, model).collect()}
    unit = model.vectors.astype(float)
    for r in docs.collect():
        own = model.latent(term_counts(pa.array([r["text"]])))[0].astype(float)
        cosines = sorted(((float(sum(a * b for a, b in zip(own, v, strict=True))), int(y))
                          for v, y in zip(unit, model.labels, strict=True)), reverse=True)[:model.neighbours]
        mass = sum(max(c, 0) ** model.power for c, _ in cosines)
        want = sum(max(c, 0) ** model.power * y for c, y in cosines) / mass if mass else model.labels.mean()
        assert math.isclose(got[r["doc_id"]], want, abs_tol=2e-3)  # single precision, ties at the last neighbour


def test_segments_match_all_splits():
    rng = random.Random(3)
    for _ in range(200):
        counts = {"".join(rng.choices("ab", k=rng.randrange(2, 5))): rng.randrange(1, 50) for _ in range(6)}
        run = "".join(rng.choices("abc", k=rng.randrange(1, 10)))
        total = sum(counts.values()) + 1

        def cost(words, counts=counts, total=total):
            return sum(-math.log(counts[w] / total) if w in counts else math.log(total) + math.log(10) * len(w) for w in words)
        cuts = [[run[a:b] for a, b in zip([0, *at], [*at, len(run)], strict=True)]
                for k in range(len(run)) for at in itertools.combinations(range(1, len(run)), k)]
        assert math.isclose(cost(Segmenter(counts).split(run)), min(map(cost, cuts)))


def test_url_verdicts_match_brute_force(spark):
    """Naive Bayes over plain counters: the log odds of every page."""
    pages = spark.read.parquet(f"{SF001}/pages.parquet")
    rows = {r["page_id"]: r for r in judge_urls(pages, queries.URL_RULES).collect()}
    word = collections.Counter(w for r in pages.collect() for w in re.findall("[a-z]+", (r["html"] or "").translate(
        str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))) if 2 <= len(w) <= 20)
    seg = Segmenter(word)
    bag = {}
    for i, r in rows.items():
        own = [w for run in re.findall("[a-z]+|[0-9]+", r["host"]) for w in (seg.split(run) if run.isalpha() else [f"#{len(run)}"])]
        own = [f"h:{w}" for w in own] + [f"p:{x}" if x.isalpha() else f"p:#{len(x)}" for x in re.findall("[a-z]+|[0-9]+", r["path"].lower())]
        bag[i] = [zlib.crc32(t.encode()) % (1 << 15) for t in own]
    seen = {v: collections.Counter(b for i, r in rows.items() if r["rule"] and r["verdict"] == v for b in bag[i]) for v in ("allow", "block")}
    number = {v: sum(bool(r["rule"]) and r["verdict"] == v for r in rows.values()) for v in seen}
    kinds = len(set(seen["allow"]) | set(seen["block"])) + 1

    def share(v, b):
        return math.log((seen[v][b] + 0.1) / (sum(seen[v].values()) + 0.1 * kinds))
    for i, r in rows.items():
        odds = math.log((number["allow"] + 1) / (number["block"] + 1)) + sum(share("allow", b) - share("block", b) for b in bag[i])
        assert math.isclose(r["log_odds"], odds, rel_tol=1e-6, abs_tol=1e-6)
        assert r["rule"] or r["verdict"] == ("allow" if r["log_odds"] >= 0 else "block")


def test_ids_of_all_documents_match_the_library(spark):
    slow = Tokenizer.from_file(queries.VOCABULARY)
    slow.encode_special_tokens = True
    fast = encoder(queries.VOCABULARY, queries.RANKS, public_tokenizers.PATTERN)
    texts = [r["text"] or "" for r in spark.read.parquet(f"{SF01}/documents.parquet").select("text").collect()]
    for text, want in zip(texts, slow.encode_batch(texts, add_special_tokens=False), strict=True):
        assert fast(text).tolist() == want.ids


def test_mixing_reaches_targets(spark):
    rng = random.Random(2)
    rows = [(i, "w " * rng.randrange(1, 60), rng.choice(["en", "en", "en", "de", None]), f"s{min(rng.randrange(6), 3)}", 0) for i in range(4000)]
    df = spark.createDataFrame([*rows, (None, None, None, None, None)], DOCS)
    targets = {"source": Target(temper=0.5), "lang": Target({"en": 1, "de": 1}, other=0.5), "topic": Target()}
    out = mix_sources(df, targets, keep=0.3, rounds=8).toPandas()
    assert len(out) == 4001
    for part, share in (("en", 0.4), ("de", 0.4)):
        got = (out.mix_tokens * out.mix_p)[out.lang == part].sum() / (out.mix_tokens * out.mix_p).sum()
        assert abs(got - share) < 0.02
    assert abs((out.mix_tokens * out.mix_sampled).sum() / out.mix_tokens.sum() - 0.3) < 0.03
    assert mix_sources(df.limit(0), targets).count() == 0


def test_mixing_keeps_clashing_columns(spark):
    rows = [(i, "a b c " * (i % 5), ["en", "de", None][i % 3], "s", 7, f"x{i}", "y", "z", {"k": i}) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, cell_lang string, "
                                     "mix_lang string, mix_p string, tokens map<string,int>")
    out = mix_sources(df, {"source": Target(), "lang": Target(temper=0.0), "topic": Target()}, keep=0.5)
    got = {r["doc_id"]: r for r in out.collect()}
    assert len(got) == 30 and dict(out.dtypes)["mix_p"] == "double"
    assert all(r["cell_lang"] == f"x{i}" and r["mix_lang"] == "y" and r["tokens"] == {"k": i} for i, r in got.items())
    assert mix_sources(df.limit(0), {"source": Target(), "topic": Target()}).count() == 0


def test_packing(spark):
    rng = np.random.default_rng(1)
    for n in (0, 1, 7, 3000):
        hist = np.bincount(rng.integers(1, 65, n), minlength=65)
        made = np.zeros(65, int)
        for uses, times in plan(hist):
            assert sum(k * m for k, m in uses) <= 64
            for k, m in uses:
                made[k] += m * times
        assert (made == hist).all() and slots(plan(hist))["n"].sum() <= hist.sum()
    assert np.allclose(nnls([(1, 3), (2, 2)], np.array([0, 5, 4, 5, 0])), [5, 2], atol=0.1)
    slow = Tokenizer.from_file(queries.VOCABULARY)
    slow.encode_special_tokens = True
    fast = encoder(queries.VOCABULARY, queries.RANKS, public_tokenizers.PATTERN)
    texts = {1: None, 2: "", 3: "héllo <|endoftext|> 日本 \n\n x", 4: "word " * 5000, 5: "a", 6: " " * 400_000}
    plain = {k: np.array([*slow.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for k, t in texts.items()}
    df = spark.createDataFrame([(k, t, 1) for k, t in texts.items()], "doc_id long, text string, length int")
    rows = pack(df, queries.VOCABULARY, queries.RANKS, public_tokenizers.PATTERN).collect()
    by = collections.defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
        ids = plain[r["doc_id"]]
        assert r["doc_tokens"] == len(ids)
        assert r["ids_crc32"] == zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes())
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    assert sum(r["length"] for r in rows) == sum({r["doc_id"]: r["doc_tokens"] for r in rows}.values())
    assert (fast("x y") == np.array(slow.encode("x y").ids)).all()
    assert pack(df.limit(0), queries.VOCABULARY, queries.RANKS, public_tokenizers.PATTERN).count() == 0


def test_language_model(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    odd = spark.createDataFrame([(-1, None), (-2, "  "), (-2, "  "), (-3, "the " * 30000)], "doc_id long, text string")
    rows = docs.select("doc_id", "text").union(odd).collect()
    got = score_texts(docs.select("doc_id", "text").union(odd)).toPandas().sort_values(["doc_id", "n_tokens"])
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = {(r["doc_id"]): [*re.findall(r"[^\x20\x09-\x0D]+", (r["text"] or "").translate(lower)), "\0"] for r in rows}
    count = collections.Counter()
    for r in rows:
        if zlib.crc32(str(r["doc_id"]).encode()) % 7 != 2:
            count.update(words[r["doc_id"]])
    n, v = sum(count.values()), len(count)
    for r in got.itertuples():
        w = words[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(count[x] > 0 for x in w), n)
        assert math.isclose(r.base_score, sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w), rel_tol=1e-9)
    held = got[got.held_out]
    assert held.score.sum() / held.n_tokens.sum() > held.base_score.sum() / held.n_tokens.sum() + 0.05
    assert score_texts(odd.limit(0)).count() == 0


@pytest.mark.parametrize("most", [1 << 16, 40])
def test_language_model_is_a_whole_distribution(spark, monkeypatch, most):
    """Twenty texts, scored by a dense softmax over classes and words; every context's chances add up to one."""
    rng = random.Random(9)
    pool = ["alpha", "beta", "gamma", "delta", "of", "the", *[f"w{i}" for i in range(60)]]
    rows = [(i, " ".join(rng.choices(pool, k=rng.randrange(0, 40)))) for i in range(20)]
    kept = {}
    trained = maxent_lm.train

    def noted(docs, text_col):
        kept["model"], kept["counts"] = trained(docs, text_col, most=most)
        return kept["model"], kept["counts"]

    monkeypatch.setattr(maxent_lm, "train", noted)
    got = {r["doc_id"]: r["score"] for r in score_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    model = kept["model"]
    assert len(model.top) <= most

    def cut(text):
        _, _, h, e, n = next(maxent_lm.tokens(pa.array([text])))
        return h, model.classes(h, e), maxent_lm.contexts(h, n), model.chances(maxent_lm.features(h, e, n))
    train = [cut(t) for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    unigram, pair, kind = collections.Counter(), collections.Counter(), {}
    for h, c, b, _ in train:
        for w, x, y in zip(h.tolist(), c.tolist(), b.tolist(), strict=True):
            unigram[w] += 1
            pair[w, y] += 1
            kind[w] = x
    members = {x: [w for w in kind if kind[w] == x] for x in range(maxent_lm.CLASSES)}

    def inside(w, x, b):
        """The softmax over the class's words and its one unseen word, of weights on their shares."""
        total = sum(unigram[v] + 1 for v in members[x]) + 1
        here = sum(pair[v, b] for v in members[x])
        def up(v):
            share = (unigram[v] + 1) / total
            weight = math.log((pair[v, b] + maxent_lm.INSIDE * share) / (here * share + maxent_lm.INSIDE * share))
            return share * math.exp(weight)
        return up(w) / sum(up(v) for v in [*members[x], "unseen"])

    for i, text in rows:
        h, c, b, chances = cut(text)
        want = sum(math.log10(chances[x, k]) + math.log10(inside(w, x, y))
                   for k, (w, x, y) in enumerate(zip(h.tolist(), c.tolist(), b.tolist(), strict=True)))
        assert math.isclose(got[i], want, rel_tol=1e-4)
        for k in range(len(h)):
            whole = sum(chances[x, k] * sum(inside(w, x, b[k]) for w in [*members[x], "unseen"]) for x in range(maxent_lm.CLASSES))
            assert math.isclose(whole, 1, rel_tol=1e-4)


def test_expected_counts_of_repeated_features():
    rng = np.random.default_rng(3)
    model = maxent_lm.Model(rng.normal(size=(maxent_lm.FEATURES, maxent_lm.CLASSES)).astype(np.float32),
                            rng.normal(size=maxent_lm.CLASSES).astype(np.float32), *[None] * 9)
    f = rng.integers(0, maxent_lm.FEATURES, (maxent_lm.ACTIVE, 700))[:, rng.integers(0, 700, 5000)]
    f[0, :3000] = 5  # one first feature on both sides of a block's border
    assert (maxent_lm._unpacked(maxent_lm._codes(f)) == f).all()
    due, want = np.zeros((2, maxent_lm.CLASSES, maxent_lm.FEATURES))
    model.expect(maxent_lm._codes(f), due, block=256)
    for x in f:
        for c, p in enumerate(model.chances(f)):
            want[c] += np.bincount(x, p, maxent_lm.FEATURES)
    assert np.allclose(due, want, rtol=1e-4, atol=1e-6) and math.isclose(due.sum(), f.size, rel_tol=1e-5)


def _random_model(rng, size=1.0):
    return maxent_lm.Model((size * rng.normal(size=(maxent_lm.FEATURES, maxent_lm.CLASSES))).astype(np.float32),
                           rng.normal(size=maxent_lm.CLASSES).astype(np.float32), *[None] * 9)


def test_softmax_takes_no_exponential_per_token(monkeypatch):
    rng = np.random.default_rng(5)
    model, taken, exp = _random_model(rng), [], np.exp

    def noted(x, *args, **kw):
        taken.append(np.size(x))
        return exp(x, *args, **kw)

    monkeypatch.setattr(np, "exp", noted)
    codes = maxent_lm._codes(rng.integers(0, maxent_lm.FEATURES, (maxent_lm.ACTIVE, 100_000)))
    model.expect(codes, due := np.zeros((maxent_lm.CLASSES, maxent_lm.FEATURES)))
    assert math.isclose(due.sum(), codes.size * maxent_lm.ACTIVE, rel_tol=1e-5)
    assert sum(taken) <= 2 * model.weights.size < codes.size * maxent_lm.CLASSES / 3


@pytest.mark.parametrize("size", [1.0, 60.0])
def test_softmax_of_small_and_large_weights(size):
    rng = np.random.default_rng(6)
    model = _random_model(rng, size)
    assert model.tables()[2] == (size == 1.0)
    f = rng.integers(0, maxent_lm.FEATURES, (maxent_lm.ACTIVE, 3000))
    z = model.weights.astype(np.float64)[f].sum(axis=0) + model.bias
    z -= z.max(axis=1, keepdims=True)
    want = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
    assert np.allclose(model.chances(f), want.T, rtol=1e-3, atol=1e-6)
    mine = want[np.arange(3000), want.argmax(axis=1)]
    assert np.allclose(model.log_class(f, want.argmax(axis=1)), np.log(mine), rtol=1e-3, atol=1e-5)


def test_expected_counts_of_a_frequent_feature():
    """More tokens of one feature than a product takes, in several blocks, beside single ones."""
    rng = np.random.default_rng(7)
    model = _random_model(rng)
    f = rng.integers(0, maxent_lm.FEATURES, (maxent_lm.ACTIVE, 9000))
    f[1, :7000], f[3, 100:], f[2, 0] = 16, maxent_lm.FEATURES - 1, 0
    model.expect(maxent_lm._codes(f), due := np.zeros((maxent_lm.CLASSES, maxent_lm.FEATURES)), block=4096)
    p = model.chances(f)
    want = [sum(np.bincount(x, p[c], maxent_lm.FEATURES) for x in f) for c in range(maxent_lm.CLASSES)]
    assert np.allclose(due, want, rtol=1e-4, atol=1e-6)


def test_words_are_found_by_their_leading_bits():
    rng = np.random.default_rng(8)
    most, top = np.uint64(2**64 - 1), rng.integers(0, 2**64, 3000, np.uint64)
    top = np.unique(np.concatenate([top, top[:50] + np.arange(50, dtype=np.uint64)]))
    for known in (top, np.append(top, most), top[:0], top[:1]):
        h = np.concatenate([known, known + np.uint64(1), rng.integers(0, 2**64, 5000, np.uint64), [np.uint64(0), most]])
        assert (maxent_lm._finder(known)(h) == np.searchsorted(known, h)).all()


def test_words_of_all_bytes():
    raw = np.random.default_rng(11).permutation(np.tile(np.arange(256, dtype=np.uint8), 8))
    starts, ends = words.word_spans(raw, np.array([0, 700]))
    want = [(k + m.start(), k + m.end()) for k, part in ((0, raw[:700]), (700, raw[700:]))
            for m in re.finditer(rb"[^\x20\x09-\x0D]+", part.tobytes())]
    assert list(zip(starts.tolist(), ends.tolist(), strict=True)) == want
    lower = np.frombuffer(raw.tobytes().lower(), np.uint8)
    assert (words.hash_spans(raw, starts, ends) == words.hash_spans(lower, starts, ends)).all()
    assert len(set(words.hash_spans(np.arange(256, dtype=np.uint8), np.arange(256), np.arange(256) + 1).tolist())) == 256 - 26


def test_tokens_do_not_depend_on_where_chunks_end():
    rng = random.Random(10)
    texts = [" ".join(rng.choices(["Aa", "b", "ccc\n", "d\u00e9"], k=k)) for k in (0, 5, 150_000, 3, 40_000, 60_000)]
    got = [x for part in maxent_lm.tokens(pa.array([*texts, None])) for x in part[4].tolist()]
    assert got == [len(re.findall(r"[^\x20\x09-\x0D]+", t)) + 1 for t in texts] + [1]
    h = np.concatenate([part[2] for part in maxent_lm.tokens(pa.array([*texts, None]))])
    assert (h == np.concatenate([part[2] for t in [*texts, None] for part in maxent_lm.tokens(pa.array([t], pa.string()))])).all()


def test_counts_of_words_that_differ_in_low_bits():
    rng = np.random.default_rng(4)
    h = (rng.integers(0, 5, 3000).astype(np.uint64) << np.uint64(40)) + rng.integers(0, 3, 3000).astype(np.uint64)
    b, e = rng.integers(0, maxent_lm.CONTEXTS, 3000), (h % np.uint64(7)).astype(np.int64)
    parts = maxent_lm._reduced(h, e, b)
    assert (np.diff(parts[0] >> np.uint64(40)).astype(np.int64) >= 0).all()
    whole = maxent_lm._reduced(*parts)
    want = collections.Counter(zip(h.tolist(), b.tolist(), strict=True))
    assert {(w, k): n for w, k, n in zip(whole[0].tolist(), whole[2].tolist(), whole[3].tolist(), strict=True)} == want
    assert len(whole[0]) == len(want)


def test_language_model_rounds_cover_all_texts(spark, monkeypatch):
    docs, summed, gathered = spark.range(60).selectExpr("id AS doc_id", "concat('the w', id % 7, ' of x') AS text"), [], maxent_lm._gathered

    def noted(texts, model, expected):
        out = gathered(texts, model, expected)
        summed.append((expected, texts.count(), round(out.sum() / maxent_lm.ACTIVE, 1)))
        return out

    monkeypatch.setattr(maxent_lm, "_gathered", noted)
    rows = score_texts(docs).collect()
    n = sum(not r["held_out"] for r in rows)
    assert summed == [(False, n, 5 * n), (True, n, 5 * n), (True, n, 5 * n)]  # four words and the end each


def test_hosts_are_split_by_all_words(spark):
    page = " ".join("q" + "".join(chr(97 + i // 26**k % 26) for k in range(4)) for i in range(60_000)) + " rare shopping"
    counts = unigrams(spark.createDataFrame([(page,)], "html string"), "html")
    hosts = spark.createDataFrame([("rareshopping.x9",), ("rareshopping.x9",), ("",)], "host string")
    assert {r["host"]: r["words"] for r in host_words(hosts, counts).collect()} == {
        "rareshopping.x9": ["rare", "shopping", "x", "#1"], "": []}
