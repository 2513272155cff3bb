"""Mixing sources to target weights by iterative proportional fitting, with DataFrame functions only.

Documents are summed into cells (source, language, topic).  Each cell starts with the same inclusion probability and is
raked in turn to the token targets of every dimension: multiplied by target over current total of its category, then
held at 1 (a document is taken at most once).  After ``rounds`` sweeps a document is sampled if a hash of its id lies
below its cell's probability, so the same document gets the same decision in any run.

Only sums per category (combined map-side) and the cell table are shuffled; the joins back to the cells and to the
documents are plain equi-joins on null-safe keys, which Spark broadcasts only where the measured size allows and splits
where one category holds much of the rows.  Each step is written to the shared checkpoint folder.

Nulls and odd inputs: a null source, language or topic is a category of its own; a null text has no tokens; a null id
is hashed as the word "null"; repeated ids share their decision; a category without tokens keeps its probability; of
other columns those named like an added one are replaced, all others stay as they are.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventspark.session import reliable_checkpoint


@dataclass(frozen=True)
class Target:
    """Wanted token shares of one dimension's categories.

    ``weights`` gives relative weights by category (others get ``other``); without it, a category's weight is its
    token count to the power ``temper`` (1: as it is, 0: all alike).
    """
    weights: Mapping[str, float] = field(default_factory=dict)
    other: float = 1.0
    temper: float = 1.0

    def weight(self, category: str, tokens: str) -> Column:
        if not self.weights:
            return F.pow(F.col(tokens).cast("double"), F.lit(self.temper))
        out = F
        for name, w in self.weights.items():
            out = out.when(F.col(category) == name, F.lit(float(w)))
        return out.otherwise(F.lit(self.other))


def n_words(text: Column) -> Column:
    """Number of runs outside 0x20 and 0x09-0x0D; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def topic(text: Column) -> Column:
    """A coarse topic from declarative rules, the first that fits."""
    return (F.when(text.contains(" | "), "table").when(text.contains("icense"), "license")
            .when(text.contains("@"), "contact").when(F.length(text) < 800, "note")
            .when(F.length(text) < 4000, "article").when(text.isNotNull(), "book"))


def cell_probabilities(cells: DataFrame, targets: Mapping[str, Target], keep: float, rounds: int) -> DataFrame:
    """``cells`` (one column per dimension, ``tokens``) with the raked inclusion probability ``p``."""
    dims = list(targets)
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    for d in dims:
        sums = cells.groupBy(F.col(d).alias("category")).agg(F.sum("tokens").alias("all"))
        sums = sums.select("category", targets[d].weight("category", "all").alias("w"))
        whole = sums.agg(F.sum("w")).first()[0] or 1.0
        wanted = sums.select("category", (F.col("w") * keep * total / whole).alias(f"target_{d}"))
        cells = reliable_checkpoint(cells.join(wanted, cells[d].eqNullSafe(wanted["category"])).drop("category"))
    cells = cells.withColumn("p", F.lit(float(keep)))
    others = [c for c in cells.columns if c != "p"]
    for _ in range(rounds):
        for d in dims:  # one aggregate and one join a step
            now = cells.groupBy(F.col(d).alias("category")).agg(F.sum(F.col("p") * F.col("tokens")).alias("now"))
            ratio = F.when(F.col("now") > 0, F.col(f"target_{d}") / F.col("now")).otherwise(1.0)
            p = F.col("p") * ratio
            cells = reliable_checkpoint(cells.join(now, cells[d].eqNullSafe(now["category"])).select(
                *others, (F.least(p, F.lit(1.0)) if d == dims[-1] else p).alias("p")))
    return cells.select(*dims, "tokens", "p")


def unit_hash(key: Column, seed: str) -> Column:
    """A number in [0, 1) from 52 bits of an MD5 digest."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def mix_sources(docs: DataFrame, targets: Mapping[str, Target], keep: float = 0.5, rounds: int = 6, seed: str = "mix",
                id_col: str = "doc_id", text_col: str = "text", topic_of=topic) -> DataFrame:
    """``docs`` with ``mix_topic, mix_tokens, mix_weight, mix_p, mix_sampled``.

    ``targets`` maps ``source``, ``lang`` and ``topic`` to their :class:`Target`; ``keep`` is the share of all tokens
    to sample.  ``mix_weight`` is the raked weight of a token (probability over ``keep``).
    """
    column = {d: F.col(d) for d in targets if d != "topic"} | {"topic": topic_of(F.col(text_col))}
    own = [F.col(f"`{c}`") for c in docs.columns]  # in one column, out of the way of the names used here
    keyed = docs.select(F.struct(*own).alias("doc"), F.col(id_col).alias("id"), n_words(F.col(text_col)).alias("words"),
                        *[column[d].alias(f"of_{d}") for d in targets])
    cells = keyed.groupBy(*[F.col(f"of_{d}").alias(d) for d in targets]).agg(F.sum("words").alias("tokens"))
    cells = cell_probabilities(reliable_checkpoint(cells), targets, keep, rounds)
    same = F.lit(True)
    for d in targets:
        same = same & F.col(f"of_{d}").eqNullSafe(F.col(d))
    p = F.round("p", 9)
    added = {"mix_tokens": F.col("words"), "mix_weight": p / F.lit(float(keep)), "mix_p": p,
             "mix_sampled": unit_hash(F.col("id"), seed) < p}
    if "topic" in targets:
        added = {"mix_topic": F.col("of_topic")} | added
    return keyed.join(cells, same).select(*[F.col(f"doc.`{c}`") for c in docs.columns if c not in added],
                                          *[v.alias(k) for k, v in added.items()])


def mixing_sql(targets: Mapping[str, Target], keep: float = 0.5, rounds: int = 6, seed: str = "mix") -> str:
    """DuckDB SQL of :func:`mix_sources` over ``documents``, for checking."""
    dims = list(targets)
    weight = {}
    for d, t in targets.items():
        if t.weights:
            weight[d] = "CASE " + " ".join(f"WHEN {d} = '{k}' THEN {float(w)}" for k, w in t.weights.items())
            weight[d] += f" ELSE {t.other} END"
        else:
            weight[d] = f"pow(sum(tokens)::DOUBLE, {t.temper})"
    steps = ["""keyed AS (SELECT doc_id, source, lang, CASE WHEN contains(text, ' | ') THEN 'table'
        WHEN contains(text, 'icense') THEN 'license' WHEN contains(text, '@') THEN 'contact'
        WHEN length(text) < 800 THEN 'note' WHEN length(text) < 4000 THEN 'article'
        WHEN text IS NOT NULL THEN 'book' END AS topic,
        coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS tokens FROM documents)""",
             f"c0 AS (SELECT {', '.join(dims)}, sum(tokens)::DOUBLE AS tokens, {keep}::DOUBLE AS p FROM keyed "
             f"GROUP BY {', '.join(dims)})"]
    for d in dims:
        steps.append(f"w_{d} AS (SELECT {d} AS category, {weight[d]} AS w FROM c0 GROUP BY {d})")
        steps.append(f"t_{d} AS (SELECT category, w * {keep} * (SELECT sum(tokens) FROM c0) / "
                     f"(SELECT sum(w) FROM w_{d}) AS target FROM w_{d})")
    n = 0
    for _ in range(rounds):
        for d in dims:
            p = (f"p * CASE WHEN sum(p * tokens) OVER (PARTITION BY {d}) > 0 "
                 f"THEN target / sum(p * tokens) OVER (PARTITION BY {d}) ELSE 1.0 END")
            if d == dims[-1]:
                p = f"least({p}, 1.0)"
            steps.append(f"c{n + 1} AS (SELECT {', '.join(dims)}, tokens, {p} AS p FROM c{n} "
                         f"JOIN t_{d} ON {d} IS NOT DISTINCT FROM category)")
            n += 1
    same = " AND ".join(f"k.{d} IS NOT DISTINCT FROM c.{d}" for d in dims)
    return f"""WITH {', '.join(steps)}
    SELECT k.doc_id, k.topic, k.tokens::BIGINT AS tokens, round(c.p, 6) AS probability,
           round(c.p / {keep}, 6) AS weight,
           ('0x' || substr(md5('{seed}:' || coalesce(k.doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE
             / {float(1 << 52)} < round(c.p, 9) AS sampled
    FROM keyed k JOIN c{n} c ON {same}"""
