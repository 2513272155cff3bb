"""Conversation structure repair by bidirectional Dijkstra over the edit lattice.

A lattice node is ``(rows consumed, state)``, the state being what the repaired conversation ends with: nothing, a
leading system row, a user row or an assistant row.  Edges are the edits of the next row (keep 0, re-role 2, delete 3;
an undeleted truncated row costs 1 more) and the insertion of an empty row (2).  A conversation is whole when it is an
optional system row followed by user-assistant pairs, or empty.

One search runs forward from the start, one backward from both ends that are allowed.  Each settles nodes by cost; of
equal costs it keeps the ASCII-least string of edit initials (forward the least prefix, backward the least suffix: at
one node no prefix of equal cost can begin another, so least parts make a least whole).  They stop once the two lowest
open costs add up to more than the best meeting, by when every cheapest path has a meeting edge whose ends are settled;
the least concatenation of them is the audit.

Spark groups the rows by conversation and sorts them; each task repairs its conversations one by one, holding a handful
of numbers per node.  A conversation is one row there and must fit a task's memory.

Rows go by turn, null turns first; rows of equal turn by role and text.  Nulls and odd inputs: a null role or text is one
space; roles are known by their first character, an empty or other role cannot be kept; a null conversation id is a
conversation of its own; repeated rows are duplicates; other columns are ignored; a table without rows gives none.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLANK = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
#: Roles by state, and what each state takes next: initial to state.
_ROLE = {_USER: "user", _ASSISTANT: "assistant"}
_TAKES = {_START: {"s": _SYSTEM, "u": _USER}, _SYSTEM: {"u": _USER}, _USER: {"a": _ASSISTANT}, _ASSISTANT: {"u": _USER}}
#: The state that a re-roled or inserted row leads to.
_MAKES = {_START: _USER, _SYSTEM: _USER, _USER: _ASSISTANT, _ASSISTANT: _USER}
REPAIRED = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
            "repaired array<struct<role:string,text:string>>")


def faults(rows: list[tuple[str, str]]) -> list[str]:
    """The first fault of each ``(role, text)``: blank, duplicate, truncated or none (empty)."""
    seen, out = set(), []
    for role, text in rows:
        core = text.strip(BLANK)
        fault = "" if core and core[-1] in ".!?" else "truncated"
        out.append("blank" if not core else "duplicate" if (role, text) in seen else fault)
        seen.add((role, text))
    return out


class _Lattice:
    """Nodes are numbered ``4 * rows consumed + state``."""

    def __init__(self, initials: list[str], fault: list[str]):
        self.initials, self.n = initials, len(initials)
        self.gone = [f in ("blank", "duplicate") for f in fault]
        self.extra = [TRUNCATED if f == "truncated" else 0 for f in fault]
        self.ends = (4 * self.n + _START, 4 * self.n + _ASSISTANT)

    def after(self, node: int) -> Iterator[tuple[int, int, str]]:
        """Edges ``(node, cost, initial)`` out of ``node``."""
        i, state = divmod(node, 4)
        yield 4 * i + _MAKES[state], INSERT, "I"
        if i < self.n:
            yield node + 4, DELETE, "D"
            if not self.gone[i]:
                kept = _TAKES[state].get(self.initials[i])
                if kept is not None:
                    yield 4 * i + 4 + kept, KEEP + self.extra[i], "K"
                yield 4 * i + 4 + _MAKES[state], REROLE + self.extra[i], "R"

    def before(self, node: int) -> Iterator[tuple[int, int, str]]:
        """Edges ``(node, cost, initial)`` into ``node``."""
        i, state = divmod(node, 4)
        for other in range(4):
            if _MAKES[other] == state:
                yield 4 * i + other, INSERT, "I"
        if i:
            yield node - 4, DELETE, "D"
            if not self.gone[i - 1]:
                for other in range(4):
                    if _TAKES[other].get(self.initials[i - 1]) == state:
                        yield 4 * i - 4 + other, KEEP + self.extra[i - 1], "K"
                    if _MAKES[other] == state:
                        yield 4 * i - 4 + other, REROLE + self.extra[i - 1], "R"


class _Side:
    """One search: ``cost``, the ``edit`` by which a node was reached and the node ``from`` which, and the open heap.

    Edits that cost nothing always consume a row, so nodes of equal cost are settled in the order of consumed rows.
    """

    def __init__(self, order: int, starts: tuple[int, ...]):
        self.order, self.heap = order, []
        self.cost, self.edit, self.came, self.depth, self.settled = {}, {}, {}, {}, set()
        for node in starts:
            self.reach(node, 0, "", -1)

    def reach(self, node: int, cost: int, edit: str, came: int) -> None:
        self.cost[node], self.edit[node], self.came[node] = cost, edit, came
        self.depth[node] = self.depth[came] + 1 if edit else 0
        heapq.heappush(self.heap, (cost, self.order * (node // 4), node))

    def top(self) -> float:
        while self.heap and (self.heap[0][2] in self.settled or self.cost[self.heap[0][2]] < self.heap[0][0]):
            heapq.heappop(self.heap)
        return self.heap[0][0] if self.heap else float("inf")

    def settle(self) -> int:
        node = heapq.heappop(self.heap)[2]
        self.settled.add(node)
        return node

    def path(self, node: int) -> list[str]:
        """Edits from ``node`` back to where this search began."""
        out = []
        while self.edit[node]:
            out.append(self.edit[node])
            node = self.came[node]
        return out

    def prefix_before(self, a: int, edit: str, node: int) -> bool:
        """Whether the path to ``a`` with ``edit`` sorts before the known path to ``node``; both walk to where they part."""
        b, new, old = self.came[node], [edit], [self.edit[node]]
        while a != b:
            if self.depth[a] >= self.depth[b]:
                new.append(self.edit[a])
                a = self.came[a]
            else:
                old.append(self.edit[b])
                b = self.came[b]
        return new[::-1] < old[::-1]


def cheapest_edits(initials: list[str], fault: list[str]) -> tuple[int, str]:
    """Cost and audit of the cheapest repair, the ASCII-least among equals."""
    lattice = _Lattice(initials, fault)
    there, back = _Side(1, (0,)), _Side(-1, lattice.ends)
    best = 0 if 0 in lattice.ends else float("inf")
    # both ends are settled first: the meeting edge of a path is then the one into its first node settled from behind
    while len(back.settled) < 2 or there.top() + back.top() <= best:
        if len(back.settled) >= 2 and (there.top(), len(there.settled)) <= (back.top(), len(back.settled)):
            node = there.settle()
            cost = there.cost[node]
            for to, w, edit in lattice.after(node):
                known = there.cost.get(to, float("inf"))
                if cost + w < known or (cost + w == known and to not in there.settled
                                        and there.prefix_before(node, edit, to)):
                    there.reach(to, cost + w, edit, node)
                best = min(best, cost + w + back.cost.get(to, float("inf")))
        else:
            node = back.settle()
            cost = back.cost[node]
            for to, w, edit in lattice.before(node):
                known = back.cost.get(to, float("inf"))
                # edits out of a node all differ, so the first one decides between two suffixes
                if cost + w < known or (cost + w == known and to not in back.settled and edit < back.edit[to]):
                    back.reach(to, cost + w, edit, node)
                best = min(best, cost + w + there.cost.get(to, float("inf")))
    met = [back.path(0)] if 0 in back.settled and back.cost[0] == best else []
    for node in there.settled - back.settled:
        for to, w, edit in lattice.after(node):
            if to in back.settled and there.cost[node] + w + back.cost[to] == best:
                met.append([*there.path(node)[::-1], edit, *back.path(to)])
    return int(best), "".join(min(met))


def apply_edits(rows: list[tuple[str, str]], audit: str) -> list[tuple[str, str]]:
    """The repaired ``(role, text)`` rows."""
    state, at, out = _START, 0, []
    for edit in audit:
        if edit == "I":
            state = _MAKES[state]
            out.append((_ROLE[state], ""))
            continue
        role, text = rows[at]
        at += 1
        if edit == "R":
            state = _MAKES[state]
            out.append((_ROLE[state], text))
        elif edit == "K":
            state = _TAKES[state][role[:1]]
            out.append((role, text))
    return out


def _repair(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in it:
        turns = batch.column(1)
        ends = turns.offsets.to_pylist()
        turn, role, text = (turns.values.field(i) for i in range(3))
        cols: list[list] = [[] for _ in range(7)]
        sizes, roles, texts = [0], [], []
        for first, last in zip(ends, ends[1:], strict=False):
            own = list(zip(role[first:last].to_pylist(), text[first:last].to_pylist(), strict=True))
            when = {t for t in turn[first:last].to_pylist() if t is not None}
            fault, initials = faults(own), [r[:1] for r, _ in own]
            pairs = [a + b for a, b in zip(initials, initials[1:], strict=False)]
            cost, audit = cheapest_edits(initials, fault)
            found = (max(when) - min(when) + 1 - len(when) if when else 0, fault.count("blank"), fault.count("duplicate"),
                     fault.count("truncated"), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit)
            for col, value in zip(cols, found, strict=True):
                col.append(value)
            for r, t in apply_edits(own, audit):
                roles.append(r)
                texts.append(t)
            sizes.append(len(roles))
        rows = pa.StructArray.from_arrays([pa.array(roles, pa.string()), pa.array(texts, pa.string())], names=["role", "text"])
        repaired = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), rows)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(c, pa.int64()) for c in cols[:6]], pa.array(cols[6], pa.string()), repaired],
            names=["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired"])


def repair_conversations(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text") -> DataFrame:
    """One row per conversation: ``conv_id``, counts of ``gaps`` in the turns, of ``blank``, ``duplicate`` and
    ``truncated`` rows and of ``illegal`` neighbours, ``cost`` and ``audit`` of the repair and the ``repaired`` rows."""
    turn = F.struct(F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(role_col), F.lit(" ")).alias("role"),
                    F.coalesce(F.col(text_col), F.lit(" ")).alias("text"))
    grouped = rows.groupBy(F.col(conv_col).cast("long").alias("conv_id")).agg(
        F.sort_array(F.collect_list(turn)).alias("turns"))
    return grouped.mapInArrow(_repair, f"conv_id long, {REPAIRED}")


def damaged(rows: DataFrame) -> DataFrame:
    """``conversations`` rows with faults that depend on conversation and turn only, about four rows in twenty of them."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    text = F.coalesce("text", F.lit(" "))
    kind = F.crc32(key) % 20
    return (rows.select("conv_id", "turn", kind.alias("kind"),
                        F.when(kind == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
                        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"))
            .filter("kind <> 0")
            .withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
            .drop("kind", "copy"))


def repair_digest(ids: DataFrame, repaired: DataFrame) -> DataFrame:
    """The repairs with a digest in place of the rows, for every conversation of ``ids``; zeros for one without rows."""
    joined = F.array_join(F.transform("repaired", lambda r: F.concat(r["role"], F.lit(":"), r["text"])), "\n")
    ids = ids.select(F.col("conv_id").cast("long").alias("id_")).distinct()
    out = ids.join(repaired, F.col("id_").eqNullSafe(F.col("conv_id")), "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return out.select(F.col("id_").alias("conv_id"), *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.sha2(F.coalesce(joined, F.lit("")).cast("binary"), 256).alias("repaired_sha256"))


#: The same by dynamic programming over the rows, a state of the conversation at a time, in DuckDB SQL.
REPAIR_SQL = r"""WITH RECURSIVE
    src AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        xor(list_reduce(list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
            lambda x: ascii(x)::BIGINT), lambda a, b: list_reduce([0, 1, 2, 3, 4, 5, 6, 7]::BIGINT[],
            lambda c, d: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, xor(a, b)), 4294967295::BIGINT),
            4294967295) % 20 AS kind FROM conversations),
    hurt AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN ''
        WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
        FROM src, range(2) c(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)),
    placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
        regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS core FROM hurt),
    rows AS (SELECT conv_id, turn, i, role, text, left(role, 1) AS ini, CASE WHEN core = '' THEN 'blank'
        WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate' WHEN right(core, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
        lead(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS following FROM placed),
    counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (following IS NOT NULL
            AND ini || following NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM rows GROUP BY conv_id),
    pads(a, b, extra, marks, lines) AS (VALUES ('0', '0', 0, '', []), ('s', 's', 0, '', []), ('u', 'u', 0, '', []),
        ('a', 'a', 0, '', []), ('0', 'u', 2, 'I', ['user:']), ('s', 'u', 2, 'I', ['user:']),
        ('u', 'a', 2, 'I', ['assistant:']), ('a', 'u', 2, 'I', ['user:']), ('0', 'a', 4, 'II', ['user:', 'assistant:']),
        ('s', 'a', 4, 'II', ['user:', 'assistant:'])),
    steps(b, to_, ini, cost, mark, made) AS (VALUES ('0', 's', 's', 0, 'K', NULL), ('0', 'u', 'u', 0, 'K', NULL),
        ('s', 'u', 'u', 0, 'K', NULL), ('a', 'u', 'u', 0, 'K', NULL), ('u', 'a', 'a', 0, 'K', NULL),
        ('0', 'u', NULL, 2, 'R', 'user'), ('s', 'u', NULL, 2, 'R', 'user'), ('a', 'u', NULL, 2, 'R', 'user'),
        ('u', 'a', NULL, 2, 'R', 'assistant'), ('0', '0', NULL, 3, 'D', NULL), ('s', 's', NULL, 3, 'D', NULL),
        ('u', 'u', NULL, 3, 'D', NULL), ('a', 'a', NULL, 3, 'D', NULL)),
    best AS (SELECT conv_id, 0::BIGINT AS i, '0' AS state, 0::BIGINT AS cost, '' AS audit, []::VARCHAR[] AS lines FROM counts
        UNION ALL SELECT conv_id, i, state, cost, audit, lines FROM (SELECT *, row_number() OVER (
            PARTITION BY conv_id, state ORDER BY cost, audit) AS nth FROM (SELECT r.conv_id, r.i, s.to_ AS state,
            b.cost + p.extra + s.cost + CASE WHEN r.fault = 'truncated' AND s.mark <> 'D' THEN 1 ELSE 0 END AS cost,
            b.audit || p.marks || s.mark AS audit, list_concat(list_concat(b.lines, p.lines), CASE s.mark
                WHEN 'D' THEN [] ELSE [coalesce(s.made, r.role) || ':' || r.text] END) AS lines
            FROM best b JOIN rows r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.i = b.i + 1
            JOIN pads p ON p.a = b.state JOIN steps s ON s.b = p.b AND (s.ini IS NULL OR s.ini = r.ini)
                AND (s.mark = 'D' OR r.fault NOT IN ('blank', 'duplicate')))) WHERE nth = 1),
    ended AS (SELECT b.conv_id, b.cost + p.extra AS cost, b.audit || p.marks AS audit, list_concat(b.lines, p.lines) AS lines
        FROM best b JOIN counts c ON c.conv_id IS NOT DISTINCT FROM b.conv_id AND c.n = b.i
        JOIN pads p ON p.a = b.state AND p.b IN ('0', 'a')),
    least AS (SELECT * FROM ended QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY cost, audit) = 1)
    SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
        coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
        coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit,
        sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
    LEFT JOIN least l ON l.conv_id IS NOT DISTINCT FROM o.conv_id"""
