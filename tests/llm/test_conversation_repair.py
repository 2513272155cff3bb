"""The bidirectional search against a plain fixpoint, and conversations with odd inputs."""

from __future__ import annotations

import random
import re

from conftest import SF001
from eventspark.llm import queries
from eventspark.llm.conversation_repair import _Lattice, apply_edits, cheapest_edits, damaged, faults, repair_conversations


def plain(initials, fault):
    """Least (cost, audit) of every node to an end, relaxed until nothing changes."""
    lattice = _Lattice(initials, fault)
    best = {node: (0, "") for node in lattice.ends}
    changed = True
    while changed:
        changed = False
        for node in range(4 * len(initials) + 3, -1, -1):
            for to, w, edit in lattice.after(node):
                if to in best and (new := (best[to][0] + w, edit + best[to][1])) < best.get(node, (10**9, "")):
                    best[node], changed = new, True
    return best[0]


def test_search_matches_plain():
    rng = random.Random(2)
    for _ in range(3000):
        n = rng.randrange(0, 10)
        initials = [rng.choice(["s", "u", "a", "u", "a", "x", ""]) for _ in range(n)]
        fault = [rng.choice(["", "", "blank", "duplicate", "truncated"]) for _ in range(n)]
        cost, audit = cheapest_edits(initials, fault)
        assert (cost, audit) == plain(initials, fault)
        rows = [(i, f"t{k}") for k, i in enumerate(initials)]
        assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in apply_edits(rows, audit)))


def test_long_conversations():
    rng = random.Random(6)
    whole = ["s"] + ["u", "a"] * 15_000
    assert cheapest_edits(whole, [""] * len(whole)) == (0, "K" * len(whole))
    initials = [rng.choice("sua") for _ in range(3000)]
    fault = [rng.choice(["", "", "blank", "truncated"]) for _ in initials]
    assert cheapest_edits(initials, fault) == plain(initials, fault)


def test_faults():
    rows = [("user", "Hi."), ("user", "Hi."), ("assistant", "Hi."), ("user", " \t"), ("user", " \t"), ("user", "Hi. \n"),
            ("user", "no end"), ("user", "¿é")]
    assert faults(rows) == ["", "duplicate", "", "blank", "blank", "", "truncated", "truncated"]


def test_odd_rows(spark):
    rows = [(1, 0, "user", "Ask."), (1, 3, "assistant", "Say."), (1, None, "system", "Be."),
            (2, 5, None, None), (2, 5, "tool", "x."), (3, None, "assistant", "Only!"), (None, 1, "user", "Null id?"),
            (4, 1, "", "no role."), (4, 2, "assistant", "fine.")]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, audit string")
    got = {r["conv_id"]: r for r in repair_conversations(df).collect()}
    assert got[1]["audit"] == "KKK" and got[1]["gaps"] == 2 and got[1]["illegal"] == 0
    assert (got[2]["blank"], got[2]["illegal"], got[2]["audit"], got[2]["cost"]) == (1, 1, "DD", 6)
    assert [tuple(r) for r in got[3]["repaired"]] == [("user", ""), ("assistant", "Only!")] and got[3]["gaps"] == 0
    assert got[None]["audit"] == "KI" and got[4]["audit"] == "RK"
    assert repair_conversations(df.limit(0)).count() == 0


def test_damage_and_every_conversation(spark):
    ids = {r[0] for r in spark.read.parquet(f"{SF001}/conversations.parquet").select("conv_id").collect()}
    got = queries.op13_conversation_repair(spark, SF001).collect()
    assert sorted(r["conv_id"] for r in got) == sorted(ids)
    gone = spark.createDataFrame([(c, t, "user", "x.") for c in range(60) for t in range(1)], "conv_id long, turn long, role string, text string")
    left = {r[0] for r in damaged(gone).select("conv_id").collect()}
    digests = {r["conv_id"]: r for r in queries.repair_digest(gone, repair_conversations(damaged(gone))).collect()}
    assert len(left) < len(digests) == 60
    empty = next(r for c, r in digests.items() if c not in left)
    assert tuple(empty)[1:8] == (0, 0, 0, 0, 0, 0, "")
    assert empty["repaired_sha256"] == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
