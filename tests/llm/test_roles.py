from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tidebook.llm import roles
from tidebook.llm.queries import op11_role_repair

SPACES = " \t\n\x0b\x0c\r"
# Two-letter states of the target pattern: nothing, an opening s, an open pair, a closed pair.
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
NAMES = {"u": "user", "a": "assistant"}
SCHEMA = "conv_id long, turn long, role string, text string, audit int, run string"


def _after_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        fate = zlib.crc32(":".join(" " if v is None else str(v) for v in (conv, turn)).encode()) % 20
        if fate:
            text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
            out += [(turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    return sorted(out, key=lambda d: (d[0] is not None, d[0] or 0, d[1], hashlib.md5(d[2].encode()).digest()))


def _faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        solid = text.strip(SPACES)
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""
        out.append(fault)
        seen.add((role, text))
    return out


def _cheapest(rows, faults):
    """Every edit of every row from every state, with whole audits and whole results."""

    def better(found, state, one):
        if state not in found or one[:2] < found[state][:2]:
            found[state] = one
            return True
        return False

    def with_inserts(found):
        while any(
            better(found, NEXT[state, i], (cost + 2, audit + "I", (*out, (NAMES[i], ""))))
            for state, (cost, audit, out) in list(found.items())
            for i in "ua"
            if (state, i) in NEXT
        ):
            pass
        return found

    found = {"": (0, "", ())}
    for (_, role, text), fault in zip(rows, faults, strict=True):
        late, after = int(fault == "truncated"), {}
        for state, (cost, audit, out) in with_inserts(found).items():
            better(after, state, (cost + 3, audit + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            for letter, price, initial, name in [("K", 0, role[:1], role), ("R", 2, "u", "user"), ("R", 2, "a", "assistant")]:
                if (state, initial) in NEXT:
                    better(after, NEXT[state, initial], (cost + price + late, audit + letter, (*out, (name, text))))
        found = after
    return min(one for state, one in with_inserts(found).items() if state in ("", "a"))


def plain_repair(rows):
    """conv_id and the other columns of the contract, one conversation at a time."""
    out = {}
    for conv in {r[0] for r in rows}:
        left = _after_damage([r for r in rows if r[0] == conv])
        faults, turns = _faults(left), [t for t, _, _ in left if t is not None]
        initials = [role[:1] for _, role, _ in left]
        cost, audit, repaired = _cheapest(left, faults)
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost,
            audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest(),
        )
    return out


def _rows(df):
    return [(r.conv_id, r.turn, r.role, r.text) for r in df.select("conv_id", "turn", "role", "text").collect()]


def _digest(df):
    rows = df.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r)[1:] for r in rows}


def test_whole_table(spark):
    rows = _rows(spark.read.parquet("/root/testdata/sf0.01/conversations.parquet"))
    assert _digest(op11_role_repair(spark, "/root/testdata/sf0.01")) == plain_repair(rows)


def _awkward(spark):
    """Null ids, turns, roles and texts, ties, repeats, foreign roles, one long conversation, clashing columns."""
    rnd, rows = random.Random(5), []
    for conv in [*range(60), None]:
        for k in range(rnd.randrange(0, 12)):
            role = rnd.choice(["user", "assistant", "system", "tool", None, "", "user", "assistant"])
            text = rnd.choice([None, "", ".", "a.", "b.", "c?", "d", "e ", "f.\n", "x" * 5000 + "!"])
            rows.append((conv, rnd.choice([None, 1, 2, 9, k, k, k]), role, text))
    rows += [
        (777, k, rnd.choice(["user", "assistant"]), "again." if k % 3 == 0 else f"text {k}" + rnd.choice([".", ""]))
        for k in range(600)
    ]
    return spark.createDataFrame([(*r, 3, "clash") for r in rows], SCHEMA)


@pytest.mark.parametrize("run_rows", [2, 7, 4096])
def test_awkward_rows_in_runs_of_any_size(spark, monkeypatch, run_rows):
    monkeypatch.setattr(roles, "_RUN_ROWS", run_rows)
    df = _awkward(spark)
    assert _digest(roles.repair_digest(df)) == plain_repair(_rows(df))


def test_empty_table(spark):
    assert roles.repair_digest(_awkward(spark).limit(0)).collect() == []


def test_every_table_of_a_run_equals_the_whole_parse():
    """Parsing two halves by their tables gives the same as parsing all rows at once."""
    rnd = random.Random(3)
    for _ in range(200):
        rows = [
            (rnd.choice("suatx"), rnd.choice([0, 0, 1]), rnd.random() < 0.8, rnd.random() < 0.3)
            for _ in range(rnd.randrange(1, 9))
        ]
        cut = rnd.randrange(len(rows) + 1)
        whole = roles.parse_run(rows, 0)
        joined = {}
        for middle, (cost, audit) in roles.parse_run(rows[:cut], 0).items():
            for end, (more, rest) in roles.parse_run(rows[cut:], middle).items():
                one = (cost + more, audit + rest)
                joined[end] = min(joined.get(end, one), one)
        assert joined == whole


def test_a_hot_conversation_is_spread_over_tasks(spark):
    """One conversation of most rows lies in many stretches, and repaired rows alternate in its order."""
    rows = [(1, k, "user" if k % 2 == 0 else "assistant", f"text {k}.") for k in range(20_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("copies", F.lit(1))
    messages, summaries = roles.repair(df)
    assert messages.select("run").distinct().count() >= 5
    ordered = [r.role for r in messages.orderBy("run", "place").collect()]
    assert ordered == ["user", "assistant"] * 10_000
    assert [(r.cost, r.audit) for r in summaries.collect()] == [(0, "K" * 20_000)]
